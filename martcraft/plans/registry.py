"""Driver queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query starts from the given tables (``lineitem`` as transactions,
joined to ``orders`` and ``part``) and runs over all of their rows. Audit
timestamps (``current_timestamp()``) are left out so results are comparable.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.config import Bands, Ladder, QualityParams, TierLadder
from martcraft.operators.catalog import (
    DIM_CUSTOMERS, DIM_PRODUCTS, FACT, MONTHLY, SOURCE, STAGING, declared_checks,
)
from martcraft.operators.cleaning import clean_transactions, null_profile, reject_counts
from martcraft.operators.dimensions import dim_customers, dim_products
from martcraft.operators.fact import fact_transactions
from martcraft.operators.monthly import monthly_sales
from martcraft.operators.cleaning import RAW_COLUMNS
from martcraft.operators.quality import (
    WriteCounts, accepted_range, accepted_values, failing_rows, freshness, load_profile, not_null, null_shares, relationships,
    run_checks, unique, unique_combination,
)
from martcraft.operators.reports import monthly_trend, product_by_tier, rows_per_source, top_customers
from martcraft.functions.cleaning import clean_prefixed_id, na_to_null
from martcraft.operators.staging import stage_transactions, valid_transactions
from martcraft.plans.incremental import IncrementalMarts
from martcraft.plans.materialize import materialize
from martcraft.plans.rebuild import with_load_checks
from martcraft.plans.refresh import append_incremental, read_target, rows_after_high_water
from martcraft.session import checkpoint_dir
from martcraft.sources.driver import driver_lines, driver_raw_transactions, driver_transactions, written_id

# Fixed values for the driver tables: reporting date after the last order
# (2001-08-01), and bounds rescaled to the amounts of those tables (their
# prices are about 900-1000 per unit, so the project's defaults would put
# every row in the top band).
AS_OF = "2001-08-05"
DRIVER_BANDS = Bands(
    value_segment=Ladder(">=", ((1200000, "VIP"), (900000, "High Value"), (600000, "Medium Value")), "Low Value"),
    frequency_segment=Ladder(">=", ((50, "Very Frequent"), (35, "Frequent"), (25, "Occasional")), "Rare"),
    aov_tier=Ladder(">=", ((25000, "High AOV"), (22000, "Medium AOV")), "Low AOV"),
    customer_tier=TierLadder(((1200000, 45, "Platinum"), (900000, 35, "Gold"), (600000, 25, "Silver")), "Bronze"),
    revenue_segment=Ladder(
        ">=", ((900000, "Star Product"), (750000, "High Performer"), (600000, "Medium Performer")), "Low Performer"
    ),
    volume_segment=Ladder(">=", ((900, "High Volume"), (700, "Medium Volume")), "Low Volume"),
    price_tier=Ladder(">=", ((975, "Premium"), (940, "Mid-Range")), "Value"),
)


class Star:
    """The star schema of one sf folder.

    Layers listed in ``keep`` are materialized once (Parquet under the shared
    checkpoint folder) because several consumers read them; the others stay
    lazy so a single-consumer query remains one plan. ``columns`` names the
    cleaned columns that the query needs; only those are written. Row checks among
    ``checks`` are counted (``counts``) by the writes of all columns. ``by_customer``
    is for queries that aggregate an unwritten fact by customer.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = AS_OF, bands: Bands = DRIVER_BANDS,
                 dirty: bool = False, audit: bool = False, keep: tuple[str, ...] = (), columns: tuple[str, ...] = (), checks: tuple = (), by_customer: bool = False):
        self.counts = WriteCounts(checks)
        if dirty:
            self.raw = driver_raw_transactions(spark, sf_dir)
            cleaned = clean_transactions(self.raw)
        else:
            cleaned = driver_transactions(spark, sf_dir)
        if columns:
            other = {f.name: f.dataType for f in cleaned.schema.fields if f.name not in columns}
            cleaned = materialize(cleaned.select(*columns), "cleaned") if "cleaned" in keep else cleaned.select(*columns)
            cleaned = cleaned.withColumns({c: F.lit(None).cast(t) for c, t in other.items()})  # read by nothing
        elif "cleaned" in keep:
            cleaned = materialize(cleaned, "cleaned", counters=lambda df: with_load_checks(df, self.counts))
        self.cleaned = cleaned
        self.stg = stage_transactions(self.cleaned)
        self.customers = dim_customers(self.stg, as_of, bands, audit=audit)
        self.products = dim_products(self.stg, as_of, bands, audit=audit)
        if "dims" in keep:
            self.customers = materialize(self.customers, "dim_customers", counters=self._counted(DIM_CUSTOMERS))
            self.products = materialize(self.products, "dim_products", counters=self._counted(DIM_PRODUCTS))
        self.fact = fact_transactions(self.stg, self.customers, self.products, audit=audit, customer_last=by_customer, by_month="fact" in keep)
        if "fact" in keep:
            self.fact = materialize(self.fact, "fact_transactions", ("transaction_month",), self._counted(FACT), dealt=True)
        self.monthly = monthly_sales(self.fact, audit=audit)
        if "monthly" in keep:
            self.monthly = materialize(self.monthly, "agg_monthly_sales", counters=self._counted(MONTHLY))

    def _counted(self, model: str) -> Callable[[DataFrame], DataFrame]:
        return lambda df: self.counts.row_checks(df, model)

    def tables(self):
        return {SOURCE: self.cleaned, STAGING: self.stg, DIM_CUSTOMERS: self.customers,
                DIM_PRODUCTS: self.products, FACT: self.fact, MONTHLY: self.monthly}


CUSTOMER_COLUMNS = ("customer_id", "transaction_date", "product_id", "quantity", "price", "tax")
PRODUCT_COLUMNS = (*CUSTOMER_COLUMNS, "product_name")
FACT_COLUMNS = ("transaction_id", *PRODUCT_COLUMNS)


def q_stg_transactions(spark, sf_dir):
    return Star(spark, sf_dir).stg.drop("transformed_at")


def q_dim_customers(spark, sf_dir):
    return Star(spark, sf_dir, keep=("cleaned",), columns=CUSTOMER_COLUMNS).customers


def q_dim_products(spark, sf_dir):
    return Star(spark, sf_dir, keep=("cleaned",), columns=PRODUCT_COLUMNS).products.withColumn(
        "stddev_unit_price", F.round("stddev_unit_price", 6))


def q_top_customers(spark, sf_dir):
    # One consumer once the unused distinct-product join is pruned: no layer is written.
    return top_customers(Star(spark, sf_dir).customers, 10)


def q_fact_transactions(spark, sf_dir):
    return Star(spark, sf_dir, keep=("cleaned",), columns=FACT_COLUMNS).fact


def q_monthly_sales(spark, sf_dir):
    return Star(spark, sf_dir, keep=("cleaned",), columns=FACT_COLUMNS, by_customer=True).monthly


def q_monthly_trend(spark, sf_dir):
    return monthly_trend(Star(spark, sf_dir, keep=("cleaned",), columns=FACT_COLUMNS).fact)


def q_product_by_tier(spark, sf_dir):
    return product_by_tier(Star(spark, sf_dir, keep=("cleaned",), columns=FACT_COLUMNS).fact)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_transactions": q_stg_transactions,
    "dim_customers": q_dim_customers,
    "dim_products": q_dim_products,
    "top_customers": q_top_customers,
    "fact_transactions": q_fact_transactions,
    "monthly_sales": q_monthly_sales,
    "monthly_trend": q_monthly_trend,
    "product_by_tier": q_product_by_tier,
}


# ------------------------------------------------------------ cleaning path
# Freshness clock for the driver tables (newest l_shipdate is 2001-11-04),
# and the cut of the first load in the incremental example.
FRESHNESS_AS_OF = "2001-11-04 18:00:00"
FIRST_LOAD_UNTIL = "1999-12-31"


def q_raw_with_audit(spark, sf_dir):
    return driver_raw_transactions(spark, sf_dir, with_source=True).drop("loaded_at")


def q_raw_file_counts(spark, sf_dir):
    return rows_per_source(driver_lines(spark, sf_dir, with_source=True))  # counts lines: no join


def q_clean_transactions(spark, sf_dir):
    return clean_transactions(driver_raw_transactions(spark, sf_dir))


def q_clean_rejects(spark, sf_dir):
    return reject_counts(driver_raw_transactions(spark, sf_dir))


def q_null_profile(spark, sf_dir):
    return null_profile(clean_transactions(driver_raw_transactions(spark, sf_dir)))


def q_load_profile(spark, sf_dir):
    return load_profile(clean_transactions(driver_raw_transactions(spark, sf_dir)))


def q_freshness(spark, sf_dir):
    return freshness(clean_transactions(driver_raw_transactions(spark, sf_dir)), FRESHNESS_AS_OF,
                     source=SOURCE)


def q_null_shares(spark, sf_dir):
    p = QualityParams()
    return null_shares(clean_transactions(driver_raw_transactions(spark, sf_dir)), list(RAW_COLUMNS),
                       p.max_null_fraction, p.min_row_count)


def q_dim_customers_raw(spark, sf_dir):
    return Star(spark, sf_dir, dirty=True, keep=("cleaned",), columns=CUSTOMER_COLUMNS).customers


def q_dim_products_raw(spark, sf_dir):
    return Star(spark, sf_dir, dirty=True, keep=("cleaned",), columns=PRODUCT_COLUMNS).products.withColumn("stddev_unit_price", F.round("stddev_unit_price", 6))


def q_monthly_sales_raw(spark, sf_dir):
    return Star(spark, sf_dir, dirty=True, keep=("cleaned",), columns=FACT_COLUMNS, by_customer=True).monthly


def q_dq_results(spark, sf_dir):
    """The 147 declared checks: row checks counted by the jobs that write the layers, the others over the written ones."""
    checks = declared_checks(DRIVER_BANDS, QualityParams(), audit=True)
    star = Star(spark, sf_dir, dirty=True, audit=True, keep=("cleaned", "dims", "fact", "monthly"), checks=checks)
    return run_checks(star.tables(), checks, star.counts.failures())


def q_dq_unique_failures(spark, sf_dir):
    ids = driver_lines(spark, sf_dir).select(clean_prefixed_id(na_to_null(written_id()), "T").alias("transaction_id"))
    return failing_rows(unique(STAGING, "transaction_id"), {STAGING: ids})  # reads ids only: no join


# A time at which the dimensions were built last, for checks that find orphans.
STALE_DIMS_UNTIL = "1996-03-31"
KEY_COLUMNS = ("transaction_id", "customer_id", "product_id", "transaction_date", "quantity", "price")


def q_dq_relationship_failures(spark, sf_dir):
    """Child rows without a parent: the declared relationships, and all staged rows, invalid ones
    too, against dimensions that were built from the rows up to ``STALE_DIMS_UNTIL``."""
    star = Star(spark, sf_dir, dirty=True, keep=("cleaned",), columns=KEY_COLUMNS)
    valid = valid_transactions(star.stg)
    old = valid.where(F.col("transaction_date") <= F.lit(STALE_DIMS_UNTIL).cast("date"))

    def keys(rows, child, parent):
        return rows.groupBy(F.col(child).alias(parent)).agg(F.count(F.lit(1)).alias("n")).drop("n")

    # The fact's keys are those of valid rows with a product; one write of the key columns serves all checks.
    fact = valid.where("product_id is not null").select(F.col("customer_id").alias("customer_fk"), F.col("product_id").alias("product_fk"))
    tables = {FACT: fact, STAGING: star.stg, MONTHLY: star.monthly.select("customer_fk"),
              DIM_CUSTOMERS: keys(valid, "customer_id", "customer_key"), DIM_PRODUCTS: keys(valid, "product_id", "product_key"),
              "stale_customers": keys(old, "customer_id", "customer_key"), "stale_products": keys(old, "product_id", "product_key")}
    out = None
    for c in (relationships(FACT, "customer_fk", DIM_CUSTOMERS, "customer_key"),
              relationships(FACT, "product_fk", DIM_PRODUCTS, "product_key"),
              relationships(MONTHLY, "customer_fk", DIM_CUSTOMERS, "customer_key"),
              relationships(STAGING, "customer_id", "stale_customers", "customer_key"),
              relationships(STAGING, "product_id", "stale_products", "product_key")):
        rows = failing_rows(c, tables).select(F.lit(c.name).alias("check_name"), "from_field")
        out = rows if out is None else out.unionByName(rows)
    return out


def q_dq_combination_failures(spark, sf_dir):
    star = Star(spark, sf_dir, dirty=True)
    return failing_rows(unique_combination(STAGING, ("customer_id", "product_id")), star.tables())


def q_dq_severities(spark, sf_dir):
    """Checks with thresholds and severities of their own, so that every status occurs."""
    star = Star(spark, sf_dir, dirty=True, keep=("cleaned",), columns=FACT_COLUMNS)
    return run_checks(star.tables(), [
        not_null(STAGING, "tax_amount", severity="warn"),
        not_null(STAGING, "customer_id", error_if=">1000000000", warn_if=">=1"),
        not_null(STAGING, "quantity", error_if=">=1"),
        accepted_range(STAGING, "quantity", 0, 1000),
        accepted_range(STAGING, "unit_price", 0, 500, severity="warn", warn_if=">1000000000"),
        accepted_values(STAGING, "transaction_quarter", [1, 2], error_if="!=0"),
        unique_combination(STAGING, ("customer_id", "product_id"), severity="warn"),
        unique(STAGING, "product_id", error_if="<1", warn_if="<=0"),
    ])


def q_freshness_raw(spark, sf_dir):
    """The raw source, before cleaning; only load times are read."""
    return freshness(driver_lines(spark, sf_dir), FRESHNESS_AS_OF, source="raw_customer_transactions")


def q_incremental_fact(spark, sf_dir):
    # The fact is written once; both reads of it prune by date.
    fact = Star(spark, sf_dir, keep=("cleaned", "fact"), columns=FACT_COLUMNS).fact
    first_load = fact.filter(F.col("transaction_date") <= F.lit(FIRST_LOAD_UNTIL).cast("date"))
    return first_load.unionByName(rows_after_high_water(fact, first_load, "transaction_date"))


def q_incremental_fact_raw(spark, sf_dir):
    """The fact of the dirty copy in two loads by the default refresh: first the dated rows up to
    a day, except every fifth one, then all others: late ones, undated ones, and the first load's last months again."""
    fact = Star(spark, sf_dir, dirty=True, keep=("cleaned", "fact"), columns=FACT_COLUMNS).fact
    cut = F.lit(FIRST_LOAD_UNTIL).cast("date")
    first = F.coalesce((F.col("transaction_date") <= cut) & (F.col("transaction_key") % 5 != 0), F.lit(False))
    again = F.coalesce(F.col("transaction_date") > F.add_months(cut, -2), F.lit(False))
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/incremental-{uuid.uuid4().hex}"
    # The dirty copy has rows of one key (the unique check reports them); the fact keeps them all.
    # They are read month by month, as the table is partitioned.
    append_incremental(spark, fact.where(first), path, repeats="keep", dealt=True)
    append_incremental(spark, fact.where(~first | again), path, repeats="keep", dealt=True)
    return read_target(spark, path).select(*fact.columns)


def q_incremental_fact_keyed(spark, sf_dir):
    """The same two loads with one row per key: of a key's rows the latest one, and the second load's over the first's."""
    fact = Star(spark, sf_dir, dirty=True, keep=("cleaned", "fact"), columns=FACT_COLUMNS).fact
    cut = F.lit(FIRST_LOAD_UNTIL).cast("date")
    first = F.coalesce((F.col("transaction_date") <= cut) & (F.col("transaction_key") % 5 != 0), F.lit(False))
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/incremental-{uuid.uuid4().hex}"
    rows = fact.select("transaction_key", "transaction_date", "transaction_month")
    append_incremental(spark, rows.where(first), path)
    append_incremental(spark, rows.where(~first), path)
    return read_target(spark, path).select(*rows.columns)


def _loaded_in_steps(spark, sf_dir, columns, *names):
    """Marts of the dirty copy by two loads: the rows up to a day, without every fifth customer; then all others, the later and the undated ones."""
    cleaned = Star(spark, sf_dir, dirty=True, keep=("cleaned",), columns=columns).cleaned
    marts = IncrementalMarts(spark, f"{checkpoint_dir(spark).rstrip('/')}/tables/marts-{uuid.uuid4().hex}", names)
    first = F.coalesce((F.col("transaction_date") <= F.lit(FIRST_LOAD_UNTIL).cast("date")) & (F.col("customer_id") % 5 != 0), F.lit(False))
    marts.load(cleaned.where(first), "first")
    marts.load(cleaned.where(~first), "rest")
    return marts


def q_incremental_dim_customers(spark, sf_dir):
    return _loaded_in_steps(spark, sf_dir, CUSTOMER_COLUMNS, "customers").customers(AS_OF, DRIVER_BANDS, audit=False)


def q_incremental_dim_products(spark, sf_dir):
    got = _loaded_in_steps(spark, sf_dir, PRODUCT_COLUMNS, "products").products(AS_OF, DRIVER_BANDS, audit=False)
    return got.withColumn("stddev_unit_price", F.round("stddev_unit_price", 6))


def q_incremental_monthly_sales(spark, sf_dir):
    return _loaded_in_steps(spark, sf_dir, FACT_COLUMNS, "customers", "months").monthly(AS_OF, DRIVER_BANDS)


QUERIES.update({
    "incremental_dim_customers": q_incremental_dim_customers,
    "incremental_dim_products": q_incremental_dim_products,
    "incremental_monthly_sales": q_incremental_monthly_sales,
    "raw_with_audit": q_raw_with_audit,
    "raw_file_counts": q_raw_file_counts,
    "clean_transactions": q_clean_transactions,
    "clean_rejects": q_clean_rejects,
    "null_profile": q_null_profile,
    "load_profile": q_load_profile,
    "freshness": q_freshness,
    "null_shares": q_null_shares,
    "dim_customers_raw": q_dim_customers_raw,
    "dim_products_raw": q_dim_products_raw,
    "monthly_sales_raw": q_monthly_sales_raw,
    "dq_results": q_dq_results,
    "dq_unique_failures": q_dq_unique_failures,
    "dq_relationship_failures": q_dq_relationship_failures,
    "dq_combination_failures": q_dq_combination_failures,
    "dq_severities": q_dq_severities,
    "freshness_raw": q_freshness_raw,
    "incremental_fact": q_incremental_fact,
    "incremental_fact_raw": q_incremental_fact_raw,
    "incremental_fact_keyed": q_incremental_fact_keyed,
})
