"""Customer and product dimensions (SCD type 1: rebuilt in full each run)."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from martcraft.config import DEFAULT_BANDS, Bands
from martcraft.functions.arith import safe_ratio
from martcraft.functions.bands import band, tier
from martcraft.functions.dates import days_between
from martcraft.operators.staging import valid_transactions


def as_of_date(as_of: str | dt.date | Column | None) -> Column:
    """The reporting date; defaults to ``current_date()`` like the modelled SQL."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def _distinct_count(rows: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    """Exact COUNT(DISTINCT value) per key as two aggregations: distinct (key, value)
    pairs (shuffled on both, so a hot key spreads by value), then a count per key."""
    return rows.select(*keys, value).distinct().groupBy(*keys).agg(F.count(value).alias(alias))


def _resummed(c: str, of: DecimalType) -> Column:
    """Partial sums of a DECIMAL(p,s), added up with the type of a single SUM."""
    return F.sum(c).cast(f"decimal({min(38, of.precision + 10)},{of.scale})")


def _mean(total: Column, n: Column, of: DecimalType) -> Column:
    """AVG of a DECIMAL(p,s) from its exact sum and count, rounded half-up once."""
    q = total.cast("decimal(38,18)") / n
    return F.when(n > 0, q.cast(f"decimal({min(38, of.precision + 4)},{of.scale + 4})"))


def dim_customers(
    stg: DataFrame,
    as_of: str | dt.date | Column | None = None,
    bands: Bands = DEFAULT_BANDS,
    audit: bool = True,
) -> DataFrame:
    """One row per customer of the valid transactions.

    Rows are reduced to (customer, day) by a hash aggregate, which also pre-reduces
    a customer with a third of the rows in every task, then to (customer, year)
    and to the customer: days and years are row counts, months the bits of a
    year. Distinct products (unbounded) are counted exactly by a second aggregate
    and joined back on ``customer_id`` (both sides are already partitioned on it).
    """
    v = valid_transactions(stg)
    totals = customer_totals(customer_days(v), v.schema["total_amount"].dataType)
    m = totals.join(_distinct_count(v, ["customer_id"], "product_id", "unique_products_purchased"), "customer_id", "left")
    return describe_customers(m, as_of, bands, audit)


# How rows of one group are put together from partial ones.
SUMMED, LEAST, MOST = "sum", "min", "max"
CUSTOMER_DAY = {"_n": SUMMED, "_value_n": SUMMED, "_units": SUMMED, "_value": SUMMED, "_min": LEAST, "_max": MOST}


def customer_days(v: DataFrame) -> DataFrame:
    """Valid rows reduced to (customer, day): mergeable measures (``CUSTOMER_DAY``)."""
    sums = {"_units": "quantity", "_value": "total_amount"}
    return v.groupBy("customer_id", "transaction_date").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count("total_amount").alias("_value_n"),
        *[F.sum(c).alias(a) for a, c in sums.items()],
        F.min("total_amount").alias("_min"),
        F.max("total_amount").alias("_max"),
    )


def customer_totals(days: DataFrame, amount: DecimalType) -> DataFrame:
    """(customer, day) rows to customers; ``amount`` is the type of one row's amount."""
    years = days.groupBy("customer_id", F.year("transaction_date").alias("_year")).agg(
        F.count("transaction_date").alias("_days"),
        F.coalesce(F.bit_count(F.bit_or(F.expr("shiftleft(1, month(transaction_date))"))), F.lit(0)).alias("_months"),
        F.min("transaction_date").alias("_first"),
        F.max("transaction_date").alias("_last"),
        *[F.sum(c).alias(c) for c in ("_n", "_value_n", "_units")],
        _resummed("_value", amount).alias("_value"),
        F.min("_min").alias("_min"),
        F.max("_max").alias("_max"),
    )
    value, value_n = _resummed("_value", amount), F.sum("_value_n")
    return years.groupBy("customer_id").agg(
        F.sum("_n").alias("total_transactions"),
        F.sum("_days").alias("unique_transaction_days"),
        F.count("_year").alias("years_active"),
        F.sum("_months").cast("bigint").alias("months_active"),
        F.min("_first").alias("first_transaction_date"),
        F.max("_last").alias("last_transaction_date"),
        F.sum("_units").alias("total_units_purchased"),
        value.alias("total_lifetime_value"),
        _mean(value, value_n, amount).alias("avg_transaction_value"),
        F.min("_min").alias("min_transaction_value"),
        F.max("_max").alias("max_transaction_value"),
    )


def describe_customers(m: DataFrame, as_of: str | dt.date | Column | None = None, bands: Bands = DEFAULT_BANDS, audit: bool = True) -> DataFrame:
    """The dimension's columns from customers' totals; what depends on the reporting date and the bands is added here."""
    today = as_of_date(as_of)
    since_last = days_between(today, F.col("last_transaction_date"))
    cols = [
        F.col("customer_id").alias("customer_key"),
        "customer_id",
        "total_transactions",
        "unique_transaction_days",
        "years_active",
        "months_active",
        "unique_products_purchased",
        "first_transaction_date",
        "last_transaction_date",
        since_last.alias("days_since_last_purchase"),
        days_between(today, F.col("first_transaction_date")).alias("customer_age_days"),
        "total_lifetime_value",
        "avg_transaction_value",
        "min_transaction_value",
        "max_transaction_value",
        "total_units_purchased",
        band(F.col("total_lifetime_value"), bands.value_segment).alias("value_segment"),
        band(F.col("total_transactions"), bands.frequency_segment).alias("frequency_segment"),
        band(since_last, bands.recency_segment).alias("recency_segment"),
        band(F.col("avg_transaction_value"), bands.aov_tier).alias("aov_tier"),
        tier(F.col("total_lifetime_value"), F.col("total_transactions"), bands.customer_tier).alias("customer_tier"),
    ]
    if audit:
        cols += [F.current_timestamp().alias("created_at"), F.current_timestamp().alias("updated_at")]
    return m.select(*cols)


def dim_products(
    stg: DataFrame,
    as_of: str | dt.date | Column | None = None,
    bands: Bands = DEFAULT_BANDS,
    name_rule: str = "max",
    audit: bool = True,
) -> DataFrame:
    """One row per product id of the valid transactions (a NULL id forms its own row).

    ``name_rule='max'`` keeps the alphabetical maximum name, as the modelled SQL
    does; ``'latest'`` takes the name on the latest sale (``max_by``).
    """
    if name_rule == "max":
        name = F.max("product_name")
    elif name_rule == "latest":
        name = F.max_by("product_name", F.struct("_named", "product_name"))
    else:
        raise ValueError(f"name_rule must be 'max' or 'latest', not {name_rule!r}")
    # A NULL product id is a group of its own. Both aggregates group on
    # (coalesce(id, 0), id IS NULL), which is the same grouping, so the join
    # back is a plain equi-join and Catalyst can drop it when the distinct
    # count is not used downstream.
    keys = ["_pk", "_pnull"]
    v = valid_transactions(stg).withColumns(
        {"_pk": F.coalesce(F.col("product_id"), F.lit(0).cast("bigint")), "_pnull": F.col("product_id").isNull()})
    agg = v.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.min("transaction_date").alias("first_sale_date"),
        F.max("transaction_date").alias("last_sale_date"),
        F.sum("quantity").alias("total_units_sold"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("unit_price").alias("avg_unit_price"),
        F.min("unit_price").alias("min_unit_price"),
        F.max("unit_price").alias("max_unit_price"),
        F.stddev_samp("unit_price").alias("stddev_unit_price"),
        F.avg("quantity").alias("avg_quantity_per_transaction"),
        F.min("quantity").alias("min_quantity_per_transaction"),
        F.max("quantity").alias("max_quantity_per_transaction"),
    )
    # The name comes from one row per (product, name): a maximum of strings in the main aggregate
    # would sort all rows. Customers and days are counted in one scan: the two distinct counts make
    # Spark expand each row into a (product, customer) and a (product, day) pair, reduce the pairs
    # (shuffled on both columns, so a hot product spreads), and count them per product. Each of the
    # two branches is pruned where nothing downstream reads its result.
    names = v.groupBy(*keys, "product_name").agg(F.max("transaction_date").alias("_named")).groupBy(*keys).agg(name.alias("product_name"))
    distinct = v.groupBy(*keys).agg(F.count_distinct("customer_id").alias("unique_customers"), F.count_distinct("transaction_date").alias("unique_transaction_days"))
    m = agg.join(names, keys, "left").join(distinct, keys, "left").withColumn(
        "product_id", F.when(~F.col("_pnull"), F.col("_pk")))
    return describe_products(m, as_of, bands, audit)


PRODUCT_DAY = {"_n": SUMMED, "_units": SUMMED, "_units_n": SUMMED, "_units_min": LEAST, "_units_max": MOST, "_value": SUMMED,
               "_price": SUMMED, "_price_n": SUMMED, "_price_2": SUMMED, "_price_min": LEAST, "_price_max": MOST}


def product_days(v: DataFrame) -> DataFrame:
    """Valid rows reduced to (product, name, day): mergeable measures (``PRODUCT_DAY``), the second moment of the price included."""
    return v.groupBy("product_id", "product_name", "transaction_date").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("quantity").alias("_units"),
        F.count("quantity").alias("_units_n"),
        F.min("quantity").alias("_units_min"),
        F.max("quantity").alias("_units_max"),
        F.sum("total_amount").alias("_value"),
        F.sum("unit_price").alias("_price"),
        F.count("unit_price").alias("_price_n"),
        F.sum((F.col("unit_price") * F.col("unit_price")).cast("decimal(28,4)")).alias("_price_2"),
        F.min("unit_price").alias("_price_min"),
        F.max("unit_price").alias("_price_max"),
    )


def product_totals(days: DataFrame, amount: DecimalType, price: DecimalType) -> DataFrame:
    """(product, name, day) rows to products; ``amount`` and ``price`` are the types of one row's values."""
    keys = ["_pk", "_pnull"]
    d = days.withColumns({"_pk": F.coalesce(F.col("product_id"), F.lit(0).cast("bigint")), "_pnull": F.col("product_id").isNull()})
    names = d.groupBy(*keys, "product_name").agg(F.lit(0)).groupBy(*keys).agg(F.max("product_name").alias("product_name"))
    by_day = d.groupBy(*keys, "transaction_date").agg(
        *[{SUMMED: F.sum, LEAST: F.min, MOST: F.max}[how](c).alias(c) for c, how in PRODUCT_DAY.items()])
    total, n = _resummed("_price", price), F.sum("_price_n")
    # Exact: the sums are decimals, so the difference of the moments loses nothing.
    spread = F.sum("_price_2").cast("decimal(38,4)") - (total.cast("decimal(38,8)") * total.cast("decimal(38,8)")).cast("decimal(38,8)") / n
    agg = by_day.groupBy(*keys).agg(
        F.sum("_n").alias("total_transactions"),
        F.count("transaction_date").alias("unique_transaction_days"),
        F.min("transaction_date").alias("first_sale_date"),
        F.max("transaction_date").alias("last_sale_date"),
        F.sum("_units").alias("total_units_sold"),
        _resummed("_value", amount).alias("total_revenue"),
        _mean(total, n, price).alias("avg_unit_price"),
        F.min("_price_min").alias("min_unit_price"),
        F.max("_price_max").alias("max_unit_price"),
        F.when(n > 1, F.sqrt(F.greatest(spread.cast("double"), F.lit(0.0)) / (n - 1))).alias("stddev_unit_price"),
        F.when(F.sum("_units_n") > 0, F.sum("_units").cast("double") / F.sum("_units_n")).alias("avg_quantity_per_transaction"),
        F.min("_units_min").alias("min_quantity_per_transaction"),
        F.max("_units_max").alias("max_quantity_per_transaction"),
    )
    return agg.join(names, keys, "left").withColumn("product_id", F.when(~F.col("_pnull"), F.col("_pk"))).drop(*keys)


def describe_products(m: DataFrame, as_of: str | dt.date | Column | None = None, bands: Bands = DEFAULT_BANDS, audit: bool = True) -> DataFrame:
    """The dimension's columns from products' totals."""
    today = as_of_date(as_of)
    cols = [
        F.col("product_id").alias("product_key"),
        "product_id",
        "product_name",
        "total_transactions",
        "unique_transaction_days",
        "unique_customers",
        "first_sale_date",
        "last_sale_date",
        days_between(today, F.col("last_sale_date")).alias("days_since_last_sale"),
        "total_units_sold",
        "total_revenue",
        safe_ratio(F.col("total_revenue"), F.col("unique_customers")).alias("revenue_per_customer"),
        "avg_unit_price",
        "min_unit_price",
        "max_unit_price",
        "stddev_unit_price",
        band(F.col("avg_unit_price"), bands.price_tier).alias("price_tier"),
        "avg_quantity_per_transaction",
        "min_quantity_per_transaction",
        "max_quantity_per_transaction",
        band(F.col("total_revenue"), bands.revenue_segment).alias("revenue_segment"),
        band(F.col("total_units_sold"), bands.volume_segment).alias("volume_segment"),
    ]
    if audit:
        cols += [F.current_timestamp().alias("created_at"), F.current_timestamp().alias("updated_at")]
    return m.select(*cols)
