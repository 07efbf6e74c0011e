"""Customer x month aggregate with growth against the previous active month."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martcraft.functions.arith import safe_ratio

MONTHLY_KEYS = ("customer_fk", "transaction_month", "transaction_year", "transaction_quarter")


# Constant per customer: the fact takes them from the one row of the customer in its dimension.
CUSTOMER_ATTRIBUTES = ("customer_tier", "customer_value_segment")


def monthly_sales(fact: DataFrame, audit: bool = True) -> DataFrame:
    """Aggregate, then LAG over each customer's months; one read of the fact.

    First an aggregate at (month key, product) grain: map-side partial
    aggregation, and the shuffle spreads a hot customer by product. Then a
    roll-up to the month key, where ``count(product_fk)`` is the exact
    distinct product count; sums are re-summed and cast back to the types of
    a single-level aggregate, averages are recomputed from exact sums and
    counts. The customer's attributes are grouping columns: they follow from
    the customer, so the groups stay the same, and both aggregates are hash
    aggregates (a maximum of strings would sort the fact). The window then
    shuffles only the aggregated rows on ``customer_fk`` (one row per active
    month: each window partition is bounded by the calendar, not by the data).
    Both LAGs share one window.
    """
    keys = (*MONTHLY_KEYS, *CUSTOMER_ATTRIBUTES)
    return with_growth(months(month_products(fact, keys), keys, amount_types(fact)), audit)


def amount_types(fact: DataFrame) -> dict:
    return {c: fact.schema[c].dataType for c in ("gross_amount", "tax_amount", "net_amount", "revenue_excluding_tax", "unit_price")}


# How rows of one (month, product) are put together from partial ones.
MONTH_PRODUCT = {c: "sum" for c in ("_n", "_units", "_units_n", "_gross", "_tax", "_net", "_extax", "_price_sum", "_price_n")} | {"_price_min": "min", "_price_max": "max"}


def month_products(fact: DataFrame, keys: tuple[str, ...] = MONTHLY_KEYS) -> DataFrame:
    """The fact at (month key, product) grain: mergeable measures (``MONTH_PRODUCT``)."""
    return fact.groupBy(*keys, "product_fk").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("units_sold").alias("_units"),
        F.count("units_sold").alias("_units_n"),
        F.sum("gross_amount").alias("_gross"),
        F.sum("tax_amount").alias("_tax"),
        F.sum("net_amount").alias("_net"),
        F.sum("revenue_excluding_tax").alias("_extax"),
        F.sum("unit_price").alias("_price_sum"),
        F.count("unit_price").alias("_price_n"),
        F.min("unit_price").alias("_price_min"),
        F.max("unit_price").alias("_price_max"),
    )


def months(per_product: DataFrame, keys: tuple[str, ...], t: dict) -> DataFrame:
    """(month key, product) rows to month keys; ``t`` are the types of one row's amounts."""

    def resum(c: str, typ) -> Column:
        # SUM over DECIMAL(p,s) is DECIMAL(p+10,s); re-summing partial sums keeps the value.
        return F.sum(c).cast(f"decimal({min(38, typ.precision + 10)},{typ.scale})")

    def exact_avg(total: Column, n: Column, typ) -> Column:
        # AVG over DECIMAL(p,s) is DECIMAL(p+4,s+4), rounded half-up once from sum/count.
        q = total.cast("decimal(38,18)") / n
        return F.when(n > 0, q.cast(f"decimal({min(38, typ.precision + 4)},{typ.scale + 4})"))

    units_n, price_n = F.sum("_units_n"), F.sum("_price_n")
    return per_product.groupBy(*keys).agg(
        F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias("transaction_count"),
        F.count("product_fk").alias("unique_products_purchased"),
        F.sum("_units").alias("total_units"),
        F.when(units_n > 0, F.sum("_units").cast("double") / units_n).alias("avg_units_per_transaction"),
        resum("_gross", t["gross_amount"]).alias("monthly_gross_revenue"),
        resum("_tax", t["tax_amount"]).alias("monthly_tax"),
        resum("_net", t["net_amount"]).alias("monthly_net_revenue"),
        resum("_extax", t["revenue_excluding_tax"]).alias("monthly_revenue_excluding_tax"),
        exact_avg(F.sum("_price_sum"), price_n, t["unit_price"]).alias("avg_unit_price"),
        F.min("_price_min").alias("min_unit_price"),
        F.max("_price_max").alias("max_unit_price"),
    )

def with_growth(m: DataFrame, audit: bool = True) -> DataFrame:
    """Months with each customer's previous active one; without the customer's attributes if ``m`` has none."""
    # NULL months sort last, as in the modelled database.
    w = Window.partitionBy("customer_fk").orderBy(F.col("transaction_month").asc_nulls_last())
    prev_rev = F.lag("monthly_net_revenue").over(w)
    prev_n = F.lag("transaction_count").over(w)
    g = m.select(
        "*",
        prev_rev.alias("previous_month_revenue"),
        prev_n.alias("previous_month_transactions"),
        safe_ratio(F.col("monthly_net_revenue"), F.col("transaction_count")).alias("avg_revenue_per_transaction"),
    )
    rev, pr = F.col("monthly_net_revenue"), F.col("previous_month_revenue")
    n, pn = F.col("transaction_count"), F.col("previous_month_transactions")
    cols = [
        *MONTHLY_KEYS,
        "transaction_count",
        "unique_products_purchased",
        "total_units",
        "avg_units_per_transaction",
        "monthly_gross_revenue",
        "monthly_tax",
        "monthly_net_revenue",
        "monthly_revenue_excluding_tax",
        "avg_revenue_per_transaction",
        "avg_unit_price",
        "min_unit_price",
        "max_unit_price",
        "previous_month_revenue",
        "previous_month_transactions",
        # As DOUBLE: a decimal quotient of these widths would keep six places only.
        F.when(pr.isNotNull() & (pr > 0), (rev - pr).cast("double") / pr.cast("double") * 100).alias("revenue_growth_pct"),
        F.when(pn.isNotNull() & (pn > 0), (n - pn) / pn.cast("double") * 100).alias("transaction_growth_pct"),
        *[c for c in CUSTOMER_ATTRIBUTES if c in m.columns],
    ]
    if audit:
        cols.append(F.current_timestamp().alias("refreshed_at"))
    return g.select(*cols)
