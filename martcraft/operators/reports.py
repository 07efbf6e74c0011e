"""Ad hoc reports over the marts: top-k, monthly trend, product by tier, samples, counts."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_customers(customers: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` by lifetime value; ``customer_id`` breaks ties so the cut is deterministic.

    NULL values sort first under DESC, as in the modelled database.

    Planned as TakeOrderedAndProject: each task keeps its own top ``n``.
    """
    return (
        customers.select("customer_id", "customer_tier", "total_lifetime_value",
                         "total_transactions", "avg_transaction_value")
        .orderBy(F.col("total_lifetime_value").desc_nulls_first(), F.col("customer_id").asc_nulls_last())
        .limit(n)
    )


def monthly_trend(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("transaction_year", "transaction_month")
        .agg(
            F.sum("net_amount").alias("total_revenue"),
            F.count(F.lit(1)).alias("transaction_count"),
            F.avg("net_amount").alias("avg_transaction_value"),
        )
        .orderBy("transaction_year", "transaction_month")
    )


def product_by_tier(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("product_name", "customer_tier")
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.sum("net_amount").alias("revenue"),
            F.avg("net_amount").alias("avg_revenue"),
        )
        .orderBy(F.col("revenue").desc_nulls_first(), "product_name", "customer_tier")
    )


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """A peek of ``n`` rows (no order, as in the modelled post-load log)."""
    return df.limit(n)


def rows_per_source(df: DataFrame, column: str = "source_file") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
