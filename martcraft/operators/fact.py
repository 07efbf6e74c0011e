"""Transaction fact: valid staging rows joined to both dimensions."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martcraft.operators.staging import derived_columns, valid_transactions

FACT_COLUMNS = (
    "transaction_key", "customer_fk", "product_fk", "transaction_date", "transaction_month",
    "transaction_year", "transaction_quarter", "units_sold", "gross_amount", "tax_amount",
    "net_amount", "revenue_excluding_tax", "unit_price", "customer_tier", "customer_value_segment",
    "product_name", "product_price_tier", "product_revenue_segment", "created_at",
)


def fact_transactions(stg: DataFrame, customers: DataFrame, products: DataFrame, audit: bool = True, customer_last: bool = False, by_month: bool = False) -> DataFrame:
    """Inner equi-joins on the natural keys; only base columns and the denormalized attributes are shuffled.

    The staged columns that follow from others of the same row (month, subtotal and so on)
    are derived behind the joins. ``customer_last`` joins the customers after the products:
    the rows then lie by customer, and aggregates by customer need no shuffle of their own.

    ``by_month`` deals the rows out by month before the other columns are derived, for a
    write that is partitioned so.

    Join strategy is left to the optimizer: a dimension under
    ``spark.sql.autoBroadcastJoinThreshold`` (checked on its size at plan or,
    with AQE, at run time) is broadcast; larger ones fall back to sort-merge,
    where AQE splits skewed customer or product partitions.
    Rows with a NULL product id drop out here, as in the modelled join.
    """
    t = valid_transactions(stg).select(
        "transaction_id", "customer_id", "product_id", "transaction_date", "quantity", "unit_price", "tax_amount",
    )
    c = customers.select(
        F.col("customer_id"), F.col("customer_key").alias("customer_fk"), "customer_tier",
        F.col("value_segment").alias("customer_value_segment"),
    )
    p = products.select(
        F.col("product_id"), F.col("product_key").alias("product_fk"),
        F.col("product_name").alias("dim_product_name"),
        F.col("price_tier").alias("product_price_tier"),
        F.col("revenue_segment").alias("product_revenue_segment"),
    )
    if customer_last:
        j = t.join(p, "product_id", "inner").join(c, "customer_id", "inner")
    else:
        j = t.join(c, "customer_id", "inner").join(p, "product_id", "inner")
    derived = derived_columns("unit_price", "tax_amount")
    if by_month:
        j = j.withColumn("transaction_month", derived.pop("transaction_month")).hint("rebalance", "transaction_month")
    j = j.withColumns(derived)
    cols = [
        F.col("transaction_id").alias("transaction_key"),
        "customer_fk",
        "product_fk",
        "transaction_date",
        "transaction_month",
        "transaction_year",
        "transaction_quarter",
        F.col("quantity").alias("units_sold"),
        F.col("subtotal").alias("gross_amount"),
        "tax_amount",
        F.col("total_amount").alias("net_amount"),
        (F.col("total_amount") - F.col("tax_amount")).alias("revenue_excluding_tax"),
        "unit_price",
        "customer_tier",
        "customer_value_segment",
        F.col("dim_product_name").alias("product_name"),
        "product_price_tier",
        "product_revenue_segment",
    ]
    if audit:
        cols.append(F.current_timestamp().alias("created_at"))
    return j.select(*cols)
