"""Staging: derived date parts, amounts and validity flags over cleaned transactions."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martcraft.functions.dates import day_name, month_name, month_start

STAGING_COLUMNS = (
    "transaction_id", "customer_id", "product_id", "transaction_date", "transaction_month",
    "transaction_year", "transaction_quarter", "month_number", "month_name", "day_name",
    "product_name", "quantity", "unit_price", "tax_amount", "subtotal", "total_amount",
    "is_valid_quantity", "is_valid_price", "is_valid_transaction", "loaded_at", "transformed_at",
)


def valid_condition(customer: str = "customer_id", quantity: str = "quantity", price: str = "price") -> Column:
    """Valid transaction as a plain conjunction, so every part reaches the Parquet scan."""
    return F.col(customer).isNotNull() & (F.col(quantity) > 0) & (F.col(price) > 0)


def stage_transactions(cleaned: DataFrame, padded_names: bool = True) -> DataFrame:
    return cleaned.select(*staging_columns(cleaned, padded_names))


def derived_columns(price: str = "price", tax: str = "tax") -> dict[str, Column]:
    """What follows from a transaction's own date, quantity, price and tax, for the facts."""
    d, q, p, t = (F.col(c) for c in ("transaction_date", "quantity", price, tax))
    return {
        "transaction_month": month_start(d), "transaction_year": F.year(d), "transaction_quarter": F.quarter(d),
        "subtotal": q * p, "total_amount": q * p + t,
    }


def staging_columns(cleaned: DataFrame, padded_names: bool = True) -> list[Column]:
    """The staged columns as expressions over the cleaned ones."""
    d = F.col("transaction_date")
    q, p, t = F.col("quantity"), F.col("price"), F.col("tax")
    derived = derived_columns()
    loaded = F.col("loaded_at") if "loaded_at" in cleaned.columns else F.lit(None).cast("timestamp")
    return [
        *(F.col(c) for c in ("transaction_id", "customer_id", "product_id", "transaction_date")),
        *(derived[c].alias(c) for c in ("transaction_month", "transaction_year", "transaction_quarter")),
        F.month(d).alias("month_number"),
        month_name(d, padded_names).alias("month_name"),
        day_name(d, padded_names).alias("day_name"),
        F.col("product_name"),
        q,
        p.alias("unit_price"),
        t.alias("tax_amount"),
        *(derived[c].alias(c) for c in ("subtotal", "total_amount")),
        F.coalesce(q > 0, F.lit(False)).alias("is_valid_quantity"),
        F.coalesce(p > 0, F.lit(False)).alias("is_valid_price"),
        F.coalesce(valid_condition(), F.lit(False)).alias("is_valid_transaction"),
        loaded.alias("loaded_at"),
        F.current_timestamp().alias("transformed_at"),
    ]


def valid_transactions(stg: DataFrame) -> DataFrame:
    """Rows with ``is_valid_transaction``; written on base columns so the filter pushes down."""
    return stg.filter(valid_condition(price="unit_price"))
