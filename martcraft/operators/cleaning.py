"""Raw all-STRING transactions -> typed cleaned transactions."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martcraft.functions.cleaning import (
    PRICE_WORDS,
    TAX_WORDS,
    clean_date,
    clean_float_id,
    clean_money,
    clean_prefixed_id,
    clean_text,
    clean_whole_number,
    na_to_null,
)

RAW_COLUMNS = (
    "transaction_id", "customer_id", "transaction_date", "product_id",
    "product_name", "quantity", "price", "tax",
)


def _cleaners(price_words, tax_words) -> dict[str, callable]:
    return {
        "transaction_id": lambda c: clean_prefixed_id(c, "T"),
        "customer_id": clean_float_id,
        "transaction_date": clean_date,
        "product_id": lambda c: clean_prefixed_id(c, "P"),
        "product_name": clean_text,
        "quantity": clean_whole_number,
        "price": lambda c: clean_money(c, price_words),
        "tax": lambda c: clean_money(c, tax_words),
    }


def _policed(raw: Column, cleaned: Column, name: str, on_reject: str) -> Column:
    if on_reject == "null":
        return cleaned
    if on_reject == "fail":
        bad = raw.isNotNull() & cleaned.isNull()
        msg = F.concat(F.lit(f"cannot read {name} from "), F.to_json(F.struct(raw.alias("value"))))
        return F.when(bad, F.raise_error(msg)).otherwise(cleaned)
    raise ValueError(f"on_reject must be 'null' or 'fail', not {on_reject!r}")


def clean_transactions(
    raw: DataFrame,
    on_reject: str = "null",
    price_words: dict[str, float] | None = None,
    tax_words: dict[str, float] | None = None,
    passthrough: tuple[str, ...] = ("loaded_at", "source_file"),
) -> DataFrame:
    """Type every raw column; unreadable values become NULL (or fail the job with ``on_reject='fail'``).

    Narrow projections: no shuffle, and every expression is codegen'd. The NA words
    go first, in a projection of their own, so each rule below reads a plain column.
    """
    cleaners = _cleaners(PRICE_WORDS if price_words is None else price_words,
                         TAX_WORDS if tax_words is None else tax_words)
    kept = [F.col(c) for c in passthrough if c in raw.columns]
    read = raw.select(*[na_to_null(F.col(name).cast("string")).alias(name) for name in RAW_COLUMNS], *kept)
    cols = [_policed(F.col(name), cleaners[name](F.col(name)), name, on_reject).alias(name) for name in RAW_COLUMNS]
    return read.select(*cols, *kept)


def reject_counts(raw: DataFrame, price_words=None, tax_words=None) -> DataFrame:
    """One row: per column, how many non-NULL raw values could not be read."""
    cleaners = _cleaners(PRICE_WORDS if price_words is None else price_words,
                         TAX_WORDS if tax_words is None else tax_words)
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    for name in RAW_COLUMNS:
        raw_c = na_to_null(F.col(name).cast("string"))
        aggs.append(F.count_if(raw_c.isNotNull() & cleaners[name](raw_c).isNull()).alias(f"rejected_{name}"))
    return raw.agg(*aggs)


def null_profile(df: DataFrame, columns: tuple[str, ...] = RAW_COLUMNS) -> DataFrame:
    """Row count and NULL count per column in one pass (the quality summary after cleaning)."""
    return df.agg(*null_counters(columns))


def null_counters(columns: tuple[str, ...] = RAW_COLUMNS) -> list[Column]:
    return [F.count(F.lit(1)).alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]]
