"""Column-expression helpers: everything here stays inside whole-stage codegen."""
from martcraft.functions.bands import band, tier
from martcraft.functions.cleaning import (
    NA_TOKENS,
    PRICE_WORDS,
    TAX_WORDS,
    clean_amount,
    clean_date,
    clean_float_id,
    clean_prefixed_id,
    clean_whole_number,
    na_to_null,
    py_strip,
    to_money,
)
from martcraft.functions.dates import day_name, days_between, month_name, month_start
from martcraft.functions.arith import safe_ratio

__all__ = [
    "band", "tier", "NA_TOKENS", "PRICE_WORDS", "TAX_WORDS", "clean_amount", "clean_date",
    "clean_float_id", "clean_prefixed_id", "clean_whole_number", "na_to_null", "py_strip", "to_money",
    "day_name", "days_between", "month_name", "month_start", "safe_ratio",
]
