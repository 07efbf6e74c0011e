"""Guarded arithmetic."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(num: Column, den: Column, otherwise=0) -> Column:
    """``CASE WHEN den > 0 THEN num / den ELSE otherwise END``; never divides by zero under ANSI."""
    return F.when(den > 0, num / den).otherwise(F.lit(otherwise) if otherwise is not None else F.lit(None))
