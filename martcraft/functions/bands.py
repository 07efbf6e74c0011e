"""Step banding (CASE on ordered bounds) as chained ``when`` expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martcraft.config import Ladder, TierLadder


def band(measure: Column, ladder: Ladder) -> Column:
    """First rung whose bound the measure meets; NULL measures get ``otherwise``."""
    if ladder.op not in (">=", "<="):
        raise ValueError(f"unsupported ladder op {ladder.op!r}")
    out = None
    for bound, label in ladder.rungs:
        cond = measure >= F.lit(bound) if ladder.op == ">=" else measure <= F.lit(bound)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(ladder.otherwise) if out is None else out.otherwise(F.lit(ladder.otherwise))


def tier(value: Column, count: Column, ladder: TierLadder) -> Column:
    """Two-measure ladder: value >= v AND count >= n."""
    out = None
    for v, n, label in ladder.rungs:
        cond = (value >= F.lit(v)) & (count >= F.lit(n))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(ladder.otherwise) if out is None else out.otherwise(F.lit(ladder.otherwise))
