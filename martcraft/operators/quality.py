"""Declarative data checks that count (and can keep) the failing rows.

Row-level checks of one table (not_null, accepted_values, accepted_range,
expression_is_true) are evaluated together in ONE aggregate pass of
``count_if`` columns, or without any pass of their own by the job that writes
the table (``WriteCounts``). Set-level checks need a shuffle each: ``unique`` and
``unique_combination`` group by their keys (partial aggregation first, so a
hot key is pre-counted per task), ``relationships`` is a left-anti join of
the child keys against the distinct parent keys.

Predicates are SQL text that is TRUE for a failing row; NULL counts as
passing, as in the declared tests being modelled.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ROW_KINDS = ("not_null", "accepted_values", "accepted_range", "expression_is_true")


@dataclass(frozen=True)
class Check:
    model: str
    kind: str
    column: str | None = None
    predicate: str | None = None  # row checks: TRUE when the row fails
    keys: tuple[str, ...] = ()  # set checks
    parent: str | None = None  # relationships
    parent_key: str | None = None
    severity: str = "error"
    error_if: str = ">0"
    warn_if: str = ">0"
    tag: str = ""
    args: tuple = ()  # what the predicate was made of: values, (lo, hi, inclusive) or (expression,)

    @property
    def name(self) -> str:
        target = self.column or "_".join(self.keys) or "model"
        return "_".join(p for p in (self.kind, self.model, target, self.tag) if p)


def _lit_sql(v) -> str:
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def not_null(model: str, column: str, **kw) -> Check:
    return Check(model, "not_null", column, f"{column} IS NULL", **kw)


def accepted_values(model: str, column: str, values, **kw) -> Check:
    vals = ", ".join(_lit_sql(v) for v in values)
    return Check(model, "accepted_values", column, f"{column} NOT IN ({vals})", args=tuple(values), **kw)


def accepted_range(model: str, column: str, lo=None, hi=None, inclusive: bool = True, **kw) -> Check:
    ge, le = (">=", "<=") if inclusive else (">", "<")
    parts = ([f"{column} {ge} {lo}"] if lo is not None else []) + ([f"{column} {le} {hi}"] if hi is not None else [])
    return Check(model, "accepted_range", column, f"NOT ({' AND '.join(parts)})", args=(lo, hi, inclusive), **kw)


def expression_is_true(model: str, expression: str, column: str | None = None, tag: str = "", **kw) -> Check:
    return Check(model, "expression_is_true", column, f"NOT ({expression})", tag=tag, args=(expression,), **kw)


def unique(model: str, column: str, **kw) -> Check:
    return Check(model, "unique", column, keys=(column,), **kw)


def unique_combination(model: str, columns: tuple[str, ...], **kw) -> Check:
    return Check(model, "unique_combination_of_columns", None, keys=tuple(columns), **kw)


def relationships(model: str, column: str, parent: str, parent_key: str, **kw) -> Check:
    return Check(model, "relationships", column, keys=(column,), parent=parent, parent_key=parent_key, **kw)


_COND = re.compile(r"^\s*(>=|<=|!=|=|>|<)\s*(-?\d+)\s*$")


def parse_threshold(cond: str) -> tuple[str, int]:
    m = _COND.match(cond)
    if not m:
        raise ValueError(f"threshold must look like '>0' or '>=10', not {cond!r}")
    return m.group(1), int(m.group(2))


def _meets(failures: Column, op: Column, n: Column) -> Column:
    return (F.when(op == ">", failures > n).when(op == ">=", failures >= n).when(op == "<", failures < n)
            .when(op == "<=", failures <= n).when(op == "=", failures == n).when(op == "!=", failures != n))


def _metadata(spark, checks: list[Check]) -> DataFrame:
    """One small row per check (bounded by the number of declared checks)."""
    rows = []
    for i, c in enumerate(checks):
        if c.severity not in ("error", "warn"):
            raise ValueError(f"severity must be 'error' or 'warn', not {c.severity!r}")
        (eop, en), (wop, wn) = parse_threshold(c.error_if), parse_threshold(c.warn_if)
        rows.append((i, c.model, c.name, c.column, c.severity, eop, en, wop, wn))
    return spark.createDataFrame(rows, "check_idx int, model string, check_name string, column_name string, "
                                       "severity string, error_op string, error_n bigint, warn_op string, "
                                       "warn_n bigint")


def failing_rows(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    """The rows a check reports, as stored by a store-failures run."""
    t = tables[check.model]
    if check.kind in ROW_KINDS:
        return t.filter(F.expr(check.predicate))
    if check.kind == "unique":
        k = check.keys[0]
        return (t.filter(F.col(k).isNotNull()).groupBy(k).agg(F.count(F.lit(1)).alias("n_records"))
                .filter("n_records > 1").withColumnRenamed(k, "unique_field"))
    if check.kind == "unique_combination_of_columns":
        return t.groupBy(*check.keys).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")
    if check.kind == "relationships":
        k = check.keys[0]
        # One row per child key takes part in the anti join; its rows come back after it.
        return _orphans(check, tables).select(F.col(k).alias("from_field"), F.explode(F.sequence(F.lit(1), F.col("n")))).select("from_field")
    raise ValueError(f"unknown check kind {check.kind!r}")


def _orphans(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    """Child keys without a parent with their rows ``n``, counted per key first: the anti join then
    moves one row per distinct child key instead of every child row (a hot key is pre-counted)."""
    k = check.keys[0]
    per_key = (tables[check.model].filter(F.col(k).isNotNull()).groupBy(k)
               .agg(F.count(F.lit(1)).alias("n")))
    parent = tables[check.parent].select(F.col(check.parent_key).alias("_parent_key")).distinct()
    return per_key.join(parent, per_key[k] == parent._parent_key, "left_anti")


def _orphan_count(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    return _orphans(check, tables).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))


class WriteCounts:
    """Counters that are filled by the job that writes a table, as observed metrics of its last stage.

    Put the counters on the very frame that is written, after any ``rebalance`` hint: a
    task of the last stage that runs twice (a lost executor, speculation) is counted
    once, one of an earlier stage might not be. Each counter belongs to one write.
    """

    def __init__(self, checks: list[Check] = ()):
        self.checks = list(checks)
        self._rows: list[Observation] = []
        self._profiles: dict[str, Observation] = {}

    def row_checks(self, df: DataFrame, model: str) -> DataFrame:
        """``df`` with counters for all row checks that are declared for ``model``."""
        counters = [F.count_if(F.expr(c.predicate)).alias(f"c{i}") for i, c in enumerate(self.checks) if c.model == model and c.kind in ROW_KINDS]
        if not counters:
            return df
        self._rows.append(Observation())
        return df.observe(self._rows[-1], *counters)

    def profile(self, df: DataFrame, name: str, counters: list[Column]) -> DataFrame:
        """``df`` with aliased aggregates, to be read as ``profile_row(name)`` after the write."""
        self._profiles[name] = Observation()
        return df.observe(self._profiles[name], *counters)

    def profile_row(self, name: str) -> dict[str, int]:
        return self._profiles[name].get

    def failures(self) -> dict[int, int]:
        """Failing rows by the check's place in ``checks``, for the tables written so far."""
        return {int(c[1:]): n for seen in self._rows for c, n in seen.get.items()}


def run_checks(tables: dict[str, DataFrame], checks: list[Check], counted: dict[int, int] | None = None) -> DataFrame:
    """One result row per check: model, check_name, column_name, severity, failures, status.

    ``counted`` has the failures of checks that were counted before
    (``WriteCounts.failures``, made of the same ``checks``); these read no table.
    Every part yields only (check_idx, failures); the status is one generic
    expression over the joined check metadata, so generated code stays small.
    """
    spark = next(iter(tables.values())).sparkSession
    counted = counted or {}
    parts: list[DataFrame] = []
    if counted:
        parts.append(spark.createDataFrame(sorted(counted.items()), "check_idx int, failures bigint"))
    by_model: dict[str, list[int]] = {}
    for i, c in enumerate(checks):
        if c.kind in ROW_KINDS and i not in counted:
            by_model.setdefault(c.model, []).append(i)
    for model, idx in by_model.items():
        counts = tables[model].agg(*[F.count_if(F.expr(checks[i].predicate)).alias(f"c{i}") for i in idx])
        pairs = F.array(*[F.struct(F.lit(i).alias("check_idx"), F.col(f"c{i}").alias("failures")) for i in idx])
        parts.append(counts.select(F.inline(pairs)))
    for i, c in enumerate(checks):
        if c.kind == "relationships":
            n = _orphan_count(c, tables)
        elif c.kind not in ROW_KINDS:
            n = failing_rows(c, tables).agg(F.count(F.lit(1)).alias("failures"))
        else:
            continue
        parts.append(n.select(F.lit(i).alias("check_idx"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    meta = _metadata(spark, checks)
    f = F.col("failures")
    err = (F.col("severity") == "error") & _meets(f, F.col("error_op"), F.col("error_n"))
    warn = _meets(f, F.col("warn_op"), F.col("warn_n"))
    return out.join(F.broadcast(meta), "check_idx").select(
        "model", "check_name", "column_name", "severity", f.cast("bigint").alias("failures"),
        F.when(err, "fail").when(warn, "warn").otherwise("pass").alias("status"),
    )


def freshness(df: DataFrame, as_of_ts, column: str = "loaded_at", warn_after_hours: float = 12,
              error_after_hours: float = 24, source: str = "source") -> DataFrame:
    """Hours since the newest ``loaded_at`` and the pass/warn/error status.

    A source without rows, or without any load time, is the stalest case: an error.
    """
    ts_type = df.schema[column].dataType.simpleString()  # timestamp or timestamp_ntz
    now = F.lit(str(as_of_ts)).cast(ts_type) if as_of_ts is not None else F.current_timestamp().cast(ts_type)
    latest = F.max(column)
    age = F.timestamp_diff("MICROSECOND", latest, now) / F.lit(3600e6)
    return df.agg(latest.alias("max_loaded_at"), age.alias("age_hours")).select(
        F.lit(source).alias("source"), "max_loaded_at", "age_hours",
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_after_hours), "error")
        .when(F.col("age_hours") > warn_after_hours, "warn")
        .otherwise("pass").alias("status"),
    )


def load_profile(cleaned: DataFrame) -> DataFrame:
    """Post-load counters in one pass (row count, NULL ids/dates/quantities, zero prices)."""
    return cleaned.agg(*load_counters())


def load_counters() -> list[Column]:
    c = F.col
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(c("transaction_id").isNull()).alias("null_transaction_ids"),
        F.count_if(c("customer_id").isNull()).alias("null_customer_ids"),
        F.count_if(c("transaction_date").isNull()).alias("null_dates"),
        F.count_if(c("quantity").isNull()).alias("null_quantities"),
        F.count_if(c("price").isNull() | (c("price") == 0)).alias("zero_prices"),
    ]


def assert_loaded(profile: DataFrame, min_rows: int = 1) -> int:
    """Fail when the load produced fewer than ``min_rows`` rows (reads the one-row profile)."""
    n = profile.select("total_rows").first()[0]
    if n < min_rows:
        raise ValueError(f"no data loaded: {n} rows, need at least {min_rows}")
    return n


def null_shares(df: DataFrame, columns, max_fraction: float = 0.05, min_rows: int = 1) -> DataFrame:
    """Declared-but-unused thresholds as a check: NULL share per column and the row count, one pass."""
    n = F.count(F.lit(1))
    agg = df.agg(n.alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns])
    out = agg.select("n", F.inline(rows))
    share = F.when(F.col("n") > 0, F.col("nulls") / F.col("n"))
    return out.select(
        "column_name", "nulls", F.col("n").alias("total_rows"), share.alias("null_share"),
        F.when(F.col("n") < min_rows, "fail").when(share > max_fraction, "warn").otherwise("pass").alias("status"),
    )
