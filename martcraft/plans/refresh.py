"""Refresh: merge of an increment by key and file, high-water append, schema drift, date bounds."""
from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martcraft.plans.key_index import KeyedTable, file_name
from martcraft.plans.materialize import materialize

log = logging.getLogger(__name__)


def rows_after_high_water(new: DataFrame, target: DataFrame, column: str = "transaction_date") -> DataFrame:
    """Rows of ``new`` strictly after ``max(column)`` of ``target`` (all rows when the target is empty).

    The mark is a lazy scalar subquery: computed once, then applied as a
    literal filter, so no join and no shuffle of ``new``. Late rows and rows
    with a NULL ``column`` never pass, as in the modelled incremental rule;
    ``append_incremental`` keeps them unless told otherwise.
    """
    mark = target.agg(F.max(column)).scalar()
    return new.filter(mark.isNull() | (F.col(column) > mark))


def fresh(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column has it."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_target(spark: SparkSession, path: str) -> DataFrame:
    """A refreshed table with the columns of all its files; files written before a column read NULL in it."""
    return spark.read.option("mergeSchema", "true").parquet(path)


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: rows of the increment written, and rows of it left out."""

    written: int
    skipped: int


def append_incremental(spark: SparkSession, new: DataFrame, path: str, column: str = "transaction_date",
                       partition_by: tuple[str, ...] = ("transaction_month",), on_schema_change: str = "fail",
                       key: str = "transaction_key", mode: str = "merge", repeats: str = "latest",
                       start: str | None = None, end: str | None = None, dealt: bool = False) -> Refresh:
    """Bring the rows of ``new`` into the table at ``path``; a first run writes everything.

    ``start`` and ``end`` bound the load by ``column``, both inclusive; rows without
    a date then don't belong to it.

    ``mode="merge"`` loses nothing: every key of ``new`` is written, whatever its
    date, NULL included. Rows of the table with a key of ``new`` are replaced
    (rows without a key are told apart by all their columns), and only the files
    that hold such rows are rewritten. They are found by the files' key ranges
    (``key_index``), then by the key column of the files in range. Running it again
    changes nothing. Of several rows of one key in ``new``, ``repeats="latest"``
    keeps the one with the latest ``column`` (ties: by all columns),
    ``repeats="keep"`` keeps all, and ``repeats="fail"`` raises.

    ``mode="high_water"`` appends only rows after ``max(column)`` of the table,
    the modelled rule. Late rows, rows of the mark's own day and rows without a
    date are left out; their number is returned and logged.

    ``dealt`` says that each task of ``new`` has rows of few ``partition_by`` values, as in a scan of
    a table partitioned alike: they are written as they lie, without a shuffle (with ``repeats="keep"``;
    the other rules deal the rows out by key first).

    With ``on_schema_change="append_new_columns"`` new columns are written, and
    ``read_target`` gives NULL for them in older rows.
    """
    if mode not in ("merge", "high_water"):
        raise ValueError(f"unknown mode {mode!r}")
    if repeats not in ("latest", "keep", "fail"):
        raise ValueError(f"unknown rule for repeated keys {repeats!r}")
    new = within_dates(new, start, end, column)
    if mode == "merge":
        new = _single(new, key, column, repeats)
        dealt = dealt and repeats == "keep"
    seen = Observation()
    if not _exists(spark, path):
        counted = new.observe(seen, F.count(F.lit(1)).alias("n"))
        (counted if dealt else counted.hint("rebalance", *partition_by)).write.partitionBy(*partition_by).parquet(path)
        return Refresh(seen.get["n"], 0)
    target = read_target(spark, path)
    check_schema_drift(target.schema, new.schema, on_schema_change)
    if mode == "merge":
        return _merge(spark, new, KeyedTable(spark, path, key, target.schema), partition_by, dealt)
    mark = target.agg(F.max(column)).first()[0]
    late = F.lit(False) if mark is None else ~F.coalesce(F.col(column) > F.lit(mark), F.lit(False))
    rows = new.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(late).alias("late")).filter(~late)
    (rows if dealt else rows.hint("rebalance", *partition_by)).write.mode("append").partitionBy(*partition_by).parquet(path)
    got = Refresh(seen.get["n"] - seen.get["late"], seen.get["late"])
    if got.skipped:
        log.warning("%d rows at or before the mark %s, or without %s, were left out", got.skipped, mark, column)
    return got


def _single(new: DataFrame, key: str, column: str, repeats: str) -> DataFrame:
    """One row per key, by the rule ``repeats``; rows without a key all stay."""
    if repeats == "keep":
        return new
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())  # a row without a key is a group of its own
    if repeats == "fail":
        n = fresh("n", new.columns)
        error = F.raise_error(F.concat(F.lit("repeated key "), F.col(key).cast("string"))).cast("boolean")
        counted = new.withColumn(n, F.when(F.col(key).isNotNull(), F.count(F.lit(1)).over(Window.partitionBy(key, own))).otherwise(F.lit(1)))
        return counted.where(F.when(F.col(n) > 1, error).otherwise(F.lit(True))).drop(n)
    rank, alone, whole = (fresh(n, new.columns) for n in ("rank", "alone", "whole"))
    w = Window.partitionBy(key, alone).orderBy(F.col(column).desc_nulls_last(), F.col(whole).desc())
    # The hash is made behind the shuffle by key: it is wider than many a row.
    by_key = new.withColumn(alone, own).repartition(key, alone).withColumn(whole, _whole(new.columns))
    return by_key.withColumn(rank, F.row_number().over(w)).where(F.col(rank) == 1).drop(rank, alone, whole)


def _whole(columns: list[str]) -> Column:
    """A hash of all columns."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def _merge(spark: SparkSession, new: DataFrame, table: KeyedTable, partition_by: tuple[str, ...], dealt: bool = False) -> Refresh:
    table.recover()
    key, shared = table.key, [c for c in table.schema.names if c in new.columns]
    seen = Observation()
    # Read several times; its write counts it.
    batch = materialize(new, "increment", counters=lambda df: df.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("keyless")))
    n, keyless = seen.get["n"], seen.get["keyless"]
    if not n:
        return Refresh(0, 0)
    ids = batch.where(F.col(key).isNotNull()).select(F.col(key).alias("_id")).distinct()
    gone = set(table.holding(ids))
    whole = None
    if keyless:  # only files that have rows without a key are looked at, and only those rows
        whole = batch.where(F.col(key).isNull()).select(_whole(shared).alias("_id")).distinct()
        near = table.unkeyed()
        if near:
            old = table.read(near).where(F.col(key).isNull()).select(_whole(shared).alias("_id"), file_name().alias("file"))
            gone |= {r.file for r in old.join(whole, "_id", "left_semi").select("file").distinct().toLocalIterator()}
    old = table.read(sorted(gone))
    kept = old.join(ids, old[key] == ids["_id"], "left_anti")
    if whole is not None:
        kept = kept.withColumn("_whole", F.when(F.col(key).isNull(), _whole(shared))).join(whole, F.col("_whole") == whole["_id"], "left_anti").drop("_whole")
    if dealt:  # the joins have dealt the kept rows out by key
        kept = kept.hint("rebalance", *partition_by)
    table.swap(kept.unionByName(batch, allowMissingColumns=True), sorted(gone), partition_by, **({"dealt": True} if dealt else {}))
    return Refresh(n, 0)


def overwrite_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("transaction_month",)) -> None:
    """Replace only the partitions present in ``df`` (idempotent for replays and late rows)."""
    (df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def schema_changes(existing: StructType, incoming: StructType) -> dict[str, list[str]]:
    old = {f.name: f.dataType.simpleString() for f in existing.fields}
    new = {f.name: f.dataType.simpleString() for f in incoming.fields}
    return {
        "added": [c for c in new if c not in old],
        "removed": [c for c in old if c not in new],
        "changed": [c for c in new if c in old and old[c] != new[c]],
    }


def check_schema_drift(existing: StructType, incoming: StructType, policy: str = "fail") -> dict[str, list[str]]:
    """``fail``: any difference raises. ``append_new_columns``: new columns are allowed
    (``read_target`` reads them); removed or retyped columns still raise. ``ignore``: no check."""
    ch = schema_changes(existing, incoming)
    if policy == "ignore":
        return ch
    if policy == "fail" and any(ch.values()):
        raise ValueError(f"schema changed: {ch}")
    if policy == "append_new_columns" and (ch["removed"] or ch["changed"]):
        raise ValueError(f"schema changed beyond new columns: {ch}")
    if policy not in ("fail", "append_new_columns"):
        raise ValueError(f"unknown on_schema_change policy {policy!r}")
    return ch


def within_dates(df: DataFrame, start: str | None = None, end: str | None = None,
                 column: str = "transaction_date") -> DataFrame:
    """Optional date bounds of an incremental load (inclusive); pushes down to the scan."""
    c = F.col(column)
    if start is not None:
        df = df.filter(c >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(c <= F.lit(end).cast("date"))
    return df
