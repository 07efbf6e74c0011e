"""Materialize a layer that several consumers read (the modelled project's ``table`` models)."""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from martcraft.session import checkpoint_dir, compiled_only


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), counters: Callable[[DataFrame], DataFrame] | None = None, dealt: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under the shared ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage (a lost executor reads files again instead of
    recomputing joins), and later scans get column pruning, filter pushdown
    and, with ``partition_by``, partition pruning. The folder goes when the
    driver's file system closes, at the end of the application: results are
    lazy, so it can't go earlier. ``counters`` (of ``WriteCounts``) is put on the
    frame that is written. ``dealt`` says that the rows are dealt out by ``partition_by`` already.
    """
    spark = df.sparkSession
    compiled_only(spark)
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    # REBALANCE lets AQE size the files of each partition value: small
    # months are coalesced, a hot month is split over several tasks.
    rows = df.hint("rebalance", *partition_by) if partition_by and not dealt else df
    w = (counters(rows) if counters else rows).write.mode("overwrite").option("compression", "zstd")  # written once, read a few times: bytes count
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)
