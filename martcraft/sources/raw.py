"""Raw CSV input: header contract, all-STRING read, audit columns."""
from __future__ import annotations

import csv
import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martcraft.operators.cleaning import RAW_COLUMNS

log = logging.getLogger(__name__)

OPEN_AT_ONCE = 32


class HeaderError(ValueError):
    pass


def file_headers(spark: SparkSession, path: str | list[str]) -> dict[str, tuple[str, ...]]:
    """The header line of every input file, column names trimmed.

    Files are listed by Spark (a path, a folder, a glob or a list of them) and
    opened through its file systems for one line each, ``OPEN_AT_ONCE`` at a time;
    no data is read. A missing path raises Spark's PATH_NOT_FOUND error as it is.
    """
    listed = spark.read.format("binaryFile").load(path).select("path")  # names only: the content column is pruned
    conf, jvm = spark._jsc.hadoopConfiguration(), spark._jvm

    def header(name: str) -> tuple[str, tuple[str, ...]]:
        p = jvm.org.apache.hadoop.fs.Path(name)
        stream = p.getFileSystem(conf).open(p)
        try:
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            stream.close()
        names = next(csv.reader([(line or "").lstrip("\ufeff")]), [])
        return name, tuple(n.strip() for n in names)

    with ThreadPoolExecutor(OPEN_AT_ONCE) as pool:
        return dict(pool.map(header, (row.path for row in listed.toLocalIterator())))


def _contract(headers: dict[str, tuple[str, ...]], required: tuple[str, ...]) -> None:
    for name, cols in headers.items():
        missing = [c for c in required if c not in cols]
        twice = sorted({c for c in required if cols.count(c) > 1})
        extra = [c for c in cols if c not in required]
        if missing:
            raise HeaderError(f"{name}: missing required columns: {missing}")
        if twice:
            raise HeaderError(f"{name}: columns given twice: {twice}")
        if extra:
            log.warning("%s: extra columns ignored: %s", name, extra)


def check_header(spark: SparkSession, path: str | list[str], required: tuple[str, ...] = RAW_COLUMNS) -> list[str]:
    """Compare the header of every file with the contract: a missing or doubled column fails,
    an extra one is logged. Returns all column names met, in order of appearance."""
    headers = file_headers(spark, path)
    _contract(headers, required)
    return list(dict.fromkeys(c for cols in headers.values() for c in cols))


def read_raw_csv(spark: SparkSession, path: str | list[str], required: tuple[str, ...] = RAW_COLUMNS,
                 with_audit: bool = True) -> DataFrame:
    """Every column as STRING (never inferred), taken by the header name of its own file.

    Files with one and the same header are read together by a schema in that
    order; the groups are united by name. ``source_file`` comes from the file
    metadata and ``loaded_at`` is the load time.
    """
    headers = file_headers(spark, path)
    _contract(headers, required)
    groups: dict[tuple[str, ...], list[str]] = {}
    for name, cols in headers.items():
        groups.setdefault(cols, []).append(name)
    out = None
    for cols, files in (groups or {tuple(required): []}).items():
        # Names that aren't asked for may repeat; a position keeps them apart.
        schema = StructType([StructField(c if c in required else f"_other_{i}", StringType(), True) for i, c in enumerate(cols)])
        if files:
            df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(files)
            audit = [F.current_timestamp().alias("loaded_at"), F.col("_metadata.file_name").alias("source_file")]
        else:
            df = spark.createDataFrame([], schema)
            audit = [F.current_timestamp().alias("loaded_at"), F.lit("").alias("source_file")]
        part = df.select(*(F.col(c) for c in required), *(audit if with_audit else []))
        out = part if out is None else out.unionByName(part)
    return out


def count_rows(df: DataFrame) -> int:
    """Data rows (header excluded); a single aggregate, nothing collected but the count."""
    return df.count()
