"""Key ranges of a table's files, kept beside them, and the swap of some files for others.

``<table>/_keys`` holds one row per data file: its least and greatest key and the
number of its rows without a key. Readers of the table don't see it (its name begins
with an underscore). Files that the index doesn't know, or that are gone, are told by
Spark's listing of the table, so other writers do no harm: a file is read once, its
key column only, when it is met first. The driver holds that list of files and their
ranges, as it holds the listing for any read of the table, and never keys.
"""
from __future__ import annotations

import re
import uuid
from bisect import bisect_left
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StructType

CELLS = 4096
MOVED_AT_ONCE = 8
_ROOT = "^([a-zA-Z0-9+.-]+):/+"


def file_name() -> Column:
    """The file of each row, named as ``KeyedTable`` does: with one slash behind the scheme, however it was listed."""
    return F.regexp_replace("_metadata.file_path", _ROOT, "$1:/")


def _path(spark: SparkSession, uri: str):
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))


class KeyedTable:
    """A partitioned Parquet table with a key; ``schema`` is that of all its files together."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType):
        self.spark, self.path, self.key, self.schema = spark, path.rstrip("/"), key, schema
        self._P = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._P(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._known: dict | None = None

    def listed(self) -> list[str]:
        """The names of the table's files, as Spark lists them for any reader."""
        self._uri = {re.sub(_ROOT, r"\1:/", u): u for u in self.spark.read.schema(self.schema).parquet(self.path).inputFiles()}
        return list(self._uri)

    def read(self, names: list[str]) -> DataFrame:
        """Some files of the last listing only, with their partition columns."""
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*(unquote(self._uri[u]) for u in names))

    def _ranges(self, names: list[str]) -> DataFrame:
        k = F.col(self.key)
        rows = self.read(names).select(k, file_name().alias("file"))
        return rows.groupBy("file").agg(F.min(k).alias("lo"), F.max(k).alias("hi"), F.count_if(k.isNull()).alias("unkeyed"))

    def ranges(self) -> list:
        """Rows ``file, lo, hi, unkeyed`` of all files, brought up to date and written."""
        files = self.listed()
        if self._known is None or set(files) - set(self._known):
            self._known = {r.file: r for r in self._stored()}
            new = [f for f in files if f not in self._known]
            if new:
                found = {r.file: r for r in self._ranges(new).collect()}
                if set(found) - set(new):
                    raise RuntimeError(f"files are named otherwise than listed: {sorted(set(found) - set(new))[:3]}")
                self._known |= {f: found.get(f, Row(file=f, lo=None, hi=None, unkeyed=0)) for f in new}  # files without rows
                self._store([self._known[f] for f in files])
        return [self._known[f] for f in files]

    def _versions(self) -> list[str]:
        folder = self._P(f"{self.path}/_keys")
        return sorted(s.getPath().getName() for s in self.fs.listStatus(folder)) if self.fs.exists(folder) else []

    def _stored(self) -> list:
        for v in reversed(self._versions()):
            if self.fs.exists(self._P(f"{self.path}/_keys/{v}/_SUCCESS")):
                return self.spark.read.parquet(f"{self.path}/_keys/{v}").collect()
        return []

    def _store(self, rows: list) -> None:
        old = self._versions()
        k = self.schema[self.key].dataType.simpleString()
        df = self.spark.createDataFrame(rows, f"file string, lo {k}, hi {k}, unkeyed bigint")
        df.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_keys/{int(old[-1]) + 1 if old else 0:08d}")
        for v in old:
            self.fs.delete(self._P(f"{self.path}/_keys/{v}"), True)

    def near(self, keys: DataFrame) -> list[str]:
        """Files whose range holds a key of ``keys`` (one column); a NULL is near the files with rows without a key.

        The range of all files is cut into ``CELLS`` cells. A cell with keys keeps
        their least and greatest one, so files meet cells and never single keys.
        """
        rows = self.ranges()
        keyed = [r for r in rows if r.lo is not None]
        k = F.col(keys.columns[0])
        cell = F.lit(0).cast("long")
        if keyed and isinstance(self.schema[self.key].dataType, (ByteType, ShortType, IntegerType, LongType)):
            least, most = min(r.lo for r in keyed), max(r.hi for r in keyed)
            inside = k.between(F.lit(least), F.lit(most))
            cell = F.when(inside, F.expr(f"cast((cast({keys.columns[0]} as decimal(38,0)) - {least}) div {(most - least) // CELLS + 1} as bigint)"))
        cells = keys.groupBy(cell.alias("cell")).agg(F.min(k).alias("a"), F.max(k).alias("b"), F.count_if(k.isNull()).alias("null"))
        found = cells.collect()  # CELLS rows and one at most
        spans = sorted((c.a, c.b) for c in found if c.a is not None and c.cell is not None)
        ends = [b for _, b in spans]

        def holds(lo, hi) -> bool:
            i = bisect_left(ends, lo)
            return i < len(spans) and spans[i][0] <= hi

        without = any(c["null"] for c in found)
        return [r.file for r in rows if r.lo is not None and holds(r.lo, r.hi) or without and r.unkeyed]

    def unkeyed(self) -> list[str]:
        """Files that have rows without a key."""
        return [r.file for r in self.ranges() if r.unkeyed]

    def holding(self, keys: DataFrame) -> list[str]:
        """Files that hold a key of ``keys``: of the near ones, the key column is read."""
        near = self.near(keys)
        if not near:
            return []
        # A number stands for the file's name, which would be most of the shuffled bytes. Names with
        # one number count as one file: a file that is taken along needlessly keeps its rows.
        names = self.spark.createDataFrame([(n,) for n in near], "file string").select("file", F.xxhash64("file").alias("n")).collect()
        rows = self.read(near).select(F.col(self.key).alias(keys.columns[0]), F.xxhash64(file_name()).alias("n"))
        held = {r.n for r in rows.join(keys, keys.columns[0], "left_semi").select("n").distinct().toLocalIterator()}
        return [r.file for r in names if r.n in held]

    def swap(self, new: DataFrame, gone: list[str], partition_by: tuple[str, ...] = (), dealt: bool = False) -> list[str]:
        """Write ``new`` (``dealt``: by ``partition_by`` already) and take the files ``gone`` away; returns the new files.

        The new files are written aside first. A note that lists both then makes
        the swap certain: it is carried out now, or by ``recover`` after a failure.
        """
        run = uuid.uuid4().hex
        staged = f"{self.path}/_staged-{run}"
        w = (new if dealt else new.hint("rebalance", *partition_by)).write.partitionBy(*partition_by) if partition_by else new.write
        w.parquet(staged)
        note = "\n".join(self._uri[g] for g in gone)
        out = self.fs.create(self._P(f"{self.path}/_swap-{run}.part"), True)
        out.write(bytearray(note.encode()))
        out.close()
        self.fs.rename(*(self._P(f"{self.path}/_swap-{run}{s}") for s in (".part", "")))
        moved = self._carry_out(run)
        self.listed()
        return moved

    def recover(self) -> None:
        """Finish swaps that a failure has cut short; what was only written aside goes."""
        names = [s.getPath().getName() for s in self.fs.listStatus(self._P(self.path))]
        for n in names:
            if n.startswith("_swap-") and not n.endswith(".part"):
                self._carry_out(n.removeprefix("_swap-"))
        for n in names:
            if n.startswith(("_staged-", "_swap-")):
                self.fs.delete(self._P(f"{self.path}/{n}"), True)

    def _carry_out(self, run: str) -> list[str]:
        """Move a run's files in and the replaced ones out, ``MOVED_AT_ONCE`` at a time; returns the new files."""
        P = self._P
        note, staged = P(f"{self.path}/_swap-{run}"), P(f"{self.path}/_staged-{run}")
        reader = self.spark._jvm.java.io.BufferedReader(self.spark._jvm.java.io.InputStreamReader(self.fs.open(note), "UTF-8"))
        gone = []
        while (line := reader.readLine()) is not None:
            gone.append(line)
        reader.close()
        top = self.fs.makeQualified(P(self.path)).toString()
        new = []
        if self.fs.exists(staged):
            found = self.fs.listFiles(staged, True)
            root = self.fs.makeQualified(staged).toString()
            while found.hasNext():
                f = found.next().getPath().toString()
                if not f.rsplit("/", 1)[1].startswith(("_", ".")):
                    new.append(f.removeprefix(root))

        def move(name: str) -> str:
            to = P(self.path + name)
            self.fs.mkdirs(to.getParent())
            self.fs.rename(P(f"{self.path}/_staged-{run}{name}"), to)
            return re.sub(_ROOT, r"\1:/", self.fs.makeQualified(to).toUri().toString())

        def remove(uri: str) -> str:
            p = _path(self.spark, uri)
            self.fs.delete(p, False)
            return p.getParent().toString()

        with ThreadPoolExecutor(MOVED_AT_ONCE) as pool:
            moved = list(pool.map(move, new))
            left = set(pool.map(remove, gone))
        for folder in sorted(left):  # folders without files
            up = P(folder)
            while up.toString().rstrip("/") != top and self.fs.exists(up) and not self.fs.listStatus(up):
                self.fs.delete(up, False)
                up = up.getParent()
        self.fs.delete(staged, True)
        self.fs.delete(note, False)
        return moved
