"""Tables written to the shared checkpoint folder, and documents packed into blocks."""
from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.llm.text import slices, utf8
from martcraft.session import checkpoint_dir


BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Give this package's sources to the Python workers of the session (once), as ``--py-files`` would.

    Rows here hold whole texts, so Arrow batches get ``BATCH_ROWS`` rows, unless
    the session sets a number itself.
    """
    sc = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    if getattr(sc, "_martcraft_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="martcraft-src-"), "martcraft_src.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(target)
    sc._martcraft_shipped = True


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the folder of ``spark.checkpoint.dir`` and read it back.

    It cuts the lineage: after the loss of an executor, later steps read files
    that all executors share. What isn't dropped before goes when the driver's
    file system closes.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete the files behind a table that ``saved`` returned and that nothing reads any more."""
    path = getattr(df, "_scratch", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def text_bytes(df: DataFrame, column: str = "text") -> int:
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


BLOCK_BYTES = 1 << 20


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = BLOCK_BYTES) -> DataFrame:
    """Pack documents into blocks of about ``limit`` bytes of text, in the order of the scan, without a shuffle.

    Returns ``block long, n_bytes long, payload binary``: a compressed Arrow batch of
    ``id long, text large_string``. A block never splits a document; a longer
    document stands alone, so a task holds one block at a time.
    """

    ship(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        ids: list = []
        texts: list = []
        size = 0

        def out() -> pa.RecordBatch:
            nonlocal ids, texts, size, seq
            rb = pa.RecordBatch.from_arrays([pa.concat_arrays(ids), pa.concat_arrays(texts)], names=["id", "text"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rb.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_batch(rb)
            row = pa.RecordBatch.from_pydict(
                {"block": [(part << 32) | seq], "n_bytes": [size], "payload": [sink.getvalue().to_pybytes()]},
                schema=pa.schema([("block", pa.int64()), ("n_bytes", pa.int64()), ("payload", pa.binary())]))
            ids, texts, size, seq = [], [], 0, seq + 1
            return row

        for batch in batches:
            for s in slices(batch, "text", limit):
                n = int(utf8(s.column("text"))[1][-1])
                if ids and size + n > limit:
                    yield out()
                ids.append(s.column("id").cast(pa.int64()))
                texts.append(s.column("text").cast(pa.large_string()))
                size += n
        if ids:
            yield out()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        pack, "block long, n_bytes long, payload binary")


def unpack(payload: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(payload) as r:
        t = r.read_all().combine_chunks()
    got = t.to_batches()
    return got[0] if got else pa.RecordBatch.from_pydict({"id": pa.array([], pa.int64()), "text": pa.array([], pa.large_string())})



def fresh(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column has it."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name
