"""The TPC-H-like tables as transactions.

``lineitem`` is the transaction grain, ``orders`` gives customer and date,
``part`` gives name and price. Left joins keep every line (a line without an
order gets a NULL customer and is then invalid, not lost).
"""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _tables(spark: SparkSession, sf_dir: str, with_source: bool = False):
    cols = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_tax", "l_shipdate"]
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    li = li.select(*cols, *([F.col("_metadata.file_name").alias("source_file")] if with_source else []))
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_retailprice")
    return li, o, p


def driver_lines(spark: SparkSession, sf_dir: str, with_source: bool = False) -> DataFrame:
    """Only what ``lineitem`` holds itself, for readers of ids or files: no join."""
    li = _tables(spark, sf_dir, with_source)[0]
    return li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
                     F.col("l_shipdate").alias("loaded_at"), *([F.col("source_file")] if with_source else []))


def driver_transactions(spark: SparkSession, sf_dir: str, with_source: bool = False) -> DataFrame:
    """Typed, cleaned transactions (the cleaned-table schema, ids widened to BIGINT).

    tax = quantity * round(l_tax * 100) cents: integer arithmetic, so exact.
    """
    li, o, p = _tables(spark, sf_dir, with_source)
    q = F.col("l_quantity").cast("int")
    tax_cents = q * F.round(F.col("l_tax") * 100).cast("int")
    # orders grows with lineitem, so it is never broadcast: a sort-merge join on
    # the order key (AQE splits a skewed key). part is joined by size: the
    # broadcast threshold decides, and at scale it is a sort-merge join too.
    j = (li.join(o.hint("merge"), li.l_orderkey == o.o_orderkey, "left")
         .join(p, li.l_partkey == p.p_partkey, "left"))
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        q.alias("quantity"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        (tax_cents.cast("decimal(12,0)") * F.lit(Decimal("0.01"))).cast("decimal(10,2)").alias("tax"),
        F.col("l_shipdate").alias("loaded_at"),  # zone-less (TIMESTAMP_NTZ), as stored
        *([F.col("source_file")] if with_source else []),
    )


def _first(k: Column, rules: list[tuple[int, int, Column]], otherwise: Column) -> Column:
    out = None
    for mod, rem, value in rules:
        cond = (k % mod) == rem
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return otherwise if out is None else out.otherwise(otherwise)


def written_id() -> Column:
    """How the dirty copy writes a transaction id."""
    k = F.col("transaction_id")
    return _first(k, [(10, 0, F.concat(F.lit("T"), k.cast("string")))], k.cast("string"))


def driver_raw_transactions(spark: SparkSession, sf_dir: str, with_source: bool = False) -> DataFrame:
    """All-STRING raw transactions with the dirt of the sample file, made by fixed rules.

    Every line is kept; the rules only change how a value is written, keyed
    on the transaction id (first matching rule wins).
    """
    t = driver_transactions(spark, sf_dir, with_source)
    k = F.col("transaction_id")
    s = lambda c: F.col(c).cast("string")
    null = F.lit(None).cast("string")
    d = F.col("transaction_date")
    # Dirt rules (modulus, remainder, written value).
    return t.select(
        written_id().alias("transaction_id"),
        _first(k, [(7, 0, null), (3, 0, F.concat(s("customer_id"), F.lit(".0")))], s("customer_id")).alias("customer_id"),
        _first(k, [(8, 0, F.date_format(d, "dd-MM-yyyy")), (25, 0, F.date_format(d, "y-M-d")),
                   (31, 0, F.concat(F.lit("ab-"), F.date_format(d, "MM-yyyy")))],
               F.when(F.year(d).between(1, 9999), d.cast("string")).otherwise(F.date_format(d, "yyyy-MM-dd"))).alias("transaction_date"),
        _first(k, [(17, 0, null), (10, 5, F.concat(F.lit("P"), s("product_id")))], s("product_id")).alias("product_id"),
        _first(k, [(4, 0, F.concat(F.lit("  "), s("product_name"), F.lit(" ")))], s("product_name")).alias("product_name"),
        _first(k, [(11, 0, null), (23, 0, F.lit("1.5")), (5, 0, F.concat(s("quantity"), F.lit(".0")))],
               s("quantity")).alias("quantity"),
        _first(k, [(9, 0, F.lit("Two Hundred")), (19, 0, F.lit(" two HUNDRED ")), (37, 0, F.lit("1_000"))],
               s("price")).alias("price"),
        _first(k, [(9, 4, F.lit("Fifteen")), (29, 0, F.lit("n/a"))], s("tax")).alias("tax"),
        F.col("loaded_at"),
        *([F.col("source_file")] if with_source else []),
    )
