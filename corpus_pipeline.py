"""The corpus pipeline: quality rules, line dedup, near duplicates, source mixing, BPE.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run``
writes as Parquet in the shared folder of ``spark.checkpoint.dir`` and reads
again as the next stage's documents. All stages but the last return the columns
of their input. Nulls, empty and long texts, repeated rows, empty tables and
other columns are treated as the operators' docstrings say.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.llm import quality
from martcraft.llm.bpe import encode_decode
from martcraft.llm.jaccard_join import one_per_component
from martcraft.llm.line_dedup import dedup_lines
from martcraft.llm.mixing import mixed_documents
from martcraft.llm.queries import tokenizer_file
from martcraft.llm.tables import saved


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the boosted-tree verdict; the others (null texts too) go."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.kept_rows(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that earlier documents have; a document that loses all its lines goes."""
    got = dedup_lines(docs)
    n_lines, n_removed, _ = got.columns[len(docs.columns):]
    got = got.where((F.col(n_removed) == 0) | (F.col(n_removed) < F.col(n_lines))).select(*docs.columns)
    if "n_chars" in docs.columns:  # goes with the text
        got = got.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return got


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the one with the smallest doc_id.

    Links: five-word shingles with a similarity of 0.8 or more. Rows without a
    doc_id or without words are in no group and stay. Rows with one doc_id and
    different texts are judged one by one; of repeated rows one stays.
    """
    return one_per_component(docs, n=5, percent=80)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; documents of small sources up to twice, by temperature weights."""
    return mixed_documents(docs, max_repeats=2.0)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit integers) and the decoded text's SHA-256."""
    got = encode_decode(docs, tokenizer_file("word_bpe_49k.json"))
    return got.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mixing", source_mixing),
    ("bpe_codec", bpe_codec),
]

#: The stages use trained models and hashes that SQL can't express; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
