"""Sinks and table lifecycle: CSV hand-off, typed load, overwrite, views, per-layer databases, JDBC."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martcraft.operators.cleaning import RAW_COLUMNS

# The typed cleaned table (ids widened to BIGINT for scale).
CLEANED_DDL = """
    transaction_id BIGINT,
    customer_id BIGINT,
    transaction_date DATE,
    product_id BIGINT,
    product_name VARCHAR(255),
    quantity INT,
    price DECIMAL(10,2),
    tax DECIMAL(10,2),
    loaded_at TIMESTAMP DEFAULT current_timestamp()
"""

# Layer -> database suffix.
LAYER_SCHEMAS = {"cleaned": "cleaned_data", "raw": "raw_data", "staging": "staging",
                 "analytics": "analytics", "failures": "dbt_test_failures"}


def layer_database(layer: str, base: str | None = None) -> str:
    """``<base>_<layer schema>`` or just the layer schema (custom schema naming)."""
    name = LAYER_SCHEMAS[layer]
    return f"{base}_{name}" if base else name


def write_csv(df: DataFrame, path: str) -> None:
    """CSV hand-off: header, no index, NULL and the empty string written as an empty field."""
    df.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def create_cleaned_table(spark: SparkSession, table: str) -> None:
    """Typed table if absent; ``loaded_at`` defaults to the load time."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({CLEANED_DDL}) USING parquet")


def load_typed(spark: SparkSession, df: DataFrame, table: str, truncate: bool = True) -> int:
    """Truncate-and-reload of the typed table (idempotent reruns).

    Columns are matched by position to the table, text is cast under ANSI
    store assignment (a bad value or an over-long name fails the whole job,
    and the commit protocol leaves the table as it was), and ``loaded_at``
    takes its default.
    """
    create_cleaned_table(spark, table)
    view = f"_load_{abs(hash(table))}"
    df.select(*RAW_COLUMNS).createOrReplaceTempView(view)
    mode = "OVERWRITE" if truncate else "INTO"
    spark.sql(f"INSERT {mode} {table} ({', '.join(RAW_COLUMNS)}) SELECT * FROM {view}")
    return spark.table(table).count()


def replace_table(df: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> None:
    """Drop-and-recreate semantics (full refresh of a ``table`` model)."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)


def truncate_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def create_view(spark: SparkSession, name: str, sql: str) -> None:
    """A ``view`` model over tables."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")


def set_properties(spark: SparkSession, table: str, props: dict[str, str]) -> None:
    """Governance metadata (owner, classification, retention, ...) as ``meta.<key>`` table
    properties (``owner`` itself is reserved by Spark)."""
    quoted = lambda x: "'" + str(x).replace("\\", "\\\\").replace("'", "\\'") + "'"
    kv = ", ".join(f"{quoted('meta.' + k)} = {quoted(v)}" for k, v in props.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({kv})")


def write_jdbc(df: DataFrame, url: str, table: str, user: str | None = None, password: str | None = None,
               driver: str | None = None) -> None:
    """Optional warehouse sink: overwrite by TRUNCATE so the target's DDL survives.

    Needs a JDBC driver on the classpath; it is not exercised in this repo's tests.
    """
    props = {"truncate": "true"}
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v:
            props[k] = v
    df.write.jdbc(url, table, mode="overwrite", properties=props)
