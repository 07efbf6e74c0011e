"""Full rebuild of every layer, in the modelled order: write, audit, publish.

raw CSV -> cleaned table -> staging (view) -> dim_customers, dim_products
(tables) -> fact_transactions (table, partitioned by month) -> agg_monthly_sales
(view). Each run writes all its tables into a folder of its own,
``<base>/runs/<run>/``, and is published by one empty file,
``<base>/published/<run>``, created after the last write. Readers take the
newest published run, so a run that dies, in whatever layer, changes nothing
for them, and a rebuild may read the tables it replaces. Declared checks stand
between the last write and the publication: one that fails with severity ``error``
keeps the run from being published. Published tables have names in the catalog,
which move to a new run by one statement each.
"""
from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.config import DEFAULT_BANDS, Bands, QualityParams
from martcraft.operators.catalog import (
    DIM_CUSTOMERS, DIM_PRODUCTS, FACT, MONTHLY, SOURCE, STAGING, declared_checks,
)
from martcraft.operators.cleaning import clean_transactions, null_counters, reject_counts
from martcraft.operators.dimensions import dim_customers, dim_products
from martcraft.operators.fact import fact_transactions
from martcraft.operators.monthly import monthly_sales
from martcraft.operators.quality import Check, WriteCounts, assert_loaded, failing_rows, load_counters, run_checks
from martcraft.operators.reports import sample_rows
from martcraft.operators.staging import stage_transactions, staging_columns
from martcraft.plans.refresh import within_dates
from martcraft.sources.tables import create_database, create_view, layer_database

log = logging.getLogger(__name__)

# The folder of each table inside a run.
CLEANED, CUSTOMERS, PRODUCTS, FACTS = (
    "cleaned_data/customer_transactions", "analytics/dim_customers", "analytics/dim_products", "analytics/fact_transactions")
MONTHS = "analytics/agg_monthly_sales"
LOAD_CHECKS = "load_checks"


@dataclass
class StarTables:
    cleaned: DataFrame
    stg: DataFrame
    customers: DataFrame
    products: DataFrame
    fact: DataFrame
    monthly: DataFrame
    path: str | None = None

    def by_model(self) -> dict[str, DataFrame]:
        return {SOURCE: self.cleaned, STAGING: self.stg, DIM_CUSTOMERS: self.customers,
                DIM_PRODUCTS: self.products, FACT: self.fact, MONTHLY: self.monthly}


class _Store:
    """Runs below a base path, through the file system that Spark uses for it."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.base).getFileSystem(spark._jsc.hadoopConfiguration())

    def published(self) -> list[str]:
        """Names of the published runs, oldest first (names begin with the time)."""
        folder = self._path(f"{self.base}/published")
        if not self.fs.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(folder))

    def folder(self, run: str) -> str:
        return f"{self.base}/runs/{run}"

    def publish(self, run: str) -> None:
        self.fs.create(self._path(f"{self.base}/published/{run}"), False).close()

    def delete(self, run: str) -> None:
        self.fs.delete(self._path(f"{self.base}/published/{run}"), False)
        self.fs.delete(self._path(self.folder(run)), True)


def _write(spark: SparkSession, df: DataFrame, path: str, partition_by: tuple[str, ...] = (),
           counters: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    # REBALANCE lets AQE size the files of each partition value: small
    # months are coalesced, a hot month is split over several tasks.
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    w = (counters(rows) if counters else rows).write
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_star(spark: SparkSession, base_path: str) -> StarTables:
    """The tables of the newest published run."""
    store = _Store(spark, base_path)
    runs = store.published()
    if not runs:
        raise FileNotFoundError(f"no published run below {base_path}")
    path = store.folder(runs[-1])
    c, cust, prod, fact = (spark.read.parquet(f"{path}/{t}") for t in (CLEANED, CUSTOMERS, PRODUCTS, FACTS))
    return StarTables(c, stage_transactions(c), cust, prod, fact, monthly_sales(fact), path)


class CheckFailure(RuntimeError):
    """Declared checks failed with severity ``error``; ``names`` lists them."""

    def __init__(self, names: list[str], stored: str):
        super().__init__(f"{len(names)} checks failed, rows are stored below {stored}: {', '.join(names[:10])}")
        self.names = names


def name_tables(spark: SparkSession, star: StarTables, prefix: str = "") -> list[str]:
    """Give the tables of a run their catalog names (``<prefix>_analytics.dim_customers`` and so on).

    Each name is a view of the run's files, replaced in one statement, so a reader
    gets the old table or the new one. Returns the names.
    """
    out = []
    for layer, folder in (("cleaned", CLEANED), ("analytics", CUSTOMERS), ("analytics", PRODUCTS), ("analytics", FACTS), ("analytics", MONTHS)):
        database = layer_database(layer, prefix or None)
        create_database(spark, database)
        name = f"{database}.{folder.rpartition('/')[2]}"
        create_view(spark, name, f"SELECT * FROM parquet.`{star.path}/{folder}`")
        out.append(name)
    return out


def rebuild(spark: SparkSession, raw: DataFrame | None, base_path: str, as_of: str | dt.date | None = None,
            bands: Bands = DEFAULT_BANDS, on_reject: str = "null", cleaned: DataFrame | None = None,
            min_rows: int = 1, keep_runs: int = 2, checks: list[Check] | None = None, names: str | None = None,
            start: str | None = None, end: str | None = None) -> StarTables:
    """Rebuild all layers from ``raw`` (all-STRING) or an already typed ``cleaned`` frame (SCD type 1).

    ``start`` and ``end`` bound the transactions by date, both inclusive. With
    ``checks`` (as ``declared_checks`` gives them) the run is audited before it is
    published: results and failing rows are stored below ``<base>/dbt_test_failures``,
    and a status ``fail`` raises ``CheckFailure``. ``names`` is the prefix of the
    databases in which the published tables get names ("": none); these include the
    monthly aggregate, which is written then.

    After the cleaned table is written, ``load_checks/`` gets the counts of
    unreadable values per column (from ``raw``), the NULL profile and the load
    profile; a load of fewer than ``min_rows`` rows fails there. A failing run
    deletes its own folder and leaves the published one as it is. After
    success, all but the newest ``keep_runs`` published runs are deleted: the
    one before stays for readers that are under way.
    """
    store = _Store(spark, base_path)
    run = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S.%f}-{uuid.uuid4().hex[:8]}"
    path = store.folder(run)
    try:
        typed = within_dates(cleaned if cleaned is not None else clean_transactions(raw, on_reject=on_reject), start, end)
        counts = WriteCounts(checks or ())
        c = _write(spark, typed, f"{path}/{CLEANED}", counters=lambda df: _count_load(df, counts))
        _check_load(spark, raw if cleaned is None else None, c, counts, f"{path}/{LOAD_CHECKS}", min_rows)
        stg = stage_transactions(c)
        cust = _write(spark, dim_customers(stg, as_of, bands), f"{path}/{CUSTOMERS}", counters=lambda df: counts.row_checks(df, DIM_CUSTOMERS))
        prod = _write(spark, dim_products(stg, as_of, bands), f"{path}/{PRODUCTS}", counters=lambda df: counts.row_checks(df, DIM_PRODUCTS))
        fact = _write(spark, fact_transactions(stg, cust, prod), f"{path}/{FACTS}", ("transaction_month",), lambda df: counts.row_checks(df, FACT))
        monthly = monthly_sales(fact)
        if names is not None:
            monthly = _write(spark, monthly, f"{path}/{MONTHS}", counters=lambda df: counts.row_checks(df, MONTHLY))
        star = StarTables(c, stg, cust, prod, fact, monthly, path)
        if checks is not None:
            _audit(spark, star, store.base, checks, counts.failures())
        store.publish(run)
    except BaseException:
        store.delete(run)
        raise
    if names is not None:
        name_tables(spark, star, names)
    for old in store.published()[:-keep_runs]:
        store.delete(old)
    return star


def _audit(spark: SparkSession, star: StarTables, base: str, checks: list[Check], counted: dict[int, int]) -> None:
    failed = check_all(spark, star, base, checks=checks, counted=counted).where("status = 'fail'").select("check_name").collect()  # at most one row a check
    if failed:
        raise CheckFailure(sorted(r.check_name for r in failed), f"{base}/dbt_test_failures")


def with_load_checks(cleaned: DataFrame, counts: WriteCounts) -> DataFrame:
    """The cleaned rows with counters of their own row checks and of those of the staged
    rows, which are a view of them: the write computes the staged columns that checks
    read, counts, and leaves them out again. The cleaned rows are counted first:
    staging then is a step of its own in the generated code."""
    own = {f"_own{i}": c for i, c in enumerate(cleaned.columns)}
    rows = counts.row_checks(cleaned, SOURCE)
    both = rows.select(*[F.col(c).alias(a) for a, c in own.items()], *staging_columns(cleaned))
    return counts.row_checks(both, STAGING).select(*[F.col(a).alias(c) for a, c in own.items()])


def _count_load(cleaned: DataFrame, counts: WriteCounts) -> DataFrame:
    rows = counts.profile(with_load_checks(cleaned, counts), "null_profile", null_counters())
    return counts.profile(rows, "load_profile", load_counters())


def _check_load(spark: SparkSession, raw: DataFrame | None, cleaned: DataFrame, counts: WriteCounts, path: str, min_rows: int) -> None:
    if raw is not None:
        rejects = _write(spark, reject_counts(raw), f"{path}/reject_counts").first().asDict()
        lost = {c: n for c, n in rejects.items() if c != "total_rows" and n}
        if lost:
            log.warning("values that could not be read and became NULL: %s", lost)
    for name in ("null_profile", "load_profile"):  # counted by the write
        seen = counts.profile_row(name)
        profile = _write(spark, spark.createDataFrame([tuple(seen.values())], ", ".join(f"{c} bigint" for c in seen)), f"{path}/{name}")
        log.info("%s: %s", name, seen)
    assert_loaded(profile, min_rows)
    log.info("sample: %s", sample_rows(cleaned).collect())


def check_all(spark: SparkSession, star: StarTables, base_path: str | None = None, bands: Bands = DEFAULT_BANDS,
              params: QualityParams = QualityParams(), checks: list[Check] | None = None, counted: dict[int, int] | None = None) -> DataFrame:
    """Run the declared checks; with ``base_path`` also store each failing check's rows.

    ``counted`` has what the writes counted already (``WriteCounts.failures`` of the same ``checks``).

    Rows stored by earlier calls for checks that pass now are deleted.
    """
    checks = checks if checks is not None else declared_checks(bands, params)
    names = [c.name for c in checks]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"check names must differ: {twice}")
    tables = star.by_model()
    results = run_checks(tables, checks, counted)
    if base_path is None:
        return results
    base = f"{base_path.rstrip('/')}/dbt_test_failures"
    results.write.mode("overwrite").parquet(f"{base}/_results")
    res = spark.read.parquet(f"{base}/_results")
    failed = {r.check_name for r in res.filter("failures > 0").select("check_name").collect()}  # at most one row a check
    store = _Store(spark, base)
    for c in checks:
        if c.name in failed:
            failing_rows(c, tables).write.mode("overwrite").parquet(f"{base}/{c.name}")
        else:
            store.fs.delete(store._path(f"{base}/{c.name}"), True)
    return res
