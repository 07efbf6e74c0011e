"""Full rebuild into files, declared checks with stored failing rows, views and truncate."""
import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martcraft.operators.quality import not_null
from martcraft.plans import rebuild as rebuild_module
from martcraft.plans.rebuild import check_all, read_star, rebuild
from martcraft.sources.tables import create_view, truncate_table

SCHEMA = ("transaction_id bigint, customer_id bigint, transaction_date date, product_id bigint, "
          "product_name string, quantity int, price decimal(10,2), tax decimal(10,2)")


def test_rebuild_and_store_failures(spark, scratch):
    d = dt.date
    rows = [(1, 7, d(2024, 1, 2), 3, "P", 2, Decimal("9.50"), Decimal("1.00")),
            (1, 8, d(2024, 2, 2), 3, "P", 1, Decimal("9.50"), Decimal("1.00")),   # duplicate id
            (2, 8, d(2024, 3, 2), 4, "Q", 1, Decimal("5.00"), None)]              # NULL tax
    cleaned = spark.createDataFrame(rows, SCHEMA)
    star = rebuild(spark, None, scratch, as_of="2024-03-10", cleaned=cleaned)
    assert os.path.isdir(f"{star.path}/analytics/fact_transactions")
    assert star.fact.count() == 3 and star.monthly.count() == 3
    res = {r.check_name: (r.failures, r.status) for r in check_all(spark, star, scratch).collect()}
    assert len(res) == 147
    assert res["unique_stg_customer_transactions_transaction_id"] == (1, "fail")
    assert res["unique_fact_transactions_transaction_key"] == (1, "fail")
    assert res["not_null_cleaned_customer_transactions_tax"] == (1, "fail")
    assert res["not_null_fact_transactions_net_amount"] == (1, "fail")
    assert res["accepted_range_agg_monthly_sales_transaction_year"] == (0, "pass")
    stored = spark.read.parquet(f"{scratch}/dbt_test_failures/unique_stg_customer_transactions_transaction_id")
    assert [(r.unique_field, r.n_records) for r in stored.collect()] == [(1, 2)]
    nulls = spark.read.parquet(f"{scratch}/dbt_test_failures/not_null_fact_transactions_net_amount")
    assert [r.transaction_key for r in nulls.collect()] == [2]
    assert not os.path.exists(f"{scratch}/dbt_test_failures/not_null_fact_transactions_customer_fk")


def test_views_and_truncate(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS vt")
    spark.createDataFrame([(1,), (2,)], "k int").write.mode("overwrite").saveAsTable("vt.base")
    create_view(spark, "vt.v", "SELECT k * 10 AS k10 FROM vt.base")
    assert sorted(r.k10 for r in spark.table("vt.v").collect()) == [10, 20]
    truncate_table(spark, "vt.base")
    assert spark.table("vt.v").count() == 0


def test_rebuild_from_raw_csv(spark, scratch):
    from martcraft.sources.raw import read_raw_csv
    os.makedirs(f"{scratch}/landing")
    with open(f"{scratch}/landing/a.csv", "w") as f:
        f.write("transaction_id,customer_id,transaction_date,product_id,product_name,quantity,price,tax\n"
                "T1,5.0,2024-01-01,P2,x,1,Two Hundred,0.1\n"
                "2,5.0,02-02-2024,2,x,2.0,3,Fifteen\n"
                "3,,2024-02-03,2,x,1,3,0.2\n")
    star = rebuild(spark, read_raw_csv(spark, f"{scratch}/landing"), f"{scratch}/wh", as_of="2024-03-01")
    assert star.cleaned.count() == 3 and star.fact.count() == 2  # the row without a customer is invalid
    m = {str(r.transaction_month): r for r in star.monthly.collect()}
    assert m["2024-02-01"].previous_month_revenue == Decimal("200.10")
    assert m["2024-02-01"].monthly_net_revenue == Decimal("21.00")


def _cleaned(spark, n=3):
    rows = [(i, 7, dt.date(2024, 1, 2), 3, "P", 2, Decimal("9.50"), Decimal("1.00")) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_rebuild_from_its_own_stored_layer(spark, scratch):
    rebuild(spark, None, scratch, as_of="2024-03-10", cleaned=_cleaned(spark))
    for _ in range(3):
        rebuild(spark, None, scratch, as_of="2024-03-11", cleaned=read_star(spark, scratch).cleaned)
    star = read_star(spark, scratch)
    assert star.cleaned.count() == star.fact.count() == 3
    assert len(os.listdir(f"{scratch}/runs")) == 2  # the published run and the one before


def test_failed_run_leaves_the_published_one(spark, scratch, monkeypatch):
    rebuild(spark, None, scratch, as_of="2024-03-10", cleaned=_cleaned(spark))

    def broken(*args):
        raise RuntimeError("died midway")

    monkeypatch.setattr(rebuild_module, "fact_transactions", broken)
    with pytest.raises(RuntimeError, match="midway"):
        rebuild(spark, None, scratch, as_of="2024-03-10", cleaned=_cleaned(spark, 9))
    monkeypatch.undo()
    assert read_star(spark, scratch).fact.count() == 3
    assert len(os.listdir(f"{scratch}/runs")) == 1


def test_failing_check_keeps_the_old_run_published(spark, scratch):
    from martcraft.operators.catalog import declared_checks
    from martcraft.operators.quality import not_null
    from martcraft.plans.rebuild import CheckFailure
    rebuild(spark, None, scratch, as_of="2024-03-10", cleaned=_cleaned(spark), checks=[not_null("fact_transactions", "customer_fk")], names="wap")
    named = lambda t: spark.table(f"wap_analytics.{t}").count()
    assert (named("fact_transactions"), named("dim_customers"), named("agg_monthly_sales")) == (3, 1, 1)
    twice = _cleaned(spark, 5).unionByName(_cleaned(spark, 1))  # one id on two rows
    with pytest.raises(CheckFailure) as e:
        rebuild(spark, None, scratch, as_of="2024-03-10", cleaned=twice, checks=declared_checks(), names="wap")
    assert "unique_fact_transactions_transaction_key" in e.value.names
    stored = spark.read.parquet(f"{scratch}/dbt_test_failures/unique_fact_transactions_transaction_key").collect()
    assert [(r.unique_field, r.n_records) for r in stored] == [(0, 2)]
    assert read_star(spark, scratch).fact.count() == 3 and len(os.listdir(f"{scratch}/runs")) == 1
    assert named("fact_transactions") == 3  # the name still is that of the old run
    warned = [not_null("fact_transactions", "tax_amount", severity="warn", warn_if=">=0")]
    star = rebuild(spark, None, scratch, as_of="2024-03-10", cleaned=twice, checks=warned, names="wap")  # warnings don't block
    assert named("fact_transactions") == read_star(spark, scratch).fact.count() == star.fact.count() == 6
    assert spark.table("wap_cleaned_data.customer_transactions").count() == 6


def test_rebuild_within_dates(spark, scratch):
    late = _cleaned(spark).unionByName(_cleaned(spark).withColumn("transaction_date", F.lit("2024-05-05").cast("date")))
    assert rebuild(spark, None, scratch, as_of="2024-06-10", cleaned=late, end="2024-02-01").fact.count() == 3
    assert rebuild(spark, None, scratch, as_of="2024-06-10", cleaned=late, start="2024-01-02", end="2024-05-05").fact.count() == 6


def test_empty_load_fails_and_publishes_nothing(spark, scratch):
    with pytest.raises(ValueError, match="no data loaded"):
        rebuild(spark, None, scratch, cleaned=_cleaned(spark).limit(0))
    with pytest.raises(FileNotFoundError):
        read_star(spark, scratch)


def test_load_checks_are_stored(spark, scratch):
    raw = spark.createDataFrame(
        [("T1", "5.0", "2024-01-01", "P2", "x", "1", "99999999999", "0.1"), ("2", "6", "2024-01-02", "3", "y", "3000000000", "3", None)],
        "transaction_id string, customer_id string, transaction_date string, product_id string, product_name string, quantity string, price string, tax string")
    star = rebuild(spark, raw, scratch, as_of="2024-03-01")
    rejects = spark.read.parquet(f"{star.path}/load_checks/reject_counts").first()
    assert (rejects.total_rows, rejects.rejected_price, rejects.rejected_quantity, rejects.rejected_tax) == (2, 1, 1, 0)
    nulls = spark.read.parquet(f"{star.path}/load_checks/null_profile").first()
    assert (nulls.null_price, nulls.null_quantity, nulls.null_tax) == (1, 1, 1)
    assert spark.read.parquet(f"{star.path}/load_checks/load_profile").first().total_rows == 2


def test_check_names_must_differ(spark, scratch):
    star = rebuild(spark, None, scratch, as_of="2024-03-10", cleaned=_cleaned(spark))
    with pytest.raises(ValueError, match="must differ"):
        check_all(spark, star, scratch, checks=[not_null("dim_customers", "customer_id")] * 2)
