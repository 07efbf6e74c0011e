"""Marts kept up to date by mergeable states, against a full rebuild."""
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from martcraft.operators.dimensions import dim_customers, dim_products
from martcraft.operators.fact import fact_transactions
from martcraft.operators.monthly import monthly_sales
from martcraft.operators.staging import stage_transactions
from martcraft.plans.incremental import IncrementalMarts

CLEANED = ("transaction_id bigint, customer_id bigint, transaction_date date, product_id bigint, product_name string, "
           "quantity int, price decimal(10,2), tax decimal(10,2), loaded_at timestamp_ntz")
AS_OF = "2024-12-31"


def cleaned(spark, seed, n, customers=40, since=0):
    from decimal import Decimal
    r = random.Random(seed)
    rows = []
    for i in range(n):
        c = r.choice([None, 7, 7, r.randrange(customers)])  # one customer has half of the rows
        rows.append((since + i, c, r.choice([None, dt.date(2023, 1, 1) + dt.timedelta(r.randrange(700))]) if i % 9 == 0 else dt.date(2023, 1, 1) + dt.timedelta(r.randrange(700)),
                     r.choice([None, r.randrange(15)]) if i % 5 == 0 else r.randrange(15), r.choice(["a", "b", None, "ö"]),
                     r.choice([None, 0, 1, 5]), r.choice([None, Decimal("0.00"), Decimal(r.randrange(1, 99999)) / 100]), r.choice([None, Decimal("1.25")]), None))
    return spark.createDataFrame(rows, CLEANED)


def same(a, b):
    cols = sorted(b.columns)
    assert sorted(a.columns) == cols
    assert {f.name: f.dataType for f in a.schema} == {f.name: f.dataType for f in b.schema}
    rounded = lambda df: df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in sorted(df.dtypes)))
    assert sorted(map(str, rounded(a).collect())) == sorted(map(str, rounded(b).collect()))


def full(df):
    stg = stage_transactions(df)
    c, p = dim_customers(stg, AS_OF, audit=False), dim_products(stg, AS_OF, audit=False)
    return c, p, monthly_sales(fact_transactions(stg, c, p, audit=False), audit=False)


def test_loads_equal_the_full_rebuild(spark, scratch):
    marts = IncrementalMarts(spark, f"{scratch}/marts")
    parts = [cleaned(spark, 1, 300), cleaned(spark, 2, 200, since=300), cleaned(spark, 3, 5, since=500), cleaned(spark, 4, 0), cleaned(spark, 5, 120, customers=90, since=600)]
    so_far = None
    for i, part in enumerate(parts):
        assert marts.load(part, f"load-{i}")
        so_far = part if so_far is None else so_far.unionByName(part)
        if i in (2, 4):
            c, p, m = full(so_far)
            same(marts.customers(AS_OF, audit=False), c)
            same(marts.products(AS_OF, audit=False), p)
            same(marts.monthly(AS_OF), m)
    assert not marts.load(parts[1], "load-1")  # known
    same(marts.monthly(AS_OF), full(so_far)[2])


def test_a_load_rewrites_only_files_of_its_keys(spark, scratch):
    from martcraft.plans.key_index import KeyedTable
    marts = IncrementalMarts(spark, f"{scratch}/marts")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files of little data
    try:
        marts.load(cleaned(spark, 8, 2000, customers=400), "first")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = lambda name: set(marts._table(name).listed())
    before = {n: files(n) for n in ("customer_days", "customers", "months", "customer_pairs")}
    assert all(len(f) > 2 for f in before.values())
    c = marts.customers(AS_OF).orderBy(F.desc("customer_id")).first()
    first = c.last_transaction_date
    one = cleaned(spark, 9, 3, since=5000).withColumn("customer_id", F.lit(c.customer_id).cast("long")).withColumn("quantity", F.lit(2)).withColumn(
        "price", F.lit("3.00").cast("decimal(10,2)")).withColumn("transaction_date", F.lit("2024-06-01").cast("date"))
    marts.load(one, "second")
    for n, was in before.items():
        assert len(was - files(n)) == 1, n  # the rest of the files are the same ones
    assert marts.customers(AS_OF).where(F.col("customer_id") == c.customer_id).first().last_transaction_date == max(dt.date(2024, 6, 1), first)
    assert isinstance(marts._table("months"), KeyedTable)


def test_growth_of_the_next_active_month_is_repaired(spark, scratch):
    from decimal import Decimal
    row = lambda i, day, price: (i, 1, dt.date.fromisoformat(day), 2, "x", 1, Decimal(price), Decimal("0.00"), None)
    marts = IncrementalMarts(spark, f"{scratch}/marts")
    marts.load(spark.createDataFrame([row(1, "2024-01-05", "10.00"), row(2, "2024-05-05", "30.00")], CLEANED), "a")
    growth = lambda: {str(r.transaction_month): (r.previous_month_revenue, r.revenue_growth_pct) for r in marts.monthly(AS_OF).collect()}
    assert growth()["2024-05-01"] == (Decimal("10.00"), 200.0)
    marts.load(spark.createDataFrame([row(3, "2024-03-05", "20.00")], CLEANED), "b")  # late
    assert growth() == {"2024-01-01": (None, None), "2024-03-01": (Decimal("10.00"), 100.0), "2024-05-01": (Decimal("20.00"), 50.0)}


def test_a_load_cut_short_is_noticed(spark, scratch, monkeypatch):
    marts = IncrementalMarts(spark, f"{scratch}/marts")
    marts.load(cleaned(spark, 1, 30), "a")
    monkeypatch.setattr(IncrementalMarts, "_renew", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        marts.load(cleaned(spark, 2, 30), "b")
    monkeypatch.undo()
    with pytest.raises(RuntimeError, match="rebuild"):
        marts.load(cleaned(spark, 3, 30), "c")
    whole = cleaned(spark, 1, 30).unionByName(cleaned(spark, 2, 30, since=30))
    marts.rebuild(whole, "all")
    same(marts.customers(AS_OF, audit=False), full(whole)[0])
    assert os.path.exists(f"{scratch}/marts/loads/all")
