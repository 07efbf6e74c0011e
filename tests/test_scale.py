"""What the marts shuffle and evaluate: plans that grow no faster than the rows."""
import re

import pytest
from pyspark.sql import functions as F

from martcraft.functions import cleaning as C
from martcraft.functions.dates import day_name, month_name
from martcraft.operators.cleaning import RAW_COLUMNS, clean_transactions
from martcraft.operators.dimensions import dim_customers, dim_products
from martcraft.operators.fact import fact_transactions
from martcraft.operators.monthly import monthly_sales
from martcraft.operators.staging import stage_transactions
from martcraft.plans.materialize import materialize
from martcraft.plans.refresh import append_incremental, read_target
from tests.test_skew import SCHEMA, fixture


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture()
def merged(spark):
    """Dimensions too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_na_words_are_tested_once_a_column(spark):
    raw = spark.range(10).select(*[F.concat(F.lit(c), F.col("id").cast("string")).alias(c) for c in RAW_COLUMNS])
    assert len(re.findall(r"\bINSET\b|\bIN \(", plan(clean_transactions(raw)))) == len(RAW_COLUMNS)


def test_plain_text_reads_as_by_the_full_rules(spark):
    texts = ["0", "12", "007", "1.5", "1.005", "12345678.99", "123456789.99", "99999999.995", "999999999999999", "1234567890123456", "1e3", "12.", ".5", "-3", "+4", " 5 ", "5\n", "5 ",
             "2023-01-05", "2023-1-5", "2023-02-30", "0000-01-01", "0999-01-01", "2023-01-05\n", " 2023-01-05", "05-01-2023", "Two Hundred", "x y", " x y ", "x\ny", "\tx", "x　", "", "é", "T12", "P7"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "s string")
    c, spaced = F.col("s"), F.concat(F.lit("\t"), F.col("s"), F.lit(" "))  # never plain
    rules = {"id": lambda x: C.clean_prefixed_id(x, "T"), "float_id": C.clean_float_id, "date": lambda x: C.clean_date(x).cast("string"), "whole": C.clean_whole_number,
             "money": lambda x: C.clean_money(x, C.PRICE_WORDS), "text": C.clean_text}
    got = df.select("s", *[f(c).alias(f"{n}_a") for n, f in rules.items()], *[f(spaced).alias(f"{n}_b") for n, f in rules.items()])
    for r in got.collect():
        assert all(r[f"{n}_a"] == r[f"{n}_b"] for n in rules), r
    assert df.select(C.clean_money(c, {"12": 5.0})).where("s = '12'").first()[0] == 5


def star(spark, **kw):
    stg = stage_transactions(spark.createDataFrame(fixture(300), SCHEMA))
    return fact_transactions(stg, dim_customers(stg, "2024-03-01"), dim_products(stg, "2024-03-01"), audit=False, **kw)


def test_derived_columns_are_not_shuffled(spark, merged):
    """Amounts and date parts of a row are derived behind the joins."""
    text = star(spark)._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in text[text.index("SortMergeJoin"):].splitlines() if "Project" in x and "transaction_id" in x]
    assert lines and not any("subtotal" in x or "transaction_quarter" in x for x in lines)


def test_monthly_aggregates_follow_the_customers_join(spark, merged):
    fact = star(spark, customer_last=True)
    got = monthly_sales(fact, audit=False)
    pruned = fact.select("customer_fk", "product_fk", "transaction_date", "units_sold", "unit_price", "tax_amount", "customer_tier", "customer_value_segment")
    assert exchanges(got) == exchanges(pruned)
    assert sorted(map(str, got.collect())) == sorted(map(str, monthly_sales(star(spark), audit=False).collect()))


def test_names_are_those_of_date_format(spark):
    days = spark.range(0, 40000, 7).select(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("d")).unionByName(
        spark.createDataFrame([(None,)], "d date"))
    got = days.select("d", month_name(F.col("d"), False).alias("m"), day_name(F.col("d"), False).alias("w"), month_name(F.col("d")).alias("mp"), day_name(F.col("d")).alias("wp"))
    m, w = F.date_format("d", "MMMM"), F.date_format("d", "EEEE")
    same = F.col("m").eqNullSafe(m) & F.col("w").eqNullSafe(w) & F.col("mp").eqNullSafe(F.rpad(m, 9, " ")) & F.col("wp").eqNullSafe(F.rpad(w, 9, " "))
    assert got.where(~same).count() == 0
    assert got.where("m is null and wp is null").count() == 1
    assert "date_format" not in plan(got)


def test_written_steps_are_compiled(spark):
    """Methods too long for the JVM's compiler are not run; a session's own limit stays."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    old = spark.conf.get(limit)
    try:
        spark.conf.unset(limit)
        materialize(spark.range(3).toDF("x"), "limit")
        assert spark.conf.get(limit) == "8000"
        spark.conf.set(limit, "9000")
        materialize(spark.range(3).toDF("x"), "limit")
        assert spark.conf.get(limit) == "9000"
    finally:
        spark.conf.set(limit, old)


def test_words_are_found_without_lower_case_copies(spark):
    texts = ["two hundred", "Two HUNDRED", " two hundred ", "two  hundred", "two hundred\n", "TEN K", "ten \u212a", "ten k", "te\u0307n k", "\u017fix", "SIX", "six", "3.5", "x", ""]
    words = {"two hundred": 200.0, "Ten K": 10.0, "six": 6.0}
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "s string")
    low = F.lower(C.py_strip(F.col("s")))
    was = F.when(low == "two hundred", 200.0).when(low == "ten k", 10.0).when(low == "six", 6.0).when(low == "3.5", 3.5)
    got = df.select("s", C.clean_amount(F.col("s"), words).alias("now"), was.alias("was"))
    assert all(r.now == r.was for r in got.collect()), got.collect()
    assert "lower(" not in plan(got.select("now"))


def test_the_fact_is_dealt_out_before_columns_are_derived(spark, merged):
    text = plan(star(spark, by_month=True))
    under = text[text.index("RebalancePartitions"):]
    assert "quarter(" in text and "quarter(" not in under and "transaction_month" in under
    assert sorted(map(str, star(spark, by_month=True).collect())) == sorted(map(str, star(spark).collect()))


def test_rows_dealt_by_month_are_loaded_without_a_shuffle(spark, scratch, monkeypatch):
    rows = spark.range(40).select(F.col("id").alias("transaction_key"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") * 3).cast("int")).alias("transaction_date"))
    rows = rows.withColumn("transaction_month", F.trunc("transaction_date", "MM")).withColumn("v", F.col("transaction_key") * 2)
    late = rows.where("transaction_key >= 30 or transaction_key % 5 = 0").withColumn("v", F.lit(-1).cast("bigint"))
    shuffled, hint = [], type(rows).hint
    monkeypatch.setattr(type(rows), "hint", lambda self, name, *a: (shuffled.append(name), hint(self, name, *a))[1])
    for name, dealt in (("plain", False), ("dealt", True)):
        shuffled.clear()
        append_incremental(spark, rows.where("transaction_key % 5 <> 0"), f"{scratch}/{name}", repeats="keep", dealt=dealt)
        assert shuffled == ([] if dealt else ["rebalance"])
        append_incremental(spark, late, f"{scratch}/{name}", repeats="keep", dealt=dealt)
        assert sorted(read_target(spark, f"{scratch}/{name}").select("transaction_key", "v").collect()) == [
            (k, -1 if k >= 30 or k % 5 == 0 else k * 2) for k in range(40)]


def test_the_hash_of_a_row_is_made_behind_the_shuffle(spark, scratch):
    from martcraft.plans.refresh import _single
    rows = spark.createDataFrame([(1, "2024-01-02", "a"), (1, "2024-01-03", "b"), (2, "2024-01-01", "c"), (None, "2024-01-01", "d"), (None, "2024-01-01", "d")],
                                 "transaction_key bigint, transaction_date string, v string")
    got = _single(rows, "transaction_key", "transaction_date", "latest")
    text = got._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "sha2" in text and "sha2" not in text[text.index("Exchange"):]
    assert sorted(r.v for r in got.collect()) == ["b", "c", "d", "d"] and got.columns == rows.columns
