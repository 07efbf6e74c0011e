import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martcraft.functions.cleaning import (
    PRICE_WORDS, clean_amount, clean_date, clean_float_id, clean_prefixed_id, clean_whole_number,
    na_to_null, py_strip, to_money,
)
from martcraft.operators.cleaning import clean_transactions, null_profile, reject_counts


def one(spark, expr, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(expr(F.col("s")).alias("x")).collect()]


def test_prefixed_id(spark):
    vals = ["T1010", "1020", " T7 ", "TT10", "t10", "1010.0", None, "", "+5", "T", "12a", "99999999999"]
    assert one(spark, lambda c: clean_prefixed_id(na_to_null(c), "T"), vals) == [
        1010, 1020, 7, None, None, None, None, None, 5, None, None, 99999999999]


def test_float_id(spark):
    vals = ["501.0", "501", "-3.7", "inf", "NaN", "1e3", "1_000", "1.0d", "abc", None, " 7.9 "]
    assert one(spark, lambda c: clean_float_id(na_to_null(c)), vals) == [
        501, 501, -3, None, None, 1000, None, None, None, None, 7]


def test_dates(spark):
    vals = ["2023-07-11", "11-07-2023", "2023-7-1", "1-7-2023", "ab-07-2023", "32-01-2023", "11-07-23",
            "2023-02-30", None, " 2023-07-10 "]
    d = dt.date
    assert one(spark, clean_date, vals) == [
        d(2023, 7, 11), d(2023, 7, 11), d(2023, 7, 1), d(2023, 7, 1), None, None, None, None, None, d(2023, 7, 10)]


def test_amounts(spark):
    vals = ["Two Hundred", " two HUNDRED ", "12.5", "1.005", "1.0d", "1_000", "inf", ".5", "1e2", "Fifteen", None]
    got = one(spark, lambda c: to_money(clean_amount(c, PRICE_WORDS)), vals)
    assert got == [Decimal("200.00"), Decimal("200.00"), Decimal("12.50"), Decimal("1.01"), None, None, None,
                   Decimal("0.50"), Decimal("100.00"), None, None]


def test_money_overflow_is_null(spark):
    assert one(spark, lambda c: to_money(clean_amount(c)), ["123456789.0"]) == [None]


def test_whole_number(spark):
    vals = ["3", "3.0", "1.5", "1e3", "", "x", "-2", None]
    assert one(spark, lambda c: clean_whole_number(na_to_null(c)), vals) == [3, 3, None, 1000, None, None, -2, None]


def test_strip_is_python_strip(spark):
    vals = ["  a b ", "\tx ", "　y ", "z"]
    assert one(spark, py_strip, vals) == [v.strip() for v in vals]


def test_na_tokens(spark):
    vals = ["NA", "n/a", "null", "None", "nan", "", "x", " NA"]
    assert one(spark, na_to_null, vals) == [None, None, None, None, None, None, "x", " NA"]


RAW = [("T1", "501.0", "11-07-2023", "P100", " Product A ", "2", "Two Hundred", "Fifteen"),
       ("2", None, "2023-07-12", "101", "Product B", "1.5", "10", "1"),
       ("x", "7", "bad", "P", "C", "", "1.0d", "")]


def test_clean_transactions_and_rejects(spark):
    raw = spark.createDataFrame(RAW, ",".join(f"{c} string" for c in (
        "transaction_id", "customer_id", "transaction_date", "product_id", "product_name", "quantity", "price", "tax")))
    rows = clean_transactions(raw).orderBy(F.col("transaction_id").asc_nulls_last()).collect()
    assert rows[0].asDict() == {"transaction_id": 1, "customer_id": 501, "transaction_date": dt.date(2023, 7, 11),
                                "product_id": 100, "product_name": "Product A", "quantity": 2,
                                "price": Decimal("200.00"), "tax": Decimal("15.00")}
    assert rows[1].quantity is None and rows[1].customer_id is None
    rej = reject_counts(raw).first().asDict()
    assert rej == {"total_rows": 3, "rejected_transaction_id": 1, "rejected_customer_id": 0,
                   "rejected_transaction_date": 1, "rejected_product_id": 1, "rejected_product_name": 0,
                   "rejected_quantity": 1, "rejected_price": 1, "rejected_tax": 0}
    prof = null_profile(clean_transactions(raw)).first()
    assert prof.total_rows == 3 and prof.null_quantity == 2 and prof.null_tax == 1


def test_on_reject_fail(spark):
    raw = spark.createDataFrame(RAW, ",".join(f"{c} string" for c in (
        "transaction_id", "customer_id", "transaction_date", "product_id", "product_name", "quantity", "price", "tax")))
    with pytest.raises(Exception, match="cannot read"):
        clean_transactions(raw, on_reject="fail").collect()
