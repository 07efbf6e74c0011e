"""The modelled project's own sample: raw CSV -> cleaned CSV, and the marts' golden values."""
import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martcraft.config import DEFAULT_BANDS
from martcraft.operators.cleaning import clean_transactions
from martcraft.operators.dimensions import dim_customers, dim_products
from martcraft.operators.fact import fact_transactions
from martcraft.operators.monthly import monthly_sales
from martcraft.operators.staging import stage_transactions, valid_transactions
from martcraft.sources.raw import read_raw_csv
from tests.conftest import SAMPLE_CLEANED, SAMPLE_RAW

pytestmark = pytest.mark.skipif(not (SAMPLE_RAW and os.path.exists(SAMPLE_RAW)),
                                reason="set MARTCRAFT_SAMPLE_DIR to the folder with the sample CSV pair")

CLEANED_SCHEMA = ("transaction_id bigint, customer_id bigint, transaction_date date, product_id bigint, "
                  "product_name string, quantity int, price decimal(10,2), tax decimal(10,2)")
AS_OF = "2023-07-25"


@pytest.fixture(scope="module")
def star(spark):
    raw = read_raw_csv(spark, SAMPLE_RAW)
    cleaned = clean_transactions(raw)
    stg = stage_transactions(cleaned)
    cust = dim_customers(stg, AS_OF, DEFAULT_BANDS)
    prod = dim_products(stg, AS_OF, DEFAULT_BANDS)
    fact = fact_transactions(stg, cust, prod)
    return dict(raw=raw, cleaned=cleaned, stg=stg, cust=cust, prod=prod, fact=fact, monthly=monthly_sales(fact))


def test_clean_equals_golden_file(spark, star):
    got = star["cleaned"].drop("loaded_at", "source_file")
    want = spark.read.schema(CLEANED_SCHEMA).option("header", True).csv(SAMPLE_CLEANED)
    assert got.count() == want.count() == 100
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_raw_audit_columns(star):
    r = star["raw"].groupBy("source_file").count().collect()
    assert [(x.source_file, x["count"]) for x in r] == [("customer_transactions.csv", 100)]
    assert star["raw"].filter(F.col("loaded_at").isNull()).count() == 0


def test_staging_totals(star):
    s = star["stg"].agg(F.sum("subtotal").alias("sub"), F.sum("total_amount").alias("tot")).first()
    assert (s.sub, s.tot) == (Decimal("46411.29"), Decimal("47926.90"))
    assert valid_transactions(star["stg"]).count() == 72
    v = valid_transactions(star["stg"]).agg(F.sum("total_amount")).first()[0]
    assert v == Decimal("40287.02")
    mn, mx = star["stg"].agg(F.min("transaction_date"), F.max("transaction_date")).first()
    assert (mn, mx) == (dt.date(2023, 7, 10), dt.date(2023, 7, 20))
    names = {(r.month_name, r.day_name) for r in star["stg"].filter("transaction_date = '2023-07-10'")
             .select("month_name", "day_name").distinct().collect()}
    assert names == {("July     ", "Monday   ")}


# Golden per-customer rows (customer, n, days, products, first, last, units, value, average).
GOLDEN_CUSTOMERS = [
    (500, 6, 5, 1, "2023-07-11", "2023-07-20", 15, "3576.47", "596.078333"),
    (501, 8, 5, 1, "2023-07-11", "2023-07-17", 28, "5028.47", "628.558750"),
    (502, 7, 5, 1, "2023-07-11", "2023-07-19", 19, "2785.57", "397.938571"),
    (503, 9, 8, 1, "2023-07-11", "2023-07-19", 20, "3684.14", "409.348889"),
    (504, 6, 5, 1, "2023-07-11", "2023-07-17", 14, "2832.18", "472.030000"),
    (505, 9, 7, 1, "2023-07-10", "2023-07-18", 31, "6389.37", "709.930000"),
    (506, 5, 4, 1, "2023-07-10", "2023-07-18", 13, "2465.36", "493.072000"),
    (507, 8, 6, 1, "2023-07-13", "2023-07-18", 27, "6685.48", "835.685000"),
    (508, 5, 3, 1, "2023-07-18", "2023-07-20", 10, "2022.26", "404.452000"),
    (509, 9, 8, 1, "2023-07-10", "2023-07-20", 26, "4817.72", "535.302222"),
]


def test_dim_customers_golden(star):
    rows = {r.customer_id: r for r in star["cust"].collect()}
    assert sorted(rows) == [g[0] for g in GOLDEN_CUSTOMERS]
    for cid, n, days, prods, first, last, units, value, avg in GOLDEN_CUSTOMERS:
        r = rows[cid]
        assert (r.total_transactions, r.unique_transaction_days, r.unique_products_purchased) == (n, days, prods)
        assert (str(r.first_transaction_date), str(r.last_transaction_date)) == (first, last)
        assert r.total_units_purchased == units
        assert r.total_lifetime_value == Decimal(value) and r.avg_transaction_value == Decimal(avg)
        assert r.value_segment == ("VIP" if cid in (501, 505, 507) else "High Value")
        assert r.aov_tier == ("High AOV" if cid in (500, 501, 505, 507, 509) else "Medium AOV")
        assert (r.frequency_segment, r.customer_tier) == ("Occasional", "Silver")
        assert r.years_active == 1 and r.months_active == 1


# Golden per-product rows (product, name, n, customers, units, revenue, avg, min, max, stddev, per customer).
GOLDEN_PRODUCTS = [
    (100, "Product E", 15, 2, 46, "9965.84", "212.132000", "52.97", "268.73", 63.054647, "4982.92"),
    (101, "Product A", 13, 2, 41, "7493.83", "166.446923", "76.27", "277.97", 55.423224, "3746.915"),
    (102, "Product B", 15, 2, 46, "9471.05", "189.520667", "87.23", "297.51", 76.324604, "4735.525"),
    (103, "Product C", 14, 2, 30, "5706.40", "186.916429", "57.47", "287.25", 72.720914, "2853.20"),
    (104, "Product D", 15, 2, 40, "7649.90", "179.356000", "94.46", "290.43", 61.951660, "3824.95"),
]


def test_dim_products_golden(star):
    rows = {r.product_id: r for r in star["prod"].collect()}
    assert sorted(rows) == [g[0] for g in GOLDEN_PRODUCTS]
    for pid, name, n, cust, units, rev, avg, mn, mx, sd, rpc in GOLDEN_PRODUCTS:
        r = rows[pid]
        assert (r.product_name, r.total_transactions, r.unique_customers, r.total_units_sold) == (name, n, cust, units)
        assert r.total_revenue == Decimal(rev) and r.avg_unit_price == Decimal(avg)
        assert (r.min_unit_price, r.max_unit_price) == (Decimal(mn), Decimal(mx))
        assert abs(r.stddev_unit_price - sd) < 1e-6
        assert r.revenue_per_customer == Decimal(rpc)
        assert (r.revenue_segment, r.volume_segment, r.price_tier) == ("Medium Performer", "Low Volume", "Premium")


# Golden monthly rows (customer, n, gross, tax, net).
GOLDEN_MONTHLY = [
    (500, 6, "3455.95", "120.52", "3576.47"), (501, 8, "4906.60", "121.87", "5028.47"),
    (502, 7, "2662.29", "123.28", "2785.57"), (503, 9, "3492.21", "191.93", "3684.14"),
    (504, 6, "2719.71", "112.47", "2832.18"), (505, 9, "6221.74", "167.63", "6389.37"),
    (506, 5, "2358.49", "106.87", "2465.36"), (507, 8, "6540.58", "144.90", "6685.48"),
    (508, 5, "1933.05", "89.21", "2022.26"), (509, 9, "4691.51", "126.21", "4817.72"),
]


def test_monthly_golden(star):
    rows = {r.customer_fk: r for r in star["monthly"].collect()}
    assert sorted(rows) == [g[0] for g in GOLDEN_MONTHLY]
    for cid, n, gross, tax, net in GOLDEN_MONTHLY:
        r = rows[cid]
        assert str(r.transaction_month) == "2023-07-01"
        assert (r.transaction_count, r.monthly_gross_revenue, r.monthly_tax, r.monthly_net_revenue) == (
            n, Decimal(gross), Decimal(tax), Decimal(net))
        assert r.previous_month_revenue is None and r.revenue_growth_pct is None
        assert r.transaction_growth_pct is None
