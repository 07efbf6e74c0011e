"""A dirty sample file through the whole star schema, against values worked out by hand."""
from decimal import Decimal

import pytest

from martcraft.plans.rebuild import rebuild
from martcraft.sources.raw import read_raw_csv

RAW = """transaction_id,customer_id,transaction_date,product_id,product_name,quantity,price,tax
T1,501.0,2024-01-05,P10,Lamp,2.0,Two Hundred,1.50
2,501.0,06-01-2024,10, Lamp ,1.0,100.00,Fifteen
3,501.0,2024-02-10,P11,Desk,3.0,50.25,0.75
T4,502.0,2024-01-05,11,Desk,1.0,60.00,2.00
5,,2024-01-07,10,Lamp,1.0,10.00,0.10
6,502.0,2024-03-01,P10,Lamp,,20.00,0.20
7,502.0,15-02-2024,12,Rug,4.0,25.00,N/A
T8,503.0,2024-02-29,12,Rug,2.0,Two Hundred,Fifteen
"""


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("sample")
    (d / "customer_transactions.csv").write_text(RAW)
    return rebuild(spark, read_raw_csv(spark, str(d / "customer_transactions.csv")), str(d / "wh"), as_of="2024-03-10")


def rows(df, *cols):
    return sorted((tuple(None if v is None else str(v) for v in r) for r in df.select(*cols).collect()), key=str)


def test_cleaned(star):
    got = rows(star.cleaned, "transaction_id", "customer_id", "transaction_date", "product_id", "product_name", "quantity", "price", "tax")
    assert got == [
        ("1", "501", "2024-01-05", "10", "Lamp", "2", "200.00", "1.50"),
        ("2", "501", "2024-01-06", "10", "Lamp", "1", "100.00", "15.00"),
        ("3", "501", "2024-02-10", "11", "Desk", "3", "50.25", "0.75"),
        ("4", "502", "2024-01-05", "11", "Desk", "1", "60.00", "2.00"),
        ("5", None, "2024-01-07", "10", "Lamp", "1", "10.00", "0.10"),
        ("6", "502", "2024-03-01", "10", "Lamp", None, "20.00", "0.20"),
        ("7", "502", "2024-02-15", "12", "Rug", "4", "25.00", None),
        ("8", "503", "2024-02-29", "12", "Rug", "2", "200.00", "15.00"),
    ]
    assert {r.source_file for r in star.cleaned.collect()} == {"customer_transactions.csv"}


def test_staging(star):
    got = rows(star.stg.where("transaction_id in (3, 5, 6, 7)"), "transaction_id", "month_name", "day_name", "subtotal", "total_amount", "is_valid_transaction")
    assert got == [
        ("3", "February ", "Saturday ", "150.75", "151.50", "True"),
        ("5", "January  ", "Sunday   ", "10.00", "10.10", "False"),
        ("6", "March    ", "Friday   ", None, None, "False"),
        ("7", "February ", "Thursday ", "100.00", None, "True"),
    ]


def test_customers(star):
    got = rows(star.customers, "customer_id", "total_transactions", "unique_transaction_days", "years_active", "months_active", "unique_products_purchased",
               "days_since_last_purchase", "customer_age_days", "total_units_purchased", "total_lifetime_value", "avg_transaction_value",
               "min_transaction_value", "max_transaction_value", "value_segment", "frequency_segment", "recency_segment", "aov_tier", "customer_tier")
    assert got == [
        ("501", "3", "3", "1", "2", "2", "29", "65", "6", "668.00", "222.666667", "115.00", "401.50", "Medium Value", "Rare", "Recent", "Medium AOV", "Bronze"),
        ("502", "2", "2", "1", "2", "2", "24", "65", "5", "62.00", "62.000000", "62.00", "62.00", "Low Value", "Rare", "Recent", "Low AOV", "Bronze"),
        ("503", "1", "1", "1", "1", "1", "10", "10", "2", "415.00", "415.000000", "415.00", "415.00", "Low Value", "Rare", "Recent", "Medium AOV", "Bronze"),
    ]


def test_products(star):
    got = rows(star.products, "product_id", "product_name", "total_transactions", "unique_transaction_days", "unique_customers", "total_units_sold",
               "total_revenue", "revenue_per_customer", "avg_unit_price", "min_unit_price", "max_unit_price", "price_tier", "revenue_segment", "volume_segment")
    assert [(*r[:7], Decimal(r[7]), *r[8:]) for r in got] == [
        ("10", "Lamp", "2", "2", "1", "3", "516.50", Decimal("516.5"), "150.000000", "100.00", "200.00", "Premium", "Low Performer", "Low Volume"),
        ("11", "Desk", "2", "2", "2", "4", "213.50", Decimal("106.75"), "55.125000", "50.25", "60.00", "Mid-Range", "Low Performer", "Low Volume"),
        ("12", "Rug", "2", "2", "2", "6", "415.00", Decimal("207.5"), "112.500000", "25.00", "200.00", "Premium", "Low Performer", "Low Volume"),
    ]
    sd = {r.product_id: r.stddev_unit_price for r in star.products.collect()}
    assert abs(sd[10] - 70.710678) < 1e-6 and abs(sd[11] - 6.894291) < 1e-6 and abs(sd[12] - 123.743687) < 1e-6


def test_fact_and_monthly(star):
    assert sorted(r.transaction_key for r in star.fact.collect()) == [1, 2, 3, 4, 7, 8]
    got = rows(star.monthly, "customer_fk", "transaction_month", "transaction_count", "unique_products_purchased", "total_units", "monthly_gross_revenue",
               "monthly_tax", "monthly_net_revenue", "previous_month_revenue", "previous_month_transactions")
    assert got == [
        ("501", "2024-01-01", "2", "1", "3", "500.00", "16.50", "516.50", None, None),
        ("501", "2024-02-01", "1", "1", "3", "150.75", "0.75", "151.50", "516.50", "2"),
        ("502", "2024-01-01", "1", "1", "1", "60.00", "2.00", "62.00", None, None),
        ("502", "2024-02-01", "1", "1", "4", "100.00", None, None, "62.00", "1"),
        ("503", "2024-02-01", "1", "1", "2", "400.00", "15.00", "415.00", None, None),
    ]
    growth = {(r.customer_fk, r.transaction_month.month): (r.revenue_growth_pct, r.transaction_growth_pct) for r in star.monthly.collect()}
    assert abs(growth[501, 2][0] - -70.66795740561471) < 1e-9 and growth[501, 2][1] == -50.0
    assert growth[502, 2] == (None, 0.0) and growth[501, 1] == (None, None)
