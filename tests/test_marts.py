"""Edge fixture: band edges, several months with a gap, NULL/zero/negative values, duplicates."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martcraft.config import DEFAULT_BANDS, Ladder
from martcraft.functions.bands import band, tier
from martcraft.operators.dimensions import dim_customers, dim_products
from martcraft.operators.fact import fact_transactions
from martcraft.operators.monthly import monthly_sales
from martcraft.operators.reports import monthly_trend, product_by_tier, top_customers
from martcraft.operators.staging import stage_transactions

SCHEMA = ("transaction_id bigint, customer_id bigint, transaction_date date, product_id bigint, "
          "product_name string, quantity int, price decimal(10,2), tax decimal(10,2)")
D = dt.date


def rows():
    return [
        # customer 1: Jan, Feb, (gap) Apr; Feb revenue 0 is impossible (price>0), so growth over a gap
        (1, 1, D(2024, 1, 5), 10, "Widget", 2, Decimal("10.00"), Decimal("1.00")),
        (2, 1, D(2024, 1, 6), 11, "Gadget", 1, Decimal("5.00"), Decimal("0.50")),
        (3, 1, D(2024, 2, 1), 10, "Widget", 1, Decimal("10.00"), Decimal("1.00")),
        (4, 1, D(2024, 4, 9), 10, "Widgets", 3, Decimal("10.00"), None),      # NULL tax: NULL total
        (5, 1, D(2024, 4, 9), 12, "Solo", 1, Decimal("7.00"), Decimal("0.70")),  # one sale: NULL stddev
        (6, 2, D(2024, 3, 3), None, "Ghost", 1, Decimal("3.00"), Decimal("0.30")),  # NULL product id
        (7, 2, D(2024, 3, 3), 11, "Gadget", 0, Decimal("5.00"), Decimal("0.50")),    # zero qty: invalid
        (8, 2, D(2024, 3, 4), 11, "Gadget", 1, Decimal("-5.00"), Decimal("0.50")),   # negative price: invalid
        (9, None, D(2024, 3, 4), 11, "Gadget", 1, Decimal("5.00"), Decimal("0.50")),  # NULL customer: invalid
        (9, 3, D(2024, 3, 5), 11, "Gadget", 4, Decimal("5.00"), Decimal("0.50")),     # duplicate id
        (10, 3, D(2024, 5, 5), 11, "Gadget", 1, Decimal("5.00"), Decimal("0.00")),
    ]


@pytest.fixture(scope="module")
def star(spark):
    cleaned = spark.createDataFrame(rows(), SCHEMA)
    stg = stage_transactions(cleaned)
    c = dim_customers(stg, "2024-05-10", DEFAULT_BANDS)
    p = dim_products(stg, "2024-05-10", DEFAULT_BANDS)
    f = fact_transactions(stg, c, p)
    return dict(stg=stg, c=c, p=p, f=f, m=monthly_sales(f))


def test_flags(star):
    got = {r.transaction_id: (r.is_valid_quantity, r.is_valid_price, r.is_valid_transaction)
           for r in star["stg"].filter("transaction_id in (7, 8)").collect()}
    assert got == {7: (False, True, False), 8: (True, False, False)}
    assert star["stg"].filter("is_valid_transaction").count() == 8


def test_customers(star):
    c = {r.customer_id: r for r in star["c"].collect()}
    assert sorted(c) == [1, 2, 3]
    r1 = c[1]
    assert (r1.total_transactions, r1.unique_transaction_days, r1.months_active, r1.years_active) == (5, 4, 3, 1)
    assert r1.unique_products_purchased == 3
    assert r1.total_lifetime_value == Decimal("21.00") + Decimal("5.50") + Decimal("11.00") + Decimal("7.70")
    assert r1.days_since_last_purchase == 31 and r1.customer_age_days == (D(2024, 5, 10) - D(2024, 1, 5)).days
    assert c[2].unique_products_purchased == 0  # only a NULL product id
    assert c[1].recency_segment == "Lapsed" and c[3].recency_segment == "Active"


def test_products(star):
    p = {r.product_id: r for r in star["p"].collect()}
    assert None in p and p[None].total_transactions == 1 and p[None].unique_customers == 1
    assert p[10].product_name == "Widgets"  # alphabetical max, as modelled
    assert p[12].stddev_unit_price is None
    assert p[11].unique_customers == 2 and p[11].total_units_sold == 1 + 4 + 1


def test_fact_drops_null_product(star):
    ids = sorted(r.transaction_key for r in star["f"].collect())
    assert ids == [1, 2, 3, 4, 5, 9, 10]


def test_monthly_growth_over_gap(star):
    m = {(r.customer_fk, str(r.transaction_month)): r for r in star["m"].collect()}
    jan, feb, apr = m[(1, "2024-01-01")], m[(1, "2024-02-01")], m[(1, "2024-04-01")]
    assert jan.previous_month_revenue is None and jan.revenue_growth_pct is None
    assert feb.previous_month_revenue == Decimal("26.50") and feb.previous_month_transactions == 2
    assert abs(feb.revenue_growth_pct - -58.4905660377) < 1e-9  # -15.5 / 26.5 * 100
    assert feb.transaction_growth_pct == -50.0
    # April's previous ACTIVE month is February (no calendar fill); NULL total ignored in the sum
    assert apr.previous_month_revenue == Decimal("11.00") and apr.monthly_net_revenue == Decimal("7.70")
    assert apr.transaction_count == 2 and apr.unique_products_purchased == 2
    assert apr.avg_revenue_per_transaction == Decimal("3.85")


def test_reports(star):
    top = top_customers(star["c"], 2).collect()
    assert [r.customer_id for r in top] == [1, 3]
    trend = monthly_trend(star["f"]).collect()
    assert [str(r.transaction_month) for r in trend] == ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01",
                                                        "2024-05-01"]
    fact = star["f"].collect()
    want = {}
    for r in fact:
        k = (r.product_name, r.customer_tier)
        n, tot = want.get(k, (0, Decimal(0)))
        want[k] = (n + 1, tot + (r.net_amount or 0))
    got = {(r.product_name, r.customer_tier): (r.transactions, r.revenue) for r in product_by_tier(star["f"]).collect()}
    assert got == want


@pytest.mark.parametrize("value,label", [(5000, "VIP"), (4999.99, "High Value"), (2000, "High Value"),
                                         (1999.99, "Medium Value"), (500, "Medium Value"), (499.99, "Low Value"),
                                         (None, "Low Value")])
def test_value_band_edges(spark, value, label):
    df = spark.createDataFrame([(None if value is None else float(value),)], "v double")
    assert df.select(band(F.col("v"), DEFAULT_BANDS.value_segment)).first()[0] == label


@pytest.mark.parametrize("days,label", [(7, "Active"), (8, "Recent"), (30, "Recent"), (31, "Lapsed"),
                                        (90, "Lapsed"), (91, "Inactive"), (None, "Inactive")])
def test_recency_band_edges(spark, days, label):
    df = spark.createDataFrame([(days,)], "d int")
    assert df.select(band(F.col("d"), DEFAULT_BANDS.recency_segment)).first()[0] == label


@pytest.mark.parametrize("v,n,label", [(5000, 15, "Platinum"), (5000, 14, "Gold"), (4999, 15, "Gold"),
                                       (2000, 10, "Gold"), (2000, 9, "Silver"), (500, 5, "Silver"),
                                       (499, 5, "Bronze"), (500, 4, "Bronze"), (None, 20, "Bronze")])
def test_tier_edges(spark, v, n, label):
    df = spark.createDataFrame([(None if v is None else float(v), n)], "v double, n int")
    assert df.select(tier(F.col("v"), F.col("n"), DEFAULT_BANDS.customer_tier)).first()[0] == label


def test_all_ladders_hit_every_label(spark):
    for name in ("frequency_segment", "aov_tier", "revenue_segment", "volume_segment", "price_tier"):
        lad: Ladder = getattr(DEFAULT_BANDS, name)
        vals = [b for b, _ in lad.rungs] + [lad.rungs[-1][0] - 1]
        df = spark.createDataFrame([(float(v),) for v in vals], "v double")
        assert [r[0] for r in df.select(band(F.col("v"), lad)).collect()] == list(lad.labels), name


def test_latest_name_rule(spark):
    two_names = [(1, 1, D(2024, 1, 1), 50, "Zeta", 1, Decimal("1.00"), Decimal("0.10")),
                 (2, 1, D(2024, 3, 1), 50, "Alpha", 1, Decimal("1.00"), Decimal("0.10"))]
    stg = stage_transactions(spark.createDataFrame(two_names, SCHEMA))
    assert dim_products(stg, "2024-05-10").first().product_name == "Zeta"  # alphabetical max, as modelled
    assert dim_products(stg, "2024-05-10", name_rule="latest").first().product_name == "Alpha"
