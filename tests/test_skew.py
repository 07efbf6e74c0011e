"""A customer owning a third of the rows: results equal a brute-force computation."""
import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

from martcraft.operators.dimensions import dim_customers
from martcraft.operators.fact import fact_transactions
from martcraft.operators.dimensions import dim_products
from martcraft.operators.monthly import monthly_sales
from martcraft.operators.staging import stage_transactions

SCHEMA = ("transaction_id bigint, customer_id bigint, transaction_date date, product_id bigint, "
          "product_name string, quantity int, price decimal(10,2), tax decimal(10,2)")


def fixture(n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        cust = 1 if i % 3 == 0 else rnd.randint(2, 60)  # customer 1 holds a third of the rows
        day = dt.date(2023, 1, 1) + dt.timedelta(days=rnd.randint(0, 400))
        prod = rnd.randint(1, 200)
        rows.append((i, cust, day, prod, f"p{prod}", rnd.randint(1, 9),
                     Decimal(rnd.randint(100, 99999)) / 100, Decimal(rnd.randint(0, 999)) / 100))
    return rows


def test_hot_customer_matches_brute_force(spark):
    rows = fixture()
    stg = stage_transactions(spark.createDataFrame(rows, SCHEMA))
    cust = {r.customer_id: r for r in dim_customers(stg, "2024-03-01").collect()}
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    for c, rs in by.items():
        got = cust[c]
        assert got.total_transactions == len(rs)
        assert got.unique_products_purchased == len({r[3] for r in rs})
        assert got.unique_transaction_days == len({r[2] for r in rs})
        assert got.months_active == len({(r[2].year, r[2].month) for r in rs})
        assert got.total_lifetime_value == sum(r[5] * r[6] + r[7] for r in rs)
    assert cust[1].total_transactions == 1000

    prod = dim_products(stg, "2024-03-01")
    monthly = {(r.customer_fk, r.transaction_month): r
               for r in monthly_sales(fact_transactions(stg, dim_customers(stg, "2024-03-01"), prod)).collect()}
    want = defaultdict(lambda: [0, set(), Decimal(0)])
    for r in rows:
        k = (r[1], r[2].replace(day=1))
        want[k][0] += 1
        want[k][1].add(r[3])
        want[k][2] += r[5] * r[6] + r[7]
    assert set(monthly) == set(want)
    for k, (n, prods, net) in want.items():
        m = monthly[k]
        assert (m.transaction_count, m.unique_products_purchased, m.monthly_net_revenue) == (n, len(prods), net)
