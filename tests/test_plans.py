"""Plan shape: the properties the design relies on at scale, read from explain()."""
import os

import pytest

from martcraft.plans.registry import QUERIES
from martcraft.sources.driver import driver_transactions
from tests.conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver tables not present")


def formatted(df) -> str:
    """The text ``df.explain("formatted")`` prints."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_orders_join_is_a_shuffle_join(spark):
    p = formatted(driver_transactions(spark, SF_SMALL))
    assert "SortMergeJoin" in p  # orders grows with lineitem: never broadcast


def test_valid_filter_and_pruning_reach_the_scan(spark):
    stg = QUERIES["dim_customers"](spark, SF_SMALL)
    p = formatted(stg)
    assert "GreaterThan(quantity,0)" in p and "GreaterThan(price,0.00)" in p and "IsNotNull(customer_id)" in p
    assert "ReadSchema: struct<customer_id:bigint,transaction_date:date,product_id:bigint,quantity:int," \
           "price:decimal(10,2),tax:decimal(10,2)>" in p or "ReadSchema: struct<customer_id:bigint" in p


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in formatted(QUERIES["top_customers"](spark, SF_SMALL))


def test_unused_distinct_counts_are_dropped(spark):
    p = formatted(QUERIES["monthly_sales"](spark, SF_SMALL))
    # the dimensions' distinct-count joins (unique_products_purchased, unique_customers)
    # are not used downstream and are removed; the monthly roll-up needs no join
    assert p.count("Join type: LeftOuter") == 0


def test_cleaning_has_no_python(spark):
    for name in ("clean_transactions", "dim_customers_raw", "dq_results"):
        p = formatted(QUERIES[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_aggregates_combine_map_side(spark):
    """A key owning a third of the rows is pre-reduced in every task before the shuffle."""
    for name in ("dim_customers", "dim_products", "monthly_sales", "dq_unique_failures"):
        p = formatted(QUERIES[name](spark, SF_SMALL))
        assert "partial_count" in p, name


@pytest.mark.parametrize("name", ["monthly_sales", "monthly_sales_raw", "dim_customers", "dim_products"])
def test_aggregates_are_hash_aggregates(spark, name):
    """No sort for an aggregate over rows; product names are reduced to one row per name first."""
    p = formatted(QUERIES[name](spark, SF_SMALL))
    assert "ObjectHashAggregate" not in p
    assert "SortAggregate" not in p or name == "dim_products"


def test_id_and_file_counts_need_no_join(spark):
    for name in ("raw_file_counts", "dq_unique_failures", "freshness_raw"):
        p = formatted(QUERIES[name](spark, SF_SMALL))
        assert "Join" not in p, name


def test_incremental_date_filter_reaches_the_scan(spark):
    p = formatted(QUERIES["incremental_fact"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(transaction_date), LessThanOrEqual(transaction_date,1999-12-31)]" in p
    assert "Subquery" in p and "Join" not in p.split("===== Subqueries =====")[0]  # the mark is one value


def test_written_layer_has_only_the_columns_read(spark):
    from martcraft.plans.registry import CUSTOMER_COLUMNS
    df = QUERIES["dim_customers"](spark, SF_SMALL)
    assert set(spark.read.parquet(os.path.dirname(df.inputFiles()[0])).columns) == set(CUSTOMER_COLUMNS)


def test_session_enables_skew_handling(spark):
    from martcraft.session import DEFAULT_CONF
    assert DEFAULT_CONF["spark.sql.adaptive.enabled"] == "true"
    assert DEFAULT_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_distinct_count_join_reuses_partitioning(spark):
    """At scale (no broadcast) the customer dimension needs five exchanges: (customer, day),
    (customer, year) and customer, the distinct pairs, the per-customer count; the join back adds none."""
    from martcraft.plans.registry import Star
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = formatted(Star(spark, SF_SMALL, keep=("cleaned",)).customers)
        tree = p[:p.index("\n\n(1)")]
        assert "SortMergeJoin LeftOuter" in tree
        assert tree.count("Exchange") == 5
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_row_checks_need_no_second_scan(spark):
    """Row checks come with the writes: what is left to scan are keys of uniqueness and relationships."""
    import re
    p = formatted(QUERIES["dq_results"](spark, SF_SMALL))
    read = {c for schema in re.findall(r"ReadSchema: struct<(.*)>", p) for c in re.findall(r"(\w+):", schema)}
    assert read == {"transaction_id", "transaction_key", "transaction_month", "customer_key", "customer_id", "product_key", "product_id", "customer_fk", "product_fk"}
