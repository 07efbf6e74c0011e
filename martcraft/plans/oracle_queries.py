"""DuckDB SQL for each registered query (same names, same column names)."""
from __future__ import annotations

from martcraft.config import QualityParams
from martcraft.operators.catalog import (
    DIM_CUSTOMERS, DIM_PRODUCTS, FACT, MONTHLY, SOURCE, STAGING, declared_checks,
)
from martcraft.operators.quality import ROW_KINDS, Check, parse_threshold
from martcraft.plans.oracle import TX_SQL, avg_decimal, raw_sql, rejects_select, star_sql
from martcraft.plans.registry import AS_OF, DRIVER_BANDS, FIRST_LOAD_UNTIL, FRESHNESS_AS_OF, STALE_DIMS_UNTIL


def _star(upto: str) -> str:
    return star_sql(AS_OF, DRIVER_BANDS, upto=upto)


ORACLE: dict[str, str] = {
    "stg_transactions": _star("stg") + "\nSELECT * FROM stg",
    "dim_customers": _star("dimc") + "\nSELECT * FROM dimc",
    "dim_products": _star("dimp") + "\nSELECT * FROM dimp",
    "top_customers": _star("dimc") + """
SELECT customer_id, customer_tier, total_lifetime_value, total_transactions, avg_transaction_value
FROM dimc ORDER BY total_lifetime_value DESC NULLS FIRST, customer_id NULLS LAST LIMIT 10""",
    "fact_transactions": _star("fact") + "\nSELECT * FROM fact",
    "monthly_sales": _star("monthly") + "\nSELECT * FROM monthly",
    "monthly_trend": _star("fact") + f"""
SELECT transaction_year, transaction_month,
       CAST(SUM(net_amount) AS DECIMAL(32,2)) AS total_revenue,
       COUNT(*) AS transaction_count,
       {avg_decimal('net_amount', 22, 2)} AS avg_transaction_value
FROM fact GROUP BY transaction_year, transaction_month
ORDER BY transaction_year, transaction_month""",
    "product_by_tier": _star("fact") + f"""
SELECT product_name, customer_tier, COUNT(*) AS transactions,
       CAST(SUM(net_amount) AS DECIMAL(32,2)) AS revenue,
       {avg_decimal('net_amount', 22, 2)} AS avg_revenue
FROM fact GROUP BY product_name, customer_tier
ORDER BY revenue DESC, product_name, customer_tier""",
}


# ------------------------------------------------------------ cleaning path
def _dirty(upto: str) -> str:
    return star_sql(AS_OF, DRIVER_BANDS, src="cln", upto=upto)


RAW_WITH = "WITH " + TX_SQL.strip() + ",\n" + raw_sql("tx")

_AUDITED = """,
stg_a AS (SELECT *, CURRENT_TIMESTAMP AS transformed_at FROM stg),
dimc_a AS (SELECT *, CURRENT_TIMESTAMP AS created_at, CURRENT_TIMESTAMP AS updated_at FROM dimc),
dimp_a AS (SELECT *, CURRENT_TIMESTAMP AS created_at, CURRENT_TIMESTAMP AS updated_at FROM dimp),
fact_a AS (SELECT *, CURRENT_TIMESTAMP AS created_at FROM fact),
monthly_a AS (SELECT *, CURRENT_TIMESTAMP AS refreshed_at FROM monthly)"""
_CTE = {SOURCE: "cln", STAGING: "stg_a", DIM_CUSTOMERS: "dimc_a", DIM_PRODUCTS: "dimp_a", FACT: "fact_a",
        MONTHLY: "monthly_a"}


def _cond(expr: str, cond: str) -> str:
    op, n = parse_threshold(cond)
    return f"{expr} {'<>' if op == '!=' else op} {n}"


def _literal(v) -> str:
    return str(v).upper() if isinstance(v, bool) else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"


def _row_failure(c: Check) -> str:
    """When a row fails, written from the check's parameters and not from Spark's predicate."""
    if c.kind == "not_null":
        return f"COUNT(*) - COUNT({c.column})"
    if c.kind == "accepted_values":
        inside = " OR ".join(f"{c.column} = {_literal(v)}" for v in c.args)
        return f"COUNT({c.column}) - COUNT_IF({inside})"
    if c.kind == "accepted_range":
        lo, hi, inclusive = c.args
        out = ([f"{c.column} {'<' if inclusive else '<='} {lo}"] if lo is not None else []) + (
            [f"{c.column} {'>' if inclusive else '>='} {hi}"] if hi is not None else [])
        return f"COUNT_IF({' OR '.join(out)})"
    # An expression holds, fails or is unknown: the rows less those where it holds or is unknown.
    e = c.args[0]
    return f"COUNT(*) - COUNT_IF({e}) - COUNT_IF(({e}) IS NULL)"


def _set_failure(c: Check) -> str:
    t = _CTE[c.model]
    if c.kind == "unique":
        k = c.keys[0]
        return f"SELECT COUNT(*) AS n FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING COUNT({k}) > 1)"
    if c.kind == "unique_combination_of_columns":
        ks = ", ".join(c.keys)
        return f"SELECT COUNT(*) AS n FROM (SELECT {ks} FROM {t} GROUP BY {ks} HAVING COUNT(*) > 1)"
    k, p = c.keys[0], _CTE[c.parent]
    return (f"SELECT COUNT(*) AS n FROM {t} x LEFT JOIN (SELECT DISTINCT {c.parent_key} AS pk FROM {p}) y ON x.{k} = y.pk "
            f"WHERE x.{k} IS NOT NULL AND y.pk IS NULL")


def _check_row(c: Check, failures: str, source: str) -> str:
    col = f"'{c.column}'" if c.column else "CAST(NULL AS VARCHAR)"
    if c.severity == "error":
        status = f"CASE WHEN {_cond(failures, c.error_if)} THEN 'fail' WHEN {_cond(failures, c.warn_if)} THEN 'warn' ELSE 'pass' END"
    else:
        status = f"CASE WHEN {_cond(failures, c.warn_if)} THEN 'warn' ELSE 'pass' END"
    return (f"SELECT '{c.model}' AS model, '{c.name}' AS check_name, {col} AS column_name, "
            f"'{c.severity}' AS severity, CAST({failures} AS BIGINT) AS failures, {status} AS status FROM {source}")


def dq_results_sql() -> str:
    """One pass per table for all its row checks, and one small query per check over sets."""
    checks = declared_checks(DRIVER_BANDS, QualityParams(), audit=True)
    ctes, rows = [], []
    for model in dict.fromkeys(c.model for c in checks):
        own = [(i, c) for i, c in enumerate(checks) if c.model == model and c.kind in ROW_KINDS]
        if own:
            ctes.append(f"f_{_CTE[model]} AS MATERIALIZED (SELECT " + ", ".join(f"{_row_failure(c)} AS c{i}" for i, c in own) + f" FROM {_CTE[model]})")
            rows += [_check_row(c, f"c{i}", f"f_{_CTE[model]}") for i, c in own]
    for i, c in enumerate(checks):
        if c.kind not in ROW_KINDS:
            ctes.append(f"s{i} AS MATERIALIZED ({_set_failure(c)})")
            rows.append(_check_row(c, "n", f"s{i}"))
    # Each table is computed once.
    sql = _dirty("monthly") + _AUDITED
    for name in ("cln", "stg", "dimc", "dimp", "fact", "monthly"):
        sql = sql.replace(f"\n{name} AS (", f"\n{name} AS MATERIALIZED (", 1)
    return sql + ",\n" + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(rows)


_REL = [("relationships_fact_transactions_customer_fk", "fact", "customer_fk", "dimc", "customer_key"),
        ("relationships_fact_transactions_product_fk", "fact", "product_fk", "dimp", "product_key"),
        ("relationships_agg_monthly_sales_customer_fk", "monthly", "customer_fk", "dimc", "customer_key"),
        ("relationships_stg_customer_transactions_customer_id", "stg", "customer_id", "stale", "customer_id"),
        ("relationships_stg_customer_transactions_product_id", "stg", "product_id", "stale", "product_id")]
# Valid rows up to the day of the last build, whose customers and products the stale dimensions have.
_STALE = f"""stale AS (
  SELECT customer_id, product_id FROM stg
  WHERE customer_id IS NOT NULL AND quantity > 0 AND unit_price > 0 AND transaction_date <= DATE '{STALE_DIMS_UNTIL}')"""

ORACLE.update({
    "raw_with_audit": RAW_WITH + "\nSELECT transaction_id, customer_id, transaction_date, product_id, product_name, "
                                 "quantity, price, tax, 'lineitem.parquet' AS source_file FROM raw",
    "raw_file_counts": "SELECT 'lineitem.parquet' AS source_file, COUNT(*) AS row_count FROM lineitem",
    "clean_transactions": _dirty("cln") + "\nSELECT * FROM cln",
    "clean_rejects": RAW_WITH + "\n" + rejects_select("raw"),
    "null_profile": _dirty("cln") + "\nSELECT COUNT(*) AS total_rows, " + ", ".join(
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in (
            "transaction_id", "customer_id", "transaction_date", "product_id", "product_name", "quantity",
            "price", "tax")) + " FROM cln",
    "load_profile": _dirty("cln") + """
SELECT COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE transaction_id IS NULL) AS null_transaction_ids,
       COUNT(*) FILTER (WHERE customer_id IS NULL) AS null_customer_ids,
       COUNT(*) FILTER (WHERE transaction_date IS NULL) AS null_dates,
       COUNT(*) FILTER (WHERE quantity IS NULL) AS null_quantities,
       COUNT(*) FILTER (WHERE price IS NULL OR price = 0) AS zero_prices
FROM cln""",
    "freshness": _dirty("cln") + f"""
SELECT '{SOURCE}' AS source, MAX(loaded_at) AS max_loaded_at,
       (epoch_us(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch_us(MAX(loaded_at))) / 3600e6 AS age_hours,
       CASE WHEN (epoch_us(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch_us(MAX(loaded_at))) / 3600e6 > 24 THEN 'error'
            WHEN (epoch_us(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch_us(MAX(loaded_at))) / 3600e6 > 12 THEN 'warn'
            ELSE 'pass' END AS status
FROM cln""",
    "null_shares": _dirty("cln") + ",\nn AS (SELECT COUNT(*) AS total_rows FROM cln)\n" + "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, nulls, total_rows,
       CASE WHEN total_rows > 0 THEN nulls / total_rows END AS null_share,
       CASE WHEN total_rows < {QualityParams().min_row_count} THEN 'fail'
            WHEN nulls / total_rows > {QualityParams().max_null_fraction} THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls FROM cln), n"""
        for c in ("transaction_id", "customer_id", "transaction_date", "product_id", "product_name", "quantity",
                  "price", "tax")),
    "dim_customers_raw": _dirty("dimc") + "\nSELECT * FROM dimc",
    "dim_products_raw": _dirty("dimp") + "\nSELECT * FROM dimp",
    "monthly_sales_raw": _dirty("monthly") + "\nSELECT * FROM monthly",
    "dq_results": dq_results_sql(),
    "dq_unique_failures": _dirty("stg") + """
SELECT transaction_id AS unique_field, COUNT(*) AS n_records FROM stg
WHERE transaction_id IS NOT NULL GROUP BY transaction_id HAVING COUNT(*) > 1""",
    "dq_relationship_failures": _dirty("monthly") + ",\n" + _STALE + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{n}' AS check_name, x.{k} AS from_field FROM {t} x WHERE x.{k} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {p} y WHERE y.{pk} = x.{k})" for n, t, k, p, pk in _REL),
    "dq_combination_failures": _dirty("stg") + """
SELECT customer_id, product_id, COUNT(*) AS n_records FROM stg GROUP BY customer_id, product_id HAVING COUNT(*) > 1""",
    "dq_severities": _dirty("stg") + """,
n AS (
  SELECT COUNT(*) - COUNT(tax_amount) AS tax, COUNT(*) - COUNT(customer_id) AS customer, COUNT(*) - COUNT(quantity) AS quantity,
         COUNT_IF(quantity < 0 OR quantity > 1000) AS quantity_range, COUNT_IF(unit_price < 0 OR unit_price > 500) AS price_range,
         COUNT_IF(transaction_quarter = 3 OR transaction_quarter = 4) AS quarter FROM stg),
pairs AS (SELECT COUNT(*) AS n FROM (SELECT 1 FROM stg GROUP BY customer_id, product_id HAVING COUNT(*) > 1)),
ids AS (SELECT COUNT(*) AS n FROM (SELECT product_id FROM stg GROUP BY product_id HAVING COUNT(product_id) > 1)),
r AS (
  SELECT 'not_null' AS kind, 'tax_amount' AS target, 'tax_amount' AS column_name, 'warn' AS severity, tax AS failures,
         CASE WHEN tax > 0 THEN 'warn' ELSE 'pass' END AS status FROM n
  UNION ALL SELECT 'not_null', 'customer_id', 'customer_id', 'error', customer,
         CASE WHEN customer > 1000000000 THEN 'fail' WHEN customer >= 1 THEN 'warn' ELSE 'pass' END FROM n
  UNION ALL SELECT 'not_null', 'quantity', 'quantity', 'error', quantity, CASE WHEN quantity > 0 THEN 'fail' ELSE 'pass' END FROM n
  UNION ALL SELECT 'accepted_range', 'quantity', 'quantity', 'error', quantity_range,
         CASE WHEN quantity_range > 0 THEN 'fail' ELSE 'pass' END FROM n
  UNION ALL SELECT 'accepted_range', 'unit_price', 'unit_price', 'warn', price_range,
         CASE WHEN price_range > 1000000000 THEN 'warn' ELSE 'pass' END FROM n
  UNION ALL SELECT 'accepted_values', 'transaction_quarter', 'transaction_quarter', 'error', quarter,
         CASE WHEN quarter <> 0 THEN 'fail' ELSE 'pass' END FROM n
  UNION ALL SELECT 'unique_combination_of_columns', 'customer_id_product_id', NULL, 'warn', pairs.n,
         CASE WHEN pairs.n > 0 THEN 'warn' ELSE 'pass' END FROM pairs
  UNION ALL SELECT 'unique', 'product_id', 'product_id', 'error', ids.n,
         CASE WHEN ids.n < 1 THEN 'fail' WHEN ids.n <= 0 THEN 'warn' ELSE 'pass' END FROM ids)
SELECT 'stg_customer_transactions' AS model, concat(kind, '_stg_customer_transactions_', target) AS check_name, column_name, severity,
       CAST(failures AS BIGINT) AS failures, status FROM r""",
    "incremental_dim_customers": _dirty("dimc") + "\nSELECT * FROM dimc",
    "incremental_dim_products": _dirty("dimp") + "\nSELECT * FROM dimp",
    "incremental_monthly_sales": _dirty("monthly") + "\nSELECT * FROM monthly",
    "freshness_raw": f"""
SELECT 'raw_customer_transactions' AS source, MAX(l_shipdate) AS max_loaded_at,
       (epoch_us(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch_us(MAX(l_shipdate))) / 3600e6 AS age_hours,
       CASE WHEN MAX(l_shipdate) IS NULL OR MAX(l_shipdate) < TIMESTAMP '{FRESHNESS_AS_OF}' - INTERVAL 24 HOUR THEN 'error'
            WHEN MAX(l_shipdate) < TIMESTAMP '{FRESHNESS_AS_OF}' - INTERVAL 12 HOUR THEN 'warn' ELSE 'pass' END AS status
FROM lineitem""",
    "incremental_fact_raw": _dirty("fact") + "\nSELECT * FROM fact",
    "incremental_fact_keyed": _dirty("fact") + f"""
SELECT transaction_key, transaction_date, transaction_month FROM (
  SELECT *, COALESCE(transaction_date <= DATE '{FIRST_LOAD_UNTIL}' AND transaction_key % 5 <> 0, FALSE) AS is_first FROM fact)
QUALIFY transaction_key IS NULL OR row_number() OVER (PARTITION BY transaction_key ORDER BY is_first, transaction_date DESC NULLS LAST) = 1""",
    "incremental_fact": _star("fact") + f"""
SELECT * FROM fact WHERE transaction_date <= DATE '{FIRST_LOAD_UNTIL}'
UNION ALL
SELECT * FROM fact WHERE transaction_date > (SELECT MAX(transaction_date) FROM fact
                                             WHERE transaction_date <= DATE '{FIRST_LOAD_UNTIL}')""",
})
