"""Reference SQL (DuckDB dialect) for every registered query.

It restates each model in plain SQL over the same Parquet tables. Where Spark's
decimal arithmetic rounds (AVG of a decimal, decimal division), the SQL
reproduces the same half-up rounding with integer arithmetic, because DuckDB
turns decimal division into DOUBLE.
"""
from __future__ import annotations

from martcraft.config import DEFAULT_BANDS, Bands, Ladder, TierLadder


# ---------------------------------------------------------------- helpers
def _half_up_div(num: str, den: str) -> str:
    """Integer quotient num/den rounded half away from zero (HUGEINT operands)."""
    return f"(sign({num}) * sign({den}) * ((2 * abs({num}) + abs({den})) // (2 * abs({den}))))"


def _units_to_decimal(units: str, scale: int, width: int) -> str:
    """An integer count of 10^-scale units as DECIMAL(width, scale), exactly."""
    unit = "0." + "0" * (scale - 1) + "1"
    return (f"CAST(CAST({units} AS DECIMAL({37 - scale},0)) * CAST({unit} AS DECIMAL({scale + 1},{scale}))"
            f" AS DECIMAL({width},{scale}))")


def avg_decimal(x: str, p: int, s: int) -> str:
    """Spark's AVG over DECIMAL(p,s): exact sum / count, rounded half-up once to scale s+4."""
    total = f"SUM(CAST({x} * {10 ** s} AS HUGEINT))"
    n = f"CAST(COUNT({x}) AS HUGEINT)"
    q = _half_up_div(f"{total} * 10000", n)
    return f"(CASE WHEN COUNT({x}) > 0 THEN {_units_to_decimal(q, s + 4, p + 4)} END)"


def ratio_decimal(num_cents: str, den: str, scale: int, width: int = 38) -> str:
    """Spark's DECIMAL(_,2) / BIGINT result at ``scale`` (half-up): num_cents are hundredths."""
    q = _half_up_div(f"CAST({num_cents} AS HUGEINT) * {10 ** (scale - 2)}", f"CAST({den} AS HUGEINT)")
    return _units_to_decimal(q, scale, width)


def cents(x: str) -> str:
    return f"CAST({x} * 100 AS HUGEINT)"


def ladder_sql(measure: str, ladder: Ladder) -> str:
    whens = " ".join(f"WHEN {measure} {ladder.op} {b} THEN '{lab}'" for b, lab in ladder.rungs)
    return f"CASE {whens} ELSE '{ladder.otherwise}' END"


def tier_sql(value: str, count: str, ladder: TierLadder) -> str:
    whens = " ".join(f"WHEN {value} >= {v} AND {count} >= {n} THEN '{lab}'" for v, n, lab in ladder.rungs)
    return f"CASE {whens} ELSE '{ladder.otherwise}' END"


# ---------------------------------------------------------------- sources
TX_SQL = """
tx AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS transaction_id,
         o.o_custkey AS customer_id,
         CAST(o.o_orderdate AS DATE) AS transaction_date,
         l.l_partkey AS product_id,
         p.p_name AS product_name,
         CAST(trunc(l.l_quantity) AS INTEGER) AS quantity,
         CAST(CAST(p.p_retailprice AS VARCHAR) AS DECIMAL(10,2)) AS price,
         CAST(CAST(CAST(trunc(l.l_quantity) AS INTEGER) * CAST(round(l.l_tax * 100) AS INTEGER) AS DECIMAL(12,0))
              * 0.01 AS DECIMAL(10,2)) AS tax,
         l.l_shipdate AS loaded_at
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""


def _mod_rules(k: str, rules: list[tuple[int, int, str]], otherwise: str) -> str:
    whens = " ".join(f"WHEN {k} % {m} = {r} THEN {v}" for m, r, v in rules)
    return f"CASE {whens} ELSE {otherwise} END"


def raw_sql(src: str = "tx") -> str:
    k = "transaction_id"
    v = lambda c: f"CAST({c} AS VARCHAR)"
    d = "transaction_date"
    cols = [
        _mod_rules(k, [(10, 0, f"'T' || {v(k)}")], v(k)) + " AS transaction_id",
        _mod_rules(k, [(7, 0, "NULL"), (3, 0, f"{v('customer_id')} || '.0'")], v("customer_id")) + " AS customer_id",
        _mod_rules(k, [(8, 0, f"strftime({d}, '%d-%m-%Y')"), (25, 0, f"strftime({d}, '%Y-%-m-%-d')"),
                       (31, 0, f"'ab-' || strftime({d}, '%m-%Y')")], f"strftime({d}, '%Y-%m-%d')")
        + " AS transaction_date",
        _mod_rules(k, [(17, 0, "NULL"), (10, 5, f"'P' || {v('product_id')}")], v("product_id")) + " AS product_id",
        _mod_rules(k, [(4, 0, "'  ' || product_name || ' '")], "product_name") + " AS product_name",
        _mod_rules(k, [(11, 0, "NULL"), (23, 0, "'1.5'"), (5, 0, f"{v('quantity')} || '.0'")], v("quantity"))
        + " AS quantity",
        _mod_rules(k, [(9, 0, "'Two Hundred'"), (19, 0, "' two HUNDRED '"), (37, 0, "'1_000'")], v("price"))
        + " AS price",
        _mod_rules(k, [(9, 4, "'Fifteen'"), (29, 0, "'n/a'")], v("tax")) + " AS tax",
        "loaded_at",
    ]
    return f"raw AS (SELECT {', '.join(cols)} FROM {src})"


_NA = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
       "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
_NUM = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _na(c: str) -> str:
    toks = ", ".join("'" + t + "'" for t in _NA)
    return f"(CASE WHEN {c} IN ({toks}) THEN NULL ELSE {c} END)"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def _id(c: str, prefix: str) -> str:
    s = _strip(_na(c))
    s = f"(CASE WHEN starts_with({s}, '{prefix}') THEN substr({s}, {len(prefix) + 1}) ELSE {s} END)"
    return f"(CASE WHEN regexp_matches({s}, '^[+-]?[0-9]+$') THEN TRY_CAST({s} AS BIGINT) END)"


def _num(s: str) -> str:
    return f"(CASE WHEN regexp_matches({s}, '{_NUM}') THEN TRY_CAST({s} AS DOUBLE) END)"


def _amount(c: str, word: str, value: float) -> str:
    s = _strip(_na(c))
    return (f"TRY_CAST((CASE WHEN lower({s}) = '{word}' THEN {value} "
            f"WHEN regexp_matches({s}, '{_NUM}') THEN TRY_CAST({s} AS DOUBLE) END) AS DECIMAL(10,2))")


def clean_exprs() -> dict[str, str]:
    """SQL for each cleaned column, written over the raw STRING columns."""
    date = _strip(_na("transaction_date"))
    cust = _num(_strip(_na("customer_id")))
    qty = _num(_strip(_na("quantity")))
    return {
        "transaction_id": _id("transaction_id", "T"),
        "customer_id": f"TRY_CAST(trunc({cust}) AS BIGINT)",
        "transaction_date": (
            f"(CASE WHEN regexp_matches({date}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') "
            f"THEN CAST(try_strptime({date}, '%Y-%m-%d') AS DATE) "
            f"WHEN regexp_matches({date}, '^[0-9]{{1,2}}-[0-9]{{1,2}}-[0-9]{{4}}$') "
            f"THEN CAST(try_strptime({date}, '%d-%m-%Y') AS DATE) END)"),
        "product_id": _id("product_id", "P"),
        "product_name": _strip(_na("product_name")),
        "quantity": f"(CASE WHEN {qty} = floor({qty}) THEN TRY_CAST({qty} AS INTEGER) END)",
        "price": _amount("price", "two hundred", 200.0),
        "tax": _amount("tax", "fifteen", 15.0),
    }


def clean_sql(src: str = "raw") -> str:
    cols = [f"{e} AS {c}" for c, e in clean_exprs().items()] + ["loaded_at"]
    return f"cln AS (SELECT {', '.join(cols)} FROM {src})"


def rejects_select(src: str = "raw") -> str:
    cols = ["COUNT(*) AS total_rows"] + [
        f"COUNT(*) FILTER (WHERE {_na(c)} IS NOT NULL AND ({e}) IS NULL) AS rejected_{c}"
        for c, e in clean_exprs().items()]
    return f"SELECT {', '.join(cols)} FROM {src}"


# ---------------------------------------------------------------- models
def stg_sql(src: str = "tx") -> str:
    d = "transaction_date"
    return f"""
stg AS (
  SELECT transaction_id, customer_id, product_id, {d},
         CAST(date_trunc('month', {d}) AS DATE) AS transaction_month,
         CAST(extract(year FROM {d}) AS INTEGER) AS transaction_year,
         CAST(extract(quarter FROM {d}) AS INTEGER) AS transaction_quarter,
         CAST(extract(month FROM {d}) AS INTEGER) AS month_number,
         rpad(strftime({d}, '%B'), 9, ' ') AS month_name,
         rpad(strftime({d}, '%A'), 9, ' ') AS day_name,
         product_name, quantity,
         price AS unit_price, tax AS tax_amount,
         CAST(quantity * price AS DECIMAL(21,2)) AS subtotal,
         CAST(quantity * price + tax AS DECIMAL(22,2)) AS total_amount,
         COALESCE(quantity > 0, false) AS is_valid_quantity,
         COALESCE(price > 0, false) AS is_valid_price,
         COALESCE(customer_id IS NOT NULL AND quantity > 0 AND price > 0, false) AS is_valid_transaction,
         loaded_at
  FROM {src}
)"""


VALID = "customer_id IS NOT NULL AND quantity > 0 AND unit_price > 0"


def dim_customers_sql(as_of: str, bands: Bands = DEFAULT_BANDS) -> str:
    today = f"DATE '{as_of}'"
    since = f"CAST(date_diff('day', last_transaction_date, {today}) AS INTEGER)"
    return f"""
cm AS (
  SELECT customer_id,
         COUNT(*) AS total_transactions,
         COUNT(DISTINCT transaction_date) AS unique_transaction_days,
         COUNT(DISTINCT transaction_year) AS years_active,
         COUNT(DISTINCT transaction_month) AS months_active,
         MIN(transaction_date) AS first_transaction_date,
         MAX(transaction_date) AS last_transaction_date,
         CAST(SUM(quantity) AS BIGINT) AS total_units_purchased,
         CAST(SUM(total_amount) AS DECIMAL(32,2)) AS total_lifetime_value,
         {avg_decimal('total_amount', 22, 2)} AS avg_transaction_value,
         MIN(total_amount) AS min_transaction_value,
         MAX(total_amount) AS max_transaction_value,
         COUNT(DISTINCT product_id) AS unique_products_purchased
  FROM stg WHERE {VALID}
  GROUP BY customer_id
),
dimc AS (
  SELECT customer_id AS customer_key, customer_id, total_transactions, unique_transaction_days,
         years_active, months_active, unique_products_purchased, first_transaction_date,
         last_transaction_date, {since} AS days_since_last_purchase,
         CAST(date_diff('day', first_transaction_date, {today}) AS INTEGER) AS customer_age_days,
         total_lifetime_value, avg_transaction_value, min_transaction_value, max_transaction_value,
         total_units_purchased,
         {ladder_sql('total_lifetime_value', bands.value_segment)} AS value_segment,
         {ladder_sql('total_transactions', bands.frequency_segment)} AS frequency_segment,
         {ladder_sql(since, bands.recency_segment)} AS recency_segment,
         {ladder_sql('avg_transaction_value', bands.aov_tier)} AS aov_tier,
         {tier_sql('total_lifetime_value', 'total_transactions', bands.customer_tier)} AS customer_tier
  FROM cm
)"""


def dim_products_sql(as_of: str, bands: Bands = DEFAULT_BANDS) -> str:
    today = f"DATE '{as_of}'"
    return f"""
pm AS (
  SELECT product_id,
         MAX(product_name) AS product_name,
         COUNT(*) AS total_transactions,
         COUNT(DISTINCT transaction_date) AS unique_transaction_days,
         MIN(transaction_date) AS first_sale_date,
         MAX(transaction_date) AS last_sale_date,
         CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
         CAST(SUM(total_amount) AS DECIMAL(32,2)) AS total_revenue,
         {avg_decimal('unit_price', 10, 2)} AS avg_unit_price,
         MIN(unit_price) AS min_unit_price,
         MAX(unit_price) AS max_unit_price,
         round(stddev_samp(unit_price), 6) AS stddev_unit_price,
         AVG(quantity) AS avg_quantity_per_transaction,
         MIN(quantity) AS min_quantity_per_transaction,
         MAX(quantity) AS max_quantity_per_transaction,
         COUNT(DISTINCT customer_id) AS unique_customers
  FROM stg WHERE {VALID}
  GROUP BY product_id
),
dimp AS (
  SELECT product_id AS product_key, product_id, product_name, total_transactions,
         unique_transaction_days, unique_customers, first_sale_date, last_sale_date,
         CAST(date_diff('day', last_sale_date, {today}) AS INTEGER) AS days_since_last_sale,
         total_units_sold, total_revenue,
         CASE WHEN unique_customers > 0 THEN {ratio_decimal(cents('total_revenue'), 'unique_customers', 8)}
              ELSE CAST(0 AS DECIMAL(38,8)) END AS revenue_per_customer,
         avg_unit_price, min_unit_price, max_unit_price, stddev_unit_price,
         {ladder_sql('avg_unit_price', bands.price_tier)} AS price_tier,
         avg_quantity_per_transaction, min_quantity_per_transaction, max_quantity_per_transaction,
         {ladder_sql('total_revenue', bands.revenue_segment)} AS revenue_segment,
         {ladder_sql('total_units_sold', bands.volume_segment)} AS volume_segment
  FROM pm
)"""


FACT_SQL = f"""
fact AS (
  SELECT t.transaction_id AS transaction_key, c.customer_key AS customer_fk, p.product_key AS product_fk,
         t.transaction_date, t.transaction_month, t.transaction_year, t.transaction_quarter,
         t.quantity AS units_sold, t.subtotal AS gross_amount, t.tax_amount,
         t.total_amount AS net_amount,
         CAST(t.total_amount - t.tax_amount AS DECIMAL(23,2)) AS revenue_excluding_tax,
         t.unit_price, c.customer_tier, c.value_segment AS customer_value_segment,
         p.product_name, p.price_tier AS product_price_tier, p.revenue_segment AS product_revenue_segment
  FROM (SELECT * FROM stg WHERE {VALID}) t
  JOIN dimc c ON t.customer_id = c.customer_id
  JOIN dimp p ON t.product_id = p.product_id
)"""


MONTHLY_SQL = f"""
mt AS (
  SELECT customer_fk, transaction_month, transaction_year, transaction_quarter,
         COUNT(*) AS transaction_count,
         COUNT(DISTINCT product_fk) AS unique_products_purchased,
         CAST(SUM(units_sold) AS BIGINT) AS total_units,
         AVG(units_sold) AS avg_units_per_transaction,
         CAST(SUM(gross_amount) AS DECIMAL(31,2)) AS monthly_gross_revenue,
         CAST(SUM(tax_amount) AS DECIMAL(20,2)) AS monthly_tax,
         CAST(SUM(net_amount) AS DECIMAL(32,2)) AS monthly_net_revenue,
         CAST(SUM(revenue_excluding_tax) AS DECIMAL(33,2)) AS monthly_revenue_excluding_tax,
         {avg_decimal('unit_price', 10, 2)} AS avg_unit_price,
         MIN(unit_price) AS min_unit_price,
         MAX(unit_price) AS max_unit_price,
         MAX(customer_tier) AS customer_tier,
         MAX(customer_value_segment) AS customer_value_segment
  FROM fact
  GROUP BY customer_fk, transaction_month, transaction_year, transaction_quarter
),
mg AS (
  SELECT *,
         LAG(monthly_net_revenue) OVER (PARTITION BY customer_fk ORDER BY transaction_month NULLS LAST) AS previous_month_revenue,
         LAG(transaction_count) OVER (PARTITION BY customer_fk ORDER BY transaction_month NULLS LAST) AS previous_month_transactions
  FROM mt
),
monthly AS (
  SELECT customer_fk, transaction_month, transaction_year, transaction_quarter,
         transaction_count, unique_products_purchased, total_units, avg_units_per_transaction,
         monthly_gross_revenue, monthly_tax, monthly_net_revenue, monthly_revenue_excluding_tax,
         CASE WHEN transaction_count > 0
              THEN {ratio_decimal(cents('monthly_net_revenue'), 'transaction_count', 8)}
              ELSE CAST(0 AS DECIMAL(38,8)) END AS avg_revenue_per_transaction,
         avg_unit_price, min_unit_price, max_unit_price,
         previous_month_revenue, previous_month_transactions,
         CASE WHEN previous_month_revenue IS NOT NULL AND previous_month_revenue > 0
              THEN CAST(monthly_net_revenue - previous_month_revenue AS DOUBLE)
                   / CAST(previous_month_revenue AS DOUBLE) * 100
         END AS revenue_growth_pct,
         CASE WHEN previous_month_transactions IS NOT NULL AND previous_month_transactions > 0
              THEN (transaction_count - previous_month_transactions)
                   / CAST(previous_month_transactions AS DOUBLE) * 100
         END AS transaction_growth_pct,
         customer_tier, customer_value_segment
  FROM mg
)"""


def star_sql(as_of: str, bands: Bands, src: str = "tx", upto: str = "monthly") -> str:
    """The WITH clause up to a model: tx -> stg -> dims -> fact -> monthly."""
    parts = [TX_SQL]
    if src == "cln":
        parts += [raw_sql("tx"), clean_sql("raw")]
    if upto == "cln":
        return "WITH " + ",\n".join(p.strip() for p in parts)
    parts.append(stg_sql(src))
    if upto in ("dimc", "fact", "monthly"):
        parts.append(dim_customers_sql(as_of, bands))
    if upto in ("dimp", "fact", "monthly"):
        parts.append(dim_products_sql(as_of, bands))
    if upto in ("fact", "monthly"):
        parts.append(FACT_SQL)
    if upto == "monthly":
        parts.append(MONTHLY_SQL)
    return "WITH " + ",\n".join(p.strip() for p in parts)
