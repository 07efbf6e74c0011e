"""Marts kept up to date by mergeable states: a load touches only the keys it has rows of.

Below ``base`` there are states and totals, each a Parquet table clustered by its key
with the key ranges of its files (``key_index``):

- states: (customer, day), (product, name, day), (customer, month, product) with sums,
  counts, extremes and the second moment of the price; and the different (customer,
  product) pairs, once by customer and once by product. Partial rows of one group are
  put together by the same aggregates, so a load adds its own partial rows to the
  files that hold its keys, and to no others. Rows are dealt out by key ranges first
  and put together there, so that one shuffle serves the aggregate and the files.
- totals: one row per customer and per product, and the months of each customer with
  the previous active one. For the keys of a load they are computed again from the
  states of those keys alone; a month that is added or changed so repairs the growth
  of the next active month too. All other rows stay as they are.

What depends on the reporting date and the bands (recency, tiers, segments) is added
when a mart is read, so a new date rewrites nothing.

A load holds new transactions. Transactions that replace earlier ones would have to
be taken out of sums and extremes first, which these states can't do: then rebuild.
Every load has a name, and a load whose name is known is skipped. A load that was cut
short leaves its mark, and the next one refuses to go on before ``rebuild`` is called:
its states would count some rows twice.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.config import DEFAULT_BANDS, Bands
from martcraft.operators import dimensions as D
from martcraft.operators import monthly as M
from martcraft.operators.staging import stage_transactions, valid_transactions
from martcraft.plans.key_index import KeyedTable
from martcraft.plans.materialize import materialize

# Each state's key, its other grouping columns and how its measures are put together.
STATES = {
    "customer_days": ("customer_id", ("transaction_date",), D.CUSTOMER_DAY),
    "product_days": ("product_id", ("product_name", "transaction_date"), D.PRODUCT_DAY),
    "customer_pairs": ("customer_id", ("product_id",), {}),
    "product_pairs": ("product_id", ("customer_id",), {}),
    "month_products": ("customer_fk", ("transaction_month", "transaction_year", "transaction_quarter", "product_fk"), M.MONTH_PRODUCT),
}
TOTALS = {"customers": "customer_id", "products": "product_id", "months": "customer_fk"}

# The states behind each table of totals; the first one has all keys of a load.
BEHIND = {"customers": ("customer_days", "customer_pairs"), "products": ("product_days", "product_pairs"), "months": ("month_products",)}


def _of(rows: DataFrame, keys: DataFrame | None) -> DataFrame:
    """The rows of some keys (one column; a NULL is a key), or of all."""
    if keys is None:
        return rows
    key = keys.columns[0]
    if key != "product_id":  # never NULL: a plain join leaves the rows by key, for the aggregates behind it
        return rows.join(keys, key, "left_semi")
    asked = keys.select(F.col(key).alias("_key"))
    return rows.join(asked, rows[key].eqNullSafe(asked["_key"]), "left_semi")


class IncrementalMarts:
    def __init__(self, spark: SparkSession, base: str, marts: tuple[str, ...] = tuple(TOTALS)):
        self.spark, self.base, self.marts = spark, base.rstrip("/"), tuple(marts)
        if "months" in marts and "customers" not in marts:
            raise ValueError("the months take their tiers from the customers")
        self._P = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._P(self.base).getFileSystem(spark._jsc.hadoopConfiguration())

    def _exists(self, name: str) -> bool:
        return self.fs.exists(self._P(f"{self.base}/{name}"))

    def _mark(self, name: str) -> None:
        self.fs.create(self._P(f"{self.base}/{name}"), True).close()

    def _table(self, name: str) -> KeyedTable:
        key = STATES[name][0] if name in STATES else TOTALS[name]
        path = f"{self.base}/{name}"
        return KeyedTable(self.spark, path, key, self.spark.read.parquet(path).schema)

    def load(self, cleaned: DataFrame, name: str) -> bool:
        """Add the cleaned transactions of one load; False if the load ``name`` is in the marts already.

        Only the tables behind ``self.marts`` are kept; that choice is made before the first load.
        """
        if self._exists(f"loads/{name}"):
            return False
        if self._exists("loads/_begun"):
            raise RuntimeError(f"a load below {self.base} was cut short: rebuild the marts")
        self._mark("loads/_begun")
        v = valid_transactions(stage_transactions(cleaned))
        self.types = {c: v.schema[c].dataType for c in ("total_amount", "unit_price")}
        sold = v.where("customer_id is not null and product_id is not null")  # as the fact's inner joins
        fact = sold.select(F.col("customer_id").alias("customer_fk"), F.col("product_id").alias("product_fk"), *M.MONTHLY_KEYS[1:],
                           F.col("quantity").alias("units_sold"), F.col("subtotal").alias("gross_amount"), "tax_amount", F.col("total_amount").alias("net_amount"),
                           (F.col("total_amount") - F.col("tax_amount")).alias("revenue_excluding_tax"), "unit_price")
        wanted = [n for n in STATES if any(n in BEHIND[m] for m in self.marts)]
        source = {**dict.fromkeys(("customer_days", "product_days", "customer_pairs", "product_pairs"), v), "month_products": fact}
        reduce = {"customer_days": D.customer_days, "product_days": D.product_days, "customer_pairs": lambda r: r.select("customer_id", "product_id").distinct(),
                  "product_pairs": lambda r: r.select("product_id", "customer_id").distinct(), "month_products": M.month_products}
        added, state = {}, {}
        for n in wanted:
            key, others, how = STATES[n]
            if not self._exists(n):  # the first load is the state
                added[n] = state[n] = self._write(n, reduce[n](self._ranged(n, source[n])).select(key, *others, *how))
                continue
            if n == "product_pairs" and "customer_pairs" in added:
                added[n] = added["customer_pairs"]
            else:
                added[n] = materialize(reduce[n](source[n]), n)
            state[n] = self._add(n, added[n])
        compute = {"customers": self._customers, "products": self._products, "months": lambda s, keys: self._months(s, keys, M.amount_types(fact))}
        for m in self.marts:
            self._renew(m, added[BEHIND[m][0]], state, compute[m])
        self._mark(f"loads/{name}")
        self.fs.delete(self._P(f"{self.base}/loads/_begun"), False)
        return True

    def _add(self, name: str, partial: DataFrame) -> DataFrame:
        """Put the partial rows into the files of their keys; returns the rows of those files."""
        key, others, how = STATES[name]
        columns = [key, *others, *how]
        table = self._table(name)
        table.recover()
        near = table.near(partial.select(key))
        together = {"sum": F.sum, "min": F.min, "max": F.max}
        rows = self._ranged(name, table.read(near).select(*columns).unionByName(partial.select(*columns)))
        measures = [together[h](c).cast(table.schema[c].dataType).alias(c) for c, h in how.items()]
        merged = rows.groupBy(key, *others).agg(*measures) if measures else rows.distinct()
        return table.read(table.swap(merged.select(*columns).sortWithinPartitions(key), near))

    def _ranged(self, name: str, df: DataFrame) -> DataFrame:
        """Ranges of the key, a hot key cut by the other columns."""
        key, others, _ = STATES.get(name, (TOTALS.get(name), (), {}))
        return df.repartitionByRange(key, *others)

    def _write(self, name: str, ranged: DataFrame) -> DataFrame:
        key = STATES[name][0] if name in STATES else TOTALS[name]
        ranged.sortWithinPartitions(key).write.parquet(f"{self.base}/{name}")
        return self.spark.read.parquet(f"{self.base}/{name}")

    def _renew(self, name: str, partial: DataFrame, state: dict[str, DataFrame], compute) -> None:
        """Replace the totals of the load's keys."""
        key = TOTALS[name]
        if not self._exists(name):  # the first load has all keys of the states
            self._write(name, self._ranged(name, compute(state, None)))
            return
        keys = materialize(partial.select(key).distinct(), f"{name}_keys")
        new = compute(state, keys)
        table = self._table(name)
        table.recover()
        near = table.near(keys)
        old = table.read(near)
        asked = keys.select(F.col(key).alias("_key"))
        kept = old.join(asked, old[key].eqNullSafe(asked["_key"]), "left_anti")
        table.swap(self._ranged(name, kept.unionByName(new)).sortWithinPartitions(key), near)

    def _customers(self, state: dict[str, DataFrame], keys: DataFrame | None) -> DataFrame:
        products = _of(state["customer_pairs"], keys).groupBy("customer_id").agg(F.count("product_id").alias("unique_products_purchased"))
        return D.customer_totals(_of(state["customer_days"], keys), self.types["total_amount"]).join(products, "customer_id", "left")

    def _products(self, state: dict[str, DataFrame], keys: DataFrame | None) -> DataFrame:
        buyers = _of(state["product_pairs"], keys).groupBy(F.col("product_id").alias("_id")).agg(F.count("customer_id").alias("unique_customers"))
        totals = D.product_totals(_of(state["product_days"], keys), self.types["total_amount"], self.types["unit_price"])
        return totals.join(buyers, totals["product_id"].eqNullSafe(buyers["_id"]), "left").drop("_id")

    def _months(self, state: dict[str, DataFrame], keys: DataFrame | None, types: dict) -> DataFrame:
        return M.with_growth(M.months(_of(state["month_products"], keys), M.MONTHLY_KEYS, types), audit=False)

    def customers(self, as_of: str | dt.date | None = None, bands: Bands = DEFAULT_BANDS, audit: bool = True) -> DataFrame:
        return D.describe_customers(self.spark.read.parquet(f"{self.base}/customers"), as_of, bands, audit)

    def products(self, as_of: str | dt.date | None = None, bands: Bands = DEFAULT_BANDS, audit: bool = True) -> DataFrame:
        return D.describe_products(self.spark.read.parquet(f"{self.base}/products"), as_of, bands, audit)

    def monthly(self, as_of: str | dt.date | None = None, bands: Bands = DEFAULT_BANDS) -> DataFrame:
        """The monthly aggregate with the customers' present tier and segment."""
        c = self.customers(as_of, bands, audit=False).select(F.col("customer_key").alias("_fk"), "customer_tier", F.col("value_segment").alias("customer_value_segment"))
        m = self.spark.read.parquet(f"{self.base}/months")
        return m.join(c, m["customer_fk"] == c["_fk"]).drop("_fk")

    def rebuild(self, cleaned: DataFrame, name: str) -> None:
        """Start again from all transactions."""
        self.fs.delete(self._P(self.base), True)
        self.load(cleaned, name)
