import os

import pytest
from pyspark.sql import functions as F

from martcraft.plans.refresh import (
    Refresh, append_incremental, check_schema_drift, read_target, rows_after_high_water, within_dates,
)
from martcraft.sources.raw import HeaderError, check_header, read_raw_csv
from martcraft.sources.tables import layer_database, load_typed, replace_table, set_properties, write_csv

HEADER = "transaction_id,customer_id,transaction_date,product_id,product_name,quantity,price,tax"


def _csv(path, header, lines):
    with open(path, "w") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")


def test_header_contract(spark, scratch):
    _csv(f"{scratch}/a.csv", HEADER + ",extra", ["T1,5.0,2024-01-01,P2,x,1,2.5,0.1,zz"])
    assert "extra" in check_header(spark, f"{scratch}/a.csv")
    _csv(f"{scratch}/b.csv", HEADER.replace(",tax", ""), ["1,5,2024-01-01,2,x,1,2.5"])
    with pytest.raises(HeaderError, match="tax"):
        check_header(spark, f"{scratch}/b.csv")
    with pytest.raises(Exception):
        check_header(spark, f"{scratch}/missing.csv")


def test_many_files_counts_and_typed_load(spark, scratch):
    os.makedirs(f"{scratch}/in")
    _csv(f"{scratch}/in/a.csv", HEADER, ["T1,5.0,2024-01-01,P2,x,1,2.5,0.1", "2,6,02-01-2024,3,y,2,3,Fifteen"])
    _csv(f"{scratch}/in/b.csv", HEADER, ["3,,2024-01-03,4,z,,4,0.2"])
    raw = read_raw_csv(spark, f"{scratch}/in")
    counts = {r.source_file: r["count"] for r in raw.groupBy("source_file").count().collect()}
    assert counts == {"a.csv": 2, "b.csv": 1}
    from martcraft.operators.cleaning import clean_transactions
    cleaned = clean_transactions(raw)
    write_csv(cleaned.drop("loaded_at", "source_file"), f"{scratch}/out")
    back = spark.read.option("header", True).csv(f"{scratch}/out")
    assert back.filter(F.col("customer_id").isNull()).count() == 1
    db = layer_database("cleaned", "t")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    n = load_typed(spark, cleaned, f"{db}.customer_transactions")
    assert n == 3
    assert load_typed(spark, cleaned, f"{db}.customer_transactions") == 3  # truncate + reload
    t = spark.table(f"{db}.customer_transactions")
    assert t.filter(F.col("loaded_at").isNull()).count() == 0
    assert dict((f.name, f.dataType.simpleString()) for f in t.schema.fields)["price"] == "decimal(10,2)"
    set_properties(spark, f"{db}.customer_transactions", {"owner": "data-engineering", "retention_days": "1095"})
    replace_table(cleaned.drop("source_file"), f"{db}.copy", ("transaction_date",))
    assert spark.table(f"{db}.copy").count() == 3


def test_columns_land_by_each_files_header(spark, scratch):
    os.makedirs(f"{scratch}/in")
    _csv(f"{scratch}/in/a.csv", HEADER, ["1,5,2024-01-01,2,x,1,2.5,0.1"])
    _csv(f"{scratch}/in/b.csv", " transaction_id ,customer_id,transaction_date,product_id,product_name,quantity,tax, price,note,note",
         ["2,5,2024-01-01,2,\"y, z\",1,0.1,2.5,n,m"])
    got = {r.transaction_id: r for r in read_raw_csv(spark, f"{scratch}/in").collect()}
    assert {(i, r.price, r.tax, r.product_name, r.source_file) for i, r in got.items()} == {
        ("1", "2.5", "0.1", "x", "a.csv"), ("2", "2.5", "0.1", "y, z", "b.csv")}
    _csv(f"{scratch}/in/c.csv", HEADER.replace(",tax", ""), ["3,5,2024-01-01,2,x,1,2.5"])
    with pytest.raises(HeaderError, match="c.csv.*tax"):
        read_raw_csv(spark, f"{scratch}/in")
    _csv(f"{scratch}/d.csv", HEADER + ",price", ["3,5,2024-01-01,2,x,1,2.5,0.1,9"])
    with pytest.raises(HeaderError, match="twice"):
        read_raw_csv(spark, f"{scratch}/d.csv")


def test_headers_of_many_files_are_read_at_once(spark, scratch):
    import threading

    from martcraft.sources.raw import file_headers
    os.makedirs(f"{scratch}/in")
    for i in range(600):
        _csv(f"{scratch}/in/{i:04d}.csv", HEADER if i % 2 else HEADER + f",c{i}", [])
    with open(f"{scratch}/in/mark.csv", "w", encoding="utf-8-sig") as f:
        f.write(HEADER + "\n")
    before = threading.active_count()
    got = {os.path.basename(k): v for k, v in file_headers(spark, f"{scratch}/in").items()}
    assert len(got) == 601 and threading.active_count() <= before + 1
    assert got["0001.csv"] == got["mark.csv"] == tuple(HEADER.split(",")) and got["0002.csv"][-1] == "c2"


def test_stream_reads_each_file_by_its_header(spark, scratch):
    from martcraft.streaming.landing import stream_landing
    land, out = f"{scratch}/landing", f"{scratch}/out"
    os.makedirs(land)
    _csv(f"{land}/a.csv", HEADER, ["1,5,2024-01-01,2,x,1,2.5,0.1"])
    _csv(f"{land}/b.csv", HEADER.replace("price,tax", "tax,price"), ["2,5,2024-01-01,2,x,1,0.1,2.5"])
    stream_landing(spark, land, out, checkpoint=f"{scratch}/ck").awaitTermination(120)
    assert {(r.transaction_id, float(r.price), float(r.tax)) for r in spark.read.parquet(out).collect()} == {(1, 2.5, 0.1), (2, 2.5, 0.1)}
    _csv(f"{land}/c.csv", HEADER.replace(",tax", ""), ["3,5,2024-01-01,2,x,1,2.5"])
    with pytest.raises(Exception, match="missing required columns"):
        stream_landing(spark, land, out, checkpoint=f"{scratch}/ck").awaitTermination(120)
    assert spark.read.parquet(out).count() == 2


def test_varchar_limit_fails_load(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS vtest")
    from martcraft.sources.tables import create_cleaned_table
    create_cleaned_table(spark, "vtest.t")
    long = spark.createDataFrame([(1, 1, None, 1, "x" * 300, 1, None, None)],
                                 "transaction_id bigint, customer_id bigint, transaction_date date, product_id bigint, "
                                 "product_name string, quantity int, price decimal(10,2), tax decimal(10,2)")
    with pytest.raises(Exception):
        load_typed(spark, long, "vtest.t")


def test_incremental_append_is_idempotent(spark, scratch):
    import datetime as dt
    d = dt.date
    rows = [(1, d(2024, 1, 5), d(2024, 1, 1)), (2, d(2024, 2, 5), d(2024, 2, 1)), (3, d(2024, 3, 5), d(2024, 3, 1))]
    df = spark.createDataFrame(rows, "transaction_key bigint, transaction_date date, transaction_month date")
    path = f"{scratch}/fact"
    append_incremental(spark, df.filter("transaction_key < 3"), path)
    append_incremental(spark, df, path)
    append_incremental(spark, df, path)
    got = sorted(r.transaction_key for r in spark.read.parquet(path).collect())
    assert got == [1, 2, 3]
    lazy = rows_after_high_water(df, df.filter("transaction_key = 1"))
    assert sorted(r.transaction_key for r in lazy.collect()) == [2, 3]
    assert rows_after_high_water(df, df.limit(0)).count() == 3
    assert within_dates(df, "2024-02-01", "2024-02-28").count() == 1


FACT = "transaction_key bigint, transaction_date date, transaction_month date, v int"


def _fact(spark, rows):
    import datetime as dt
    day = lambda d: d and dt.date.fromisoformat(d)
    month = lambda d: d and dt.date.fromisoformat(d).replace(day=1)
    return spark.createDataFrame([(k, day(d), month(d), v) for k, d, v in rows], FACT)


def _table(spark, path):
    return sorted(((r.transaction_key, str(r.transaction_date), r.v) for r in read_target(spark, path).collect()), key=str)


def test_merge_keeps_late_same_day_and_undated_rows(spark, scratch):
    path = f"{scratch}/fact"
    first = [(1, "2024-01-05", 1), (2, "2024-03-05", 1), (3, None, 1), (None, "2024-02-01", 1), (None, "2024-02-01", 2)]
    assert append_incremental(spark, _fact(spark, first), path) == Refresh(5, 0)
    later = [(4, "2024-01-09", 1), (5, "2024-03-05", 1), (6, None, 1), (None, "2024-02-01", 3), (7, "2023-12-31", 1), (2, "2024-03-06", 2)]
    want = sorted(((k, str(d), v) for k, d, v in [r for r in first if r[0] != 2] + later), key=str)
    assert append_incremental(spark, _fact(spark, later), path).written == 6
    assert _table(spark, path) == want
    append_incremental(spark, _fact(spark, later), path)  # again: nothing changes, rows without a key included
    assert _table(spark, path) == want
    # A key whose date moves leaves its old month, which goes if nothing is left there.
    append_incremental(spark, _fact(spark, [(7, "2024-03-01", 9)]), path)
    assert [r for r in _table(spark, path) if r[0] == 7] == [(7, "2024-03-01", 9)]
    assert not os.path.exists(f"{path}/transaction_month=2023-12-01")
    assert append_incremental(spark, _fact(spark, []), path) == Refresh(0, 0)


def test_merge_reads_and_rewrites_only_files_with_its_keys(spark, scratch):
    from martcraft.plans.key_index import KeyedTable
    path = f"{scratch}/fact"
    for lo in (0, 1000, 2000):  # three files of one month, each with a key range of its own
        rows = [(lo + 2 * i, "2024-01-05", 1) for i in range(50)]
        append_incremental(spark, _fact(spark, rows).coalesce(1), path, mode="high_water" if lo == 0 else "merge")
    table = KeyedTable(spark, path, "transaction_key", read_target(spark, path).schema)
    before = set(table.listed())
    assert len(before) == 3
    key = lambda *ks: spark.createDataFrame([(k,) for k in ks], "_id long")
    assert len(table.near(key(1010))) == 1 and table.near(key(500, 5000, -7)) == []
    assert len(table.near(key(4, 1004, 1500))) == 2
    assert len(table.near(key(1011))) == 1 and table.holding(key(1011)) == []  # in range, but not there
    plan = table.read(table.near(key(1010))).select("transaction_key")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<transaction_key:bigint>" in plan and "1 paths" in plan
    append_incremental(spark, _fact(spark, [(1010, "2024-01-06", 7), (1011, "2024-02-01", 7)]), path)
    after = set(table.listed())
    assert len(before & after) == 2 and len(before - after) == 1  # one file was rewritten
    got = {k: v for k, _, v in _table(spark, path)}
    assert len(_table(spark, path)) == 151 and got[1010] == got[1011] == 7 and got[1012] == 1


def test_merge_keeps_one_row_per_key(spark, scratch):
    rows = [(1, "2024-01-05", 1), (1, "2024-02-05", 2), (2, None, 3), (2, "2024-01-01", 4), (None, "2024-01-01", 5), (None, "2024-01-01", 5)]
    path = f"{scratch}/latest"
    assert append_incremental(spark, _fact(spark, rows), path).written == 4
    assert _table(spark, path) == sorted([(1, "2024-02-05", 2), (2, "2024-01-01", 4), (None, "2024-01-01", 5), (None, "2024-01-01", 5)], key=str)
    append_incremental(spark, _fact(spark, [(1, "2023-05-05", 8), (1, "2023-04-05", 9)]), path)
    assert [x for x in _table(spark, path) if x[0] == 1] == [(1, "2023-05-05", 8)]
    append_incremental(spark, _fact(spark, rows), f"{scratch}/keep", repeats="keep")
    assert len(_table(spark, f"{scratch}/keep")) == 6
    with pytest.raises(Exception, match="repeated key"):
        append_incremental(spark, _fact(spark, rows), f"{scratch}/fail", repeats="fail")
    append_incremental(spark, _fact(spark, rows[1:3] + rows[4:]), f"{scratch}/once", repeats="fail")
    assert len(_table(spark, f"{scratch}/once")) == 4


def test_merge_moves_rows_between_odd_partitions(spark, scratch):
    path, schema = f"{scratch}/odd", "transaction_key long, transaction_date date, part string"
    df = lambda rows: spark.createDataFrame([(k, None, p) for k, p in rows], schema)
    append_incremental(spark, df([(1, "a/b"), (2, "x:y"), (3, "50%"), (4, None), (5, "a=b c"), (6, "é{[")]), path, partition_by=("part",))
    append_incremental(spark, df([(1, "z"), (2, "z"), (3, "%41"), (4, "a/b"), (5, "a=b c"), (6, None)]), path, partition_by=("part",))
    got = {(r.transaction_key, r.part) for r in spark.read.schema(schema).parquet(path).collect()}
    assert got == {(1, "z"), (2, "z"), (3, "%41"), (4, "a/b"), (5, "a=b c"), (6, None)}
    assert sum(f.startswith("part=") for f in os.listdir(path)) == 5


def test_swap_names_the_new_files_as_they_are_listed(spark, scratch):
    from martcraft.plans.key_index import KeyedTable

    path = f"{scratch}/odd names"
    rows = [(1, "a/b"), (2, "c:d"), (3, "50 %"), (None, "plain")]
    df = spark.createDataFrame(rows, "transaction_key long, part string")
    df.write.partitionBy("part").parquet(path)
    table = KeyedTable(spark, path, "transaction_key", df.schema)
    before = table.listed()
    assert [f.rsplit("/", 2)[1] for f in table.unkeyed()] == ["part=plain"]
    new = table.swap(df.where("transaction_key is not null"), before, ("part",))
    assert sorted(new) == sorted(table.listed()) and not set(new) & set(before)
    assert sorted((r.transaction_key, r.part) for r in table.read(new).collect()) == rows[:3]
    assert table.unkeyed() == []


def test_merge_is_finished_after_a_failure(spark, scratch, monkeypatch):
    from martcraft.plans.key_index import KeyedTable
    path = f"{scratch}/fact"
    append_incremental(spark, _fact(spark, [(k, "2024-01-05", 1) for k in range(6)]), path)
    later = _fact(spark, [(3, "2024-02-05", 2), (9, "2024-02-05", 2)])
    done = KeyedTable._carry_out
    monkeypatch.setattr(KeyedTable, "_carry_out", lambda self, run: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        append_incremental(spark, later, path)
    assert len(_table(spark, path)) == 6  # nothing to be seen yet
    monkeypatch.setattr(KeyedTable, "_carry_out", done)
    append_incremental(spark, _fact(spark, [(10, "2024-03-05", 1)]), path)  # finishes the one before first
    assert [(k, v) for k, _, v in _table(spark, path)] == sorted([(0, 1), (1, 1), (2, 1), (3, 2), (4, 1), (5, 1), (9, 2), (10, 1)], key=str)
    monkeypatch.setattr(KeyedTable, "swap", lambda self, new, gone, by: (new.write.parquet(f"{path}/_staged-x"), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        append_incremental(spark, later, path)
    monkeypatch.undo()
    append_incremental(spark, _fact(spark, [(11, "2024-03-05", 1)]), path)
    assert len(_table(spark, path)) == 9 and not [f for f in os.listdir(path) if f.startswith(("_staged", "_swap"))]


def test_loads_within_dates(spark, scratch):
    path = f"{scratch}/fact"
    rows = [(1, "2024-01-05", 1), (2, "2024-02-05", 1), (3, "2024-03-05", 1), (4, None, 1)]
    assert append_incremental(spark, _fact(spark, rows), path, end="2024-02-05").written == 2
    assert append_incremental(spark, _fact(spark, rows), path, start="2024-02-05", end="2024-12-31").written == 2
    assert [r[0] for r in _table(spark, path)] == [1, 2, 3]


def test_high_water_counts_what_it_leaves_out(spark, scratch):
    path = f"{scratch}/fact"
    append_incremental(spark, _fact(spark, [(1, "2024-01-05", 1)]), path)
    got = append_incremental(spark, _fact(spark, [(2, "2024-01-05", 1), (3, None, 1), (4, "2024-01-01", 1), (5, "2024-01-06", 1)]), path, mode="high_water")
    assert got == Refresh(1, 3)
    assert [r[0] for r in _table(spark, path)] == [1, 5]


@pytest.mark.parametrize("mode", ["merge", "high_water"])
def test_new_column_survives(spark, scratch, mode):
    path = f"{scratch}/fact"
    append_incremental(spark, _fact(spark, [(1, "2024-01-05", 1)]), path)
    wide = _fact(spark, [(2, "2024-02-05", 1)]).withColumn("extra", F.lit("new"))
    with pytest.raises(ValueError, match="schema changed"):
        append_incremental(spark, wide, path, mode=mode)
    append_incremental(spark, wide, path, on_schema_change="append_new_columns", mode=mode)
    append_incremental(spark, _fact(spark, [(3, "2024-03-05", 1)]).withColumn("extra", F.lit("more")), path, mode=mode)
    assert {r.transaction_key: r.extra for r in read_target(spark, path).collect()} == {1: None, 2: "new", 3: "more"}


def test_csv_hand_off_keeps_empty_strings_apart(spark, scratch):
    write_csv(spark.createDataFrame([(1, ""), (2, None), (3, "x")], "k int, v string"), f"{scratch}/c")
    text = "".join(open(f"{scratch}/c/{f}").read() for f in os.listdir(f"{scratch}/c") if f.startswith("part"))
    assert '""' not in text


def test_own_checkpoint_folder_only_in_local_mode(monkeypatch):
    from martcraft import session

    class Context:
        master, applicationId = "local-cluster[2,1,1024]", "none"

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(RuntimeError, match="shared folder"):
        session.checkpoint_dir(Session())


def test_materialized_folders_are_deleted_with_the_application(spark):
    from martcraft.plans.materialize import materialize
    from urllib.parse import urlparse
    path = urlparse(materialize(spark.range(3).toDF("k"), "gone").inputFiles()[0]).path
    folder = spark._jvm.org.apache.hadoop.fs.Path(os.path.dirname(path))
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    assert fs.cancelDeleteOnExit(folder)  # it was registered
    fs.deleteOnExit(folder)


def test_schema_drift(spark):
    a = spark.createDataFrame([(1, "x")], "k bigint, v string").schema
    b = spark.createDataFrame([(1, "x", 2)], "k bigint, v string, w int").schema
    c = spark.createDataFrame([(1, 2)], "k bigint, v int").schema
    with pytest.raises(ValueError):
        check_schema_drift(a, b, "fail")
    assert check_schema_drift(a, b, "append_new_columns")["added"] == ["w"]
    with pytest.raises(ValueError):
        check_schema_drift(a, c, "append_new_columns")


def test_file_stream_loads_each_file_once(spark, scratch):
    from martcraft.streaming.landing import stream_landing
    land, out = f"{scratch}/landing", f"{scratch}/stream_out"
    os.makedirs(land)
    _csv(f"{land}/a.csv", HEADER, ["T1,5.0,2024-01-01,P2,x,1,2.5,0.1", "2,6,02-01-2024,3,y,2,3,Fifteen"])
    q = stream_landing(spark, land, out, name="t1", checkpoint=f"{scratch}/ck")
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 2
    _csv(f"{land}/b.csv", HEADER, ["3,7,2023-12-31,4,z,1,4,0.2"])  # late row, dated before the mark
    q = stream_landing(spark, land, out, name="t1", checkpoint=f"{scratch}/ck")
    q.awaitTermination(120)
    q = stream_landing(spark, land, out, name="t1", checkpoint=f"{scratch}/ck")
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == 3 and got.filter("transaction_id = 3").count() == 1


def test_scale_conf():
    from martcraft.session import scale_conf
    big = scale_conf(100 << 40, 8000)
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 << 12  # 256 MiB each
    small = scale_conf(10 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "24"
