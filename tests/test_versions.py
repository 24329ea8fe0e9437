"""Versioned tables: readers never miss a table, of two loaders one is refused, bad records change nothing."""

from __future__ import annotations

import os
import threading

import pytest

from ledgerlake.plans import pipeline as P
from ledgerlake.sinks import versions as V
from ledgerlake.sinks import warehouse as W
from ledgerlake.sources.csv_records import read_csv
from ledgerlake.sources.files import load_csv_by_name


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_a_load_replaces_the_rows_and_keeps_the_layout(spark, tmp_path, typed_tables):
    loc = str(tmp_path / "orders")
    first = V.load_version(spark, typed_tables["orders"], "ver_orders", loc)
    assert first["created"] and (first["version"], first["rows_loaded"]) == (1, 10)
    assert first["partition_by"] == [W.INGEST_DATE] and first["clustering"] == ["customer_id", "product_id"]
    second = V.load_version(spark, typed_tables["orders"].limit(4), "ver_orders", loc, clustering=["order_id"])
    assert not second["created"] and second["version"] == 2 and second["clustering"] == ["customer_id", "product_id"]
    assert W.read_table(spark, "ver_orders").count() == 4
    assert V.read_version(spark, "ver_orders", 1).count() == 10
    third = V.load_version(spark, W.read_table(spark, "ver_orders").limit(3), "ver_orders", loc)  # from itself
    assert third["version"] == 3 and V.versions(spark, "ver_orders") == [2, 3]
    assert not os.path.exists(first["location"]) and os.path.exists(second["location"])
    assert rows(W.verify_tables(spark, {"ver_orders": 3})) == rows(spark.sql("SELECT 'ver_orders', 3L, 3L, true"))


def test_readers_never_miss_the_table_while_columns_change(spark, tmp_path):
    frames = [spark.range(40).selectExpr("id AS a", *[f"id AS more_{k}" for k in range(n)]) for n in range(4)]
    V.load_version(spark, frames[0], "ver_read", str(tmp_path), num_files=1)
    seen, failed, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                df = spark.table("ver_read")
                seen.append((len(df.columns), df.count()))
            except Exception as e:  # noqa: BLE001 - whatever a reader meets
                failed.append(e)
    reader = threading.Thread(target=read)
    reader.start()
    try:
        for k in range(8):
            V.load_version(spark, frames[k % 4], "ver_read", str(tmp_path), num_files=1, keep=8)
    finally:
        done.set()
        reader.join()
    assert not failed and len(seen) > 8
    assert {n for _, n in seen} == {40} and len({c for c, _ in seen}) > 1


def test_of_two_loaders_one_is_refused(spark, tmp_path):
    V.load_version(spark, spark.range(1), "ver_two", str(tmp_path), num_files=1)
    began, results, gate = V.current_version(spark, "ver_two"), [], threading.Barrier(2)

    def load(n):
        gate.wait()
        try:
            results.append((n, V.load_version(spark, spark.range(n), "ver_two", str(tmp_path), base=began, num_files=1)))
        except V.ConcurrentLoad as e:
            results.append((n, e))
    threads = [threading.Thread(target=load, args=(n,)) for n in (10, 20)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    won = [n for n, r in results if isinstance(r, dict)]
    assert len(won) == 1 and len(results) == 2
    assert spark.table("ver_two").count() == won[0] and V.versions(spark, "ver_two") == [1, 2]
    # one that began before the other's commit is refused as well
    with pytest.raises(V.ConcurrentLoad, match="since this load began"):
        V.load_version(spark, spark.range(5), "ver_two", str(tmp_path), base=began, num_files=1)
    assert spark.table("ver_two").count() == won[0]


def test_a_loader_that_dies_before_the_view_moves(spark, tmp_path, monkeypatch):
    V.load_version(spark, spark.range(3), "ver_dead", str(tmp_path), num_files=1)
    with monkeypatch.context() as m:
        m.setattr(V, "_view", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            V.load_version(spark, spark.range(7), "ver_dead", str(tmp_path), num_files=1)
    assert spark.table("ver_dead").count() == 3
    with pytest.raises(V.ConcurrentLoad, match="recover"):
        V.load_version(spark, spark.range(9), "ver_dead", str(tmp_path), num_files=1)
    assert V.recover(spark, "ver_dead") == 2 and spark.table("ver_dead").count() == 7
    assert V.recover(spark, "ver_dead") == 2  # again: nothing to do
    assert V.load_version(spark, spark.range(9), "ver_dead", str(tmp_path), num_files=1)["version"] == 3


def test_a_plain_table_is_no_versioned_one(spark, tmp_path):
    W.load_table(spark, spark.range(2), "ver_plain", str(tmp_path))
    with pytest.raises(ValueError, match="no versioned table"):
        V.load_version(spark, spark.range(2), "ver_plain", str(tmp_path))


GOOD = "a,b,c\n1,x,2024-01-01\n2,\"y\ny\",2024-01-02\n"
BAD = {"bad value": ("a,b,c\n1,x,2024-01-01\none,y,2024-01-02\n", ["one,y,2024-01-02"]),
       "short row": ("a,b,c\n1,x,2024-01-01\n2,y\n", ["2,y"]),
       "long row": ("a,b,c\n1,x,2024-01-01,7\n2,y,2024-01-01\n", ["1,x,2024-01-01,7"])}
HEADERS = {"unknown column": "a,b,c,d\n1,x,2024-01-01,4\n", "missing column": "a,b\n1,x\n", "renamed": "a,b,cc\n1,x,2024-01-01\n"}
SCHEMA = "a bigint, b string, c date"


@pytest.mark.parametrize("load", [V.load_version, W.load_table], ids=["versioned", "swapped"])
@pytest.mark.parametrize("reader", [read_csv, load_csv_by_name], ids=["parallel", "one_task"])
def test_rejects_change_nothing_and_are_kept(spark, tmp_path, load, reader):
    table = f"rej_{load.__name__}_{reader.__name__}"
    schema = spark.createDataFrame([], SCHEMA).schema
    path = tmp_path / "f.csv"

    def run(text, **options):
        path.write_text(text)
        df = reader(spark, str(path), schema=schema, reject="_bad")
        return load(spark, df, table, str(tmp_path / "wh"), reject="_bad", num_files=2, **options)
    assert run(GOOD)["rows_rejected"] == 0
    before = rows(W.read_table(spark, table))
    assert len(before) == 2
    for text, records in BAD.values():
        with pytest.raises(W.RejectedRows) as e:
            run(text)
        assert e.value.rows == len(records)
        assert [r["record"] for r in spark.table(e.value.table).collect()] == records
        assert rows(W.read_table(spark, table)) == before
    for text in HEADERS.values():
        with pytest.raises(ValueError, match="CSV header"):
            run(text)
        assert rows(W.read_table(spark, table)) == before
    swapped = run("c,a,b\n2024-01-01,1,x\n2024-01-02,2,\"y\ny\"\n")  # by name: the same rows
    assert swapped["rows_loaded"] == 2 and rows(W.read_table(spark, table)) == before
    assert not spark.catalog.tableExists(W.rejects_table(table))
    some = run(BAD["bad value"][0], max_rejects=1)
    assert (some["rows_loaded"], some["rows_rejected"]) == (1, 1) and W.read_table(spark, table).count() == 1
    assert spark.table(W.rejects_table(table)).count() == 1
    assert W.read_table(spark, table).columns == ["a", "b", "c"]


@pytest.mark.parametrize("versioned", [False, True])
def test_processed_files_are_loaded_by_name(spark, tmp_path, versioned):
    proc, wh, table = tmp_path / "proc", str(tmp_path / "wh"), f"swap_{versioned}".lower()
    out = W.save_as_csv(spark.createDataFrame([(1, 2)], "a int, b int"), str(proc / f"{table}_processed.csv"), single_file=True)
    part = next(proc.glob("*/part-*"))

    def load(text):
        part.write_text(text)
        (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
        return P.load_all_tables(spark, str(proc), wh, versioned=versioned).collect()
    assert load("b,a\n2,1\n")[0]["total_rows"] == 1
    assert [r.asDict() for r in W.read_table(spark, table).collect()] == [{"a": 1, "b": 2}]
    for text in ("a,b,c\n1,2,3\n", "a,c\n1,2\n", "a\n1\n"):
        with pytest.raises(ValueError, match="CSV header"):
            load(text)
    for text in ("a,b\n1,x\n", "a,b\n1,2,3\n", "a,b\n1\n"):
        with pytest.raises(W.RejectedRows):
            load(text)
    assert [r.asDict() for r in W.read_table(spark, table).collect()] == [{"a": 1, "b": 2}] and out


def test_a_versioned_run(spark, tmp_path, fixture_dir):
    from ledgerlake.__main__ import main
    spark.sql("DROP TABLE IF EXISTS customers")  # of other tests
    runs = [P.run_pipeline(spark, str(fixture_dir), str(tmp_path / "wh"), selected="customers.csv", versioned=True)
            for _ in range(2)]
    assert [r["load"]["version"] for r in runs] == [1, 2] and runs[1]["rows_loaded"] == 14
    assert W.read_table(spark, "customers").count() == 14
    again = main(["run", "--input", str(fixture_dir), "--warehouse", str(tmp_path / "wh"), "--file", "customers.csv",
                  "--versioned"], spark)
    assert again["status"] == "success" and V.current_version(spark, "customers") == 3
    checked = main(["reconcile", "--tables", "customers"], spark)
    assert checked["passed"] and len(checked["checks"]) == 5
    spark.sql("DROP VIEW customers")
    for v in V.versions(spark, "customers"):
        spark.sql(f"DROP TABLE customers__v{v:06}")


def test_a_refused_load_moves_and_writes_its_rejects_only(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(1, None), (2, "2,x"), (3, None)], "customer_id int, bad string")
    monkeypatch.setattr(W, "clustered", lambda *args: pytest.fail("rows of a refused load are moved"))
    with pytest.raises(W.RejectedRows) as e:
        V.load_version(spark, rows, "refused_only", str(tmp_path / "t"), reject="bad")
    assert e.value.rows == 1 and V.current_version(spark, "refused_only") == 0
    assert [r["record"] for r in spark.table(e.value.table).collect()] == ["2,x"]
    monkeypatch.undo()
    done = V.load_version(spark, rows, "refused_only", str(tmp_path / "t"), reject="bad", max_rejects=1)
    assert (done["rows_loaded"], done["rows_rejected"]) == (2, 1)
    assert sorted(r["customer_id"] for r in spark.table("refused_only").collect()) == [1, 3]
