"""Quoted CSV in parallel: the same rows and types as Spark's multi-line reader, at every block size."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from ledgerlake.sources import csv_records as R
from ledgerlake.sources.files import load_csv


@pytest.fixture
def blocks(spark, monkeypatch):
    """Sets the size of a block of the text files."""
    read_lines = R.read_lines

    def to(size: int) -> None:
        def split(*args):
            keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
            before = {k: spark.conf.get(k) for k in keys}
            try:
                for k, v in keys.items():
                    spark.conf.set(k, v)
                return read_lines(*args)
            finally:
                for k, v in before.items():
                    spark.conf.set(k, v)
        monkeypatch.setattr(R, "read_lines", split)
    return to


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


CASES = {
    "plain": "a,b\n1,x\n2,y\n",
    "no_end": "a,b\n1,x\n2,y",
    "newline": 'a,b\n1,"x\ny"\n2,z\n3,"p\n\nq\n"\n',
    "crlf": 'a,b\r\n1,"x\r\ny"\r\n2,z\r\n\r\n3,""\r\n',
    "mixed_ends": 'a,b\n1,"x\r\ny\rz"\n\n2,z\n',
    "stray_quotes": 'a,b\n"q""x",5" pipe\n"ab"cd,e"f\n3,"a""\nb"\n4,7" by 9"\n"",\n',
    "open_at_end": 'a,b\n1,x\n2,"open\n3,x',
    "spaces": 'a,b\n1, "sp\n2,"x" \n3, \n  \n4,"  "\n',
    "doubled": 'a,b\n"""","""x"""\n"a""\n""b","""\n"""\n',
    "delimiters_in_quotes": 'a,b\n"1,\n2","x,""y"",z"\n",\n",","\n',
    "quoted_header": '"a\nb","c,d"\n1,2\n',
    "header_only": "a,b\n",
    "odd_names": "Order Date,a,A,,1st,x.y\n1,2,3,4,5,6\n",
    "bom": "﻿a,b\n1,2\n",
    "reset": 'a,b\n1,"in\nside","x"\n2,y\n"3\n","z\n"\n',
}


@pytest.mark.parametrize("name", CASES)
def test_rows_of_the_multi_line_reader(spark, tmp_path, blocks, name):
    path = tmp_path / f"{name}.csv"
    path.write_bytes(CASES[name].encode())
    want = load_csv(spark, str(path), infer_schema=False)
    blocks(5)
    found = R.read_csv(spark, str(path), infer_schema=False)
    assert (found.columns, rows(found)) == (want.columns, rows(want))


@pytest.mark.parametrize("seed,size", [(0, 9), (1, 40), (2, 200)])
def test_random_files(spark, tmp_path, blocks, seed, size):
    rng = random.Random(seed)
    for k in range(3):
        end = rng.choice(["\n", "\r\n"])

        def field():
            text = "".join(rng.choice(['"', ",", end, "a", "bc", " ", end, '""', "é"]) for _ in range(rng.randint(0, 6)))
            if rng.random() < 0.7:
                return '"' + text.replace('"', '""') + '"'
            return text.replace(end, "").replace(",", "").lstrip('"') or "n"
        lines = end.join(",".join(field() for _ in range(3)) for _ in range(60))
        (tmp_path / f"{k}.csv").write_bytes(f"x,y,z{end}{lines}{end}".encode())
    want = rows(load_csv(spark, str(tmp_path), infer_schema=False))
    blocks(size)
    assert rows(R.read_csv(spark, str(tmp_path), infer_schema=False)) == want


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path, blocks):
    path = tmp_path / "large.csv"
    path.write_text("id,note\n" + "".join(f'{k},"first\nsecond ""{k}"""\n' for k in range(5000)))
    want = rows(load_csv(spark, str(path)))
    blocks(16_000)
    lines = R.read_lines(spark, str(path), ",")
    assert lines.select("block").distinct().count() > 5 and load_csv(spark, str(path)).rdd.getNumPartitions() == 1
    found = R.read_csv(spark, str(path))
    assert dict(found.dtypes) == {"id": "int", "note": "string"} and rows(found) == want


@pytest.mark.parametrize("bound", [0, 1 << 19])
def test_a_record_over_many_blocks_and_both_joins(spark, tmp_path, blocks, monkeypatch, bound):
    monkeypatch.setattr(R, "MAX_BROADCAST_LINES", bound)
    path = tmp_path / "long.csv"
    path.write_text('a,b\n1,"' + "line\n" * 400 + '"\n2,x\n3,"' + 'q""\n' * 300 + '"\n')
    want = rows(load_csv(spark, str(path), infer_schema=False))
    blocks(100)
    assert rows(R.read_csv(spark, str(path), infer_schema=False)) == want


TYPED = {"i": ["1", "-2", "+3"], "l": ["1", "3000000000", "2"], "d": ["1", "2.5", "1e3"], "s": ["1", "x", "2"],
         "day": ["2024-01-31", "2024-02-01", ""], "at": ["2024-01-31 10:00:00", "2024-02-01T11:12:13", ""],
         "flag": ["true", "False", ""], "none": ["", "", ""], "big": ["99999999999999999999", "1", "2"],
         "bad_day": ["2024-02-31", "2024-02-01", ""], "space": [" 1", "2", "3"]}


def test_types_as_the_builtin_inference(spark, tmp_path):
    path = tmp_path / "typed.csv"
    path.write_text(",".join(TYPED) + "\n" + "\n".join(map(",".join, zip(*TYPED.values()))) + "\n")
    want, found = load_csv(spark, str(path)), R.read_csv(spark, str(path))
    assert found.dtypes == want.dtypes and rows(found) == rows(want)


SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
                       T.StructField("c", T.DateType())])


def test_columns_by_name_in_every_file(spark, tmp_path):
    (tmp_path / "1.csv").write_text('a,b,c\n1,"x\n",2024-01-01\n')
    (tmp_path / "2.csv").write_text("c,a,b\n2024-01-02,2,y\n")
    found = R.read_csv(spark, str(tmp_path), schema=SCHEMA)
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in SCHEMA]
    assert [(r["a"], r["b"], str(r["c"])) for r in found.orderBy("a").collect()] == [
        (1, "x\n", "2024-01-01"), (2, "y", "2024-01-02")]
    for header in ("a,b\n1,x\n", "a,b,c,d\n1,x,2024-01-01,4\n", "a,b,C2\n1,x,2024-01-01\n"):
        (tmp_path / "2.csv").write_text(header)
        with pytest.raises(ValueError, match="CSV header has"):
            R.read_csv(spark, str(tmp_path), schema=SCHEMA)


def test_rejected_records_are_marked(spark, tmp_path):
    (tmp_path / "r.csv").write_text('a,b,c\n1,x,2024-01-01\none,"y\ny",2024-01-02\n3,z\n4,z,2024-01-04,more\n5,z,soon\n')
    found = R.read_csv(spark, str(tmp_path / "r.csv"), schema=SCHEMA, reject="bad")
    assert sorted(r["bad"] for r in found.filter("bad IS NOT NULL").collect()) == [
        "3,z", "4,z,2024-01-04,more", "5,z,soon", 'one,"y\ny",2024-01-02']
    assert [r["a"] for r in found.filter("bad IS NULL").collect()] == [1]


def test_no_python_workers(spark, tmp_path):
    (tmp_path / "p.csv").write_text(CASES["newline"])
    plan = R.read_csv(spark, str(tmp_path / "p.csv"), infer_schema=False)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_an_empty_file(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    assert R.read_csv(spark, str(tmp_path / "e.csv")).columns == []
    assert R.read_csv(spark, str(tmp_path / "e.csv"), schema=SCHEMA).count() == 0


@pytest.mark.parametrize("seed", [0, 1])
def test_many_records_move_their_lines_once(spark, tmp_path, blocks, monkeypatch, seed):
    rng = random.Random(seed)
    for k in range(2):
        cells = ("".join(rng.choice(["\n", '""', ",", "a"]) for _ in range(rng.randint(0, 30))) for _ in range(40))
        (tmp_path / f"{k}.csv").write_text("x,y\n" + "".join(f'{n},"{c}"\n' for n, c in enumerate(cells)))
    want = rows(load_csv(spark, str(tmp_path), infer_schema=False))
    monkeypatch.setattr(R, "MAX_BROADCAST_LINES", 0)
    blocks(50)
    found = R.read_csv(spark, str(tmp_path), infer_schema=False)
    assert rows(found) == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation" in x and "kept" in x for x in plan.splitlines()) == 1  # the written lines are read once


@pytest.mark.parametrize("text", [CASES["plain"], CASES["no_end"], CASES["crlf"].replace('"x\r\ny"', "x"), CASES["spaces"],
                                  CASES["bom"], CASES["odd_names"], CASES["header_only"], 'a,b\n"x, ""y""",z\n\n"",\n'])
def test_lines_that_are_records_are_not_written(spark, tmp_path, monkeypatch, text):
    for k in range(2):
        (tmp_path / f"{k}.csv").write_bytes(text.encode())
    want = rows(load_csv(spark, str(tmp_path), infer_schema=False))

    def refuse(*args):
        raise AssertionError("lines are written")
    monkeypatch.setattr(R, "read_lines", refuse)
    assert rows(R.read_csv(spark, str(tmp_path), infer_schema=False)) == want


def test_a_row_that_reads_as_the_header(spark, tmp_path):
    (tmp_path / "h.csv").write_text("a,b\n1,x\na,b\n")
    assert rows(R.read_csv(spark, str(tmp_path), infer_schema=False)) == ["('1', 'x')", "('a', 'b')"]
