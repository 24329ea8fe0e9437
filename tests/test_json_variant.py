"""JSON through VARIANT: the rows and types of Spark's own inference, from one scan of the text."""

from __future__ import annotations

import json

import pytest

from ledgerlake.sources import json_variant as J
from ledgerlake.sources.files import load_json

RECORDS = [{"b": 1, "a": "x", "p": 120.5, "n": None, "x.y": {"k": [1, 2.5], "odd name": True}},
           {"b": "two", "a": "y", "p": 3, "big": 12345678901234567890123, "d": "2024-01-01", "list": [{"q": 1}, {"q": "s"}]},
           {"b": 2.5, "Order ID": 7, "VOID: VARIANT": 1, "tick`s": "t", "list": [], "deep": {"o": {"z": None, "w": 0.25}}},
           {"b": True, "a": "", "flag": True}, {"b": None, "flag": False, "neg": -5}]


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def same(found, want):
    assert found.dtypes == want.dtypes
    assert rows(found) == rows(want)


@pytest.mark.parametrize("lines", [False, True])
@pytest.mark.parametrize("as_text", [False, True])
def test_columns_types_and_rows_of_the_inference(spark, tmp_path, lines, as_text):
    p = tmp_path / "r.json"
    p.write_text("\n".join(map(json.dumps, RECORDS)) if lines else json.dumps(RECORDS, indent=1))
    same(J.read_json(spark, str(p), multi_line=not lines, as_text=as_text),
         load_json(spark, str(p), multi_line=not lines, as_text=as_text))


def test_the_fixture(spark, fixture_dir):
    path = str(fixture_dir / "orders.json")
    found = J.read_json(spark, path)
    assert found.count() == 12
    same(found, load_json(spark, path))


def test_a_clashing_type_keeps_every_value(spark, tmp_path):
    """Plain values as written, others as JSON text; numbers with an exponent in one form."""
    p = tmp_path / "c.json"
    p.write_text(json.dumps([*RECORDS, {"b": {"in": [1, "2"]}}, {"b": 1e300}, {"b": [True]}], indent=2))
    found = J.read_json(spark, str(p))
    assert sorted(r["b"] for r in found.filter("b IS NOT NULL").collect()) == [
        "1", "1.0E300", "2.5", "[true]", "true", "two", '{"in":[1,"2"]}']


def test_one_object_an_empty_array_and_several_files(spark, tmp_path):
    for name, text in (("one", '{"a": 1,\n "b": "x"}'), ("none", "[]"), ("more", '[{"a": 2}, {"c": 3}]')):
        (tmp_path / f"{name}.json").write_text(text)
    same(J.read_json(spark, str(tmp_path / "one.json")), load_json(spark, str(tmp_path / "one.json")))
    assert J.read_json(spark, str(tmp_path / "none.json")).columns == []
    same(J.read_json(spark, str(tmp_path)), load_json(spark, str(tmp_path)))


def test_records_that_are_no_json(spark, tmp_path):
    p = tmp_path / "bad.json"
    p.write_text('{"a": 1}\nnot json\n\n{"a": 2, \n[1]\n')
    found = J.read_json(spark, str(p), multi_line=False)
    assert found.columns == ["_corrupt_record", "a"]
    assert rows(found) == sorted(map(repr, [(None, 1), ("not json", None), ('{"a": 2, ', None), ("[1]", None)]))


def test_one_scan_of_the_text(spark, tmp_path):
    """Jobs that read the input: one, where the inferring reader has two."""
    p = tmp_path / "r.json"
    p.write_text("\n".join(map(json.dumps, RECORDS)))
    found = J.read_json(spark, str(p), multi_line=False)
    assert str(p) not in found._jdf.queryExecution().toString()  # reads what was written
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("variant", "variant")
    J.read_json(spark, str(p), multi_line=False)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("variant")) == 1


def test_a_document_over_the_limit(spark, tmp_path, monkeypatch):
    p = tmp_path / "r.json"
    p.write_text(json.dumps(RECORDS))
    want = rows(load_json(spark, str(p)))
    monkeypatch.setattr(J, "MAX_DOCUMENT", 10)
    assert rows(J.read_json(spark, str(p))) == want


def test_type_texts():
    assert J.variant_type("OBJECT<a: VOID, b: VARIANT, `: VOID`: DECIMAL(3, 1), VOID: DECIMAL(20,0), o: OBJECT<>>") == (
        "STRUCT<a: STRING, b: STRING, `: VOID`: DOUBLE, VOID: DECIMAL(20,0), o: STRING>")
    assert J.variant_type("OBJECT<x: ARRAY<OBJECT<y: ARRAY<VOID>>>>") == "STRUCT<x: ARRAY<STRUCT<y: ARRAY<STRING>>>>"
