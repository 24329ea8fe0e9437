from __future__ import annotations

import json

import pytest

from ledgerlake.sources import files as S
from ledgerlake.sources.catalog import find_selected_file, list_input_files


def test_fixture_row_counts(raw_tables):
    assert raw_tables["customers"].count() == 15
    assert raw_tables["orders"].count() == 12
    assert raw_tables["products"].count() == 5


def test_fixture_key_columns(raw_tables):
    assert "customer_id" in raw_tables["customers"].columns
    assert "order_id" in raw_tables["orders"].columns
    assert {"product_id", "product_name", "category"} <= set(raw_tables["products"].columns)


def test_csv_inferred_types(raw_tables):
    types = dict(raw_tables["customers"].dtypes)
    assert types["customer_id"] == "int"
    assert types["signup_date"] == "date"
    # an unquoted empty field is NULL
    assert raw_tables["customers"].filter("email IS NULL").count() == 1


def test_json_columns_alphabetical(raw_tables):
    cols = raw_tables["orders"].columns
    assert cols == sorted(cols)
    types = dict(raw_tables["orders"].dtypes)
    assert types["price"] == "double" and types["order_date"] == "string"


def test_csv_tolerant_headers(spark, tmp_path):
    p = tmp_path / "headers.csv"
    p.write_text('Order Date,Sales($),a,A,,1st,x.y\n2025-01-01,"1,5","line\nbreak","say ""hi""",z,1,2\n')
    df = S.load_csv(spark, str(p), multi_line=True)
    assert df.count() == 1
    row = df.collect()[0]
    assert row[2] == "line\nbreak"
    assert row[3] == 'say "hi"'
    from ledgerlake.functions.naming import normalize_columns
    assert df.columns == ["Order Date", "Sales($)", "a2", "A3", "_c4", "1st", "x.y"]
    assert normalize_columns(df).columns == ["order_date", "sales", "a2", "a3", "c4", "column_1st", "x_y"]


def test_dotted_header_is_quoted(spark, tmp_path):
    p = tmp_path / "dots.csv"
    p.write_text("x.y,b\n1,\n,2\n")
    from ledgerlake.operators.quality import generate_quality_report, report_as_dict
    rep = report_as_dict(generate_quality_report(S.load_csv(spark, str(p)), "dots"))
    assert rep["nulls"]["null_counts"] == {"x.y": 1, "b": 1}


def test_xml_dynamic_attributes_nested_repeated(spark, tmp_path):
    p = tmp_path / "nested.xml"
    p.write_text(
        "<?xml version='1.0'?>\n<items>\n"
        '  <item id="1" kind="a"><name>Pen</name><size><h>2</h><w>1</w></size><tag>x</tag><tag>y</tag></item>\n'
        '  <item id="2"><name></name><kind>child-wins</kind></item>\n'
        "  <gadget><name>Clip</name></gadget>\n"
        "</items>\n")
    df = S.load_xml_dynamic(spark, str(p))
    rows = {r["name"]: r.asDict() for r in df.collect()}
    assert df.count() == 3
    pen = rows["Pen"]
    assert pen["id"] == "1" and pen["kind"] == "a"
    assert json.loads(pen["size"]) == {"h": "2", "w": "1"}
    assert pen["tag"] == "y"  # last repeated child wins
    empty = rows[None]
    assert empty["kind"] == "child-wins"  # child element wins over attribute
    assert rows["Clip"]["id"] is None


def test_xml_without_records_raises(spark, tmp_path):
    p = tmp_path / "empty.xml"
    p.write_text("<?xml version='1.0'?>\n<root></root>\n")
    with pytest.raises(ValueError):
        S.load_xml_dynamic(spark, str(p))


def test_load_file_dispatch(spark, fixture_dir):
    assert S.load_file(spark, str(fixture_dir / "customers.csv")).count() == 15
    assert S.load_file(spark, str(fixture_dir / "orders.json")).count() == 12
    assert S.load_file(spark, str(fixture_dir / "products.xml")).count() == 5
    with pytest.raises(ValueError):
        S.load_file(spark, str(fixture_dir / "notes.txt"))


def test_catalog_listing_and_selection(spark, tmp_path):
    d = tmp_path / "inbox"
    (d / "sub").mkdir(parents=True)
    (d / "b.CSV").write_text("a\n1\n")
    (d / "A.json").write_text("[]")
    (d / "~$tmp.xlsx").write_text("x")
    (d / "notes.txt").write_text("x")
    (d / "sub" / "c.csv").write_text("a\n1\n")
    cat = list_input_files(spark, str(d))
    rows = cat.collect()
    assert [r["name"] for r in rows] == ["A.json", "b.CSV"]
    assert [r["type"] for r in rows] == ["JSON", "CSV"]
    assert find_selected_file(cat, "B.csv")["name"] == "b.CSV"
    assert find_selected_file(cat, "/some/where/a.JSON")["name"] == "A.json"
    assert find_selected_file(cat)["name"] == "A.json"
    with pytest.raises(FileNotFoundError, match="A.json, b.CSV"):
        find_selected_file(cat, "missing.csv")


def test_empty_inputs(spark, tmp_path):
    from ledgerlake.operators.quality import generate_quality_report, report_as_dict
    (tmp_path / "h.csv").write_text("a,b\n")
    (tmp_path / "e.json").write_text("[]")
    csv = S.load_csv(spark, str(tmp_path / "h.csv"))
    assert csv.count() == 0 and csv.columns == ["a", "b"]
    rep = report_as_dict(generate_quality_report(csv, "h.csv"))
    assert rep["row_count"] == 0 and rep["duplicates"]["duplicate_rows"] == 0 and rep["schema"]["passed"]
    js = S.load_json(spark, str(tmp_path / "e.json"))
    assert js.count() == 0
    rep = report_as_dict(generate_quality_report(js, "e.json"))
    assert rep["row_count"] == 0 and rep["column_count"] == len(js.columns)


def test_all_null_column_and_duplicate_headers(spark, tmp_path):
    from ledgerlake.functions.naming import normalize_columns
    from ledgerlake.operators.quality import generate_quality_report, report_as_dict
    (tmp_path / "n.csv").write_text("id,note,id\n1,,1\n2,,2\n")
    df = S.load_csv(spark, str(tmp_path / "n.csv"))
    assert df.columns == ["id0", "note", "id2"]  # Spark suffixes duplicate headers with their index
    assert normalize_columns(df).columns == ["id0", "note", "id2"]
    rep = report_as_dict(generate_quality_report(df, "n.csv"))
    assert rep["nulls"]["null_counts"]["note"] == 2


def test_xml_tags_do_not_depend_on_block_size(spark, tmp_path):
    p = tmp_path / "big.xml"
    noise = "<!-- <a> <b/> -->" + "<?x <y>?>" + "<note>x &gt; y<![CDATA[</items> <z>]]></note>"
    p.write_text("<!DOCTYPE items [<!ELEMENT items ANY> <!ENTITY e 'x'>]>" + "<!-- long -->\n" * 400 + "<items a='1>0'>"
                 + "".join(f"<item n='{k}'>{noise}</item>" for k in range(300)) + "<gadget/></items>")
    (tmp_path / "other.xml").write_text("<orders><order><id>7</id></order></orders>")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (old, "700"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert S.record_tags(spark, str(p)) == ["gadget", "item"]
            assert S.record_tags(spark, str(tmp_path)) == ["gadget", "item", "order"]
            assert S.record_tags(spark, str(tmp_path), "orders") == ["order"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    p.write_text("<items>" + "".join(f"<item><n>{k}</n></item>" for k in range(300)) + "</items>")
    assert S.load_xml_dynamic(spark, str(tmp_path)).count() == 301


def test_xml_after_a_long_preamble_and_with_several_roots(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<?xml version='1.0'?>\n<!--\n" + "line\n" * 300 + "-->\n<products><product><id>1</id>"
                                    "</product></products>")
    (tmp_path / "b.xml").write_text("<orders>\n<order><id>2</id></order>\n</orders>")
    rows = S.load_xml_dynamic(spark, str(tmp_path)).collect()
    assert sorted(r["id"] for r in rows) == ["1", "2"]


def test_xml_record_tag_at_two_depths_is_refused(spark, tmp_path):
    p = tmp_path / "x.xml"
    p.write_text("<all><item><item2/></item><box><item/></box></all>")
    with pytest.raises(ValueError, match="row_tags"):
        S.load_xml_dynamic(spark, str(p))


def test_schema_skips_inference(spark, fixture_dir):
    from ledgerlake.entities import CUSTOMERS, PRODUCTS
    df = S.load_xml(spark, str(fixture_dir / "products.xml"), schema=PRODUCTS.schema)
    assert df.schema == PRODUCTS.schema and df.count() == 5
    df = S.load_file(spark, str(fixture_dir / "customers.csv"), schema=CUSTOMERS.schema)
    assert df.schema == CUSTOMERS.schema and df.count() == 15


def test_added_files_are_read(spark, tmp_path):
    from ledgerlake.sources.tables import read_table
    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    assert read_table(spark, str(tmp_path), "t").count() == 3
    spark.range(5).write.mode("append").parquet(path)
    assert read_table(spark, str(tmp_path), "t").count() == 8


def test_xml_nested_child_is_one_level_json(spark, tmp_path):
    p = tmp_path / "deep.xml"
    p.write_text(
        "<?xml version='1.0'?>\n<rows>\n"
        '  <row><id>1</id><dims unit="cm"><h>2</h><w/><d><x>9</x></d><t>a</t><t>b</t></dims></row>\n'
        "</rows>\n")
    r = S.load_xml_dynamic(spark, str(p)).collect()[0]
    assert json.loads(r["dims"]) == {"h": "2", "w": None, "d": None, "t": "b"}


def test_catalog_ignores_nested_dir_with_same_name(spark, tmp_path):
    d = tmp_path / "inbox"
    (d / "sub" / "inbox").mkdir(parents=True)
    (d / "a.csv").write_text("a\n1\n")
    (d / "sub" / "inbox" / "b.csv").write_text("a\n1\n")
    assert [r["name"] for r in list_input_files(spark, str(d)).collect()] == ["a.csv"]
    assert [r["name"] for r in list_input_files(spark, "file://" + str(d)).collect()] == ["a.csv"]


def test_quoted_newlines_are_read_by_default(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text('a,b\n1,"two\nlines"\n2,x\n')
    assert [tuple(r) for r in S.load_file(spark, str(p)).collect()] == [(1, "two\nlines"), (2, "x")]
    with pytest.raises(Exception):  # one record a line was stated: the broken one raises
        S.load_file(spark, str(p), multi_line=False).collect()
    (tmp_path / "plain.csv").write_text("a,b\n1,x\n2,y\n")
    assert S.load_file(spark, str(tmp_path / "plain.csv"), multi_line=False).count() == 2


def test_typed_xml_takes_child_texts(spark, tmp_path):
    p = tmp_path / "p.xml"
    p.write_text("<?xml version='1.0'?>\n<products>\n"
                 '  <product sku="x"><product_id>1</product_id><product_name>A</product_name>'
                 "<product_name>B</product_name><category/><dims><h>2</h></dims></product>\n"
                 "</products>\n")
    r = S.load_xml(spark, str(p)).first().asDict()
    assert r == {"category": None, "dims": None, "product_id": "1", "product_name": "B"}
