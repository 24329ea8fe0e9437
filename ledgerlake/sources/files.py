"""File loaders: CSV, JSON and XML.

All readers are Spark's distributed sources; nothing is parsed on the driver.

Scale notes:

* Spark's multi-line readers make every file one task. A CSV file larger than an input split is therefore read by
  :mod:`ledgerlake.sources.csv_records`, which splits quoted CSV as well (``parallel`` says so for any file).
  ``multi_line=False`` states that a file has one record a line: it is then split over tasks, and a CSV record that is
  broken by a newline raises instead of being read as two. JSON documents are one task a file, JSON lines are split.
* Schema inference costs a full extra pass over the input; pass ``schema=`` (the typed entities have one) to skip it,
  and ``row_tags=`` to skip the pass that finds the record tags of generic XML.
"""

from __future__ import annotations

import re
from pathlib import PurePath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.columns import col
from ledgerlake.sources import csv_records, json_variant
from ledgerlake.sources.xml_tags import record_tags

# File extensions the loaders accept (lower case).
SUPPORTED_EXTENSIONS = (".csv", ".json", ".xml")

ATTRIBUTE_PREFIX = "@"
VALUE_TAG = "_VALUE"


def load_csv(spark: SparkSession, path: str, *, header: bool = True, infer_schema: bool = True,
             schema: T.StructType | None = None, multi_line: bool = True,
             mode: str | None = None, enforce_schema: bool = True, parallel: bool | None = None) -> DataFrame:
    """CSV with a header row. Quoted newlines belong to their field, and a doubled quote
    inside a quoted field is an escaped quote. An unquoted empty field is NULL.
    ``multi_line=False``: one record a line, read in parallel; anything else raises.
    ``mode``: PERMISSIVE, or FAILFAST with ``multi_line=False``, unless given. A ``schema`` applies by
    position; ``enforce_schema=False`` raises where a header has other names. ``parallel``: whether files with
    quoted newlines are split, by default those larger than an input split (not where ``schema`` or ``mode`` asks
    for what only Spark's reader does)."""
    if multi_line and header and schema is None and mode is None:
        if parallel is None:
            parallel = largest_file(spark, path)[0] > split_bytes(spark)
        if parallel:
            return csv_records.read_csv(spark, path, infer_schema=infer_schema)
    reader = (spark.read.option("header", header).option("escape", '"').option("multiLine", multi_line)
              .option("mode", mode or ("PERMISSIVE" if multi_line else "FAILFAST"))
              .option("enforceSchema", enforce_schema))
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    return reader.csv(path)


def largest_file(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes of the largest file under ``path``, and the number of files; from the listing."""
    found = spark.read.format("binaryFile").load(path).agg(F.max("length"), F.count("*")).first()
    return int(found[0] or 0), int(found[1])


def split_bytes(spark: SparkSession) -> int:
    """Bytes of an input split: the most that one task reads of a file that can be split."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    return int(number) * 1024 ** " kmgt".index(unit or " ")


def load_csv_by_name(spark: SparkSession, path: str, *, schema: T.StructType | None = None, infer_schema: bool = True,
                     reject: str | None = None, parallel: bool | None = None) -> DataFrame:
    """CSV files with headers, strictly by the names in them: see :func:`ledgerlake.sources.csv_records.read_csv`.

    ``parallel``: whether files are split; by default where one is larger than a split, or where there are several, whose
    headers may differ.
    """
    if parallel is None:
        size, files = largest_file(spark, path)
        parallel = files != 1 or size > split_bytes(spark)
    names = [] if parallel else load_csv(spark, path, infer_schema=False, parallel=False).columns
    if not names:
        return csv_records.read_csv(spark, path, schema=schema, infer_schema=infer_schema, reject=reject)
    wanted = names if schema is None else schema.fieldNames()
    csv_records.check_names(path, names, wanted)
    kinds = {} if schema is None else {f.name: f.dataType for f in schema.fields}
    if schema is None and infer_schema:
        kinds = {f.name: f.dataType for f in load_csv(spark, path, parallel=False).schema.fields}
    fields = [T.StructField(n, kinds.get(n, T.StringType())) for n in names]
    marked = [T.StructField(reject, T.StringType())] if reject else []
    df = (spark.read.option("header", True).option("escape", '"').option("multiLine", True)
          .option("columnNameOfCorruptRecord", reject or csv_records.CORRUPT)
          .schema(T.StructType(fields + marked)).csv(path))
    return df.select(*[col(n) for n in wanted + [reject] * bool(reject)])


def load_json(spark: SparkSession, path: str, *, multi_line: bool = True,
              schema: T.StructType | None = None, as_text: bool = False, variant: bool = False) -> DataFrame:
    """A JSON document or array of objects per file (``multi_line``), or JSON lines.
    Inferred columns come out in alphabetical order. ``as_text``: plain values stay text. ``variant``: without a
    schema, the text is read once, see :mod:`ledgerlake.sources.json_variant`."""
    if variant and schema is None:
        return json_variant.read_json(spark, path, multi_line=multi_line, as_text=as_text)
    reader = spark.read.option("multiLine", multi_line).option("primitivesAsString", as_text)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def _xml_reader(spark: SparkSession, row_tag: str, schema: T.StructType | None = None):
    reader = (spark.read.format("xml").option("rowTag", row_tag)
              .option("attributePrefix", ATTRIBUTE_PREFIX).option("inferSchema", False))
    return reader.schema(schema) if schema is not None else reader


def load_xml(spark: SparkSession, path: str, row_tag: str = "product",
             schema: T.StructType | None = None) -> DataFrame:
    """Typed XML: every ``row_tag`` element is a record, each child tag a text column
    (a repeated child keeps its last value, attributes are ignored, a child with
    children contributes only its own text). Empty elements become NULL. With ``schema``
    the records are read in one pass, into its columns and types."""
    df = _xml_reader(spark, row_tag, schema).load(path)
    if schema is not None:
        return _strings_null_if_empty(df)
    cols = [_element_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
            for f in df.schema.fields if not f.name.startswith(ATTRIBUTE_PREFIX) and f.name != VALUE_TAG]
    return df.select(*cols)


def _strings_null_if_empty(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.nullif(F.col(f"`{f.name}`"), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def _flatten_record(df: DataFrame) -> DataFrame:
    """One record per row: attributes become columns (a child element of the same
    name wins), repeated children keep the last one, nested children become a
    one-level JSON object string."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    children = {n for n in fields if not n.startswith(ATTRIBUTE_PREFIX)}

    def value(name: str):
        col, dtype = F.col(f"`{name}`"), fields[name]
        if isinstance(dtype, T.ArrayType):
            col, dtype = F.element_at(col, -1), dtype.elementType
        if isinstance(dtype, T.StructType):
            return _one_level_json(col, dtype)
        return col.cast("string")

    cols = []
    for name in fields:
        if name.startswith(ATTRIBUTE_PREFIX):
            plain = name[len(ATTRIBUTE_PREFIX):]
            if plain not in children:
                cols.append(value(name).alias(plain))
        elif ATTRIBUTE_PREFIX + name in fields:
            # per record: the child element (even an empty one) wins over the attribute
            cols.append(F.coalesce(value(name), value(ATTRIBUTE_PREFIX + name)).alias(name))
        else:
            cols.append(value(name).alias(name))
    return df.select(*cols)


def _element_text(col, dtype: T.DataType):
    """Text of a (possibly repeated) child element: the last repeat, the element's
    own text when it has children or attributes, else the value itself."""
    if isinstance(dtype, T.ArrayType):
        col, dtype = F.element_at(col, -1), dtype.elementType
    if isinstance(dtype, T.StructType):
        names = [f.name for f in dtype.fields]
        text = col.getField(VALUE_TAG).cast("string") if VALUE_TAG in names else F.lit(None).cast("string")
    else:
        text = col.cast("string")
    return F.nullif(text, F.lit(""))  # an empty element has no text


def _one_level_json(col, dtype: T.StructType):
    """A nested child as a one-level JSON object: child tag -> text (NULL kept),
    attributes of the nested element left out."""
    parts = [_element_text(col.getField(f.name), f.dataType).alias(f.name)
             for f in dtype.fields if not f.name.startswith(ATTRIBUTE_PREFIX) and f.name != VALUE_TAG]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def load_xml_dynamic(spark: SparkSession, path: str, row_tags: list[str] | None = None,
                     root_tag: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Generic XML: every direct child of a document's root is a record (one read per
    record tag, unioned by name); columns in name order. Documents may have different
    roots; ``root_tag`` takes the children of that root only. ``row_tags`` names the
    record tags (no pass to find them), ``schema`` the records' fields (no inference).
    Zero records raise ``ValueError``."""
    tags = row_tags or record_tags(spark, path, root_tag)
    if not tags:
        raise ValueError(f"{PurePath(path).name}: the root element has no children")
    parts = [_strings_null_if_empty(_flatten_record(_xml_reader(spark, t, schema).load(path))) for t in tags]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select(*[F.col(f"`{c}`") for c in sorted(out.columns)])  # records as name -> value: sorted names


def file_extension(path: str) -> str:
    """Lower-cased extension with the dot, e.g. ``.csv``."""
    return PurePath(path).suffix.lower()


def load_text_columns(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """CSV or JSON by its own header or field names, every plain value as text.

    CSV reads the header only; several files must have the same one, others raise. JSON has no header, so its field
    names come from the records, in the one pass that reads them.
    """
    if file_extension(path) == ".json":
        return load_json(spark, path, multi_line=multi_line, as_text=True, variant=True)
    df = load_csv(spark, path, infer_schema=False, multi_line=multi_line)
    if len(df.inputFiles()) > 1:
        df = load_csv(spark, path, schema=df.schema, multi_line=multi_line, enforce_schema=False)
    return df


def load_file(spark: SparkSession, path: str, *, multi_line: bool = True, schema: T.StructType | None = None,
              row_tags: list[str] | None = None, root_tag: str | None = None) -> DataFrame:
    """Dispatch on the lower-cased extension; unknown extensions raise ``ValueError``.

    ``multi_line=False``: the file has one record a line (CSV without quoted newlines,
    JSON lines) and is split over tasks. With ``schema`` nothing is inferred.
    ``row_tags`` and ``root_tag``: see :func:`load_xml_dynamic`.
    """
    ext = file_extension(path)
    if ext == ".csv":
        return load_csv(spark, path, multi_line=multi_line, schema=schema)
    if ext == ".json":
        return load_json(spark, path, multi_line=multi_line, schema=schema, variant=True)
    if ext == ".xml":
        return load_xml_dynamic(spark, path, row_tags, root_tag, schema)
    raise ValueError(f"no loader for files of type {ext or 'none'}: {PurePath(path).name}")
