"""JSON without an inference pass: the text is read once, into VARIANT values, and its types follow from these.

Spark's JSON reader without a schema reads the input twice, once for the types. Here each record becomes a VARIANT, the
records are written to the shared checkpoint folder, and the merged type of all of them is an aggregate of that write
(``observe``). Columns are then cast from the written values. The types are those of Spark's inference: fields in order of
their names, whole numbers BIGINT, others DOUBLE, and text for a field whose values have different types, which keeps
every value (an object or array as JSON text; a number with an exponent in Java's form).

A document is one VARIANT, so of at most ``MAX_DOCUMENT`` bytes; larger documents go to Spark's own reader, with its
pass for the types. JSON lines have that limit by line, and are split over tasks.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.session import ensure_checkpoint_dir

#: Bytes of a document that become one VARIANT; Spark's own limit is 16 MiB.
MAX_DOCUMENT = 16 * 1024 * 1024 - 1
CORRUPT = "_corrupt_record"


def _records(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """(v, corrupt): each record as a VARIANT, or the text that is none."""
    if multi_line:
        documents = spark.read.option("singleVariantColumn", "v").option("multiLine", True).json(path)
        items = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array("v"))
        return documents.select(F.explode(items).alias("v"), F.lit(None).cast("string").alias("corrupt"))
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select(F.try_parse_json("value").alias("v"), "value")
    return parsed.select("v", F.when(F.col("v").isNull(), F.col("value")).alias("corrupt"))


def variant_type(found: str) -> str:
    """A type as ``schema_of_variant_agg`` gives it, as the type of a column."""
    parts = re.split(r"(`(?:[^`]|``)*`)", found)  # quoted field names stay as they are
    for k in range(0, len(parts), 2):
        text = re.sub(r"\bDECIMAL\((\d+),\s*0\)", r"DECIMAL(\1,0)", parts[k])
        text = re.sub(r"\bDECIMAL\(\d+,\s*[1-9]\d*\)|\bFLOAT\b(?!:)", "DOUBLE", text)
        text = re.sub(r"(^|: |<)(?:VOID|VARIANT)(?=$|,|>)", r"\1STRING", text)
        parts[k] = re.sub(r"(^|: |<)OBJECT<", r"\1STRUCT<", re.sub(r"(^|: |<)OBJECT<>", r"\1STRING", text))
    return "".join(parts)


def _cast(v: Column, kind: T.DataType) -> Column:
    return F.try_variant_get(v, "$", kind.simpleString() if not isinstance(kind, T.StructType) else _ddl(kind))


def _ddl(kind: T.StructType) -> str:
    fields = ", ".join(f"`{f.name.replace('`', '``')}`: "
                       + (_ddl(f.dataType) if isinstance(f.dataType, T.StructType) else _nested(f.dataType))
                       for f in kind.fields)
    return f"struct<{fields}>"


def _nested(kind: T.DataType) -> str:
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        return f"array<{_ddl(inner) if isinstance(inner, T.StructType) else _nested(inner)}>"
    return kind.simpleString()


def read_json(spark: SparkSession, path: str, *, multi_line: bool = True,
              as_text: bool = False) -> DataFrame:
    """The records of JSON documents (an object or an array of objects a file), or of JSON lines, with the columns that
    Spark's reader would infer. ``as_text``: plain values stay text.

    Records that are no JSON, or no objects, come as a row of nulls with their text in ``_corrupt_record``, a column that
    exists only if there are any.
    """
    if multi_line:
        largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0
        if largest > MAX_DOCUMENT:
            return spark.read.option("multiLine", True).option("primitivesAsString", as_text).json(path)
    seen = Observation()
    records = _records(spark, path, multi_line)
    object_type = F.schema_of_variant("v").startswith("OBJECT<")
    records = records.select(F.when(object_type, F.col("v")).alias("v"),
                             F.when(~F.coalesce(object_type, F.lit(False)), F.coalesce("corrupt", F.to_json("v")))
                             .alias("corrupt"))
    at = f"{ensure_checkpoint_dir(spark).rstrip('/')}/json-{uuid.uuid4().hex}"
    records.observe(seen, F.schema_of_variant_agg("v").alias("kind"), F.count("corrupt").alias("corrupt"),
                    F.count("v").alias("objects")).write.parquet(at)
    written = spark.read.schema(records.schema).parquet(at)
    found = seen.get
    corrupt = [F.col("corrupt").alias(CORRUPT)] if found["corrupt"] else []
    kind = variant_type(found["kind"]) if found["objects"] else "STRING"
    if kind == "STRING":  # no field in any record
        return written.select(*corrupt)
    fields = T.DataType.fromDDL(kind).fields
    if as_text:
        fields = [T.StructField(f.name, _texts(f.dataType)) for f in fields]
    whole = _cast(F.col("v"), T.StructType(fields)).alias("x")
    out = written.select(whole, *corrupt)
    return out.select(*[F.col(CORRUPT)] * bool(corrupt), *[F.col("x").getField(f.name).alias(f.name) for f in fields])


def _texts(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _texts(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_texts(kind.elementType))
    return T.StringType()
