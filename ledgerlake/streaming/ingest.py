"""Incremental ingestion (extension).

The batch pipeline reprocesses every input file on each run. With Structured
Streaming only files that landed since the last run are read: the file source
remembers what it has processed in the query checkpoint, and
``trigger(availableNow=True)`` processes everything available, then stops, so the
same code runs as a scheduled batch job or continuously.

* The source always has an explicit schema (no inference on a stream). Columns are found by name: a CSV header must have
  the entity's columns in their order, else the batch fails; JSON fields are found by their normalised names.
* Cleaning is the stateless part of the typed cleaners (types, trimming, the
  positive-value filters), applied per micro-batch inside the plan.
* Key de-duplication across runs uses ``dropDuplicatesWithinWatermark`` on the time a
  record arrives (the micro-batch's time), so its state is bounded by the watermark
  instead of growing with every key ever seen. Business dates play no part in it:
  arrival times only grow, so no record is ever late and none is dropped but repeats.
* The checkpoint lives under the cluster's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.entities import ENTITIES, EntitySpec
from ledgerlake.functions.naming import normalized
from ledgerlake.operators import cleaning as C
from ledgerlake.session import ensure_checkpoint_dir


def read_landed(spark: SparkSession, input_dir: str, entity: str, fmt: str = "json",
                multi_line: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the entity's records from files landing in ``input_dir``."""
    spec = ENTITIES[entity]
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "json":
        values = reader.format("json").option("singleVariantColumn", "v").option("multiLine", multi_line).load(input_dir)
        return _fields_by_name(values, spec)
    reader = reader.format(fmt).schema(spec.schema)
    if fmt == "csv":  # a header with other names, or in another order, fails the batch instead of swapping columns
        reader = (reader.option("multiLine", multi_line).option("header", True).option("escape", '"')
                  .option("enforceSchema", False))
    return reader.load(input_dir)


def _fields_by_name(values: DataFrame, spec: EntitySpec) -> DataFrame:
    """The entity's columns of JSON documents (``v``: an object or an array of objects), by normalised field names as in
    the batch path; a field that no record has is null, further ones are left out."""
    items = F.explode(F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array("v")))
    fields = values.select(items.alias("v")).select(F.try_variant_get("v", "$", "map<string, variant>").alias("given"))

    def value(f: T.StructField):
        same = F.map_filter("given", lambda k, _: normalized(k) == F.lit(f.name))
        return F.try_variant_get(F.get(F.map_values(same), 0), "$", "string").alias(f.name)
    return fields.filter("given IS NOT NULL").select(*[value(f) for f in spec.schema.fields])


def clean_stream(stream: DataFrame, entity: str, dedupe_within: str | None = None) -> DataFrame:
    """Stateless typed cleaning; with ``dedupe_within`` (an interval such as ``7 days``),
    a key that arrives again within that time of its first arrival is dropped."""
    spec = ENTITIES[entity]
    df = C.cast_to_entity(C.clean_strings(stream), spec)
    if entity == "customers":
        df = df.select(*[F.lower(F.col(c)).alias(c) if c == "email" else F.col(c) for c in df.columns])
    for c in spec.positive:
        df = df.filter(F.col(c) > 0)
    if dedupe_within:
        arrived = "_arrived"
        df = (df.withColumn(arrived, F.current_timestamp())
              .withWatermark(arrived, dedupe_within)
              .dropDuplicatesWithinWatermark(list(spec.key))
              .drop(arrived))
    return df


def ingest(spark: SparkSession, input_dir: str, entity: str, table_path: str, name: str | None = None,
           fmt: str = "json", dedupe_within: str | None = None,
           checkpoint: str | None = None, available_now: bool = True,
           max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Append newly landed ``entity`` records from ``input_dir`` to the Parquet table
    at ``table_path``. Returns the started query (``awaitTermination()`` it when
    ``available_now``). ``max_files_per_trigger`` bounds each micro-batch, so a large
    backlog is worked off in several batches instead of one."""
    name = name or f"ingest_{entity}"
    if checkpoint is None:
        checkpoint = os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    stream = read_landed(spark, input_dir, entity, fmt, max_files_per_trigger=max_files_per_trigger)
    out = clean_stream(stream, entity, dedupe_within)
    writer = (out.writeStream.format("parquet").option("path", table_path)
              .option("checkpointLocation", checkpoint).queryName(name).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
