"""One pipeline run: load -> profile -> clean -> load table -> profile -> record.

Spark work per run, whatever the number of columns:

1. raw report: one aggregate over the source (schema inference of text formats
   is one more pass unless a schema is given);
2. table load: one write of the cleaned plan; the loaded row count is an
   ``observe()`` metric of that write;
3. processed report: one aggregate over the written table (Parquet, pruned);
4. optional processed CSV: written from the table, not by re-cleaning the source;
5. the run record: one row appended to the ``pipeline_runs`` table.

Nothing is cached: the written table is the durable intermediate, so a lost
executor only re-runs tasks of the current step.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlake.entities import ENTITIES
from ledgerlake.functions.naming import normalize_columns, normalize_table_name, processed_file_name, unique_names
from ledgerlake.operators import cleaning as C
from ledgerlake.operators.quality import generate_quality_report, report_as_dict
from ledgerlake.sinks import warehouse as W
from ledgerlake.sinks.versions import load_version
from ledgerlake.sources.catalog import find_selected_file, list_input_files, list_processed_datasets
from ledgerlake.sources.files import file_extension, load_csv_by_name, load_file, load_text_columns

RUNS_TABLE = "pipeline_runs"
#: The column of records that are none while processed files are loaded.
REJECT = "_rejected_record"

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("processed_file", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
])

TYPED_CLEANERS = {
    "customers": C.clean_customers,
    "orders": C.clean_orders,
    "products": C.clean_products,
}


def clean_for(df: DataFrame, entity: str | None) -> DataFrame:
    """Generic cleaning, or the typed cleaner of ``entity`` (after name
    normalisation and casting to the entity's types; empty strings are kept, as
    the typed cleaners only trim). Columns of the entity that are missing raise
    ``ValueError``; further ones are kept."""
    if entity is None:
        return C.clean_dataframe(df)
    named = normalize_columns(df)
    missing = [c for c in ENTITIES[entity].columns if c not in named.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} for {entity}; found {', '.join(named.columns)}")
    return TYPED_CLEANERS[entity](C.cast_to_entity(_whole_numbers(named, ENTITIES[entity].schema), ENTITIES[entity]))


def _whole_numbers(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text such as ``2.0`` in columns that become whole numbers, which a cast of text refuses, without its fraction."""
    from pyspark.sql import functions as F
    whole = {f.name for f in schema.fields if isinstance(f.dataType, T.LongType)}
    return df.withColumns({
        f.name: F.coalesce(F.col(f.name).try_cast("bigint"), F.col(f.name).try_cast("decimal(38,6)").try_cast("bigint"))
        for f in df.schema.fields if f.name in whole and isinstance(f.dataType, T.StringType)})


def append_run_record(spark: SparkSession, warehouse_root: str, record: dict) -> None:
    """Append one run record to the ``pipeline_runs`` Parquet table."""
    row = {f.name: record.get(f.name) for f in RUN_SCHEMA.fields}
    (spark.createDataFrame([row], RUN_SCHEMA).write.mode("append")
     .parquet(os.path.join(warehouse_root, RUNS_TABLE)))


def read_run_records(spark: SparkSession, warehouse_root: str) -> DataFrame:
    """All run records appended so far."""
    return spark.read.schema(RUN_SCHEMA).parquet(os.path.join(warehouse_root, RUNS_TABLE))


def pipeline_status(spark: SparkSession, warehouse_root: str) -> DataFrame:
    """The latest run record (status of the last run): a top-1 over the run log."""
    from pyspark.sql import functions as F
    return read_run_records(spark, warehouse_root).orderBy(F.desc("started_at"), F.desc("run_id")).limit(1)


def process_dataset(spark: SparkSession, path: str, name: str, warehouse_root: str,
                    processed_dir: str | None = None, entity: str | None = None,
                    num_files: int | None = None, versioned: bool = False, **load_options) -> dict:
    """Load, profile, clean, load into the warehouse and profile one dataset. ``versioned``: into a table of
    :mod:`ledgerlake.sinks.versions`, whose readers see the load at once.

    ``load_options``: ``multi_line``, ``schema``, ``row_tags``, ``root_tag`` of
    :func:`ledgerlake.sources.files.load_file`; a typed run of CSV or JSON reads text by
    header or field names unless a schema is given, so no types are inferred. ``num_files``:
    of the table's clustered layout, by default from the size of the input.
    """
    if entity and load_options.get("schema") is None and file_extension(path) in (".csv", ".json"):
        raw = load_text_columns(spark, path, multi_line=load_options.get("multi_line", True))
        if not raw.columns:  # no header or no record at all
            raw = spark.createDataFrame([], ENTITIES[entity].schema)
    else:
        raw = load_file(spark, path, **load_options)
    return process_frame(spark, raw, name, warehouse_root, processed_dir, entity, num_files or input_files(spark, path),
                         versioned)


def input_files(spark: SparkSession, path: str) -> int:
    """Files of a table made of the input under ``path``, from the sizes in its listing."""
    from pyspark.sql import functions as F
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    return W.files_for(int(size or 0))


def process_frame(spark: SparkSession, raw: DataFrame, name: str, warehouse_root: str,
                  processed_dir: str | None = None, entity: str | None = None, num_files: int | None = None,
                  versioned: bool = False) -> dict:
    """Profile, clean, load into the warehouse and profile a dataset that is read already."""
    raw_report = report_as_dict(generate_quality_report(raw, name))
    cleaned = clean_for(raw, entity)
    processed = processed_file_name(name)
    table = normalize_table_name(processed)
    write = load_version if versioned else W.load_table
    load = write(spark, cleaned, table, os.path.join(warehouse_root, table), num_files=num_files)
    loaded = W.read_table(spark, table)
    processed_report = report_as_dict(generate_quality_report(loaded, f"{name} (processed)"))
    csv_dir = None
    if processed_dir:
        csv_dir = W.save_as_csv(loaded, os.path.join(processed_dir, processed))
    return {"source_file": name, "processed_file": processed, "processed_path": csv_dir,
            "table_name": table, "rows_loaded": load["rows_loaded"], "load": load,
            "raw_report": raw_report, "processed_report": processed_report}


def generic_run_report(spark: SparkSession, raw: DataFrame, name: str, warehouse_root: str) -> DataFrame:
    """A generic run on a dataset that is read already, as rows: the report on the input (stage ``raw``), the rows
    loaded (``load``), and the report on the loaded table (``processed``); check_name, column_name, value, passed."""
    table = normalize_table_name(processed_file_name(name))
    load = W.load_table(spark, clean_for(raw, None), table, os.path.join(warehouse_root, table))
    kept = ["check_name", "column_name", "value", "passed"]
    stages = {"raw": raw, "processed": W.read_table(spark, table)}
    before, after = (generate_quality_report(df, stage).selectExpr(f"'{stage}' AS stage", *kept)
                     for stage, df in stages.items())
    rows = spark.createDataFrame([("load", "rows_loaded", None, load["rows_loaded"], True)], before.schema)
    return before.unionByName(after).unionByName(rows)


def run_pipeline(spark: SparkSession, input_dir: str, warehouse_root: str, selected: str | None = None,
                 processed_dir: str | None = None, entity: str | None = None,
                 num_files: int | None = None, **load_options) -> dict:
    """Run one dataset (``selected`` by name, else the first file) end to end and
    append the run record. Failures are recorded and re-raised. Options: see
    :func:`process_dataset`."""
    record = {"run_id": uuid.uuid4().hex, "started_at": _now(), "status": "running"}
    try:
        chosen = find_selected_file(list_input_files(spark, input_dir), selected)
        record["source_file"] = chosen["name"]
        result = process_dataset(spark, chosen["path"], chosen["name"], warehouse_root, processed_dir, entity,
                                 num_files, **load_options)
        record.update(processed_file=result["processed_file"], table_name=result["table_name"],
                      rows_loaded=result["rows_loaded"], status="success")
    except Exception as e:
        record.update(status="failed", error=f"{type(e).__name__}: {e}", finished_at=_now())
        try:
            append_run_record(spark, warehouse_root, record)
        except Exception as unrecorded:
            e.add_note(f"the run record could not be written either: {unrecorded}")
        raise
    record["finished_at"] = _now()
    append_run_record(spark, warehouse_root, record)
    return {**result, **record}


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def load_all_tables(spark: SparkSession, processed_dir: str, warehouse_root: str, versioned: bool = False) -> DataFrame:
    """Load every ``*_processed.csv`` under ``processed_dir`` into its table, then
    return table_name, total_rows for all of them. Two files mapping to the same
    table name raise ``ValueError`` before anything is loaded.

    The processed CSVs are read by the names in their headers, with the types stored beside them; only one without has
    its types inferred. A missing or unknown column raises ``ValueError``, and a record with another number of fields or
    a value of another type raises ``RejectedRows`` (such records are kept, see
    :func:`ledgerlake.sinks.warehouse.rejects_table`); either leaves the table as it was. ``versioned``: tables of
    :mod:`ledgerlake.sinks.versions`.
    """
    datasets = list_processed_datasets(spark, processed_dir)
    tables: dict[str, str] = {}
    for name in sorted(datasets, key=str.lower):
        t = normalize_table_name(name)
        if t in tables:
            raise ValueError(f"{name} and {tables[t]} both map to table {t}")
        tables[t] = name
    load = load_version if versioned else W.load_table
    for t, name in tables.items():
        df = load_csv_by_name(spark, datasets[name], schema=W.saved_schema(spark, datasets[name]), reject=REJECT)
        named = unique_names([c for c in df.columns if c != REJECT])
        load(spark, df.toDF(*named, *([REJECT] if REJECT in df.columns else [])), t, os.path.join(warehouse_root, t),
             num_files=input_files(spark, datasets[name]), reject=REJECT if REJECT in df.columns else None)
    return W.table_counts(spark, list(tables))


def create_warehouse_views(spark: SparkSession, customers: str = "customers", orders: str = "orders",
                           products: str = "products") -> list[str]:
    """Register the four analytics views (business_summary, customer_analytics,
    sales_analytics, product_analytics) over the loaded warehouse tables."""
    from ledgerlake.operators.analytics import create_analytics_views
    return create_analytics_views(W.read_table(spark, customers), W.read_table(spark, orders),
                                  W.read_table(spark, products))
