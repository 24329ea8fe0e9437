"""Warehouse sink: truncate-and-load tables, layout, verification.

A table is a Parquet table in the session catalog with an explicit location:

* new tables are partitioned by the load date (``_ingest_date``) and written in a
  clustered layout: range-partitioned and sorted on up to two clustering columns
  (:func:`ledgerlake.functions.naming.choose_clustering_columns`), recorded as the
  table property ``ledgerlake.clustering``;
* reloading an existing table keeps its partition and clustering columns;
* every load replaces the whole table (truncate semantics);
* the loaded row count comes from an ``observe()`` metric of the write itself and is
  checked against the files written.

A load is staged, then swapped: the rows are written to a new folder below the table's
location, the count is checked, the table's location is moved to that folder, and the
files of the load before go last. A load that fails at any step before the swap leaves
the old rows, layout and properties as they were. As nothing is written over, a plan
may read the table that it reloads. Transactional formats (``delta``, ``iceberg``)
replace the rows by a commit of their own.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.naming import choose_clustering_columns
from ledgerlake.functions.columns import col, has_map, quote

INGEST_DATE = "_ingest_date"
CLUSTERING_PROPERTY = "ledgerlake.clustering"
ORDER_PROPERTY = "ledgerlake.clustering.order"
RECORD_PROPERTY = "ledgerlake.content"
REJECTED = "_rejected"
SCHEMA_FOLDER = "_schema"
TARGET_FILE_BYTES = 512 * 1024 * 1024
TRANSACTIONAL = ("delta", "iceberg")


def save_as_csv(df: DataFrame, out_dir: str, single_file: bool = False) -> str:
    """Write ``df`` as CSV with a header into ``out_dir`` (replaced), with its schema as
    JSON in the hidden folder ``_schema``. NULL is written as an empty field; struct,
    array and map values (which CSV cannot hold) as JSON text. One file only on request
    (``single_file`` funnels all rows through one task, so keep it for small outputs)."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    flat = df.select(*[F.to_json(col(f.name)).alias(f.name) if isinstance(f.dataType, nested) else col(f.name)
                       for f in df.schema.fields])
    out = flat.coalesce(1) if single_file else flat
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(out_dir)
    df.sparkSession.createDataFrame([(flat.schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{out_dir.rstrip('/')}/{SCHEMA_FOLDER}")
    return out_dir


def saved_schema(spark: SparkSession, csv_dir: str) -> T.StructType | None:
    """The schema stored by :func:`save_as_csv`, or None."""
    path = f"{csv_dir.rstrip('/')}/{SCHEMA_FOLDER}"
    try:
        text = spark.read.text(path).first()
    except AnalysisException:  # no such folder
        return None
    return T.StructType.fromJson(json.loads(text["value"])) if text else None


def clustered(df: DataFrame, columns: list[str], num_partitions: int | None = None) -> DataFrame:
    """Range-partition and sort within partitions on ``columns`` (no-op when empty).

    Range bounds come from a sample. A range bound cannot fall inside one key, so
    a hash of the whole row is the last range column: a key holding a third of all
    rows is cut into as many partitions as its share of the sample asks for,
    instead of landing in one task. The hash is deterministic, so a retried task
    gets the same rows. Files stay sorted on ``columns``.
    """
    if not columns:
        return df
    cols = [F.col(f"`{c}`") for c in columns]
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if not has_map(f.dataType)]
    spread = F.xxhash64(*hashable) if hashable else F.lit(0)
    if num_partitions:
        ranged = df.repartitionByRange(num_partitions, *cols, spread)
    else:
        ranged = df.repartitionByRange(*cols, spread)
    return ranged.sortWithinPartitions(*cols)


def table_layout(spark: SparkSession, table: str) -> dict | None:
    """Partition and clustering columns of an existing table, or None."""
    if not spark.catalog.tableExists(table):
        return None
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES `{table}`").collect()}
    raw = props.get(CLUSTERING_PROPERTY, "")
    return {"partition_by": parts, "clustering": [c for c in raw.split(",") if c]}


def z_ordered_table(spark: SparkSession, table: str) -> bool:
    """Whether a table's files are laid out by an interleaved key."""
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES `{table}`").collect()}
    return props.get(ORDER_PROPERTY) == "z"


def files_for(size_bytes: int, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Number of files for an input of that size."""
    return max(1, -(-size_bytes // target_bytes))


class RejectedRows(ValueError):
    """A load has more rejected records than it may have; the table is as it was, the records are in ``table``."""

    def __init__(self, name: str, rows: int, table: str) -> None:
        super().__init__(f"{name}: {rows} records were rejected, see table {table}")
        self.rows, self.table = rows, table


def rejects_table(table: str) -> str:
    """Where the rejected records of a table's last load are."""
    return f"{table}__rejects"


def stage(spark: SparkSession, df: DataFrame, folder: str, partition_by: list[str], clustering: list[str],
          num_files: int | None = None, table_format: str = "parquet", reject: str | None = None,
          z_order: bool = False, max_rejects: int | None = None) -> dict:
    """Writes ``df`` to the new folder ``folder`` in the layout of a table.

    ``reject`` names a text column of ``df`` that holds a record which is none (see
    :func:`ledgerlake.sources.csv_records.read_csv`), else null. Such rows are written first, by themselves, below the same
    folder, and are no part of the table; if they are more than ``max_rejects``, the others are neither moved nor written.
    ``z_order``: files by the interleaved key of the clustering columns instead of their order, see
    :mod:`ledgerlake.sinks.layout`. The numbers of both are metrics of the writes; the good ones are checked
    against the files, and their fingerprint (:mod:`ledgerlake.sinks.content`) is taken. Returns ``rows`` (the written
    rows), ``location``, ``rows_loaded``, ``rows_rejected``, ``rejects`` (their folder), ``clustering`` and ``record``.
    """
    from ledgerlake.sinks import content, layout
    dated = df.withColumn(INGEST_DATE, F.current_date()) if INGEST_DATE in partition_by else df
    cluster = [c for c in clustering if c in df.columns and c != reject]
    at, rejected, kept = folder, 0, dated
    if reject:
        at, beside = f"{folder}/{REJECTED}=false", f"{folder}/{REJECTED}=true"
        seen = Observation()
        (dated.filter(col(reject).isNotNull()).observe(seen, F.count(F.lit(1)).alias("rows"))
         .write.format(table_format).partitionBy(*partition_by).save(beside))
        rejected, kept = int(seen.get["rows"]), dated.filter(col(reject).isNull()).drop(reject)
        if not rejected:
            delete_folder(spark, beside)
    said = {"location": at, "rows_rejected": rejected, "clustering": cluster,
            "rejects": f"{folder}/{REJECTED}=true" if rejected else None, "reject": reject}
    if max_rejects is not None and rejected > max_rejects:
        return said | {"rows": spark.createDataFrame([], kept.schema), "rows_loaded": 0, "record": None}
    seen = Observation()
    out = (layout.z_ordered if z_order else clustered)(kept, cluster, num_files)
    own = [c for c in df.columns if c != reject]
    out.observe(seen, *content.metrics(out, own)).write.format(table_format).partitionBy(*partition_by).save(at)
    rows = int(seen.get["fp_rows"])
    written = spark.read.format(table_format).schema(kept.schema).load(at) if rows or not reject else (
        spark.createDataFrame([], kept.schema))
    if (found := written.count()) != rows:
        raise RuntimeError(f"{rows} rows were written to {at}, {found} are there")
    return said | {"rows": written, "rows_loaded": rows,
                   "record": content.record(kept, partition_by, cluster, content.fingerprint(seen.get))}


def keep_rejects(spark: SparkSession, table: str, staged: dict, max_rejects: int = 0) -> None:
    """Keeps the rejected records of a staged load as a view; raises if they are more than ``max_rejects``. A load
    without any removes those of the load before."""
    name = rejects_table(table)
    if not staged["rows_rejected"]:
        if staged["reject"]:
            spark.sql(f"DROP VIEW IF EXISTS {quote(name)}")
        return
    spark.sql(f"CREATE OR REPLACE VIEW {quote(name)} AS SELECT {quote(staged['reject'])} AS record, {INGEST_DATE} "
              f"FROM parquet.`{staged['rejects']}`" if INGEST_DATE in staged["rows"].columns else
              f"CREATE OR REPLACE VIEW {quote(name)} AS SELECT {quote(staged['reject'])} AS record "
              f"FROM parquet.`{staged['rejects']}`")
    if staged["rows_rejected"] > max_rejects:
        delete_folder(spark, staged["location"])  # of rows that are not loaded only the rejected ones stay
        raise RejectedRows(table, staged["rows_rejected"], name)


def load_table(spark: SparkSession, df: DataFrame, table: str, location: str,
               clustering: list[str] | None = None, table_format: str = "parquet",
               num_files: int | None = None, reject: str | None = None, max_rejects: int = 0,
               z_order: bool | None = None) -> dict:
    """Replace table ``table`` (stored at ``location``) with ``df``.

    ``num_files``: range partitions (files per load date) of the clustered layout, see
    :func:`files_for`; by default Spark's shuffle partition count. ``reject``: see :func:`stage`;
    more than ``max_rejects`` such records raise ``RejectedRows`` before the table changes. ``z_order``:
    files by the interleaved key of the clustering columns, kept on reload.

    Returns ``{"table", "location", "rows_loaded", "rows_rejected", "partition_by", "clustering",
    "created"}``; ``location`` is the folder that holds the rows.
    """
    layout = table_layout(spark, table)
    created = layout is None
    if created:
        partition_by = [INGEST_DATE]
        names = [c for c in df.columns if c != reject]
        cluster = list(clustering) if clustering is not None else choose_clustering_columns(names)
    else:
        partition_by = layout["partition_by"]
        cluster = layout["clustering"]

    if table_format in TRANSACTIONAL:
        if reject:
            raise ValueError(f"rejects are kept beside Parquet tables only, not {table_format}")
        cluster = [c for c in cluster if c in df.columns]
        dated = df.withColumn(INGEST_DATE, F.current_date()) if INGEST_DATE in partition_by else df
        obs = Observation(f"load_{table}")
        out = clustered(dated, cluster, num_files).observe(obs, F.count(F.lit(1)).alias("rows"))
        (out.write.format(table_format).partitionBy(*partition_by).mode("overwrite").option("path", location)
         .saveAsTable(table))
        at, rows, rejected = location, int(obs.get["rows"]), 0
    else:
        folder = f"{location.rstrip('/')}/load-{uuid.uuid4().hex}"
        z_order = z_ordered_table(spark, table) if z_order is None and not created else bool(z_order)
        staged = stage(spark, df, folder, partition_by, cluster, num_files, table_format, reject, z_order,
                       max_rejects)
        keep_rejects(spark, table, staged, max_rejects)
        at, rows, rejected, cluster = (staged[k] for k in ("location", "rows_loaded", "rows_rejected", "clustering"))
        before = None if created else table_location(spark, table)
        _point_at(spark, table, at, staged["rows"], partition_by, table_format, created)
        if before and before.rstrip("/") != at:
            _delete_load(spark, load_folder(before), keep=load_folder(at))
    said = {CLUSTERING_PROPERTY: ",".join(cluster)}
    if table_format not in TRANSACTIONAL:
        said |= {RECORD_PROPERTY: staged["record"], ORDER_PROPERTY: "z" if z_order else "linear"}
    spark.sql(f"ALTER TABLE `{table}` SET TBLPROPERTIES ({properties(said)})")
    return {"table": table, "location": at, "rows_loaded": rows, "rows_rejected": rejected,
            "partition_by": partition_by, "clustering": cluster, "created": created}


def properties(values: dict[str, str]) -> str:
    """Table properties as SQL."""
    def text(x: str) -> str:
        return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return ", ".join(f"{text(k)} = {text(v)}" for k, v in values.items())


def table_location(spark: SparkSession, table: str) -> str:
    """The folder of a table's rows."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED `{table}`").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _point_at(spark: SparkSession, table: str, at: str, rows: DataFrame, partition_by: list[str], table_format: str,
              create: bool) -> None:
    """Makes ``at`` the table's folder. A table whose columns change is defined anew over it."""
    columns = [f for f in rows.schema.fields if f.name not in partition_by]
    wanted = [(f.name, f.dataType) for f in [*columns, *(rows.schema[c] for c in partition_by)]]
    same = not create and [(f.name, f.dataType) for f in spark.table(table).schema.fields] == wanted
    if same:
        spark.sql(f"ALTER TABLE `{table}` SET LOCATION '{at}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS `{table}`")  # external: its files stay until the new definition stands
        fields = ", ".join(f"{quote(n)} {t.simpleString()}" for n, t in wanted)
        spark.sql(f"CREATE TABLE `{table}` ({fields}) USING {table_format} "
                  + (f"PARTITIONED BY ({', '.join(map(quote, partition_by))}) " if partition_by else "")
                  + f"LOCATION '{at}'")
    if partition_by:
        find_partitions(spark, table)
    spark.catalog.refreshTable(table)


def find_partitions(spark: SparkSession, table: str) -> None:
    """Tells a catalog that tracks partitions those of the table's folder, in place of what it had."""
    try:
        old = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS `{table}`").collect()]  # a row a load date
    except AnalysisException:  # the catalog does not track partitions: they are the folder's
        return
    for spec in old:
        values = ", ".join(f"{quote(k)} = '{v}'" for k, v in (x.split("=", 1) for x in spec.split("/")))
        spark.sql(f"ALTER TABLE `{table}` DROP IF EXISTS PARTITION ({values})")
    spark.sql(f"MSCK REPAIR TABLE `{table}`")


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder, where the session has a file system to ask (Spark Connect has none: the files stay)."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - Spark Connect raises its own kind
        return
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(conf).delete(path, True)


def load_folder(location: str) -> str:
    """The folder of a load: that of its rows, or the one above where rejected records are written beside them."""
    return location.rstrip("/").removesuffix(f"/{REJECTED}=false")


def _delete_load(spark: SparkSession, before: str, keep: str) -> None:
    """Deletes the files of the load before; a folder that also holds ``keep`` loses all else."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(before)
    fs = folder.getFileSystem(conf)
    inside = keep.rstrip("/").split(":", 1)[-1].lstrip("/").startswith(folder.toUri().getPath().strip("/") + "/")
    if not inside:
        fs.delete(folder, True)
        return
    for status in fs.listStatus(folder):
        if status.getPath().getName() != keep.rstrip("/").rsplit("/", 1)[-1]:
            fs.delete(status.getPath(), True)


def read_table(spark: SparkSession, table: str, drop_load_columns: bool = True) -> DataFrame:
    """A loaded table, without the load-date partition column by default."""
    df = spark.table(table)
    return df.drop(INGEST_DATE) if drop_load_columns and INGEST_DATE in df.columns else df


def table_counts(spark: SparkSession, tables: list[str]) -> DataFrame:
    """table_name, total_rows for each catalog table (one small aggregate each)."""
    parts = [spark.table(t).agg(F.count(F.lit(1)).alias("total_rows"))
             .select(F.lit(t).alias("table_name"), "total_rows") for t in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def verify_tables(spark: SparkSession, expected: dict[str, int]) -> DataFrame:
    """Reconciliation: table_name, expected_rows, actual_rows, matches (expected vs
    ``COUNT(*)``; a missing table has NULL actual_rows and does not match)."""
    schema = T.StructType([T.StructField("table_name", T.StringType()),
                           T.StructField("expected_rows", T.LongType())])
    exp = spark.createDataFrame(list(expected.items()), schema)
    present = [t for t in expected if spark.catalog.tableExists(t)]
    if present:
        actual = table_counts(spark, present).withColumnRenamed("total_rows", "actual_rows")
    else:
        actual = spark.createDataFrame([], "table_name string, actual_rows long")
    return exp.join(actual, "table_name", "full").select(
        "table_name", "expected_rows", "actual_rows",
        F.coalesce(F.col("expected_rows") == F.col("actual_rows"), F.lit(False)).alias("matches"),
    ).orderBy("table_name")


def describe_table(spark: SparkSession, table: str) -> dict:
    """Columns and types, partitioning and clustering of a table (metadata only)."""
    layout = table_layout(spark, table) or {}
    cols = [(c.name, c.dataType) for c in spark.catalog.listColumns(table)]
    return {"table": table, "columns": cols, **layout}


def create_or_replace_views(spark: SparkSession, views: dict[str, DataFrame]) -> list[str]:
    """Register each DataFrame as a temporary view (``CREATE OR REPLACE VIEW``)."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
