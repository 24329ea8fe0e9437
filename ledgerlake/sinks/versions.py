"""Versioned tables: readers see a load at once, whatever it changes, and of two loaders at once one is refused.

A table is a view over its current version. Each version is a catalog table ``<table>__v<number>`` over a folder of its
own that is never written again. A load

1. notes the version it starts from,
2. writes its rows to a new folder, with the counts of good and rejected records as metrics of these writes,
3. defines the next version over the folder. The catalog refuses a name that exists, so of two loaders that started from
   the same version only one passes; the other raises ``ConcurrentLoad`` and changes nothing,
4. points the view at it, by one ``CREATE OR REPLACE VIEW``: a reader finds the old or the new version, never none, also
   when columns change.

No loader starts while a defined version is not yet viewed, so step 4 never sets a table back. If a loader dies between
3 and 4, ``recover`` finishes its commit. All steps are SQL statements and writes; only the deletion of files of versions
out of use needs a file system, and is left out where there is none (Spark Connect).
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ledgerlake.functions.columns import quote
from ledgerlake.functions.naming import choose_clustering_columns
from ledgerlake.sinks import warehouse as W

VERSION_PROPERTY = "ledgerlake.version"


class ConcurrentLoad(RuntimeError):
    """Another loader has changed the table since this load began, or is changing it."""


def version_table(table: str, version: int) -> str:
    """The catalog table of a version."""
    return f"{table}__v{version:06}"


def _property(spark: SparkSession, table: str, key: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {quote(table)}").collect()
    return next((r["value"] for r in rows if r["key"] == key), None)


def versions(spark: SparkSession, table: str) -> list[int]:
    """The versions that are defined, also those that are not viewed."""
    name = re.compile(re.escape(table.lower()) + r"__v(\d+)")
    found = [name.fullmatch(t.name.lower()) for t in spark.catalog.listTables(pattern=f"{table}__v*")]
    return sorted(int(m[1]) for m in found if m)


def current_version(spark: SparkSession, table: str) -> int:
    """The version that readers see; 0 if there is none."""
    if not spark.catalog.tableExists(table):
        return 0
    found = _property(spark, table, VERSION_PROPERTY)
    if found is None:
        raise ValueError(f"{table} exists and is no versioned table")
    return int(found)


def _view(spark: SparkSession, table: str, version: int) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {quote(table)} TBLPROPERTIES ('{VERSION_PROPERTY}' = '{version}') "
              f"AS SELECT * FROM {quote(version_table(table, version))}")


def commit(spark: SparkSession, table: str, folder: str, rows: DataFrame, partition_by: list[str],
           base: int, properties: dict[str, str] | None = None) -> int:
    """Makes the rows in ``folder``, with the columns of ``rows``, the version after ``base``; returns its number."""
    now, newest = current_version(spark, table), max(versions(spark, table), default=0)
    if now != base:
        raise ConcurrentLoad(f"{table}: version {now} was committed since this load began at version {base}")
    if newest > now:
        raise ConcurrentLoad(f"{table}: version {newest} is being committed; recover() finishes it if its loader is gone")
    name = version_table(table, base + 1)
    fields = [*(f for f in rows.schema.fields if f.name not in partition_by), *(rows.schema[c] for c in partition_by)]
    columns = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in fields)
    by = f"PARTITIONED BY ({', '.join(map(quote, partition_by))}) " if partition_by else ""
    extra = W.properties({VERSION_PROPERTY: str(base + 1), **(properties or {})})
    try:
        spark.sql(f"CREATE TABLE {quote(name)} ({columns}) USING parquet {by}LOCATION '{folder}' TBLPROPERTIES ({extra})")
    except AnalysisException as e:
        if "ALREADY_EXISTS" in str(e.getCondition() or e):
            raise ConcurrentLoad(f"{table}: another load committed version {base + 1}") from e
        raise
    if partition_by:
        W.find_partitions(spark, name)
    _view(spark, table, base + 1)
    return base + 1


def recover(spark: SparkSession, table: str) -> int:
    """Finishes the commit of a loader that is gone: the newest version becomes the one that readers see."""
    newest = max(versions(spark, table), default=0)
    if newest > current_version(spark, table):
        name = version_table(table, newest)
        if any(c.isPartition for c in spark.catalog.listColumns(name)):
            W.find_partitions(spark, name)
        _view(spark, table, newest)
    return newest


def load_version(spark: SparkSession, df: DataFrame, table: str, location: str, *, base: int | None = None,
                 clustering: list[str] | None = None, num_files: int | None = None, reject: str | None = None,
                 max_rejects: int = 0, keep: int = 2) -> dict:
    """Replaces the rows of the versioned table ``table``, stored below ``location``, with ``df``.

    ``base``: the version that ``df`` was made from, by default the current one. ``reject``: see
    :func:`ledgerlake.sinks.warehouse.stage`; more than ``max_rejects`` of them raise ``RejectedRows``, and the table
    stays as it was. ``keep``: versions that stay, the new one included. Partition and clustering columns are kept from
    the version before, the latter as far as the columns still exist.
    """
    base = current_version(spark, table) if base is None else base
    if base:
        layout = W.table_layout(spark, version_table(table, base)) or {}
        partition_by, cluster = layout["partition_by"], layout["clustering"]
    else:
        partition_by = [W.INGEST_DATE]
        cluster = choose_clustering_columns([c for c in df.columns if c != reject]) if clustering is None else clustering
    folder = f"{location.rstrip('/')}/load-{uuid.uuid4().hex}"
    done = W.stage(spark, df, folder, partition_by, cluster, num_files, reject=reject, max_rejects=max_rejects)
    W.keep_rejects(spark, table, done, max_rejects)
    version = commit(spark, table, done["location"], done["rows"], partition_by, base,
                     {W.CLUSTERING_PROPERTY: ",".join(done["clustering"]), W.RECORD_PROPERTY: done["record"]})
    retire(spark, table, keep)
    return {"table": table, "version": version, "location": done["location"], "rows_loaded": done["rows_loaded"],
            "rows_rejected": done["rows_rejected"], "partition_by": partition_by, "clustering": done["clustering"],
            "created": base == 0}


def read_version(spark: SparkSession, table: str, version: int) -> DataFrame:
    """A version that is still kept."""
    df = spark.table(version_table(table, version))
    return df.drop(W.INGEST_DATE) if W.INGEST_DATE in df.columns else df


def retire(spark: SparkSession, table: str, keep: int = 2) -> list[int]:
    """Removes all versions but the last ``keep`` up to the current one, with their files."""
    old = [v for v in versions(spark, table) if v <= current_version(spark, table) - max(keep, 1)]
    for v in old:
        name = version_table(table, v)
        folder = W.table_location(spark, name)
        spark.sql(f"DROP TABLE IF EXISTS {quote(name)}")  # external: its files are deleted next
        W.delete_folder(spark, W.load_folder(folder))
    return old
