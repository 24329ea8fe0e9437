"""Source catalog: which input files exist, and picking one by name.

The listing is Spark's ``binaryFile`` source with only ``path``, ``length`` and
``modificationTime`` selected, so file contents are never read; it works on any
Hadoop-compatible file system and the listing itself is distributed for large
directories.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.files import SUPPORTED_EXTENSIONS

NAMES_SHOWN = 20  # in an error message
CATALOG_COLUMNS = ("name", "extension", "type", "size", "modified", "path")


def list_input_files(spark: SparkSession, directory: str,
                     extensions: tuple[str, ...] = SUPPORTED_EXTENSIONS) -> DataFrame:
    """Supported files directly inside ``directory`` (not in sub-directories), no
    ``~$`` temporary files, sorted by lower-cased name.

    Columns: name, extension (".csv"), type ("CSV"), size (bytes), modified, path.
    """
    raw = spark.read.format("binaryFile").load(directory).select("path", "length", "modificationTime")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    ext = F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))
    listed = raw.select(
        name.alias("name"), ext.alias("extension"),
        F.upper(F.regexp_replace(ext, r"^\.", "")).alias("type"),
        F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "path",
        F.regexp_replace(F.regexp_extract("path", r"^(.*)/[^/]+$", 1), _SCHEME, "").alias("_parent"),
    )
    top = _top_level_parent(directory)
    return (
        listed.filter(F.col("extension").isin(*extensions))
        .filter(~F.col("name").startswith("~$"))
        .filter(F.col("_parent") == top)
        .drop("_parent")
        .orderBy(F.lower("name"), "name")
    )


_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?"


def _top_level_parent(directory: str) -> str:
    """The directory's path without scheme and authority, as the listed files'
    parent paths are compared (``hdfs://nn/data/in`` -> ``/data/in``)."""
    d = directory.rstrip("/")
    if re.match(_SCHEME, d):
        d = re.sub(_SCHEME, "", d)
    else:
        d = os.path.abspath(d)
    return d.rstrip("/") or "/"


def find_selected_file(catalog: DataFrame, selected: str | None = None) -> dict:
    """The catalog row for ``selected`` (base name, case-insensitive), or the first
    in sort order when nothing is selected. Raises ``FileNotFoundError``, with the first
    names that there are, when there is no match or the catalog is empty.

    Only file metadata is collected, never contents.
    """
    if selected is None:
        first = catalog.limit(1).collect()
        if not first:
            raise FileNotFoundError("the input directory holds no file that can be loaded")
        return first[0].asDict()
    base = selected.replace("\\", "/").rsplit("/", 1)[-1]
    hit = catalog.filter(F.lower("name") == base.lower()).limit(1).collect()
    if hit:
        return hit[0].asDict()
    known = [r["name"] for r in catalog.select("name").limit(NAMES_SHOWN + 1).collect()]
    shown = ", ".join(known[:NAMES_SHOWN]) + (", ..." if len(known) > NAMES_SHOWN else "")
    raise FileNotFoundError(f"no input file is named {base!r}; there are: {shown or 'none'}")


def list_processed_datasets(spark: SparkSession, processed_dir: str) -> dict[str, str]:
    """Processed datasets under ``processed_dir``: ``{"<stem>_processed.csv": directory}``,
    sorted by lower-cased name. A processed CSV is the directory Spark wrote it as
    (part files inside); only the distinct directories are collected, never data."""
    dirs = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(processed_dir)
            .select(F.regexp_extract("path", r"^(.*/[^/]+_processed\.csv)/[^/]+$", 1).alias("dir"))
            .filter(F.col("dir") != "").distinct().collect())
    found = {r["dir"].rsplit("/", 1)[-1]: r["dir"] for r in dirs}
    return {k: found[k] for k in sorted(found, key=str.lower)}
