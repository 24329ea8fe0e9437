"""Name rules: column names, table names, clustering columns.

These work on metadata (``df.columns``, file names) on the driver; renaming a
DataFrame with ``toDF`` is a projection and starts no job.
"""

from __future__ import annotations

import itertools
import re
from pathlib import PurePath

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SEPARATORS = re.compile(r"[\W_]+", re.ASCII)

# Preferred clustering columns, in priority order, at most two chosen.
CLUSTERING_PRIORITY = (
    "customer_id", "product_id", "order_id", "region", "category",
    "country", "city", "state", "segment",
)
MAX_CLUSTERING_COLUMNS = 2
PROCESSED_SUFFIX = "_processed"


def _identifier(text: str, fallback: str) -> str:
    """``text`` with every run of characters other than ASCII letters and digits as one ``_``, none at the ends.

    Nothing left gives ``fallback``; a leading digit gets a prefix in front.
    """
    name = "_".join(part for part in _SEPARATORS.split(text.lower()) if part)
    return name or fallback


def _not_numeric(name: str, prefix: str) -> str:
    return f"{prefix}_{name}" if name[0].isdigit() else name


def normalize_column_name(name: object) -> str:
    """``Ship Mode!`` -> ``ship_mode``, ``%`` -> ``column``, ``2nd try`` -> ``column_2nd_try``."""
    return _not_numeric(_identifier(str(name), "column"), "column")


def normalized(name: Column) -> Column:
    """:func:`normalize_column_name` for names that are data, such as the keys of a map."""
    joined = F.regexp_replace(F.regexp_replace(F.lower(name), r"[^a-z0-9]+", "_"), "^_|_$", "")
    return (F.when(joined == "", F.lit("column")).when(F.regexp_like(joined, F.lit("^[0-9]")),
                                                       F.concat(F.lit("column_"), joined)).otherwise(joined))


def unique_names(names: list[str]) -> list[str]:
    """Normalised names, made unique: repeats of ``a`` are numbered from ``a_2`` on, past names that are taken."""
    bases = [normalize_column_name(n) for n in names]
    numbers: dict[str, itertools.count] = {}
    given: dict[str, None] = {}  # in order
    for base in bases:
        if base in given:
            later = numbers.setdefault(base, itertools.count(2))
            base = next(c for c in (f"{base}_{n}" for n in later) if c not in given)
        given[base] = None
    return list(given)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every top-level column by :func:`unique_names` (metadata only)."""
    return df.toDF(*unique_names(df.columns))


def normalize_table_name(file_name: str) -> str:
    """Target table of a processed file: ``Web Visits (May)_processed.csv`` -> ``web_visits_may``, ``7.csv`` ->
    ``table_7``, a name without letters or digits -> ``dataset``."""
    stem = PurePath(file_name).stem.removesuffix(PROCESSED_SUFFIX)
    return _not_numeric(_identifier(stem, "dataset"), "table")


def processed_file_name(source_name: str) -> str:
    """``visits.json`` -> ``visits_processed.csv``."""
    return f"{PurePath(source_name).stem}{PROCESSED_SUFFIX}.csv"


def choose_clustering_columns(columns: list[str]) -> list[str]:
    """Up to two columns from :data:`CLUSTERING_PRIORITY` that exist, in priority order."""
    present = set(columns)
    return [c for c in CLUSTERING_PRIORITY if c in present][:MAX_CLUSTERING_COLUMNS]
