"""Column helpers for arbitrary (raw, un-normalised) schemas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quote(name: str) -> str:
    """Back-tick quote a raw column name (dots, spaces, back-ticks are safe)."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """The top-level column called ``name``, whatever characters it contains."""
    return F.col(quote(name))


def has_map(dtype: T.DataType) -> bool:
    """True if the type is or contains a MAP (not comparable, not hashable in Spark)."""
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.StructType):
        return any(has_map(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return has_map(dtype.elementType)
    return False


def comparable(df, name: str) -> Column:
    """A column usable in DISTINCT / GROUP BY: map-typed values become JSON text."""
    return F.to_json(col(name)) if has_map(df.schema[name].dataType) else col(name)
