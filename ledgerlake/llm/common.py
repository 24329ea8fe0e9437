"""Helpers shared by the operators: durable intermediate tables, skew-safe lookups, word splitting."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import ledgerlake.llm
from ledgerlake.session import ensure_checkpoint_dir

# Functions of this package travel to the workers by value, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(ledgerlake.llm)

#: A key is hot if it holds more than 1/HOT_PARTS of all rows; by counting there are fewer than HOT_PARTS such keys.
HOT_PARTS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given Parquet table."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def durable(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the cluster's shared checkpoint folder and read back.

    Cuts the lineage: a lost executor costs no recomputation of ``df``, and a nondeterministic input order
    cannot change rows between two uses.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lookup(rows: DataFrame, keyed: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``keyed`` (one row a key), safe for keys that hold a large share of ``rows``.

    ``weight`` names the column of ``keyed`` with the number of ``rows`` a key has, ``total`` is their sum. Keys over
    ``total / HOT_PARTS`` rows are fewer than HOT_PARTS, whatever the data: only those are broadcast, and their rows
    stay where they are. All other keys meet in a shuffle in which no key has more than 1/HOT_PARTS of the rows.
    """
    # rounded up to a power of two, so that plans of one shape share their generated code
    is_hot = F.col(weight) > F.lit(1 << (max(total, 1) // HOT_PARTS).bit_length())
    hot = keyed.filter(is_hot)
    stay = rows.join(F.broadcast(hot), key)
    move = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(keyed.filter(~is_hot), key)
    return stay.unionByName(move)


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words (runs of other bytes than 0x20 and 0x09-0x0D) of a text, A-Z in lower case, in lists of bounded size."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + size)
        while end < n and data[end] not in b" \t\n\v\f\r":
            end += 1
        if words := data[at:end].lower().split():
            yield words
        at = end
