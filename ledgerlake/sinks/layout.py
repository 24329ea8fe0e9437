"""Physical layouts beyond a range order: an interleaved (Z-order) key, and buckets for joins without a shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.columns import col, has_map
from ledgerlake.sinks import warehouse as W

#: Bits of a column's rank, and rows from which the ranks' bounds are taken: bounds only place rows in files.
RANK_BITS = 8
SAMPLE_ROWS = 20_000


def quantile_bounds(df: DataFrame, columns: list[str], sample_rows: int = SAMPLE_ROWS,
                    bits: int = RANK_BITS) -> dict[str, list]:
    """For each column at most ``2**bits - 1`` different values that part its values into about equal ranks.

    Taken from the ``sample_rows`` rows with the smallest hashes, so a run on the same files gives the same bounds.
    """
    hashable = [col(f.name) for f in df.schema.fields if not has_map(f.dataType)]
    place = F.xxhash64(*hashable, F.monotonically_increasing_id())
    sample = df.select(*[col(c) for c in columns], place.alias("_place")).orderBy("_place").limit(sample_rows)
    rows = sample.drop("_place").collect()
    bounds = {}
    for k, c in enumerate(columns):
        values = sorted(r[k] for r in rows if r[k] is not None)
        n = 1 << bits
        bounds[c] = sorted({values[len(values) * j // n] for j in range(1, n)}) if values else []
    return bounds


def _rank(value: Column, bounds: list) -> Column:
    """The number of bounds up to a value, by halving; null is first."""
    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(bounds[middle]), within(low, middle)).otherwise(within(middle + 1, high))
    return F.when(value.isNull(), F.lit(0)).otherwise(within(0, len(bounds)))


def z_key(columns: list[str], bounds: dict[str, list], bits: int = RANK_BITS) -> Column:
    """The ranks of the columns with their bits interleaved, the highest first: rows near in all columns are near."""
    key = F.lit(0).cast("long")
    for k, c in enumerate(columns):
        rank = _rank(col(c), bounds[c]).cast("long")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(bit, b * len(columns) + len(columns) - 1 - k))
    return key


def z_ordered(df: DataFrame, columns: list[str], num_partitions: int | None = None, bits: int = RANK_BITS) -> DataFrame:
    """Range-partitioned and sorted by the interleaved key of ``columns``: a filter on any of them prunes files.

    As in :func:`ledgerlake.sinks.warehouse.clustered`, a hash of the row cuts a hot key over several partitions.
    """
    if len(columns) < 2:
        return W.clustered(df, columns, num_partitions)
    key = z_key(columns, quantile_bounds(df, columns, bits=bits), bits)
    hashable = [col(f.name) for f in df.schema.fields if not has_map(f.dataType)]
    by = [key, F.xxhash64(*hashable)]
    ranged = df.repartitionByRange(num_partitions, *by) if num_partitions else df.repartitionByRange(*by)
    return ranged.sortWithinPartitions(key, *[col(c) for c in columns])


def hottest_share(df: DataFrame, columns: list[str]) -> float:
    """The share of the rows that the most frequent key holds."""
    counts = df.groupBy(*[col(c) for c in columns]).count().agg(F.max("count"), F.sum("count")).first()
    return counts[0] / counts[1] if counts[1] else 0.0


def load_bucketed(spark: SparkSession, df: DataFrame, table: str, location: str, bucket_by: list[str], buckets: int,
                  most: float = 2.0) -> dict:
    """Writes ``df`` as the new or replaced table ``table`` in ``buckets`` files by a hash of ``bucket_by``, each sorted.

    Tables with the same number of buckets by the columns of a join meet without a shuffle, and an aggregate by these
    columns needs none either. A bucket is one task, here and in every such join, so a key with more than ``most`` times
    a bucket's fair share of the rows raises ``ValueError``: such a table is better off in :func:`warehouse.load_table`.
    """
    share = hottest_share(df, bucket_by)
    if share * buckets > max(most, 1.0) and share > 1 / buckets:
        raise ValueError(f"{table}: one value of {', '.join(bucket_by)} holds {share:.0%} of the rows, too many for one of "
                         f"{buckets} buckets")
    folder = f"{location.rstrip('/')}/load-{uuid.uuid4().hex}"
    before = W.table_location(spark, table) if spark.catalog.tableExists(table) else None
    (df.repartition(buckets, *[col(c) for c in bucket_by]).write.format("parquet").bucketBy(buckets, *bucket_by)
     .sortBy(*bucket_by).option("path", folder).mode("overwrite").saveAsTable(table))
    if before and before.rstrip("/") != folder:
        W.delete_folder(spark, before)
    return {"table": table, "location": folder, "bucket_by": bucket_by, "buckets": buckets, "hottest_share": share}
