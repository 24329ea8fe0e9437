"""Exact dedup by two-pass Bloom filtering, with DataFrame and SQL functions only.

Pass 1 sets four bits of a blocked Bloom filter for every row's text hash and keeps the bits that two or more rows
set. Pass 2 looks up every row: if one of its bits was set once only, no other row has its text and the row passes
straight through, without a shuffle. Only the rest (rows of repeated texts, and a few by chance) is grouped by
SHA-256.

The filter has 16 bits a row and at most ``max_filter_bits`` (default 2**28: 32 MB), which bounds the broadcast. Above
2**28 / 16 rows its false-positive rate rises from 0.24 % towards 1; the result stays exact, and what then moves
beyond the repeated rows is a digest of some 50 bytes a row (in :func:`keep_one_copy` the row itself).

Defined results: a null text counts as empty. Rows with a null id count in their group; the row that stays is one with
an id, and if the group has none, keep_id is null and its rows are all kept, as nothing names one of them. Rows that
repeat both id and text are one document and share its decision; :func:`keep_one_copy` keeps one row of these too. An empty table gives an empty table. Other columns
are neither read nor changed, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import durable, lookup

BITS_A_ROW = 16
BLOCK_BITS = 32768  # the bits that one value of bitmap_construct_agg holds
MAX_FILTER_BITS = 1 << 28
PROBES = 4


def _keys(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(docs[text_col], F.lit(""))
    return [docs[id_col].alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("sha"), F.xxhash64(text).alias("hash")]


def _positions() -> list[Column]:
    bits = F.xxhash64("hash")  # 60 more hash bits, equal for equal texts
    return [F.shiftrightunsigned(bits, 15 * k).bitwiseAND(F.lit(BLOCK_BITS - 1)) for k in range(PROBES)]


def filter_blocks(rows: int, max_filter_bits: int = MAX_FILTER_BITS) -> int:
    """Blocks of the filter for a number of rows."""
    return max(1, min(-(-rows * BITS_A_ROW // BLOCK_BITS), max_filter_bits // BLOCK_BITS))


def bit_filter(keys: DataFrame, blocks: int, least: int = 2) -> DataFrame:
    """Pass 1: (block, bitmap), the bits that ``least`` or more rows set by their ``hash``."""
    bits = keys.select(F.pmod("hash", F.lit(blocks)).alias("block"),
                       F.explode(F.array_distinct(F.array(*_positions()))).alias("bit"))
    kept = bits.groupBy("block", "bit").count().filter(F.col("count") >= least)
    return kept.repartition("block").groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def mark_found(keys: DataFrame, bitmaps: DataFrame, blocks: int) -> DataFrame:
    """Pass 2: ``keys`` with ``again``, false where the filter lacks a bit of the ``hash``."""
    found = F.col("bitmap").isNotNull()
    for bit in _positions():
        byte = F.substring("bitmap", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))
        found = found & (F.bit_get(F.conv(F.hex(byte), 16, 10).cast("int"), bit.bitwiseAND(F.lit(7)).cast("int")) == 1)
    probed = keys.withColumn("block", F.pmod("hash", F.lit(blocks))).join(F.broadcast(bitmaps), "block", "left")
    return probed.select(*keys.columns, F.coalesce(found, F.lit(False)).alias("again"))


def _groups(docs: DataFrame, id_col: str, text_col: str, max_filter_bits: int):
    """The keys with their marks, the groups of marked rows and the number of rows."""
    keys = durable(docs.select(*_keys(docs, id_col, text_col)), "dedup-keys")
    rows = keys.count()
    blocks = filter_blocks(rows, max_filter_bits)
    bitmaps = durable(bit_filter(keys, blocks), "dedup-filter")
    marked = mark_found(keys, bitmaps, blocks)
    groups = (marked.filter("again").groupBy("sha")
              .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    return marked, durable(groups, "dedup-groups"), rows


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """A row a document: doc_id, keep_id (the largest id of its group), group_size, kept, text_sha256."""
    marked, groups, rows = _groups(docs, id_col, text_col, max_filter_bits)
    once = marked.filter("NOT again").select("doc_id", "sha", F.col("doc_id").alias("keep_id"),
                                             F.lit(1).cast("long").alias("group_size"))
    again = lookup(marked.filter("again").select("doc_id", "sha"), groups, "sha", "group_size", rows)
    return once.unionByName(again).select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"),
                                          F.lower(F.hex("sha")).alias("text_sha256"))


def keep_one_copy(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """``docs`` with one row of each text: one with the largest id, or without an id if none has one. Whole rows, their
    own columns; of rows with that id the last one as JSON text.

    Rows that the filter clears stay in their partition. The others are reduced to one a text in each task before they
    move, so a group of copies is no hot key.
    """
    keys = durable(docs.select(*_keys(docs, id_col, text_col)), "dedup-keys")
    blocks = filter_blocks(keys.count(), max_filter_bits)
    bitmaps = durable(bit_filter(keys, blocks), "dedup-filter")
    whole = docs.select(F.struct(*docs.columns).alias("row"), *_keys(docs, id_col, text_col))
    marked = mark_found(whole, bitmaps, blocks)
    best = F.max_by("row", F.struct("doc_id", F.to_json("row")))  # nulls are the smallest
    survivors = marked.filter("again").groupBy("sha").agg(best.alias("row"))
    return marked.filter("NOT again").select("row.*").unionByName(survivors.select("row.*"))


def one_row_an_id(docs: DataFrame, ids: DataFrame, drop: DataFrame, id_col: str,
                  max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """``docs`` without the rows whose id is in ``drop`` and with one row of each other id in ``ids`` (both doc_id,
    distinct, ``drop`` part of ``ids``); whole rows without ``id_col``.

    As in :func:`without_ids`, rows that a filter of the ids clears stay in their partition. The others are reduced to
    one an id before they move.
    """
    hashed = F.xxhash64(F.col("doc_id")).alias("hash")
    blocks = filter_blocks(ids.count(), max_filter_bits)
    bitmaps = durable(bit_filter(ids.select(hashed), blocks, least=1), "ids-filter")
    own = [c for c in docs.columns if c != id_col]
    whole = docs.select(F.struct(*own).alias("row"), docs[id_col].alias("doc_id")).select("*", hashed)
    marked = mark_found(whole, bitmaps, blocks)
    listed = marked.filter("again").groupBy("doc_id").agg(F.min_by("row", F.to_json("row")).alias("row"))
    rest = listed.join(drop.select("doc_id"), "doc_id", "left_anti")
    return marked.filter("NOT again").select("row.*").unionByName(rest.select("row.*"))


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id",
                max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """``docs`` without the rows whose id is in ``ids`` (doc_id, distinct, not null): whole rows, their own columns.

    Rows that a filter of the ids clears stay in their partition; only the rest meets the ids in a shuffle.
    """
    hashed = F.xxhash64(F.col("doc_id")).alias("hash")
    blocks = filter_blocks(ids.count(), max_filter_bits)
    bitmaps = durable(bit_filter(ids.select(hashed), blocks, least=1), "ids-filter")
    whole = docs.select(F.struct(*docs.columns).alias("row"), docs[id_col].alias("doc_id")).select("*", hashed)
    marked = mark_found(whole, bitmaps, blocks)
    rest = marked.filter("again").join(ids.select("doc_id"), "doc_id", "left_anti")
    return marked.filter("NOT again").select("row.*").unionByName(rest.select("row.*"))
