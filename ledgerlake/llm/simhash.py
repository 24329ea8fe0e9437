"""SimHash near-duplicates by pigeonring filtering.

A 64-bit fingerprint is cut into a ring of m = 5 segments. If two fingerprints differ in at most t = 2 bits, some
segment starts a chain in which any first l segments differ in at most floor(l * t / m) bits together (the strong form
of the pigeonring principle): 0, 0, 1, 1, 2. So the first two segments of the chain are equal and key a bucket, and
the sums over the first three, four and five are checked in turn, the last being the full Hamming check. Only distinct
fingerprints enter, so copies of a text never meet each other.

Buckets of more than ``bucket_limit`` fingerprints are not compared pair by pair. Their members (all of them, once for
all buckets) are linked exactly and in linear work: x and y differ in at most two bits if and only if some z differs
in at most one bit from either, so every member offers itself and its 64 one-bit changes, and those that offer the
same z (65 at most) are linked. The result does not depend on the limit.

Components come from alternating large-star and small-star steps, each written to the shared checkpoint folder.

Defined results: a null text counts as empty; a text without words has fingerprint zero and is linked like any other.
Rows with a null id take part and get their component's smallest id, null if it has none. Repeated rows give equal
rows. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import durable, lookup, word_blocks
from ledgerlake.llm.exact_dedup import one_row_an_id, without_ids

SEGMENTS = (13, 13, 13, 13, 12)
MAX_DISTANCE = 2
SHINGLE_WORDS = 3
HASH_SEED = 42
BUCKET_LIMIT = 128
MAX_ROUNDS = 60


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a UTF-8 text as a signed 64-bit integer; equal weights for all shingles, repeats included."""
    ones, shingles, carry = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for block in word_blocks(text):
        carry += block
        hashes = [digest(b" ".join(x), HASH_SEED) for x in zip(*(carry[k:] for k in range(words)), strict=False)]
        if hashes:
            bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            shingles += len(hashes)
            carry = carry[len(carry) - words + 1:]
    if not shingles and carry:
        return int(np.uint64(digest(b" ".join(carry), HASH_SEED)).view(np.int64))
    bits = np.packbits(2 * ones > shingles, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of every row, the fingerprint as a signed long."""
    slim = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(x.as_py(), words) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, fp bigint")


def _mask(start: int, count: int, segments: tuple[int, ...]) -> int:
    """The bits of ``count`` segments from ``start`` on around the ring, as a signed long."""
    mask = 0
    for k in range(start, start + count):
        k %= len(segments)
        mask |= ((1 << segments[k]) - 1) << sum(segments[:k])
    return mask - (1 << 64) if mask >> 63 else mask


def chain_budgets(segments: tuple[int, ...], distance: int) -> list[int]:
    """Most differing bits over the first 1, 2, ... segments of a chain."""
    return [(k + 1) * distance // len(segments) for k in range(len(segments))]


def buckets(nodes: DataFrame, segments: tuple[int, ...], distance: int) -> DataFrame:
    """(start, key, fp): a fingerprint under each of its chains' equal first segments."""
    budgets = chain_budgets(segments, distance)
    equal = sum(b == 0 for b in budgets)
    if not equal:
        raise ValueError("more segments than the distance are needed")
    keys = [F.struct(F.lit(i).alias("start"),
                     F.col("fp").bitwiseAND(F.lit(_mask(i, equal, segments))).alias("key")) for i in range(len(segments))]
    return nodes.select(F.explode(F.array(*keys)).alias("b"), "fp").select("b.start", "b.key", "fp")


def pigeonring_links(small: DataFrame, segments: tuple[int, ...], distance: int) -> DataFrame:
    """Links (u < v) between members of the same bucket that pass every check along the chain."""
    budgets = chain_budgets(segments, distance)
    a, b = small.alias("a"), small.alias("b")
    differ = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    joined = a.join(b, (F.col("a.start") == F.col("b.start")) & (F.col("a.key") == F.col("b.key"))
                    & (F.col("a.fp") < F.col("b.fp")) & (F.bit_count(differ) <= distance)
                    & _chain(differ, budgets, segments))
    return joined.select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))


def _chain(differ, budgets: list[int], segments: tuple[int, ...]):
    """For each start of a chain: the cumulative differences are within the budgets."""
    ok = F.lit(False)
    for start in range(len(segments)):
        fits = F.col("a.start") == start
        for count in range(1, len(segments)):
            if budgets[count - 1]:
                part = differ.bitwiseAND(F.lit(_mask(start, count, segments)))
                fits = fits & (F.bit_count(part) <= budgets[count - 1])
        ok = ok | fits
    return ok


def midpoint_links(nodes: DataFrame, distance: int) -> DataFrame:
    """Links (u < v) that join exactly the components of distinct ``nodes`` (fp), in work linear in their number.

    Two bits: fingerprints that offer the same z (65 at most) are linked to the smallest of them. One bit: a
    fingerprint is linked to those of its one-bit changes that are nodes.
    """
    if distance > 2:
        raise ValueError("one-bit changes cover up to two differing bits")
    changes = [F.col("fp").bitwiseXOR(F.lit(1 << k if k < 63 else -(1 << 63))) for k in range(64 if distance else 0)]
    if distance < 2:
        near = nodes.select(F.col("fp").alias("u"), F.explode(F.array(F.col("fp"), *changes)).alias("v"))
        return near.filter("u < v").join(nodes.select(F.col("fp").alias("v")), "v", "left_semi").select("u", "v")
    offers = nodes.select("fp", F.explode(F.array(F.col("fp"), *changes)).alias("z"))
    groups = offers.groupBy("z").agg(F.collect_list("fp").alias("all")).filter("size(all) > 1")
    return groups.select(F.array_min("all").alias("u"), F.explode("all").alias("v")).filter("u < v").distinct()


def links(nodes: DataFrame, segments: tuple[int, ...] = SEGMENTS, distance: int = MAX_DISTANCE,
          bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (u < v) among distinct fingerprints ``nodes`` (fp) that give all components at ``distance`` bits."""
    placed = buckets(nodes, segments, distance)
    sizes = placed.groupBy("start", "key").count().filter("count > 1")
    sizes = durable(sizes, "simhash-buckets")
    small = placed.join(sizes.filter(F.col("count") <= bucket_limit).select("start", "key"), ["start", "key"])
    large = sizes.filter(F.col("count") > bucket_limit).select("start", "key")
    members = durable(placed.join(large, ["start", "key"], "left_semi").select("fp").distinct(), "simhash-members")
    small = durable(small, "simhash-small")
    return pigeonring_links(small, segments, distance).unionByName(midpoint_links(members, distance)).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the smallest node of the component.

    Large-star and small-star steps alternate until every component is a star: O(log**2 n) rounds at most.
    """
    edges = durable(edges.select("u", "v").filter("u <> v"), "components")
    rounds = 0
    while not _is_settled(edges):
        if (rounds := rounds + 1) > MAX_ROUNDS:
            raise RuntimeError("components did not settle")
        total = 2 * edges.count()
        edges = durable(_star(edges, total, large=True), "components")
        edges = durable(_star(edges, total, large=False), "components")
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
        edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def _is_settled(edges: DataFrame) -> bool:
    """Whether the links are stars whose centres are their smallest nodes: u < v, each v once, no u a v as well."""
    wrong = edges.filter("u > v").select("v")
    twice = edges.groupBy("v").count().filter("count > 1").select("v")
    inner = edges.select("v").distinct().join(edges.select(F.col("u").alias("v")), "v", "left_semi")
    return wrong.unionByName(twice).unionByName(inner).isEmpty()


def _star(edges: DataFrame, total: int, large: bool) -> DataFrame:
    """One star step: neighbours of a node (larger ones; or it and the smaller ones) move to the smallest of all.

    ``total``: at least the rows of ``edges`` in both directions, by which a node counts as a hub.
    """
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    rows = both if large else both.filter("v < u")
    least = rows.groupBy("u").agg(F.min("v").alias("least"), F.count("*").alias("n"))
    if large:
        least = least.withColumn("least", F.least("u", "least"))
    least = durable(least, "components-least")
    met = lookup(rows, least, "u", "n", total)
    if large:
        moved = met.filter("v > u").select(F.col("least").alias("u"), "v")
    else:
        moved = met.select(F.col("least").alias("u"), "v").unionByName(
            least.select(F.col("least").alias("u"), F.col("u").alias("v")))
    return moved.filter("u < v").distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                       segments: tuple[int, ...] = SEGMENTS, distance: int = MAX_DISTANCE,
                       bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """A row a document: doc_id, fingerprint (16 hex digits), component_id (the smallest id that links reach)."""
    fps = durable(fingerprints(docs, id_col, text_col, words), "simhash-fingerprints")
    nodes = durable(fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "simhash-nodes")
    total = fps.count()
    roots = durable(components(links(nodes.select("fp"), segments, distance, bucket_limit)), "simhash-roots")
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp")
    least = durable(linked.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("members")),
                    "simhash-least")
    named = lookup(linked.select("fp", "n", "root"), least, "root", "members", max(1, roots.count()))
    alone = nodes.join(roots.select(F.col("node").alias("fp")), "fp", "left_anti")
    ids = durable(named.select("fp", "n", "component_id").unionByName(
        alone.select("fp", "n", F.col("first").alias("component_id"))), "simhash-ids")
    return lookup(fps, ids, "fp", "n", max(1, total)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_near_copy(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; whole rows, their own columns.

    Rows with a null id stay, as nothing names one of them.
    """
    found = durable(simhash_components(docs, id_col, text_col, **options), "simhash-found")
    drop = durable(found.filter("doc_id <> component_id").select("doc_id").distinct(), "simhash-drop")
    return without_ids(docs, drop, id_col)


def keep_one_row(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest id; whole rows, their own columns.

    Rows are told apart by id and text hash: texts under one id are decided each on its own, of rows equal in both one
    stays, and of a component without ids one row. Ids come before none.
    """
    name = "_id_and_text"
    while name in docs.columns:
        name += "_"
    key = F.struct(docs[id_col].isNull().alias("missing"), docs[id_col].alias("id"),
                   F.xxhash64(F.coalesce(docs[text_col], F.lit(""))).alias("hash"))
    keyed = docs.withColumn(name, key)
    found = durable(simhash_components(keyed, name, text_col, **options).select("doc_id", "component_id"),
                    "simhash-found")
    ids = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_or(F.col("doc_id") != F.col("component_id"))
                                      .alias("leaves")).filter("n > 1 OR leaves")
    ids = durable(ids, "simhash-drop")
    return one_row_an_id(keyed, ids, ids.filter("leaves"), name)
