"""Approximate nearest neighbours by learned partitions.

A bounded sample (``sample_rows``, default 4096 in expectation, by a hash of the id) is fitted: its neighbour graph is
cut into balanced partitions (median splits along principal axes, then moves that keep more neighbours together while
no partition outgrows its share), and a small classifier learns each vector's distribution of neighbours over the
partitions. The classifier puts every row of the table into its likeliest partition, and sends a query to the most
probable ones; how many is set on held-back sample rows, so that ``target_recall`` of their neighbours is reached. All
rows of those partitions are candidates and are ranked by their exact distance.

Partitions meet their queries in blocks of bounded size (salted by the id), so no partition makes a large task. A
query also gets further partitions until they hold ``min_candidates`` rows, so small tables are searched whole.

Defined results: rows with a null id, and vectors that are null, zero, of another length than the commonest one, or
hold a null or non-finite component take no part. Ties go to the smaller id. Rows that repeat an id are candidates of
their own, but one query (the smallest vector), and no candidate for it. With fewer candidates than k all are
returned. An empty table gives an empty table. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import durable

SAMPLE_ROWS = 4096
BLOCK_ROWS = 20_000
QUERY_ROWS = 20_000


@dataclass
class Router:
    """A classifier with one hidden layer over standardised vectors."""

    mean: np.ndarray
    scale: float
    layers: list[np.ndarray]
    probes: int = 1

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return _softmax(np.maximum((x - self.mean) / self.scale @ w1 + b1, 0) @ w2 + b2)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each row."""
    norms = (x * x).sum(axis=1)
    out = []
    for at in range(0, len(x), 512):
        d = norms[None, :] - 2 * x[at:at + 512] @ x.T
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        out.append(np.argpartition(d, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def balanced_partitions(x: np.ndarray, near: np.ndarray, parts: int, slack: float = 0.1, rounds: int = 20) -> np.ndarray:
    """Partition of each row: the neighbour graph cut into ``parts`` of nearly equal size with few edges cut."""
    label = np.zeros(len(x), np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:  # halve the largest at the median of its main axis
        rows = groups.pop(int(np.argmax([len(g) for g in groups])))
        centred = x[rows] - x[rows].mean(axis=0)
        axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = rows[np.argsort(centred @ axis, kind="stable")]
        groups += [order[:len(order) // 2], order[len(order) // 2:]]
    for k, rows in enumerate(groups):
        label[rows] = k
    most = int(np.ceil(len(x) / parts * (1 + slack)))
    a = np.repeat(np.arange(len(x)), near.shape[1])
    a, b = np.concatenate([a, near.ravel()]), np.concatenate([near.ravel(), a])  # both directions
    for _ in range(rounds):
        kept = np.zeros((len(x), parts))
        np.add.at(kept, (a, label[b]), 1)
        best = kept.argmax(axis=1)
        gain = kept[np.arange(len(x)), best] - kept[np.arange(len(x)), label]
        sizes, moved = np.bincount(label, minlength=parts), 0
        for row in np.argsort(-gain, kind="stable")[:np.count_nonzero(gain > 0)]:
            if sizes[best[row]] < most:
                sizes[label[row]] -= 1
                sizes[best[row]] += 1
                label[row] = best[row]
                moved += 1
        if not moved:
            break
    return label


def train_router(x: np.ndarray, targets: np.ndarray, hidden: int = 128, epochs: int = 60, seed: int = 5) -> Router:
    """The classifier for soft targets, by Adam on mini-batches."""
    rng = np.random.default_rng(seed)
    router = Router(x.mean(axis=0), float(x.std()) or 1.0, [])
    z = (x - router.mean) / router.scale
    sizes = [(z.shape[1], hidden), (hidden, targets.shape[1])]
    w = router.layers = [v for a, b in sizes for v in (rng.normal(0, (2 / a) ** 0.5, (a, b)), np.zeros(b))]
    m, v, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for epoch in range(epochs):
        rate = 0.003 * (1 - epoch / epochs)
        order = rng.permutation(len(z))
        for at in range(0, len(z), 128):
            rows = order[at:at + 128]
            h = np.maximum(z[rows] @ w[0] + w[1], 0)
            gap = (_softmax(h @ w[2] + w[3]) - targets[rows]) / len(rows)
            back = gap @ w[2].T * (h > 0)
            step += 1
            for k, g in enumerate((z[rows].T @ back, back.sum(axis=0), h.T @ gap, gap.sum(axis=0))):
                g = g + 1e-4 * w[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return router


def fit_router(sample: np.ndarray, parts: int, k: int, target_recall: float) -> Router:
    """The router of a sample; a fifth of it, held back, sets the number of probes."""
    x = np.unique(sample, axis=0)
    x = x[np.random.default_rng(3).permutation(len(x))]
    parts = max(1, min(parts, len(x) // (4 * k)))
    if parts == 1:
        return Router(x[:1].sum(axis=0), 1.0, [np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)])
    near = neighbours(x, k)
    label = balanced_partitions(x, near, parts)
    targets = np.zeros((len(x), parts))
    np.add.at(targets, (np.arange(len(x))[:, None], label[near]), 1 / k)
    learn = len(x) - len(x) // 5
    router = train_router(x[:learn], targets[:learn])
    p = router.probabilities(x)
    assigned, order = p.argmax(axis=1), np.argsort(-p[learn:], axis=1)
    rank = np.argsort(order, axis=1)  # of each partition for each held-back row
    found = np.take_along_axis(rank, assigned[near[learn:]], axis=1)
    recall = [(found < r).mean() for r in range(1, parts + 1)]
    router.probes = 1 + next(r for r, x in enumerate(recall) if x >= target_recall or r == parts - 1)
    return router


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    slim = rows.select(rows[id_col].alias("vec_id"), rows[vector_col].alias("v")).filter("vec_id IS NOT NULL")
    finite: Column = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = slim.filter(F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    common = good.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return good.filter(F.size("v") == (common["size"] if common else 0))


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def top_k(queries: np.ndarray, query_ids: np.ndarray, base: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple]:
    """(query's place, places of its k nearest in ``base``, distances), ties to the smaller id, own id left out.

    Matrix products select all rows that can be among the k nearest; those are ranked by direct differences.
    """
    norms = (base * base).sum(axis=1)
    for at in range(0, len(queries), 64):
        part = queries[at:at + 64]
        size = (part * part).sum(axis=1)[:, None]
        d = size + norms[None, :] - 2 * part @ base.T
        d[query_ids[at:at + 64, None] == ids[None, :]] = np.inf
        slack = 1e-9 * (size[:, 0] + norms.max())
        limit = (np.partition(d, k - 1, axis=1)[:, k - 1] if k < d.shape[1] else np.full(len(d), np.inf)) + slack
        for row in range(len(part)):
            near = np.flatnonzero((d[row] <= limit[row]) & np.isfinite(d[row]))
            exact = np.sqrt(((base[near] - part[row]) ** 2).sum(axis=1))
            order = np.lexsort((ids[near], exact))[:k]
            yield at + row, near[order], exact[order]


def nearest(rows: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
            parts: int = 32, target_recall: float = 0.97, min_candidates: int = 2000, sample_rows: int = SAMPLE_ROWS,
            block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found, by Euclidean distance, of the rows where ``queries`` holds
    (a condition on vec_id), among all others."""
    spark = rows.sparkSession
    vectors = valid_vectors(rows, id_col, vector_col)
    total = vectors.count()
    out = "query_id bigint, vec_id bigint, score double"
    if not total:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    chosen = F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * min(1, sample_rows / total))
    sample = np.array([r["v"] for r in vectors.filter(chosen).select("v").limit(2 * sample_rows).collect()], np.float64)
    size = vectors.select(F.size("v")).first()[0]
    router = fit_router(sample.reshape(-1, size), parts, k, target_recall) if len(sample) else fit_router(
        np.ones((1, size)), 1, k, target_recall)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                part = router.probabilities(_matrix(batch.column("v"), size)).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32())], ["vec_id", "v", "part"])

    kind = vectors.schema["v"].dataType.simpleString()
    index = durable(vectors.mapInArrow(assign, f"vec_id bigint, v {kind}, part int"), "ann-index")
    held = {r["part"]: r["count"] for r in index.groupBy("part").count().collect()}  # a row a partition
    counts = np.array([held.get(p, 0) for p in range(router.layers[3].size)])
    blocks = {p: -(-n // block_rows) for p, n in held.items()}

    asked = index.filter(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    chunks = max(1, -(-index.filter(queries).count() // query_rows))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                order = np.argsort(-router.probabilities(_matrix(batch.column("v"), size)), axis=1, kind="stable")
                before = np.cumsum(counts[order], axis=1) - counts[order]
                take = (np.arange(order.shape[1]) < router.probes) | (before < min_candidates + 1)
                places = [[f"{p}:{b}" for p in order[i][take[i]] for b in range(blocks.get(p, 0))]
                          for i in range(len(order))]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.list_(pa.string()))],
                                                 ["vec_id", "v", "places"])

    routed = asked.mapInArrow(route, f"vec_id bigint, v {kind}, places array<string>")
    chunk = F.pmod(F.xxhash64("vec_id", F.lit("chunk")), F.lit(chunks)).cast("int")
    left = routed.select("vec_id", "v", F.explode("places").alias("place"), chunk.alias("chunk"))
    sizes = F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair])
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.element_at(sizes, F.col("part")))
    right = index.select("vec_id", "v", F.concat_ws(":", "part", block).alias("place"),
                         F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))

    def rank(q: pa.Table, b: pa.Table) -> pa.Table:
        found: list[list] = [[], [], []]
        if q.num_rows and b.num_rows:
            query_ids, ids = q.column("vec_id").to_numpy(), b.column("vec_id").to_numpy()
            base = _matrix(b.column("v"), size)
            for at, near, score in top_k(_matrix(q.column("v"), size), query_ids, base, ids, k):
                found[0] += [query_ids[at]] * len(near)
                found[1] += ids[near].tolist()
                found[2] += score.tolist()
        return pa.table([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()),
                         pa.array(found[2], pa.float64())], ["query_id", "vec_id", "score"])

    ranked = left.groupBy("place", "chunk").cogroup(right.groupBy("place", "chunk")).applyInArrow(rank, out)
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return ranked.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
