"""Quality classifier by Bradley-Terry pairwise ranking.

A document's score is a weighted sum of features of its whole text: shares of characters by kind (single punctuation
marks, capitals, digits, white space, others) and of repeated words and lines. The weights are learnt from preference
pairs (a document labelled 1 over one labelled 0) by logistic loss on feature differences with an L2 penalty, on a
bounded sample of labelled rows (``rows_a_label`` of each label in expectation, by a hash of id and text, equal rows
counting once; default 2000).

The threshold is a quantile of scores: over all labelled rows to learn from, as large a share is below it as is
labelled 0. The score given out is a logistic function that has the value ``cut`` there.

Defined results: a null text counts as empty; an empty text has all features zero and gets the score that follows. A
document labelled both ways teaches nothing. Texts are taken whole, in blocks; equal scores share the threshold's side.
Without both labels to learn from every score is ``cut``. Null ids and repeated rows are scored alike and teach nothing
if null. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import durable, word_blocks

ROWS_A_LABEL = 2000
WINDOW = 64
MARKS = np.frombuffer(string.punctuation.encode(), np.uint8)
GROUPS = [np.frombuffer(x.encode(), np.uint8) for x in (string.ascii_uppercase, string.digits, " ", "\n\r", "\t\v\f")]
FEATURES = 2 * len(MARKS) + len(GROUPS) + 6


def features(text: bytes) -> np.ndarray:
    """The features of a whole UTF-8 text."""
    out = np.zeros(FEATURES)
    size = len(text)
    if not size:
        return out
    share = np.bincount(np.frombuffer(text, np.uint8), minlength=256) / size
    marks = share[MARKS]
    words, windows, distinct, again, letters, last = 0, 0, 0.0, 0, 0, None
    for block in word_blocks(text):
        words += len(block)
        letters += sum(map(len, block))
        again += sum(map(eq, block, block[1:])) + (block[0] == last)
        last = block[-1]
        for at in range(0, len(block), WINDOW):
            part = block[at:at + WINDOW]
            distinct += len(set(part)) / len(part)
            windows += 1
    lines = text.split(b"\n")
    rest = [share[128:].sum(), again / max(words, 1), distinct / max(windows, 1), letters / max(words, 1) / 10,
            len(set(lines)) / len(lines), np.log1p(words) / 10]
    return np.concatenate([np.sqrt(marks), marks * 10, [share[g].sum() for g in GROUPS], rest])


@dataclass
class Ranker:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def score(self, text: bytes) -> float:
        return float((features(text) - self.mean) / self.scale @ self.weights)


def train_pairs(good: np.ndarray, bad: np.ndarray, epochs: int = 200, pairs: int = 2048, l2: float = 1e-3,
                seed: int = 11) -> Ranker:
    """Bradley-Terry weights: P(a over b) = logistic(weights . (a - b)), by Adam over drawn preference pairs."""
    both = np.concatenate([good, bad])
    ranker = Ranker(np.zeros(FEATURES), np.zeros(FEATURES), np.ones(FEATURES))
    if not len(good) or not len(bad):
        return ranker
    ranker.mean, ranker.scale = both.mean(axis=0), np.maximum(both.std(axis=0), 1e-3)
    good, bad = (good - ranker.mean) / ranker.scale, (bad - ranker.mean) / ranker.scale
    rng, w = np.random.default_rng(seed), ranker.weights
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, epochs + 1):
        gap = good[rng.integers(len(good), size=pairs)] - bad[rng.integers(len(bad), size=pairs)]
        g = -gap.T @ (1 / (1 + np.exp(np.clip(gap @ w, -50, 50)))) / pairs + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.03 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return ranker


def clear_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(doc_id, label) of the documents that have one label, 0 or 1."""
    given = labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("int").alias("label")).filter(
        "doc_id IS NOT NULL AND label IN (0, 1)")
    return given.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).filter(
        "label = most").select("doc_id", "label")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).cast("binary").alias("text"))


def fit(texts: DataFrame, learn: DataFrame, rows_a_label: int = ROWS_A_LABEL) -> Ranker:
    """The weights, from ``texts`` (doc_id, text) and the labels ``learn`` (doc_id, label)."""
    # by row, not by id: a row's place follows from its id and text, and equal rows count once
    keyed = texts.withColumn("key", F.xxhash64("doc_id", "text"))
    held = durable(keyed.select("doc_id", "key").join(learn, "doc_id").select("label", "key"), "quality-keys")
    sizes = {r["label"]: r["count"] for r in held.groupBy("label").count().collect()}  # two rows at most
    place = F.pmod(F.xxhash64("key", F.lit("quality sample")), F.lit(1 << 30)) / float(1 << 30)
    wanted = [(F.col("label") == k) & (place < rows_a_label / n) for k, n in sizes.items()]
    if len(wanted) < 2:
        return train_pairs(np.zeros((0, FEATURES)), np.zeros((0, FEATURES)))
    chosen = durable(held.filter(wanted[0] | wanted[1]).distinct(), "quality-sample")  # 2 * rows_a_label rows or so

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(x.as_py()).tolist() for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.list_(pa.float64()))],
                                             ["label", "x"])

    picked = keyed.join(F.broadcast(chosen), "key").groupBy("label", "key").agg(F.first("text").alias("text"))
    rows = picked.select("label", "text").mapInArrow(run, "label int, x array<double>").collect()
    of = lambda k: np.array(sorted(tuple(r["x"]) for r in rows if r["label"] == k)).reshape(-1, FEATURES)
    return train_pairs(of(1), of(0))


def classify(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", cut: float = 0.3, rows_a_label: int = ROWS_A_LABEL) -> DataFrame:
    """A row a document: doc_id, score (0 to 1), predicted (1 from ``cut`` on).

    ``learn`` is a condition on doc_id: the labels to learn from.
    """
    texts = _texts(docs, id_col, text_col)
    known = durable(clear_labels(labels, id_col, label_col).filter(learn), "quality-labels")
    ranker = fit(texts, known, rows_a_label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [ranker.score(x.as_py()) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(raw, pa.float64())], ["doc_id", "raw"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    scored = durable(texts.mapInArrow(run, f"doc_id {kind}, raw double"), "quality-scores")
    labelled = scored.join(known, "doc_id").agg(F.avg(1 - F.col("label")).alias("low"), F.count("*").alias("n"))
    low = labelled.first()["low"]
    at = 0.0
    if low is not None:
        at = scored.join(known, "doc_id").agg(F.percentile_approx("raw", F.lit(float(low)), 100_000)).first()[0]
    odds = float(np.log(cut / (1 - cut)))
    above = F.col("raw") - F.lit(float(at))
    score = F.when(above == 0, F.lit(cut)).otherwise(1 / (1 + F.exp(-(above + F.lit(odds)))))
    return scored.select("doc_id", score.alias("score")).withColumn("predicted", (F.col("score") >= cut).cast("int"))
