"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the one- to three-character n-grams of a text (letters in lower case, everything else one space), hashed
to 2**14 buckets, with logarithmic term frequency, inverse document frequency over all training documents, and unit
length. The weights are trained by follow-the-regularised-leader with L1 and L2 penalties on a bounded sample of
labelled rows (``rows_a_language`` of each language in expectation, chosen by a hash of the id; default 600); a fifth
of the sample is held back to calibrate the temperature of the softmax.

Defined results: a null text, or one without any letter, is ``und`` with score 0, and so is every text if there is no
labelled row to learn from. Ties go to the first language in alphabetical order. Repeated rows are scored alike; null
ids never enter the training sample. An empty table gives an empty table. Other columns than those named are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import durable

UNKNOWN = "und"
BUCKET_BITS = 14
ROWS_A_LANGUAGE = 600


_LETTERS: list[np.ndarray] = []  # filled on first use


def _letters() -> np.ndarray:
    """True for the code points that are letters."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0]


def term_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams of a whole text and how often each occurs; empty without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = _letters()[points]
    if not is_letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    spaced = np.concatenate([[32], np.where(is_letter, points, 32), [32]]).astype(np.uint32)
    spaced = spaced[np.concatenate([[True], (spaced[1:] != 32) | (spaced[:-1] != 32)])]
    mixed = spaced * np.uint32(0x9E3779B1)
    two = (mixed[:-1] ^ (mixed[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + mixed[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint32(15))) * np.uint32(0xC2B2AE3D) + mixed[2:]
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for grams in (mixed[spaced != 32], two, three):
        grams = (grams ^ (grams >> np.uint32(13))) * np.uint32(0x27D4EB2F)
        counts += np.bincount(grams >> np.uint32(32 - BUCKET_BITS), minlength=1 << BUCKET_BITS)
    terms = np.flatnonzero(counts)
    return terms, counts[terms]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float = 1.0

    def features(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[terms]
        return x / np.sqrt((x * x).sum())

    def logits(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.features(terms, counts) @ self.weights[terms] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        terms, counts = term_counts(text or "")
        if not len(terms) or not self.languages:
            return UNKNOWN, 0.0
        p = _softmax(self.logits(terms, counts) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_ftrl(model: Model, rows: list, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02,
               l2: float = 0.02, seed: int = 7) -> None:
    """Follow-the-regularised-leader (proximal) over (language, terms, counts) rows; sets weights and bias."""
    buckets, classes = model.weights.shape
    z, n = np.zeros((buckets + 1, classes)), np.zeros((buckets + 1, classes))  # the last row is the bias

    def solve(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        sparse = l1 * (at < buckets)[:, None]
        return -np.sign(zs) * np.maximum(np.abs(zs) - sparse, 0) / ((beta + np.sqrt(n[at])) / alpha + l2)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            lang, terms, counts = rows[k]
            label, at = model.languages.index(lang), np.append(terms, buckets)
            x = np.append(model.features(terms, counts), 1.0)
            w = solve(at)
            gap = _softmax(x @ w)
            gap[label] -= 1
            g = x[:, None] * gap
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    weights = solve(np.arange(buckets + 1))
    model.weights, model.bias = weights[:-1], weights[-1]


def calibrate(model: Model, rows: list) -> float:
    """The temperature with the least negative log-likelihood of held-back rows, by a search that narrows."""
    if not rows:
        return 1.0
    logits = np.array([model.logits(terms, counts) for _, terms, counts in rows])
    labels = np.array([model.languages.index(lang) for lang, _, _ in rows])

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-300)).mean())

    low, high = -4.0, 3.0
    for _ in range(5):
        grid = np.linspace(low, high, 15)
        best = grid[int(np.argmin([loss(t) for t in grid]))]
        step = grid[1] - grid[0]
        low, high = max(-4.0, best - step), min(3.0, best + step)
    return float(np.exp(best))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many rows of ``texts`` (text) each bucket occurs, and how many have a letter; over all rows."""
    size = 1 << BUCKET_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            for x in batch.column("text"):
                terms, _ = term_counts(x.as_py())
                if len(terms):
                    seen[terms] += 1
                    seen[size] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())], ["bucket", "n"])

    parts = texts.select("text").mapInArrow(run, "bucket int, n bigint")
    found = np.zeros(size + 1, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most 2**14 + 1 rows
        found[row["bucket"]] = row["n"]
    return found[:size], int(found[size])


def sample_terms(labelled: DataFrame, rows_a_language: int) -> list[tuple[str, np.ndarray, np.ndarray, bool]]:
    """(language, terms, counts, held back) of at most about ``rows_a_language`` different rows of each
    language, chosen by a hash of id and text."""
    # by row, not by id: a row's place follows from its id and text, and equal rows count once
    keyed = labelled.filter("doc_id IS NOT NULL").withColumn("key", F.xxhash64("doc_id", "text"))
    sizes = keyed.groupBy("lang").agg((F.lit(float(rows_a_language)) / F.count("*")).alias("share"))
    place = F.pmod(F.xxhash64(F.col("key"), F.lit("language sample")), F.lit(1_000_000_000)) / 1e9
    # keys only: the texts stay where they are, and what is broadcast is the bounded sample
    # one row a language, of which the model that the driver trains holds a column of weights each
    keys = durable(keyed.select("key", "lang").join(F.broadcast(sizes), "lang").filter(place < F.col("share"))
                   .select("key", "lang").distinct(), "language-sample")
    chosen = (keyed.join(F.broadcast(keys), ["key", "lang"], "left_semi")
              .groupBy("lang", "key").agg(F.first("text").alias("text"))
              .select("lang", "text", (F.pmod("key", F.lit(5)) == 0).alias("back")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [term_counts(x.as_py()) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("back"), pa.array([t.astype("<i4").tobytes() for t, _ in pairs]),
                 pa.array([c.astype("<i4").tobytes() for _, c in pairs])], ["lang", "back", "terms", "counts"])

    rows = chosen.mapInArrow(run, "lang string, back boolean, terms binary, counts binary").collect()
    rows = sorted((r for r in rows if r["terms"]), key=lambda r: (r["lang"], r["terms"], r["counts"]))
    unpack = lambda b: np.frombuffer(b, "<i4")  # noqa: E731  a view: the sample is held once
    return [(r["lang"], unpack(r["terms"]), unpack(r["counts"]), r["back"]) for r in rows]


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows_a_language: int = ROWS_A_LANGUAGE) -> Model:
    """A model from the rows of ``docs`` where ``learn`` holds and the language is known."""
    labelled = docs.filter(learn & docs[lang_col].isNotNull()).select(
        docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), docs[lang_col].alias("lang"))
    seen, rows = document_frequencies(labelled)
    sample = sample_terms(labelled, rows_a_language)
    languages = sorted({lang for lang, *_ in sample})
    size = 1 << BUCKET_BITS
    model = Model(languages, np.log((1 + rows) / (1 + seen)) + 1, np.zeros((size, len(languages))),
                  np.zeros(len(languages)))
    if languages:
        train_ftrl(model, [r[:3] for r in sample if not r[3]])
        model.temperature = calibrate(model, [r[:3] for r in sample if r[3]])
    return model


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, lang_pred, score) from the whole texts; ``row`` is a struct of the given columns."""
    given = docs.select(F.struct(*docs.columns).alias("row"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(x.as_py()) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64())], ["row", "lang_pred", "score"])

    schema = given.select("row").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return given.mapInArrow(run, schema)
