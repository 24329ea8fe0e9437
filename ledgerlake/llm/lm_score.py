"""Language-model scoring with a log-bilinear model trained by noise-contrastive estimation.

Tokens are the words of a text (A-Z in lower case) and one end. Counts over all training documents give the base score,
a smoothed unigram score. The model predicts a token's class from the classes before it: the commonest words are
classes of their own, all other words share classes by their last two bytes, and within a class a word has its smoothed
share of the class's count. Class probabilities come from batched matrix products over all classes, so they are
normalised, and so is the score over all words known or new.

Training is in numpy with noise shared by a mini-batch: a first model on a bounded sample of documents, then one pass
in which each task trains it on all its documents; the tasks' models are averaged by their tokens in a Spark
aggregate. The driver gets the model and at most ``hot_parts`` words with their counts (those with more than 1 in
``hot_parts`` of the tokens; there cannot be more). A document's other words meet their counts in a shuffle.

Defined results: a null text counts as empty; an empty text is its end alone. Rows with a null id are scored and teach
nothing. Repeated rows are scored and learnt like any other. Without training documents every base score is 0 a token,
and the model knows one class for all words. An empty table gives an empty table. Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import durable, word_blocks

END = b""  # no word is empty
CONTEXT = 3
WIDTH = 16
HOT_PARTS = 500_000
WORD_CLASSES = 384
SUFFIX_CLASSES = 64
SUFFIX_BYTES = 2
SEED_DOCUMENTS = 1500
FLUSH_WORDS = 200_000


class _ClassMap(dict):
    """Classes of hot words; that of another word is its suffix's, and is not kept."""

    suffixes: dict[bytes, int]

    def __missing__(self, word: bytes) -> int:
        return self.suffixes.get(word[-SUFFIX_BYTES:], 1)


def text_classes(text: bytes, known: _ClassMap) -> np.ndarray:
    """The classes of a text's words and of its end, as :meth:`Vocabulary.classes` has them."""
    found: list[int] = []
    for block in word_blocks(text):
        found += map(known.__getitem__, block)
    found.append(0)
    return np.array(found, np.int64)


@dataclass
class Vocabulary:
    """Hot words by place, with each one's class and count; the classes of other words by suffix.

    Class 0 is the end, class 1 that of words whose suffix has no class of its own. ``mass``: the smoothed count of a
    class's words, 0 for classes of one word.
    """

    hot: dict[bytes, int]
    hot_class: np.ndarray
    hot_count: np.ndarray
    suffixes: dict[bytes, int]
    mass: np.ndarray
    class_count: np.ndarray

    def places(self, text: bytes) -> tuple[np.ndarray, list[bytes]]:
        """The hot words' places, the end's last; -1 for others, which are listed in order."""
        get, places, rare = self.hot.get, [], []
        for block in word_blocks(text):
            found = [get(w, -1) for w in block]
            places += found
            if -1 in found:
                rare += [w for w, k in zip(block, found, strict=True) if k < 0]
        places.append(get(END, -1))
        return np.array(places, np.int64), rare

    def class_map(self) -> _ClassMap:
        """The class of any word but the end."""
        known = _ClassMap(zip(self.hot, self.hot_class.tolist()))
        known.suffixes = self.suffixes
        return known

    def classes(self, places: np.ndarray, rare: list[bytes]) -> np.ndarray:
        out = self.hot_class[places]
        others = places < 0
        others[-1] = False
        out[others] = [self.suffixes.get(w[-SUFFIX_BYTES:], 1) for w in rare]
        out[-1] = 0
        return out


class LogBilinear:
    """The next class's score: its vector times a sum of weighted context vectors, and its bias."""

    def __init__(self, class_count: np.ndarray, seed: int = 1) -> None:
        rng, n = np.random.default_rng(seed), len(class_count)
        p = (class_count + 1.0) / (class_count.sum() + n)
        self.noise = p.astype(np.float64)
        self.parameters = [rng.normal(0, 0.1, (n, WIDTH)), rng.normal(0, 0.1, (n, WIDTH)),
                           rng.uniform(0.5, 1.0, (CONTEXT, WIDTH)), np.log(p)]
        self.parameters = [x.astype(np.float32) for x in self.parameters]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parameters])

    def load(self, values: np.ndarray) -> None:
        at = 0
        for k, x in enumerate(self.parameters):
            self.parameters[k] = values[at:at + x.size].reshape(x.shape).astype(np.float32)
            at += x.size

    @staticmethod
    def contexts(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Targets, and the CONTEXT classes before each, nearest first; before a document stand ends."""
        pad = np.zeros(CONTEXT, np.int64)
        joined = np.concatenate([x for d in documents for x in (pad, d)])
        sizes = np.array([len(d) for d in documents])
        at = np.arange(sizes.sum()) + np.repeat(np.arange(1, len(sizes) + 1) * CONTEXT, sizes)
        return joined[at], np.stack([joined[at - k] for k in range(1, CONTEXT + 1)])

    def train(self, documents: list[np.ndarray], rng: np.random.Generator, state: list[np.ndarray], batch: int = 1024,
              noise_size: int = 64, rate: float = 0.1) -> None:
        """One pass of noise-contrastive estimation, by Adagrad; ``state`` holds its sums."""
        target, context = self.contexts(documents)
        out, into, mix, bias = self.parameters
        log_noise = np.log(noise_size * self.noise).astype(np.float32)
        order = rng.permutation(len(target))
        draws = rng.choice(len(self.noise), size=(-(-len(target) // batch), noise_size), p=self.noise)
        for step, at in enumerate(range(0, len(target), batch)):
            rows, drawn = order[at:at + batch], draws[step]
            w, before = target[rows], [c[rows] for c in context]
            vectors = [into[c] for c in before]
            guess = sum(v * mix[k] for k, v in enumerate(vectors))
            own, others = out[w], out[drawn]
            up = _logistic(log_noise[w] - (guess * own).sum(axis=1) - bias[w])
            down = _logistic(guess @ others.T + (bias[drawn] - log_noise[drawn]))
            toward = up[:, None] * own - down @ others
            n = len(bias)
            g_out = _row_sums([w, drawn], [up[:, None] * guess, -(down.T @ guess)], n)
            g_bias = np.bincount(w, up, n) - np.bincount(drawn, down.sum(axis=0), n)
            g_mix = np.stack([(toward * v).sum(axis=0) for v in vectors])
            g_into = _row_sums(before, [toward * mix[k] for k in range(CONTEXT)], n)
            for x, g, s in zip(self.parameters, (g_out, g_into, g_mix, g_bias), state, strict=True):
                g = (g / len(rows)).astype(np.float32)
                s += g * g
                x += rate * g / (np.sqrt(s) + 1e-6)

    def fresh_state(self) -> list[np.ndarray]:
        return [np.full_like(x, 1e-6) for x in self.parameters]

    def log_probabilities(self, documents: list[np.ndarray], chunk: int = 512) -> np.ndarray:
        """The natural log-probability of every token's class, normalised over all classes.

        Tokens are taken by their contexts, and the scores of all classes are computed once for each different context.
        """
        target, context = self.contexts(documents)
        out, into, mix, bias = self.parameters
        turned = np.ascontiguousarray(np.column_stack([out, bias]).T)  # the bias meets a constant 1
        mixed = [np.column_stack([into * mix[k], np.full(len(into), k == 0)]).astype(np.float32) for k in range(CONTEXT)]
        ones = np.ones(len(bias), np.float32)
        # no score is beyond this, so scores that cannot overflow are used as they are
        most = sum(np.abs(m).max(axis=0) for m in mixed) @ np.abs(turned).max(axis=1)
        key = np.zeros(len(target), np.int64)
        for c in context:
            key = key * len(bias) + c
        order = np.argsort(key)
        key, target = key[order], target[order]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        number = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(key))))  # of each token's context
        context = context[:, order[starts]]
        found = np.empty(len(target))
        for at in range(0, len(starts), chunk):
            low, high = starts[at], starts[at + chunk] if at + chunk < len(starts) else len(target)
            guess = mixed[0][context[0, at:at + chunk]]
            for m, c in zip(mixed[1:], context[1:], strict=True):
                guess += m[c[at:at + chunk]]
            scores = guess @ turned
            if most > 60:
                scores -= scores.max(axis=1, keepdims=True)
            rows = number[low:high] - at
            own = scores[rows, target[low:high]]
            np.exp(scores, out=scores)
            found[order[low:high]] = own - np.log(scores @ ones)[rows]
        return found


def _row_sums(rows: list[np.ndarray], values: list[np.ndarray], size: int) -> np.ndarray:
    """The sum of the value rows by row number, as a matrix of ``size`` rows."""
    at = np.concatenate(rows)[:, None] * WIDTH + np.arange(WIDTH)
    return np.bincount(at.ravel(), np.concatenate(values).ravel(), size * WIDTH).reshape(size, WIDTH)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows of ``texts`` (text as binary); the end is the empty word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def taken() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()),
                                              pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for x in batch.column("text"):
                for block in word_blocks(x.as_py()):
                    counts.update(block)
                counts[END] += 1
                if len(counts) > FLUSH_WORDS:
                    yield taken()
        yield taken()

    return texts.select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def make_vocabulary(counts: DataFrame, total: int, word_classes: int = WORD_CLASSES,
                    suffix_classes: int = SUFFIX_CLASSES, hot_parts: int = HOT_PARTS) -> Vocabulary:
    hot = counts.filter(F.col("n") * hot_parts > F.lit(total)).collect()  # fewer than hot_parts words
    hot = sorted(((bytes(r["word"]), r["n"]) for r in hot), key=lambda x: (-x[1], x[0]))
    single = [w for w, _ in hot if w != END][:word_classes]
    tail = F.expr(f"substring(word, greatest(length(word) - {SUFFIX_BYTES - 1}, 1), {SUFFIX_BYTES})")
    parts = counts.filter("length(word) > 0").groupBy(tail.alias("tail")).agg(
        F.sum("n").alias("n"), F.count("*").alias("words")).collect()  # 65,792 tails of two bytes at most
    mass = {bytes(r["tail"]): [r["n"], r["words"]] for r in parts}
    number = dict(hot)
    for w in single:
        mass[w[-SUFFIX_BYTES:]][0] -= number[w]
        mass[w[-SUFFIX_BYTES:]][1] -= 1
    tails = sorted(mass, key=lambda t: (-mass[t][0], t))[:suffix_classes]
    classes = {END: 0} | {w: 2 + k for k, w in enumerate(single)}
    suffixes = {t: 2 + len(single) + k for k, t in enumerate(tails)}
    size = 2 + len(single) + len(tails)
    smoothed, count = np.zeros(size), np.zeros(size)
    for t, (n, words) in mass.items():
        smoothed[suffixes.get(t, 1)] += n + 0.5 * words
        count[suffixes.get(t, 1)] += n
    for w, k in classes.items():
        count[k] = number.get(w, 0)
    # a place beyond the last (-1) stands for words that are not hot
    hot_class = np.array([classes.get(w, suffixes.get(w[-SUFFIX_BYTES:], 1)) for w, _ in hot] + [1], np.int64)
    smoothed[1] += 1e-300  # never zero: class 1 holds several words, if only new ones
    return Vocabulary({w: k for k, (w, _) in enumerate(hot)}, hot_class, np.array([n for _, n in hot] + [0], float),
                      suffixes, smoothed, count)


def train_model(texts: DataFrame, words: Vocabulary, seed_documents: int = SEED_DOCUMENTS) -> LogBilinear:
    """The model of ``texts`` (doc_id, text): seeded on a bounded sample, then trained on all rows and averaged."""
    model = LogBilinear(words.class_count)
    total = texts.count()
    share = F.lit(int((1 << 30) * min(1.0, seed_documents / max(total, 1))))
    chosen = texts.filter(F.pmod(F.xxhash64("doc_id", F.lit("seed")), F.lit(1 << 30)) < share).limit(2 * seed_documents)

    def to_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.class_map()
        for batch in batches:
            ids = [text_classes(x.as_py(), known).astype("<i2").tobytes() for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    seeds = sorted(bytes(r["ids"]) for r in chosen.mapInArrow(to_classes, "ids binary").collect())
    rng, state = np.random.default_rng(2), model.fresh_state()
    documents = [np.frombuffer(x, "<i2").astype(np.int64) for x in seeds]
    for _ in range(2 if documents else 0):
        model.train(documents, rng, state)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, tokens = LogBilinear(words.class_count), 0
        own.load(model.flat())
        sums, draw = [s.copy() for s in state], np.random.default_rng(TaskContext.get().partitionId())
        waiting, size, known = [], 0, words.class_map()
        for batch in batches:
            for x in batch.column("text"):
                waiting.append(text_classes(x.as_py(), known))
                size += len(waiting[-1])
                if size >= 1 << 18:
                    own.train(waiting, draw, sums)
                    tokens, waiting, size = tokens + size, [], 0
        if waiting:
            own.train(waiting, draw, sums)
            tokens += size
        values = own.flat().astype(np.float64) * tokens
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(values) + 1), pa.int32()), pa.array(np.append(values, tokens), pa.float64())],
            ["at", "value"])

    summed = texts.select("text").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("v"))
    rows = summed.orderBy("at").collect()  # one row a parameter, and the tokens
    if rows and rows[-1]["v"]:
        model.load(np.array([r["v"] for r in rows[:-1]]) / rows[-1]["v"])
    return model


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          hot_parts: int = HOT_PARTS) -> DataFrame:
    """A row a document: doc_id, n_tokens, n_known, train_tokens, base_score, score (log10).

    ``learn`` is a condition on doc_id: the documents to learn from.
    """
    texts = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).cast("binary").alias("text"))
    training = texts.filter(learn & F.col("doc_id").isNotNull())
    counts = durable(word_counts(training), "lm-counts")
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, distinct = sums["n"], sums["v"]
    words = make_vocabulary(counts, total, hot_parts=hot_parts)
    model = train_model(training, words)
    # of one token: log10 of its smoothed count, and of its share of its class beyond that (0 for classes of one word)
    log_count = np.log10(words.hot_count + 0.5)
    shared = words.mass > 0
    class_mass = np.where(shared, np.log10(words.mass + 0.5), 0.0)
    kind = texts.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "word", "tf", "tokens", "known", "base", "model"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            at, size, group = 0, 0, []
            for k, x in enumerate(batch.column("text")):
                group.append(words.places(x.as_py()))
                size += len(group[-1][0])
                if size >= 1 << 19 or k == batch.num_rows - 1:
                    yield from of_group(group, ids[at:k + 1], number, batch.column("doc_id").type)
                    number += len(group)
                    at, size, group = k + 1, 0, []

    def of_group(group: list, ids: list, number: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """The rows of documents, then those of their words that are not hot."""
        types = [pa.int64(), id_type, pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

        def batch_of(size: int, **given) -> pa.RecordBatch:
            columns = [pa.array(given[c], t) if c in given else pa.nulls(size, t) for c, t in zip(names, types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names)

        classes = [words.classes(places, rare) for places, rare in group]
        logs = model.log_probabilities(classes) / np.log(10)
        start, of_doc, found = 0, [], []
        for (places, rare), own in zip(group, classes, strict=True):
            hot = places[places >= 0]
            part = logs[start:start + len(own)].sum() - class_mass[own].sum()
            part += log_count[hot[shared[words.hot_class[hot]]]].sum()
            start += len(own)
            of_doc.append((len(places), len(hot), log_count[hot].sum(), part))
            # an end that was never learnt is a word like the others
            found.append(Counter(rare if places[-1] >= 0 else [*rare, END]))
        rows = np.arange(number, number + len(group))
        tokens, known, base, score = zip(*of_doc, strict=True)
        yield batch_of(len(rows), row=rows, doc_id=ids, tokens=tokens, known=known, base=base, model=score)
        if any(found):
            counts = np.array([len(c) for c in found])
            yield batch_of(int(counts.sum()), row=np.repeat(rows, counts), word=[w for c in found for w in c],
                           tf=[n for c in found for n in c.values()])

    found = durable(texts.mapInArrow(run, f"row bigint, doc_id {kind}, word binary, tf int, tokens bigint, "
                                          "known bigint, base double, model double"), "lm-parts")
    rest = found.filter("word IS NOT NULL").select("row", "word", "tf").join(counts, "word", "left")
    number = F.coalesce("n", F.lit(0))
    rest = rest.groupBy("row").agg(
        F.sum(F.col("tf") * F.log10(number + 0.5)).alias("more"),
        F.sum(F.when(F.length("word") > 0, F.col("tf") * F.log10(number + 0.5))).alias("more_model"),
        F.sum(F.when(number > 0, F.col("tf")).otherwise(0)).alias("more_known"))
    one = found.filter("tokens IS NOT NULL").join(rest, "row", "left")
    more, zero = lambda c: F.coalesce(c, F.lit(0.0)), F.lit(0)
    whole = float(np.log10(total + 0.5 * (distinct + 1)))
    return one.select("doc_id", F.col("tokens").alias("n_tokens"),
                      (F.col("known") + F.coalesce("more_known", zero)).cast("long").alias("n_known"),
                      F.lit(total).cast("long").alias("train_tokens"),
                      (F.col("base") + more("more") - F.col("tokens") * whole).alias("base_score"),
                      (F.col("model") + more("more_model")).alias("score"))
