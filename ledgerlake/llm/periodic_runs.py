"""Periodic runs of words by Kruskal's rule on common prefixes, in descending order.

A run is a stretch of words with smallest period q, at least ``least`` words and two periods long, that cannot be longer
with that period. Suffixes of a text are united into classes by decreasing length of their common prefix (LCP), with
union-find; each class keeps its positions in order. When two classes are united at LCP l, positions i < j that become
neighbours have exactly l words in common. If j - i <= l, the words from i to j + l have period j - i: they are a run
unless the word before i continues it. The period is the smallest one, as a position in between that had it would
already be in the class. So every run is found once, from its first word.

As a run has LCP at least half its length, only suffixes that share ``least / 2`` words with another are sorted. Their
order comes from prefix doubling over all documents of a part at once, in numpy: positions whose prefix is theirs alone
leave the sorting early. LCPs are read off the ranks of each doubling. Memory and time of a part grow with its words,
times the doublings (the logarithm of the longest repeat); a part is ``PART_CHARS`` characters or one text, if longer.

Defined results: a null text has no words. Null ids and repeated rows give a row each. An empty table gives an empty
table. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 12
PART_CHARS = 2_000_000
_BLOCK = 512  # positions in a block of an ordered set


class Positions:
    """An ordered set of positions in blocks, so that an insertion moves few of them."""

    def __init__(self, ordered: list[int]) -> None:
        self.size = len(ordered)
        self.blocks = [ordered[k:k + _BLOCK] for k in range(0, len(ordered), _BLOCK)]
        self.firsts = [b[0] for b in self.blocks]

    def add(self, x: int) -> None:
        k = max(bisect_left(self.firsts, x) - 1, 0)
        block = self.blocks[k]
        insort(block, x)
        self.firsts[k] = block[0]
        self.size += 1
        if len(block) > 2 * _BLOCK:
            self.blocks.insert(k + 1, block[_BLOCK:])
            del block[_BLOCK:]
            self.firsts.insert(k + 1, self.blocks[k + 1][0])

    def around(self, x: int) -> tuple[int | None, int | None]:
        """The neighbours of a position of the set."""
        k = bisect_left(self.firsts, x)
        if k == len(self.firsts) or self.firsts[k] != x:
            k -= 1
        block = self.blocks[k]
        at = bisect_left(block, x)
        before = block[at - 1] if at else self.blocks[k - 1][-1] if k else None
        if at + 1 < len(block):
            return before, block[at + 1]
        return before, self.blocks[k + 1][0] if k + 1 < len(self.blocks) else None

    def __iter__(self) -> Iterator[int]:
        return (x for block in self.blocks for x in block)


def repeats(words: np.ndarray, doc_end: np.ndarray, shared: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, lcp): neighbours in the order of suffixes with ``shared`` or more words in common.

    ``words``: numbers of words, of all documents one after another; ``doc_end``: by position, where its document ends.
    Suffixes of different documents have nothing in common.
    """
    n = len(words)
    nothing = np.empty(0, np.int64)
    if n < 2:
        return nothing, nothing, nothing
    # ranks: where a class begins in the order; equal ranks share the first 2**k words
    order = np.lexsort((words, doc_end))
    apart = np.concatenate([[True], (words[order][1:] != words[order][:-1])
                            | (doc_end[order][1:] != doc_end[order][:-1])])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(apart, np.arange(n), 0))
    levels, step = [rank.astype(np.int32)], 1
    slots, active = _shared(rank[order], order)
    while len(active):
        ahead = active + step
        inside = ahead < doc_end[active]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)], -1)
        # a class has consecutive slots, so sorting by (class, second) keeps every class in its own slots
        first = rank[active]
        within = np.lexsort((second, first))
        active, first, second = active[within], first[within], second[within]
        new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        rank = rank.copy()
        rank[active] = slots[np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))]
        order[slots] = active
        levels.append(rank.astype(np.int32))
        step *= 2
        slots, active = _shared(rank[active], active, slots)
    # neighbours in the order that share at least one word
    i, j = order[:-1], order[1:]
    near = levels[0][i] == levels[0][j]
    i, j = i[near], j[near]
    lcp = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = i + lcp, j + lcp
        same = (a < doc_end[i]) & (b < doc_end[j])
        same &= levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)]
        lcp[same] += 1 << k
    enough = lcp >= shared
    return i[enough], j[enough], lcp[enough]


def _shared(ranks: np.ndarray, rows: np.ndarray, slots: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Of positions in order: the slots and positions of those that have their rank in common with another."""
    if not len(ranks):
        return np.empty(0, np.int64), rows[:0]
    same = ranks[1:] == ranks[:-1]
    keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    at = np.flatnonzero(keep)
    return (at if slots is None else slots[at]), rows[at]


def find_runs(words: np.ndarray, doc_end: np.ndarray, doc_start: np.ndarray,
              least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs, in no order; see :func:`repeats` for the arrays."""
    left, right, lcp = repeats(words, doc_end, -(-least // 2))
    by = np.argsort(-lcp, kind="stable")
    found: list[tuple[int, int, int]] = []
    parent: dict[int, int] = {}
    sets: dict[int, Positions] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x], x = top, up
        return top

    def seed(i: int, j: int, shared: int) -> None:
        period = j - i
        if period <= shared and period + shared >= least and (
                i == doc_start[i] or words[i - 1] != words[j - 1]):
            found.append((i, j + shared, period))

    for i, j, shared in zip(left[by].tolist(), right[by].tolist(), lcp[by].tolist()):
        a, b = root(i), root(j)
        if a not in sets and b not in sets:  # two single positions
            i, j = (i, j) if i < j else (j, i)
            parent[b] = a
            sets[a] = Positions([i, j])
            seed(i, j, shared)
            continue
        if a not in sets or b in sets and sets[a].size < sets[b].size:
            a, b = b, a
        large, small = sets[a], sets.pop(b, None) or (b,)
        parent[b] = a
        added = list(small)
        for x in added:
            large.add(x)
        for k, x in enumerate(added):  # old neighbours within the small class are not new
            before, after = large.around(x)
            if before is not None and (k == 0 or before != added[k - 1]):
                seed(before, x, shared)
            if after is not None and (k + 1 == len(added) or after != added[k + 1]):
                seed(x, after, shared)
    return found


def repeat_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """``words`` with a repeated tail for a tenth of the ids, from the checksum of the id."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    whole, rest = divmod(n - a, p)
    return words[:a] + words[a:a + p] * whole + words[a:a + rest]


Change = Callable[[list[bytes], "int | None"], list[bytes]]


def runs_of(texts: list[list[bytes]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """Each text's runs as (start, length, period) in order of start and period; texts as lists of words."""
    numbers: dict[bytes, int] = {}
    sizes = np.array([len(x) for x in texts], np.int64)
    words = np.array([numbers.setdefault(w, len(numbers)) for x in texts for w in x], np.int64)
    ends = np.cumsum(sizes)
    doc_end, doc_start = np.repeat(ends, sizes), np.repeat(ends - sizes, sizes)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = sorted(find_runs(words, doc_end, doc_start, least), key=lambda x: (x[0], x[2]))
    of = np.searchsorted(ends, [x[0] for x in found], "right").tolist() if found else []
    starts = (ends - sizes).tolist()
    for d, (start, end, period) in zip(of, found):
        out[d].append((start - starts[d], end - start, period))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """``words`` without those that a run holds after its first period."""
    kept, upto = [], 0
    for start, end in sorted((s + q, s + n) for s, n, q in runs):
        kept += words[upto:start]
        upto = max(upto, end)
    return kept + words[upto:]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
                  change: Change | None = None) -> DataFrame:
    """A row a document: doc_id, its runs (start, length, period) in words, and its text without repeated periods.

    Words are runs of other bytes than white space (0x20, 0x09-0x0D). ``change`` maps a text's words and id to the words
    that are searched.
    """
    slim = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, texts, size = 0, [], 0
            for k, (doc_id, text) in enumerate(zip(batch.column("doc_id"), batch.column("text"))):
                raw = text.as_buffer().to_pybytes()
                words = raw.split()
                texts.append(change(words, doc_id.as_py()) if change else words)
                size += len(raw)
                if size < PART_CHARS and k < batch.num_rows - 1:
                    continue
                found = runs_of(texts, least)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, len(texts)),
                     pa.array([[dict(zip(("start", "length", "period"), r)) for r in x] for x in found], run_type),
                     pa.array([b" ".join(collapse(w, r)) for w, r in zip(texts, found)], pa.binary()).cast(pa.string())],
                    ["doc_id", "runs", "collapsed"])
                start, texts, size = k + 1, [], 0

    return slim.mapInArrow(run, f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
                                "collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """The rows of :func:`periodic_runs` in numbers and checksums."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"),
                                                              r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                      r["period"].cast("string")))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    length = -F.col("best.less")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        length.alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * -best.less) DIV best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
