"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Both tokenizers' tokens are laid on one line of bytes. For a batch of documents, ``pandas.merge_asof`` keyed by document
finds for each token's start the other side's token that covers it; the union of both directions is the overlaps. Where
the two tokens of an overlap end alike a group ends; between two such ends, all tokens of one side are linked to all of
the other. How many documents hold a pair of ids linked is counted over the whole corpus, and each document's links are
weighed with these counts.

The tokenizers: A is a byte-level BPE file, B a sentencepiece BPE model with byte fallback that adds a space in front.
A group's pairs are taken by distinct ids with their multiplicity where a group has many tokens, so a
group costs its distinct pairs only. A batch is worked off in parts of ``PART_CHARS`` characters (or one text, if longer).

The pair counts are no broadcast: only pairs that more than ``1 / HOT_PAIRS`` of all (document, pair) rows hold are, so
fewer than HOT_PAIRS, whatever the data; rows of all other pairs meet their counts in a shuffle, in which no pair has
more than that share.

Defined results: a null or empty text, or one whose tokens' bytes of either side are not a space and the text (such as
one with U+2581), has no tokens: zeros and an empty group string. Null ids and repeated rows give a row each, and count
as a document each. An empty table gives an empty table. Extra columns are not read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.byte_bpe import ByteBpe
from ledgerlake.llm.common import durable

PART_CHARS = 500_000
#: Pairs held by more than 1/HOT_PAIRS of all (document, pair) rows are broadcast.
HOT_PAIRS = 1 << 19
#: Groups with more links than this are expanded by distinct ids.
WIDE_GROUP = 256
SPACE_MARK = "▁"  # fixed value: sentencepiece's stand-in for a space


class Tokens:
    """Token ids of both sides, with each id's bytes."""

    def __init__(self, byte_bpe: str, piece_bpe: str) -> None:
        a, b = ByteBpe(byte_bpe), sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        self.encode_a, self.encode_b = a.encoding.encode_ordinary, b.encode
        self.a_bytes = [b""] * len(a.size)
        for token, k in a.ranks.items():
            self.a_bytes[k] = token
        self.b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace(SPACE_MARK, " ").encode()
                        for k in range(b.get_piece_size()) for p in [b.id_to_piece(k)]]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))

    def ids(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """For each text the ids of a space and the text by A, and of the text by B; none if there is no text, or where
        either side's bytes differ from a space and the text."""
        out = []
        for text, b in zip(texts, self.encode_b([x or "" for x in texts], num_threads=1)):
            want = b" " + (text or "").encode()
            if not text or b"".join([self.b_bytes[k] for k in b]) != want:
                out.append(([], []))
                continue
            a = self.encode_a(" " + text)
            out.append((a, b) if b"".join([self.a_bytes[k] for k in a]) == want else ([], []))
        return out


def _covering(left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
    """For each start on the left, the row of the right token of its document that covers it."""
    return pd.merge_asof(left, right, on="start", by="doc")["row"].to_numpy()


def overlaps(a_doc: np.ndarray, a_size: np.ndarray, b_doc: np.ndarray, b_size: np.ndarray):
    """Rows of A and of B that overlap, in order; and whether both end alike. The tokens of both sides are in order, a
    document's sizes add up to the same on both, and documents follow each other."""
    a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
    a = pd.DataFrame({"start": a_end - a_size, "doc": a_doc})
    b = pd.DataFrame({"start": b_end - b_size, "doc": b_doc})
    rows_a, rows_b = np.arange(len(a)), np.arange(len(b))
    by_a = _covering(a, b.assign(row=rows_b))
    by_b = _covering(b, a.assign(row=rows_a))
    # a start that both sides share gives its pair in both directions: it counts once
    new = b["start"].to_numpy() != a["start"].to_numpy()[by_b]
    left, right = np.concatenate([rows_a, by_b[new]]), np.concatenate([by_a, rows_b[new]])
    order = np.argsort(left * (len(b) + 1) + right, kind="stable")  # two ordered runs: merged in one pass
    left, right = left[order], right[order]
    return left, right, a_end[left] == b_end[right]


class Aligned:
    """The alignment of a part: documents' tokens one after another, groups with their tokens' first rows and numbers."""

    def __init__(self, found: list[tuple[list[int], list[int]]], tokens: Tokens) -> None:
        n = len(found)
        self.docs = n
        self.n_a, self.n_b = (np.array([len(x[k]) for x in found], np.int64) for k in (0, 1))
        self.a, self.b = (np.array(array("I", chain.from_iterable(x[k] for x in found)), np.int64) for k in (0, 1))
        a_doc, b_doc = np.repeat(np.arange(n), self.n_a), np.repeat(np.arange(n), self.n_b)
        left, right, ends = overlaps(a_doc, tokens.a_size[self.a], b_doc, tokens.b_size[self.b])
        self.doc = a_doc[left[ends]]  # by group
        last_a, last_b = left[ends], right[ends]
        self.first_a, self.first_b = np.concatenate([[0], last_a + 1])[:-1], np.concatenate([[0], last_b + 1])[:-1]
        self.size_a, self.size_b = last_a + 1 - self.first_a, last_b + 1 - self.first_b
        self.n_overlaps = np.bincount(a_doc[left], minlength=n)
        self.n_groups = np.bincount(self.doc, minlength=n)
        links = np.concatenate([[0], np.cumsum(self.size_a * self.size_b)])
        upto = np.concatenate([[0], np.cumsum(self.n_groups)])
        self.n_links = links[upto[1:]] - links[upto[:-1]]
        self.upto = upto

    def pairs(self, n_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, a_id * n_b + b_id, links) of each document's distinct linked pairs, in order."""
        links = self.size_a * self.size_b
        some = np.flatnonzero(links <= WIDE_GROUP)
        of = np.repeat(some, links[some])
        within = np.arange(len(of)) - np.repeat(np.cumsum(links[some]) - links[some], links[some])
        across = self.size_b[of]
        code = self.a[self.first_a[of] + within // across] * n_b + self.b[self.first_b[of] + within % across]
        parts = [_summed(self.doc[of], code, np.ones(len(of), np.int64))]
        for g in np.flatnonzero(links > WIDE_GROUP):
            a, times_a = np.unique(self.a[self.first_a[g]:self.first_a[g] + self.size_a[g]], return_counts=True)
            b, times_b = np.unique(self.b[self.first_b[g]:self.first_b[g] + self.size_b[g]], return_counts=True)
            code = (a[:, None] * n_b + b[None, :]).ravel()
            parts.append((np.full(len(code), self.doc[g]), code, np.outer(times_a, times_b).ravel()))
        return parts[0] if len(parts) == 1 else _summed(*map(np.concatenate, zip(*parts)))

    def group_strings(self, a_text: np.ndarray, b_text: np.ndarray) -> list[str]:
        """Each document's groups as ``a1,a2|b1;a3|b2,b3``; the texts of ids."""
        groups = len(self.doc)
        # where each token stands when a group's A tokens are followed by its B tokens
        a_group, b_group = np.repeat(np.arange(groups), self.size_a), np.repeat(np.arange(groups), self.size_b)
        at_a = np.arange(len(self.a)) + self.first_b[a_group]
        at_b = np.arange(len(self.b)) + (self.first_a + self.size_a)[b_group]
        texts = np.empty(len(self.a) + len(self.b), object)
        signs = np.full(len(texts), ",", object)
        texts[at_a], texts[at_b] = a_text[self.a], b_text[self.b]
        signs[at_a[self.first_a + self.size_a - 1]] = "|"
        signs[at_b[self.first_b + self.size_b - 1]] = ";"
        both = np.empty(2 * len(texts), object)
        both[::2], both[1::2] = texts, signs
        parts, out, start = both.tolist(), [], 0
        for n in (2 * (self.n_a + self.n_b)).tolist():
            out.append("".join(parts[start:start + max(n - 1, 0)]))
            start += n
        return out


def _summed(doc: np.ndarray, code: np.ndarray, times: np.ndarray):
    """Equal (document, code) as one, with the sum of their times."""
    order = np.lexsort((code, doc))
    doc, code, times = doc[order], code[order], times[order]
    if not len(doc):
        return doc, code, times
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])]))
    return doc[first], code[first], np.add.reduceat(times, first)


def align(docs: DataFrame, byte_bpe: str, piece_bpe: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document: its row number, doc_id, n_a, n_b, n_groups, n_overlaps, n_links, the groups as a string, and
    its distinct linked pairs of ids (``a_id * pieces of B + b_id``) with their number of links.

    ``byte_bpe`` and ``piece_bpe`` are paths of tokenizer files that every executor has.
    """
    slim = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("doc_id"),
                       docs[text_col].alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_overlaps", "n_links", "groups", "pairs", "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(byte_bpe, piece_bpe)
        a_text = np.array([str(k) for k in range(len(tokens.a_size))], object)
        b_text = np.array([str(k) for k in range(len(tokens.b_size))], object)
        for batch in batches:
            start, texts, size = 0, [], 0
            for k, x in enumerate(batch.column("text")):
                texts.append(text := x.as_py())
                size += len(text or "")
                if size < PART_CHARS and k < batch.num_rows - 1:
                    continue
                part, n = Aligned(tokens.ids(texts), tokens), len(texts)
                doc, code, times = part.pairs(len(tokens.b_size))
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(start, n), batch.column("doc_id").slice(start, n),
                     *(pa.array(x, pa.int64()) for x in (part.n_a, part.n_b, part.n_groups, part.n_overlaps,
                                                         part.n_links)),
                     pa.array(part.group_strings(a_text, b_text), pa.string()),
                     pa.ListArray.from_arrays(offsets, pa.array(code, pa.int64())),
                     pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))], names)
                start, texts, size = k + 1, [], 0

    return slim.mapInArrow(run, f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_overlaps long, "
                                "n_links long, groups string, pairs array<bigint>, links array<bigint>")


def pair_counts(held: DataFrame, pieces: int) -> DataFrame:
    """(pair, n, best): in how many rows of ``held`` (row, pair, links) a pair is, and whether no other pair of its A id
    is in more."""
    counts = durable(held.groupBy("pair").agg(F.count("*").alias("n")).withColumn("a", F.expr(f"pair DIV {pieces}")),
                     "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))  # at most one row an id of A
    return counts.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def weigh(aligned: DataFrame, pieces: int, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``aligned`` (written rows of :func:`align`) without its pairs, with n_best and count_sum; ``pieces``: of B."""
    held = aligned.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select(
        "row", F.col("x.pairs").alias("pair"), F.col("x.links").alias("links"))
    counts = durable(pair_counts(held, pieces), "pair-info")
    rows = aligned.agg(F.sum(F.size("pairs"))).first()[0] or 0
    is_hot = F.col("n") > F.lit(rows // hot_pairs)
    hot, rest = counts.filter(is_hot), counts.filter(~is_hot)
    sums = [F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
            F.sum(F.col("links") * F.col("n")).alias("count_sum")]
    often = held.join(F.broadcast(hot), "pair").groupBy("row").agg(*sums)
    seldom = (held.join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(rest, "pair")
              .groupBy("row").agg(*sums))
    found = often.unionByName(seldom).groupBy("row").agg(F.sum("n_best").alias("n_best"),
                                                         F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return aligned.drop("pairs", "links").join(found, "row", "left").withColumns(
        {c: F.coalesce(F.col(c), zero) for c in ("n_best", "count_sum")}).drop("row")


def alignment(docs: DataFrame, byte_bpe: str, piece_bpe: str, id_col: str = "doc_id", text_col: str = "text",
              digests: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_overlaps, n_links, groups, n_best, count_sum of every whole text.

    ``digests``: groups are written as their SHA-256 only (empty without tokens), as they are longer than the texts.
    """
    pieces = sentencepiece.SentencePieceProcessor(model_file=piece_bpe).get_piece_size()
    found = align(docs, byte_bpe, piece_bpe, id_col, text_col)
    if digests:
        digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
        found = found.withColumn("groups", digest)
    return weigh(durable(found, "aligned"), pieces)
