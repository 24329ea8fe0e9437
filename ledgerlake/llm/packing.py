"""Vector bin packing of token sequences with the dot-product heuristic.

A sequence (bin) has three capacities: tokens, segments and loss-bearing tokens. An item is a piece of a document with
its demand for each; which tokens bear loss is given by document (all of them unless stated), and a cut piece demands
its own ones. The first token of a piece has nothing before it to be predicted from, so it never bears loss. For the open sequence, the fitting item with the largest dot product of demand and room left,
both as shares of the capacities, is placed next. Items may be cut: when none fits whole, the longest one is cut to
fill the sequence, and what remains of it is an item again. A document's whole stretches of ``tokens`` fill sequences
of their own.

Each task packs its own rows in their order, with a bounded pool of items, so nothing is shuffled. A sequence that
ends before its capacity (it ran out of segments or loss-bearing tokens, or it is the last of its task) is cut back to
a power of two, which needs no padding; the rest goes on as new items.

With all tokens loss-bearing a sequence of s pieces holds at most ``tokens`` - s of them, so the default third capacity
binds on no plain document; it does on examples with spans of loss, or if set lower.

Defined results: a null or empty text is the end id alone. Null spans of loss are the whole example, no spans are none
of it. Null ids and repeated rows are documents like any other. An
empty table gives an empty table. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.byte_bpe import shared_bpe

END_ID = 0


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 64
    loss_tokens: int = 1023


@dataclass(frozen=True)
class Piece:
    """``length`` ids of a document from ``start`` on; the first id of a piece bears no loss."""

    doc: int
    start: int
    length: int


@dataclass(frozen=True)
class Placed:
    piece: Piece
    sequence: int
    offset: int


class Packer:
    """Packs pieces as they come; ``pool``: most items that wait."""

    #: Columns of ``items``.
    DOC, START, LENGTH, LOSS = range(4)

    def __init__(self, limits: Limits = Limits(), pool: int = 1024, cut: bool = True) -> None:
        if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
            raise ValueError("every capacity is at least 1")
        self.limits, self.pool, self.cut, self.sequences = limits, pool, cut, 0
        #: Longest piece that fits a sequence of its own.
        self.longest = min(limits.tokens, limits.loss_tokens + 1)
        self.room = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.items = np.zeros((2 * pool + limits.segments, 4), np.int64)
        self.waiting = np.zeros(len(self.items), bool)
        self.share = np.zeros((len(self.items), 3))  # demand by capacity
        self.positions: dict[int, np.ndarray] = {}  # document: its loss-bearing positions, if not all

    def add(self, doc: int, length: int, positions: np.ndarray | None = None) -> Iterator[Placed]:
        """Takes a document; gives the pieces whose places are settled by now.

        ``positions``: those of its loss-bearing tokens, ascending; None for all.
        """
        if positions is not None:
            self.positions[doc] = positions
        if not self.cut and self._reach(doc, 0, length, self.limits.tokens, self.limits.loss_tokens) < length:
            raise ValueError(f"an example of {length} tokens, {self.demand(doc, 0, length)} of them loss-bearing, "
                             "does not fit, and cutting is off")
        start = 0
        while start < length:
            taken = self._reach(doc, start, length - start, self.limits.tokens, self.limits.loss_tokens)
            if taken == self.limits.tokens or positions is None and taken == self.longest:
                yield from self._close([Piece(doc, start, taken)])
            else:
                self._wait(int(self.waiting.argmin()), doc, start, taken)
            start += taken
            if np.count_nonzero(self.waiting) >= self.pool:
                yield from self._pack(self.pool // 2)

    def demand(self, doc: int, start: int, length: int) -> int:
        """The loss-bearing tokens of a piece."""
        at = self.positions.get(doc)
        if at is None:
            return length - 1
        return int(np.searchsorted(at, start + length) - np.searchsorted(at, start + 1))

    def _reach(self, doc: int, start: int, length: int, tokens: int, loss: int) -> int:
        """The longest piece from ``start`` on within ``tokens`` and ``loss``: at least one token."""
        at = self.positions.get(doc)
        if at is None:
            return min(length, tokens, loss + 1)
        over = int(np.searchsorted(at, start + 1)) + loss  # the first position that is too many
        return min(length, tokens, int(at[over]) - start if over < len(at) else length)

    def finish(self) -> Iterator[Placed]:
        yield from self._pack(0)

    def _wait(self, slot: int, doc: int, start: int, length: int) -> None:
        loss = self.demand(doc, start, length)
        self.items[slot] = doc, start, length, loss
        self.share[slot] = (length, 1, loss) / self.room
        self.waiting[slot] = True

    def _close(self, pieces: list[Piece]) -> list[Placed]:
        out, offset = [], 0
        for p in pieces:
            out.append(Placed(p, self.sequences, offset))
            offset += p.length
        self.sequences += 1
        return out

    def _pack(self, leave: int) -> Iterator[Placed]:
        """Fills sequences until at most ``leave`` items wait."""
        while np.count_nonzero(self.waiting) > leave:
            chosen = self._fill()
            total = sum(p.length for p in chosen)
            if self.cut and total < self.limits.tokens and total & (total - 1):
                chosen = self._cut_back(chosen, 1 << (total.bit_length() - 1))
            yield from self._close(chosen)

    def _fill(self) -> list[Piece]:
        """The pieces of one sequence, taken out of the items."""
        tokens, segments, loss = self.limits.tokens, self.limits.segments, self.limits.loss_tokens
        lengths, demands, chosen = self.items[:, self.LENGTH], self.items[:, self.LOSS], []
        while tokens and segments:
            fits = self.waiting & (lengths <= tokens) & (demands <= loss)
            if fits.any():
                worth = self.share @ (np.array([tokens, segments, loss]) / self.room)
                best = int(np.where(fits, worth, -1).argmax())
            elif self.cut and self.waiting.any():
                best = int(np.where(self.waiting, lengths, -1).argmax())
            else:
                break
            doc, start, length, demand = self.items[best].tolist()
            taken = self._reach(doc, start, length, tokens, loss)
            self.waiting[best] = False
            if taken < length:
                self._wait(best, doc, start + taken, length - taken)
                demand = self.demand(doc, start, taken)
            chosen.append(Piece(doc, start, taken))
            tokens, segments, loss = tokens - taken, segments - 1, loss - demand
        return chosen

    def _cut_back(self, pieces: list[Piece], tokens: int) -> list[Piece]:
        """The first ``tokens`` tokens of ``pieces``; the rest waits again."""
        kept = []
        for p in pieces:
            length = min(p.length, tokens)
            tokens -= length
            if length:
                kept.append(Piece(p.doc, p.start, length))
            if length < p.length:
                self._wait(int(self.waiting.argmin()), p.doc, p.start + length, p.length - length)
        return kept


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   limits: Limits = Limits(), pool: int = 1024, loss_col: str | None = None) -> DataFrame:
    """A row a piece: doc_id, start, length, ids (unsigned 32-bit little-endian), doc_tokens, sequence_id, offset; with
    ``loss_col`` also loss_positions, those of the piece's loss-bearing ids, counted from its first.

    ``tokenizer`` is the path of a byte-level BPE file that every executor has. ``loss_col``: an array of (start, end)
    structs, the spans of the text that bear loss (code points, end exclusive). An id bears loss if it holds a part of
    a span; the end id stands for one code point after the text. Without the column all ids bear loss.
    """
    slim = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"),
                       *([docs[loss_col].alias("loss")] if loss_col else []))
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    names += ["loss_positions"] if loss_col else []
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, packer = shared_bpe(tokenizer), Packer(limits, pool)
        first = TaskContext.get().partitionId() << 40
        waiting: dict[int, list] = {}  # document: id, its ids, ids not yet given out, loss-bearing positions
        rows: list[tuple] = []
        id_type = pa.null()

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(),
                     pa.list_(pa.int64())][:len(names)]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
            rows.clear()
            return out

        def place(settled: Iterator[Placed]) -> None:
            for x in settled:
                p, entry = x.piece, waiting[x.piece.doc]
                ids = entry[1]
                rows.append((entry[0], p.start, p.length, ids[4 * p.start:4 * (p.start + p.length)], len(ids) // 4,
                             first + x.sequence, x.offset, *([_part(entry[3], p)] if loss_col else [])))
                entry[2] -= p.length
                if not entry[2]:
                    del waiting[p.doc]
                    packer.positions.pop(p.doc, None)

        count = 0
        for batch in batches:
            id_type = batch.column("doc_id").type
            for k, (doc_id, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True)):
                ids, positions = bpe.ids(text.as_py()) + END_ID.to_bytes(4, "little"), None
                if loss_col and (spans := batch.column("loss")[k].as_py()) is not None:
                    positions = loss_positions(text.as_py(), [tuple(x.values()) for x in spans], bpe.sizes(ids[:-4]))
                waiting[count] = [doc_id, ids, len(ids) // 4, positions]
                place(packer.add(count, len(ids) // 4, positions))
                count += 1
                if len(rows) >= 2000:
                    yield batch_of()
        place(packer.finish())
        if rows:
            yield batch_of()

    return slim.mapInArrow(run, f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
                                "sequence_id bigint, offset bigint" + ", loss_positions array<bigint>" * bool(loss_col))


def loss_positions(text: str, spans: list[tuple[int, int]], sizes: np.ndarray) -> np.ndarray:
    """The ids that hold a part of ``spans`` (code points of ``text``); ``sizes``: bytes of each id but the end's."""
    starts = np.cumsum(np.append(0, sizes))  # the last one is the end id's
    chars = np.frombuffer(text.encode("utf-32-le"), "<u4")
    at = np.cumsum(np.concatenate([[0], 1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF), [1]]))
    found = np.zeros(len(starts), bool)
    for start, end in spans:
        start, end = max(start, 0), min(end, len(text) + 1)
        if start < end:
            found[np.searchsorted(starts, at[start], "right") - 1:np.searchsorted(starts, at[end])] = True
    return np.flatnonzero(found)


def _part(positions: np.ndarray | None, piece: Piece) -> list[int]:
    """The loss-bearing positions of a piece, from its first id on, which bears none."""
    if positions is None:
        return list(range(1, piece.length))
    low, high = np.searchsorted(positions, [piece.start + 1, piece.start + piece.length])
    return (positions[low:high] - piece.start).tolist()
