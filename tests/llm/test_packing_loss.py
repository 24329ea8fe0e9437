"""The third capacity: loss-bearing tokens as a demand of their own."""

from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlake.llm.packing import Limits, Packer, loss_positions, pack_documents
from ledgerlake.llm.queries import BYTE_BPE, tokenizer_path


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 200), st.integers(0, 4)), max_size=50),
       st.sampled_from([Limits(64, 8, 10), Limits(64, 4, 63), Limits(50, 3, 1)]))
def test_masked_examples_keep_all_limits(docs, limits):
    packer, placed = Packer(limits, 16), []
    masks = {k: np.arange(n) % 4 < share for k, (n, share) in enumerate(docs)}
    for k, mask in masks.items():
        placed += packer.add(k, len(mask), np.flatnonzero(mask))
    placed += packer.finish()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for x in placed:
        pieces[x.piece.doc].append((x.piece.start, x.piece.length))
        sequences[x.sequence].append(x)
    for doc, mask in masks.items():
        at = 0
        for start, length in sorted(pieces[doc]):
            assert start == at and length > 0
            at += length
        assert at == len(mask)
    for parts in sequences.values():
        assert sum(x.piece.length for x in parts) <= limits.tokens and len(parts) <= limits.segments
        assert sum(int(masks[x.piece.doc][x.piece.start + 1:x.piece.start + x.piece.length].sum())
                   for x in parts) <= limits.loss_tokens


def test_the_loss_limit_binds_and_prompts_do_not_count():
    limits = Limits(64, 8, 10)

    def sequences(positions):
        packer = Packer(limits, 16, cut=False)
        return {x.sequence for k in range(6) for x in packer.add(k, 10, positions)} | {x.sequence for x in packer.finish()}

    assert len(sequences(np.array([8, 9]))) == 2  # five times two loss-bearing tokens a sequence
    assert len(sequences(np.array([], int))) == 1  # all prompt
    assert len(sequences(None)) == 6  # nine each
    with pytest.raises(ValueError):
        list(Packer(limits, 16, cut=False).add(0, 20, np.arange(20)))


def test_positions_of_spans():
    sizes = np.array([1, 2, 3])  # "a", "é", "bcd"
    assert loss_positions("aébcd", [(1, 2)], sizes).tolist() == [1]
    assert loss_positions("aébcd", [(0, 1), (3, 4)], sizes).tolist() == [0, 2]
    assert loss_positions("aébcd", [(4, 6)], sizes).tolist() == [2, 3]  # the end id too
    assert loss_positions("aébcd", [(2, 2)], sizes).tolist() == []


def test_documents_with_spans(spark):
    path = tokenizer_path(BYTE_BPE)
    library, limits = Tokenizer.from_file(path), Limits(64, 8, 12)
    prompt, reply = "what is the größte river? " * 3, "the Amazon, 日本 said so"
    rows = [(k, prompt + reply, [(len(prompt), len(prompt + reply))]) for k in range(20)]
    rows += [(50, prompt * 9, []), (51, reply, None), (52, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans array<struct<start: int, end: int>>")
    found, sequences, ids = defaultdict(set), defaultdict(list), defaultdict(dict)
    for r in pack_documents(docs.coalesce(1), path, limits=limits, loss_col="spans").collect():
        found[r["doc_id"]] |= {r["start"] + p for p in r["loss_positions"]}
        sequences[r["sequence_id"]].append((r["length"], len(r["loss_positions"])))
        ids[r["doc_id"]][r["start"]] = np.frombuffer(r["ids"], "<u4").tolist()
    for doc, text, spans in rows:
        whole = library.encode(text or "", add_special_tokens=False)
        assert [x for _, part in sorted(ids[doc].items()) for x in part] == [*whole.ids, 0]
        bears = {k for k, (a, b) in enumerate(whole.offsets) for s, e in spans or [] if a < e and b > s}
        bears = set(range(len(whole.ids) + 1)) if spans is None else bears
        assert found[doc] == bears - ids[doc].keys()
    for parts in sequences.values():
        assert sum(n for n, _ in parts) <= 64 and len(parts) <= 8 and sum(m for _, m in parts) <= 12
    assert any(sum(n for n, _ in parts) < 64 for parts in sequences.values())
