from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlake.llm.packing import Limits, Packer, pack_documents
from ledgerlake.llm.queries import BYTE_BPE, tokenizer_path
from tests.llm.cases import hard_docs, hard_rows, no_docs

SHORT = Limits(tokens=64, segments=4, loss_tokens=60)


def packed(lengths, limits, pool=16, cut=True):
    packer, out = Packer(limits, pool, cut), []
    for k, n in enumerate(lengths):
        out += packer.add(k, n)
    return out + list(packer.finish())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 200), max_size=60), st.sampled_from([SHORT, Limits(64, 64, 63), Limits(50, 3, 20)]))
def test_every_token_once_within_all_limits(lengths, limits):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for x in packed(lengths, limits):
        pieces[x.piece.doc].append((x.piece.start, x.piece.length))
        sequences[x.sequence].append((x.offset, x.piece.length))
    for doc, n in enumerate(lengths):
        at = 0
        for start, length in sorted(pieces[doc]):
            assert start == at and length > 0
            at += length
        assert at == n
    for parts in sequences.values():
        total = 0
        for offset, length in sorted(parts):
            assert offset == total
            total += length
        assert total <= limits.tokens and len(parts) <= limits.segments
        assert total - len(parts) <= limits.loss_tokens
        longest = min(limits.tokens, limits.loss_tokens + 1)  # of one piece
        assert total in (limits.tokens, longest) or total & (total - 1) == 0  # full, or a power of two


def test_whole_examples_are_not_cut():
    lengths = [30, 40, 20, 10, 64, 1, 1, 1, 1, 1]
    placed = packed(lengths, Limits(64, 4, 63), cut=False)
    assert sorted((x.piece.doc, x.piece.length) for x in placed) == list(enumerate(lengths))
    with pytest.raises(ValueError):
        packed([65], Limits(64, 4, 63), cut=False)


def test_the_largest_dot_product_goes_first():
    placed = packed([10, 40, 24], Limits(64, 8, 63), pool=100)
    first = [x.piece.doc for x in placed if x.sequence == 0]
    assert first == [1, 2]


def test_rows(spark):
    path = tokenizer_path(BYTE_BPE)
    library, texts = Tokenizer.from_file(path), defaultdict(list)
    for r in hard_rows():
        texts[r[0]].append(library.encode(r[1] or "", add_special_tokens=False).ids + [0])
    docs, sizes = defaultdict(list), defaultdict(list)
    for r in pack_documents(hard_docs(spark), path).collect():
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] and 0 <= r["start"] < r["doc_tokens"]
        docs[r["doc_id"]].append((r["start"], ids, r["doc_tokens"]))
        sizes[r["sequence_id"]].append((r["offset"], r["length"]))
    assert docs.keys() == texts.keys()
    for doc, wholes in texts.items():
        assert sum(len(i) for _, i, _ in docs[doc]) == sum(map(len, wholes))
        if len(wholes) == 1:
            assert [x for _, i, _ in sorted(docs[doc]) for x in i] == wholes[0]
            assert {n for _, _, n in docs[doc]} == {len(wholes[0])}
    for parts in sizes.values():
        total = sum(n for _, n in parts)
        assert sorted(o for o, _ in parts) == np.cumsum([0] + [n for _, n in sorted(parts)])[:-1].tolist()
        assert total <= 1024 and (total == 1024 or total & (total - 1) == 0)
    assert pack_documents(no_docs(spark), path).collect() == []
