import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerlake.llm import token_alignment as T
from ledgerlake.llm.byte_bpe import byte_alphabet
from ledgerlake.llm.queries import BYTE_BPE, PIECE_BPE, tokenizer_path
from tests.llm.cases import SCHEMA, hard_docs, hard_rows, no_docs, row

A = Tokenizer.from_file(tokenizer_path(BYTE_BPE))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_BPE))
STANDS = {c: b for b, c in enumerate(byte_alphabet())}
ENTRIES = {k: bytes(STANDS[c] for c in t) for t, k in A.get_vocab().items() if t != "<|endoftext|>"}


def b_bytes(k):
    piece = B.id_to_piece(k)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(k) else piece.replace("▁", " ").encode()


def groups_of(text):
    """[(A ids, B ids)] by the libraries, by walking both sides' ends."""
    if not text:
        return []
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    want = (" " + text).encode()
    if b"".join(ENTRIES[k] for k in a) != want or b"".join(b_bytes(k) for k in b) != want:
        return []
    out, left, right, i, j, at_a, at_b = [], [], [], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            left.append(a[i])
            at_a += len(ENTRIES[a[i]])
            i += 1
        else:
            right.append(b[j])
            at_b += len(b_bytes(b[j]))
            j += 1
        if at_a == at_b:
            out.append((left, right))
            left, right = [], []
    return out


def brute(rows):
    groups = [groups_of(r[1]) for r in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    counts = Counter(p for c in links for p in c)
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for r, g, c in zip(rows, groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((r[0], sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
                    sum(n for p, n in c.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in c.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=repr)


EXTRA = [row(k, t) for k, t in enumerate([
    "a ", " a", "  a  b ", "\n", " ", "x ▁y", "<|endoftext|> and <s> </s> <unk> <0x41>", "é ﬁ ﷺ", "tab\tand\x00nul \x1c\x85 z",
    "can't  won't\n\n  do  it\r\n", "🙂🙂 👩‍👩‍👧 " * 3, "==========" * 40 + "...", "ab" * 500, "　wide spaces   x",
    "the the the the", "1234567890" * 30, "ÿĀ߿ࠀ" * 20], 200)]


def found_by(docs):
    from pyspark.sql import functions as F
    found = T.alignment(docs, tokenizer_path(BYTE_BPE), tokenizer_path(PIECE_BPE))
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)


@pytest.mark.parametrize("hot,wide,part", [(T.HOT_PAIRS, T.WIDE_GROUP, T.PART_CHARS), (50, 1, 500)])
def test_matches_brute_force(spark, monkeypatch, hot, wide, part):
    monkeypatch.setattr(T, "WIDE_GROUP", wide)
    monkeypatch.setattr(T, "PART_CHARS", part)
    monkeypatch.setattr(T.weigh, "__defaults__", (hot,))
    rows = hard_rows() + EXTRA
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert sorted(map(tuple, found_by(docs).collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    assert found_by(no_docs(spark)).collect() == []


def test_overlaps_are_all_pairs_that_share_a_byte():
    rng = random.Random(2)
    for _ in range(200):
        a_doc, a_size, b_doc, b_size = [], [], [], []
        for d in range(rng.randint(1, 3)):
            n = rng.randint(1, 30)
            for doc, size in ((a_doc, a_size), (b_doc, b_size)):
                cuts = sorted({0, n, *rng.sample(range(n + 1), rng.randint(0, n))})
                size += [y - x for x, y in zip(cuts, cuts[1:])]
                doc += [d] * (len(cuts) - 1)
        left, right, ends = T.overlaps(*map(np.array, (a_doc, a_size, b_doc, b_size)))
        a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
        want = [(i, j, a_end[i] == b_end[j]) for i in range(len(a_end)) for j in range(len(b_end))
                if max(a_end[i] - a_size[i], b_end[j] - b_size[j]) < min(a_end[i], b_end[j])]
        assert list(zip(left, right, ends)) == want


def test_hard_docs_keep_their_rows(spark):
    assert found_by(hard_docs(spark)).count() == len(hard_rows())
