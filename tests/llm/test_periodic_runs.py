import hashlib
import random
import zlib

import pytest

from ledgerlake.llm import periodic_runs as P
from tests.llm.cases import SCHEMA, hard_docs, hard_rows, no_docs, row


def brute(words, least=12):
    """Every stretch that cannot be extended, by each period in ascending order: the first period is the smallest."""
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q) and j > i:
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def tail(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words or doc_id is None:
        return words
    a = (h // 10) % len(words)
    p = 1 + (len(words) - a) // (3 + (h // 10) % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]


def want(doc_id, text):
    words = tail((text or "").encode().split(), doc_id)
    runs = sorted(brute(words), key=lambda r: (r[0], r[2]))
    drop = {k for s, n, q in runs for k in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for k, w in enumerate(words) if k not in drop)
    return (doc_id, len(runs), *(top or (None, None, None)), 1000 * top[1] // top[2] if top else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_texts(seed):
    rng = random.Random(seed)
    for _ in range(250):
        texts = []
        for _ in range(rng.randint(1, 4)):
            words = [b"abcde"[k:k + 1] for k in rng.choices(range(rng.choice([1, 2, 3, 5])), k=rng.randint(0, 80))]
            if words and rng.random() < 0.5:
                words = (words[:rng.randint(1, len(words))] * 9)[:rng.randint(1, 100)] + words[:5]
            texts.append(words)
        least = rng.choice([2, 5, 12])
        assert P.runs_of(texts, least) == [sorted(brute(w, least), key=lambda r: (r[0], r[2])) for w in texts]


def test_runs_do_not_cross_documents():
    assert P.runs_of([[b"x"] * 7, [b"x"] * 7, []]) == [[], [], []]


def test_long_periodic_texts():
    assert P.runs_of([[b"x"] * 100_000]) == [[(0, 100_000, 1)]]
    assert P.runs_of([[b"a", b"b", b"c"] * 20_000 + [b"a"]]) == [[(0, 60_001, 3)]]
    a, b = b"a", b"ab"
    while len(b) < 30_000:  # Fibonacci words hold very many runs
        a, b = b, b + a
    words = [bytes([x]) for x in b[:400]]
    assert P.runs_of([words]) == [sorted(brute(words), key=lambda r: (r[0], r[2]))]
    assert len(P.runs_of([[bytes([x]) for x in b]])[0]) > 9000


def test_ordered_positions():
    rng = random.Random(1)
    given = rng.sample(range(100_000), 6000)
    found = P.Positions(sorted(given[:2]))
    for x in given[2:]:
        found.add(x)
    order = sorted(given)
    assert list(found) == order and found.size == 6000
    for k in (0, 1, 2999, 5998, 5999):
        near = found.around(order[k])
        assert near == (order[k - 1] if k else None, order[k + 1] if k < 5999 else None)


@pytest.mark.parametrize("part", [P.PART_CHARS, 300])
def test_query_rows(spark, monkeypatch, part):
    monkeypatch.setattr(P, "PART_CHARS", part)
    rng = random.Random(4)
    rows = hard_rows() + [row(k, " ".join(rng.choices("abc", k=rng.randint(0, 60)))) for k in range(300, 420)]
    rows += [row(500, "go on " * 9), row(501, "one two three four five six " * 2), row(502, "A a " * 6), row(503, "x\x1cy " * 12)]
    found = P.digest(P.periodic_runs(spark.createDataFrame(rows, SCHEMA).repartition(3), change=P.repeat_tail))
    rows = [r for r in rows if r[0] != 10]  # 30,000 words: too slow by brute force
    got = [tuple(r) for r in found.collect() if r["doc_id"] != 10]
    assert sorted(got, key=repr) == sorted((want(r[0], r[1]) for r in rows), key=repr)


def test_general_interface(spark):
    docs = spark.createDataFrame([row(1, "so it goes " * 5 + "end")], SCHEMA)
    found = P.periodic_runs(docs).first()
    assert [tuple(r) for r in found["runs"]] == [(0, 15, 3)] and found["collapsed"] == "so it goes end"
    assert P.periodic_runs(docs, least=16).first()["runs"] == []


def test_empty_and_hard_tables(spark):
    assert P.digest(P.periodic_runs(no_docs(spark))).collect() == []
    assert P.periodic_runs(hard_docs(spark)).count() == len(hard_rows())
