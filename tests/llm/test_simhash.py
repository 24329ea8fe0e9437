import random
from collections import defaultdict

import pytest
import xxhash

from ledgerlake.llm import simhash
from tests.llm.cases import hard_docs, hard_rows, no_docs, words_of


def brute_fingerprint(text, n=3):
    words = words_of(text)
    if not words:
        return 0
    shingles = [b" ".join(words[k:k + n]) for k in range(len(words) - n + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, distance=2):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def partition(pairs):
    groups = defaultdict(set)
    for node, name in pairs:
        groups[name].add(node)
    return sorted(map(sorted, groups.values()))


def near_fingerprints(seed=3, groups=30, size=40):
    """Random centres, each with members that differ in up to four bits."""
    rng, out = random.Random(seed), set()
    for _ in range(groups):
        centre = rng.getrandbits(64)
        for _ in range(rng.randint(1, size)):
            x = centre
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << bit
            out.add(x)
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_match_brute_force():
    for r in hard_rows():
        if len(r[1] or "") < 10_000:
            assert simhash.fingerprint((r[1] or "").encode()) == signed(brute_fingerprint(r[1]))


def test_long_texts_are_read_whole_in_blocks(monkeypatch):
    text = " ".join(random.Random(1).choice(["ab", "cd", "ef\n", "gh"]) for _ in range(3000))
    whole = simhash.fingerprint(text.encode())
    blocks = simhash.word_blocks
    monkeypatch.setattr(simhash, "word_blocks", lambda data: blocks(data, 100))
    assert simhash.fingerprint(text.encode()) == whole == signed(brute_fingerprint(text))


def test_chain_budgets_hold_for_every_close_pair():
    """The strong pigeonring principle, over random pairs within the distance."""
    rng, m, t = random.Random(5), simhash.SEGMENTS, simhash.MAX_DISTANCE
    budgets = simhash.chain_budgets(m, t)
    assert budgets == [0, 0, 1, 1, 2]
    for _ in range(2000):
        differ = sum(1 << b for b in rng.sample(range(64), rng.randint(0, t)))
        assert any(all((differ & simhash._mask(i, n, m) & (2**64 - 1)).bit_count() <= budgets[n - 1]
                       for n in range(1, len(m) + 1)) for i in range(len(m)))


@pytest.mark.parametrize("limit", [128, 3, 1])
def test_links_give_the_components_whatever_the_bucket_limit(spark, limit):
    nodes = near_fingerprints()
    df = spark.createDataFrame([(signed(x),) for x in nodes], "fp long")
    roots = dict(map(tuple, simhash.components(simhash.links(df, bucket_limit=limit)).collect()))
    want = brute_components(nodes)
    assert partition([(signed(x), roots.get(signed(x), signed(x))) for x in nodes]) == partition(
        [(signed(x), y) for x, y in want.items()])


@pytest.mark.parametrize("distance", [0, 1])
def test_other_distances(spark, distance):
    nodes = near_fingerprints(8, 10, 20)
    df = spark.createDataFrame([(signed(x),) for x in nodes], "fp long")
    want = partition([(signed(x), y) for x, y in brute_components(nodes, distance).items()])
    for limit in (100, 1):
        roots = dict(map(tuple, simhash.components(simhash.links(df, distance=distance, bucket_limit=limit)).collect()))
        assert partition([(signed(x), roots.get(signed(x), signed(x))) for x in nodes]) == want


def test_long_chains_become_one_component(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1001)], "u long, v long")
    roots = dict(map(tuple, simhash.components(edges).collect()))
    assert {roots[k] for k in range(301)} == {0} and roots[1001] == 1000


def test_rows_match_brute_force(spark):
    rows = hard_rows()
    prints = {r[1]: brute_fingerprint(r[1]) if len(r[1] or "") < 10_000 else
              simhash.fingerprint(r[1].encode()) % 2**64 for r in rows}
    roots, least = brute_components(set(prints.values())), defaultdict(list)
    for r in rows:
        if r[0] is not None:
            least[roots[prints[r[1]]]].append(r[0])
    want = sorted(((r[0], f"{prints[r[1]]:016x}", min(least[roots[prints[r[1]]]], default=None)) for r in rows), key=repr)
    found = simhash.simhash_components(hard_docs(spark))
    assert sorted(map(tuple, found.collect()), key=repr) == want
    kept = simhash.keep_one_near_copy(hard_docs(spark))
    assert kept.schema == hard_docs(spark).schema
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(
        (i for i, _, c in want if i is None or i == c), key=repr)


def test_empty_table(spark):
    assert simhash.simhash_components(no_docs(spark)).collect() == []
    assert simhash.keep_one_near_copy(no_docs(spark)).collect() == []
