import hashlib
import random
import re
from collections import defaultdict

import pytest

from ledgerlake.llm import decontamination as D
from tests.llm.cases import SCHEMA, hard_docs, hard_rows, no_docs, row

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, row long, term string, phrase string, n int"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, size=10):
    wanted = defaultdict(set)
    for item_id, text in items:
        w = words(text)
        for k in range(max(len(w) - size, 0) + 1):
            if w:
                wanted[tuple(w[k:k + size])].add(item_id)
    out = []
    for r in rows:
        w, hit, found = words(r[1]), set(), set()
        for n in {len(x) for x in wanted}:
            for k in range(len(w) - n + 1):
                if (ids := wanted.get(tuple(w[k:k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= ids
        ids = sorted(str(x) for x in found if x is not None)
        out.append((r[0], len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def items_of(spark, items):
    return spark.createDataFrame([(i, t, 1, "t", "p", 2) for i, t in items], ITEMS)


def check(spark, rows, items):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = D.digest(D.decontaminate(docs, items_of(spark, items)))
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows, items)


LONG = " ".join(f"w{k}" for k in range(25))
HARD_ITEMS = [(1, LONG), (2, "same text here NOW"), (3, None), (4, " ,;: "), (5, "日本語 テキスト"), (None, "said twice over"),
              (10, "lost"), (10, "password Hunter2222"), (7, "a a a a a a a a a a a"), (8, "never occurs anywhere"),
              (9, LONG), (1, LONG)]


def test_hard_rows(spark):
    rows = hard_rows() + [row(50, f"x {LONG.upper()}, y"), row(51, LONG[:-2]), row(52, "a " * 40), row(53, f"{LONG} {LONG}"),
                          row(54, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 É w3"), row(55, f"a a a {LONG} a")]
    check(spark, rows, HARD_ITEMS)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_of_few_words(spark, seed):
    rng = random.Random(seed)

    def text(most):
        return "".join(rng.choice(["a", "b", "B", "c9"]) + rng.choice([" ", ". ", "\n"]) for _ in range(rng.randint(0, most)))
    check(spark, [row(k, text(120)) for k in range(60)], [(k, text(14)) for k in range(12)])


@pytest.mark.parametrize("limit", ["MAX_TERMS", "SLOTS"])
def test_tables_over_the_broadcast_bound(spark, monkeypatch, limit):
    monkeypatch.setattr(D, limit, 1)
    monkeypatch.setattr(D, "HOT_PARTS", 20)
    rng = random.Random(5)
    rows = [row(k, " ".join(rng.choices("abcdefgh", [40, 9, 8, 7, 6, 5, 4, 1], k=150))) for k in range(40)] + hard_rows()
    check(spark, rows, [(k, " ".join(rng.choices("abcdefgh", k=3 + k % 9))) for k in range(20)] + HARD_ITEMS)


def test_empty_tables(spark):
    assert D.digest(D.decontaminate(no_docs(spark), items_of(spark, HARD_ITEMS))).collect() == []
    found = D.digest(D.decontaminate(hard_docs(spark), items_of(spark, [])))
    assert sorted(map(tuple, found.collect()), key=repr) == brute(hard_rows(), [])


def test_whole_vocabulary_index_answers_the_same(spark):
    items = items_of(spark, HARD_ITEMS)
    docs = hard_docs(spark).union(spark.createDataFrame([row(60, f"z {LONG}")], SCHEMA))
    phrases = (D.windows(items).selectExpr("window AS terms").distinct().selectExpr("hash(terms) AS phrase", "terms"))
    whole, part = D.build_index(docs), D.build_index(docs, phrases.selectExpr("explode(terms) AS word"))
    assert whole.postings.count() > part.postings.count()

    def places(index):
        ids = {r["row"]: r["doc_id"] for r in index.postings.filter(f"term = {D.END}").collect()}
        return sorted(((ids[r["row"]], r["start"], r["phrase"]) for r in D.occurrences(phrases, index).collect()), key=repr)
    assert places(whole) == places(part) != []


def test_proximity(spark):
    rng = random.Random(3)
    texts = {k: rng.choices("abcdefghijklmnop", k=120) for k in range(30)}
    items = {1: "a b c", 2: "p", 3: "a a a b", 4: "e f g h i", 5: "zzz a", 6: ""}
    span = 7
    docs = spark.createDataFrame([row(k, " ".join(w)) for k, w in texts.items()], SCHEMA)
    index = D.build_index(docs)
    ids = {r["row"]: r["doc_id"] for r in index.postings.filter(f"term = {D.END}").collect()}
    found = D.proximity(spark.createDataFrame([*items.items()], "item_id long, text string"), index, span)
    want = set()
    for k, w in texts.items():
        for i, text in items.items():
            need = set(text.split())
            for s in range(len(w)):
                if need and w[s] in need and need <= set(w[s:s + span]):
                    want.add((k, i, s, next(e for e in range(s, s + span) if need <= set(w[s:e + 1]))))
    rows = [(ids[r["row"]], r["item_id"], r["start"], r["end"]) for r in found.collect()]
    assert len(rows) == len(want) > 20 and set(rows) == want


def test_a_passage_in_a_third_of_all_texts(spark):
    check(spark, [row(k, f"x{k} {LONG} y" if k % 3 == 0 else f"w1 w2 w3 {k}") for k in range(1500)], [(1, LONG), (2, LONG[30:])])


def test_runs_without_python(spark):
    found = D.digest(D.decontaminate(hard_docs(spark), items_of(spark, HARD_ITEMS)))
    assert not any(x in found._jdf.queryExecution().toString() for x in ("Python", "Pandas", "Arrow"))
