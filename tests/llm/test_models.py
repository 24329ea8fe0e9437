"""Language ID, quality and language-model scoring: held-out accuracy, brute-force statistics, hard rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import language_id, lm_score, quality
from ledgerlake.llm.queries import op1_language_id, op3_quality, op5_lm_score
from tests.llm.cases import SCHEMA, hard_docs, hard_rows, no_docs, prose, row, words_of

SF = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


# -- language ID

def test_term_counts_are_those_of_all_grams():
    terms, counts = language_id.term_counts("Öl 12")
    assert counts.sum() == 2 + 3 + 2  # two letters; " ö", "öl", "l "; " öl", "öl "
    assert len(language_id.term_counts("12 !!")[0]) == 0 and len(language_id.term_counts("")[0]) == 0
    assert (language_id.term_counts("ab cd")[0] == language_id.term_counts("AB,--CD")[0]).all()


def test_language_accuracy_on_held_out_rows(spark):
    found = op1_language_id(spark, SF).join(table(spark, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == table(spark, "documents").count()
    assert all(r["held_out"] == (fold(r["doc_id"], 3) == 1) for r in found)
    held = [r["lang_pred"] == r["lang"] for r in found if r["held_out"]]
    assert np.mean(held) >= 0.95 and all(0 <= r["score"] <= 1 for r in found)


def test_document_frequencies_cover_all_rows(spark):
    docs = hard_docs(spark).select(F.coalesce("text", F.lit("")).alias("text"))
    seen, rows = language_id.document_frequencies(docs)
    want = Counter(t for r in hard_rows() for t in language_id.term_counts(r[1] or "")[0].tolist())
    assert {k: int(seen[k]) for k in np.flatnonzero(seen)} == dict(want)
    assert rows == sum(len(language_id.term_counts(r[1] or "")[0]) > 0 for r in hard_rows())


def test_calibration_finds_the_temperature():
    rng = np.random.default_rng(0)
    model = language_id.Model(["a", "b"], np.ones(1 << 14), np.zeros((1 << 14, 2)), np.zeros(2))
    logits = rng.normal(0, 1, (4000, 2))
    p = language_id._softmax(logits)
    labels = (rng.random(4000) > p[:, 0]).astype(int)
    model.logits = lambda terms, counts: 3 * logits[terms]
    rows = [(model.languages[y], k, None) for k, y in enumerate(labels)]
    assert 2.5 < language_id.calibrate(model, rows) < 3.5


def test_l1_makes_weights_sparse():
    rows = [(lang, *language_id.term_counts(prose(lang, k))) for lang in ("de", "en") for k in range(30)]
    model = language_id.Model(["de", "en"], np.ones(1 << 14), np.zeros((1 << 14, 2)), np.zeros(2))
    language_id.train_ftrl(model, rows)
    seen = len({t for _, terms, _ in rows for t in terms})
    assert 0 < np.count_nonzero(model.weights.any(axis=1)) < seen
    assert model.predict(prose("de", 99))[0] == "de"


def test_language_of_hard_rows(spark):
    docs = hard_docs(spark)
    model = language_id.fit(docs, F.lit(True))
    out = language_id.predict(docs, model)
    assert out.schema["row"].dataType.names == docs.columns and out.count() == len(hard_rows())
    got = {r["row"]["doc_id"]: (r["lang_pred"], r["score"]) for r in out.collect()}
    assert all(got[k] == ("und", 0.0) for k in (1, 2, 3, 4, 5)) and got[13][0] != "und"
    nothing = language_id.fit(no_docs(spark), F.lit(True))
    assert {(r["lang_pred"], r["score"]) for r in language_id.predict(docs, nothing).collect()} == {("und", 0.0)}
    assert language_id.predict(no_docs(spark), model).collect() == []


# -- quality

def test_quality_on_held_out_rows(spark):
    found = op3_quality(spark, "/root/testdata/sf0.01").collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(found) == 1000
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    held = [(r["score"], labels[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad]) >= 0.95
    assert np.mean([(s >= 0.3) == y for s, y in held]) >= 0.9


def test_quality_features_do_not_depend_on_block_size(monkeypatch):
    text = (prose("fr", 1, 500) + "\n").encode() * 3
    whole, blocks = quality.features(text), quality.word_blocks
    monkeypatch.setattr(quality, "word_blocks", lambda data: blocks(data, 300))
    moved = np.flatnonzero(np.abs(quality.features(text) - whole) > 1e-9)
    assert moved.tolist() in ([], [quality.FEATURES - 4])  # only windows of words begin anew with a block
    assert not quality.features(b"").any()


def test_pairs_rank_the_better_text_higher():
    good = np.array([quality.features(prose("en", k).encode()) for k in range(30)])
    bad = np.array([quality.features((f"w{k} " * 40).encode()) for k in range(30)])
    ranker = quality.train_pairs(good, bad)
    assert ranker.score(prose("en", 77).encode()) > ranker.score(b"z " * 50)


def test_quality_of_hard_rows(spark):
    docs = hard_docs(spark)
    labels = spark.createDataFrame([(k, k % 2, "s") for k in range(100, 160)] + [(100, 1, "s"), (None, 1, "s"), (101, None, "s"),
                                   (102, 7, "s")], "doc_id long, quality int, text string")
    found = quality.classify(docs, labels, F.lit(True)).collect()
    assert len(found) == len(hard_rows()) and all(0 <= r["score"] <= 1 for r in found)
    assert {r["doc_id"]: r["label"] for r in quality.clear_labels(labels, "doc_id", "quality").collect()} == {
        k: k % 2 for k in range(101, 160)}
    none = quality.classify(docs, labels.limit(0), F.lit(True)).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.3, 1)}
    assert quality.classify(no_docs(spark), labels, F.lit(True)).collect() == []


# -- language-model scores

def brute_base(rows, learn):
    counts = Counter()
    for doc_id, text in rows:
        if learn(doc_id):
            counts.update([*words_of(text), b""])
    total, whole = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    out = []
    for doc_id, text in rows:
        words = [*words_of(text), b""]
        out.append((doc_id, len(words), sum(counts[w] > 0 for w in words), total,
                    sum(math.log10((counts[w] + 0.5) / whole) for w in words)))
    return out


def same(found, want):
    found = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in found),
                   key=lambda r: repr(r[:2]))
    want = sorted(want, key=lambda r: repr(r[:2]))
    assert [r[:4] for r in found] == [r[:4] for r in want]
    assert [r[4] for r in found] == pytest.approx([r[4] for r in want], rel=1e-9)


def test_base_scores_and_gain_over_them(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    found = op5_lm_score(spark, SF).collect()
    same(found, brute_base(rows, lambda k: fold(k, 5) != 1))
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) * 0.95  # scores are negative
    assert all(r["score"] < 0 for r in found)


@pytest.mark.parametrize("hot_parts", [5, 500_000])
def test_base_scores_of_hard_rows(spark, hot_parts):
    rows = [(r[0], r[1]) for r in hard_rows()]
    found = lm_score.score(hard_docs(spark), F.col("doc_id") % 3 != 0, hot_parts=hot_parts).collect()
    same(found, brute_base(rows, lambda k: k is not None and k % 3 != 0))


def test_nothing_to_learn_from(spark):
    found = lm_score.score(hard_docs(spark), F.lit(False)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in found} == {(0, 0, 0.0)}
    assert lm_score.score(no_docs(spark), F.lit(True)).collect() == []


def test_probabilities_of_all_words_sum_to_one(spark):
    """The scores of all one-word texts, known and new, against those of the empty text's end."""
    texts = ["a a a b b c", "a b b d", "c a e f"] * 5
    counts = Counter(w for t in texts for w in t.split())
    rows = [row(k, t) for k, t in enumerate(texts)]
    probe = [row(1000 + k, w) for k, w in enumerate([*counts, "newword"])]
    found = lm_score.score(spark.createDataFrame(rows + probe, SCHEMA), F.col("doc_id") < 1000).collect()
    score = {r["doc_id"]: r["score"] for r in found}
    words = lm_score.make_vocabulary(lm_score.word_counts(spark.createDataFrame(rows, SCHEMA).selectExpr(
        "CAST(text AS binary) AS text")), 65)
    assert words.class_count[0] == 15 and words.class_count.sum() == 15 + 70
    assert all(10 ** score[1000 + k] < 1 for k in range(len(counts) + 1))


def test_class_probabilities_are_normalised_and_learnt():
    rng = np.random.default_rng(1)
    docs = [np.tile([2, 3, 4], 40) for _ in range(20)] + [np.tile([5, 6], 60) for _ in range(20)]
    count = np.bincount(np.concatenate(docs), minlength=8).astype(float)
    model = lm_score.LogBilinear(count)
    state = model.fresh_state()
    for _ in range(30):
        model.train(docs, rng, state, batch=256)
    after = [[2, 3, k] for k in range(8)]
    p = [np.exp(model.log_probabilities([np.array(d)])[-1]) for d in after]
    assert sum(p) == pytest.approx(1, abs=1e-4) and p[4] > 0.8


def test_each_context_is_scored_once(monkeypatch):
    rng = np.random.default_rng(3)
    docs = [np.append(rng.integers(1, 4, rng.integers(0, 60)), 0) for _ in range(40)]
    model = lm_score.LogBilinear(np.bincount(np.concatenate(docs), minlength=6).astype(float))
    target, context = model.contexts(docs)
    assert target.tolist() == np.concatenate(docs).tolist()
    padded = [[0, 0, 0, *d] for d in docs]
    assert context.T.tolist() == [[d[k - 1], d[k - 2], d[k - 3]] for d in padded for k in range(3, len(d))]
    out, into, mix, bias = model.parameters
    scores = sum(into[c] * mix[k] for k, c in enumerate(context)) @ out.T + bias
    want = scores[np.arange(len(target)), target] - np.log(np.exp(scores).sum(axis=1))
    rows, real = [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, **how: (rows.append(len(x)), real(x, **how))[1])
    found = model.log_probabilities(docs, chunk=7)
    assert np.allclose(found, want, atol=1e-5) and sum(rows) == len(set(zip(*context.tolist()))) < len(target)


def test_classes_of_a_text_by_the_map():
    words = lm_score.Vocabulary({b"the": 0, lm_score.END: 1, b"running": 2}, np.array([2, 0, 3, 1]), np.ones(4), {b"ng": 3},
                                np.ones(4), np.ones(4))
    known = words.class_map()
    for text in (b"", b"The end of running \xc3\xa9\n the x sing", b" a "):
        assert lm_score.text_classes(text, known).tolist() == words.classes(*words.places(text)).tolist()
    assert set(known) == set(words.hot)  # nothing is kept of other words
