"""Samples that a classifier is fitted on are bounded by rows, whatever the ids; long words cost time by length."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import language_id, quality, trie_bpe
from ledgerlake.llm.queries import WORD_BPE, tokenizer_path
from tests.llm.cases import SCHEMA, prose, row


@pytest.mark.parametrize("same_text", [False, True])
def test_one_id_with_most_of_the_rows(spark, same_text):
    rows = [row(7, "the same words again" if same_text else prose("en", k, 12)) for k in range(8000)]
    rows += [row(k + 100, prose(lang, k, 12), lang) for k in range(300) for lang in ("de", "fr")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    labelled = docs.select("doc_id", "text", "lang")
    sample = language_id.sample_terms(labelled, 100)
    by = {lang: sum(r[0] == lang for r in sample) for lang in ("en", "de", "fr")}
    assert 50 < by["de"] < 200 and 50 < by["fr"] < 200 and (by["en"] <= 1 if same_text else 50 < by["en"] < 200)
    model = language_id.fit(docs, F.lit(True), rows_a_language=100)
    found = language_id.predict(docs.filter("lang <> 'en'"), model)
    assert found.filter("lang_pred <> row.lang").count() < 12


def test_one_labelled_id_with_most_of_the_rows(spark, monkeypatch):
    rows = [row(7, prose("en", k, 12) + "!?" * (k % 5)) for k in range(6000)]
    rows += [row(k + 100, prose("en", k, 12)) for k in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    labels = spark.createDataFrame([(7, 0)] + [(k + 100, 1) for k in range(400)], "doc_id long, quality int")
    seen = {}
    monkeypatch.setattr(quality, "train_pairs", lambda good, bad, **_: seen.update(good=len(good), bad=len(bad)) or
                        quality.Ranker(np.zeros(quality.FEATURES), np.zeros(quality.FEATURES), np.ones(quality.FEATURES)))
    quality.classify(docs, labels, F.lit(True), rows_a_label=150)
    assert 75 < seen["good"] < 300 and 75 < seen["bad"] < 300


def test_long_words_cost_time_by_length():
    bpe, took = trie_bpe.TrieBpe(tokenizer_path(WORD_BPE)), []
    for n in (100_000, 800_000):
        began = time.process_time()
        assert sum(len(ids) for _, ids in bpe.encode_words(["ab" * (n // 2)])) > 0
        took.append(time.process_time() - began)
    assert took[1] < 16 * max(took[0], 0.05)
