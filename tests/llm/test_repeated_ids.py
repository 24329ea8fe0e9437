"""Dedup stages on ids that are not unique, or missing."""

from collections import Counter

import corpus_pipeline
from ledgerlake.llm import simhash
from tests.llm.cases import hard_rows, no_docs, prose, row, SCHEMA
from tests.llm.test_simhash import brute_components


def rows_given():
    rows = [row(k, prose("en", k)) for k in range(20)] * 2  # loaded twice
    rows += [row(None, prose("de", k)) for k in range(5)] * 3  # groups without ids
    rows += [row(50, prose("fr", 1)), row(51, prose("fr", 1)), row(51, prose("fr", 2)), row(51, "")]
    return rows


def test_one_row_a_text(spark):
    kept = corpus_pipeline.drop_exact_copies(spark, spark.createDataFrame(rows_given(), SCHEMA).repartition(4), None)
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    best = {}
    for i, text, *_ in rows_given():
        best[text] = max(best.get(text, -1), -1 if i is None else i)
    assert Counter(found) == Counter((None if i < 0 else i, t) for t, i in best.items())


def test_one_row_a_component(spark):
    for rows in (rows_given(), hard_rows()):
        docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
        kept = corpus_pipeline.drop_near_copies(spark, docs, None)
        assert [(f.name, f.dataType) for f in kept.schema] == [(f.name, f.dataType) for f in docs.schema]
        prints = {r[1]: simhash.fingerprint((r[1] or "").encode()) % 2**64 for r in rows}
        roots, least = brute_components(set(prints.values())), {}
        for i, text, *_ in rows:
            root = roots[prints[text]]
            least[root] = min(least.get(root, 10**9), 10**9 if i is None else i)
        found = [(roots[prints[r["text"]]], r["doc_id"]) for r in kept.collect()]
        assert Counter(found) == Counter((root, None if i == 10**9 else i) for root, i in least.items())
    assert corpus_pipeline.drop_near_copies(spark, no_docs(spark), None).collect() == []
