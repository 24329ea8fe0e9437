"""Every stage against a brute-force version on its own input, and the whole run."""

import re
from collections import defaultdict

import corpus_pipeline
from ledgerlake.llm import language_id, simhash
from ledgerlake.llm.queries import BYTE_BPE, tokenizer_path
from ledgerlake.llm.secret_scan import MARK, Scanner, redacted
from tests.llm.cases import SCHEMA, hard_docs, no_docs, prose
from tests.llm.test_simhash import brute_components

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def planted(spark):
    """Clean prose, exact and near copies, a secret, and texts without letters."""
    texts = {k: (prose(lang, k, 120), lang) for k, lang in enumerate(["en", "de", "fr"] * 20)}
    texts |= {200 + k: texts[1] for k in range(30)} | {300: (texts[2][0] + " extra", "fr"), 400: ("12 34", "en"),
              401: (None, "en"), 402: ("mine: password = hunter2222", "en"), 403: ("", None)}
    return spark.createDataFrame([(k, t, lang, "s", len(t or "")) for k, (t, lang) in texts.items()], DOCUMENTS)


def test_the_stages_call_their_operators_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "secret_scans",
                                                      "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_against_brute_force(spark, tmp_path):
    docs = planted(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, None).write.parquet(out)
        given, docs = docs.collect(), spark.read.parquet(out)
        rows = docs.collect()
        if name != "packing":
            assert docs.schema.names == [x.split()[0] for x in DOCUMENTS.split(", ")]
            assert len({r["doc_id"] for r in rows}) == len(rows)
        kept = {r["doc_id"] for r in rows}
        if name == "language_id":
            assert kept == {r["doc_id"] for r in given if re.search(r"[^\W\d_]", r["text"] or "")}
        elif name == "exact_dedup":
            last = defaultdict(int)
            for r in given:
                last[r["text"]] = max(last[r["text"]], r["doc_id"])
            assert kept == set(last.values())
        elif name == "simhash_near_dedup":
            prints = {r["doc_id"]: simhash.fingerprint(r["text"].encode()) % 2**64 for r in given}
            roots, least = brute_components(set(prints.values())), {}
            for i, p in sorted(prints.items(), reverse=True):
                least[roots[p]] = i
            assert kept == set(least.values())
        elif name == "secret_scans":
            scanner = Scanner()
            assert {tuple(r) for r in rows} == {
                (r["doc_id"], t := redacted(r["text"], scanner.named_spans(r["text"])), r["lang"], r["source"], len(t))
                for r in given}
            assert any(MARK in r["text"] for r in rows)
        else:
            assert kept == {r["doc_id"] for r in given}
            whole = {r["doc_id"]: r["doc_tokens"] for r in rows}
            placed = defaultdict(int)
            for r in rows:
                placed[r["doc_id"]] += r["length"]
            assert placed == whole


def test_clean_documents_pass_language_id_and_dedup(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model_kept = corpus_pipeline.identify_language(spark, docs, None)
    assert model_kept.count() == docs.count()


def test_hard_rows_through_all_stages(spark, tmp_path):
    for k, docs in enumerate([hard_docs(spark), no_docs(spark)]):
        for name, stage in corpus_pipeline.STAGES:
            out = str(tmp_path / f"{k}-{name}")
            result = stage(spark, docs, None)
            if name != "packing":
                assert [(f.name, f.dataType) for f in result.schema] == [(f.name, f.dataType) for f in docs.schema]
            result.write.parquet(out)
            docs = spark.read.parquet(out)
    assert docs.count() == 0 and SCHEMA and language_id and tokenizer_path(BYTE_BPE)


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert 0 < out.select("doc_id").distinct().count() <= 200
