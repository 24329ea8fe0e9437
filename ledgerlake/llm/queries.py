"""The registered queries of the operators: each applies its operator to a whole given table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (ann, chat_format, decontamination, language_id, lm_score, packing, periodic_runs, quality,
                            token_alignment, trie_bpe)
from ledgerlake.llm.common import table
from ledgerlake.llm.exact_dedup import exact_dedup
from ledgerlake.llm.secret_scan import digest as secret_digest
from ledgerlake.llm.secret_scan import scan, scan_sql
from ledgerlake.llm.simhash import simhash_components

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


#: Names of the public tokenizer files; see :func:`tokenizer_path`.
WORD_BPE, BYTE_BPE, PIECE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies, on the driver and on every executor alike."""
    import public_tokenizers

    return public_tokenizers.path(name)


def fold(docs: DataFrame, folds: int) -> Column:
    """The fold of a document; null for a null id."""
    return F.crc32(docs["doc_id"].cast("string").cast("binary")) % folds


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, fold(docs, 3) != 1)
    out = language_id.predict(docs.select("doc_id", "text", (fold(docs, 3) == 1).alias("held_out")), model)
    return out.select("row.doc_id", "row.held_out", "lang_pred", "score")


def op2_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path(WORD_BPE)
    out = trie_bpe.decode(trie_bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = quality.classify(docs, labels, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    return found.select("doc_id", (fold(found, 5) == 0).alias("held_out"), "score", "predicted")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(scan(table(spark, sf_dir, "documents")))


ORACLE["op4_secret_scan"] = scan_sql()


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = lm_score.score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1)
    return found.select("doc_id", (fold(found, 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                        "base_score", "score")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE["op6_exact_dedup"] = """
SELECT doc_id, MAX(doc_id) OVER same AS keep_id, COUNT(*) OVER same AS group_size,
       doc_id = MAX(doc_id) OVER same AS kept, SHA256(COALESCE(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY COALESCE(text, ''))"""


def op7_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


#: A conversation whose texts hold control strings of usual templates.
HARD_TURNS = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = given.unionByName(spark.createDataFrame(HARD_TURNS, "conv_id bigint, turn bigint, role string, text string"))
    return chat_format.digest(chat_format.read_back(chat_format.format_conversations(turns)))


ORACLE["op9_chat_format"] = chat_format.digest_sql(
    "SELECT conv_id, turn, role, text FROM conversations UNION ALL FROM (VALUES "
    + ", ".join("({}, {}, '{}', '{}')".format(*x) for x in HARD_TURNS) + ")")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_digest(packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE)))


def packing_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.digest(found)


ORACLE["op11_decontamination"] = decontamination.digest_sql()


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_alignment.alignment(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE),
                                      tokenizer_path(PIECE_BPE), digests=True)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                        F.col("groups").alias("groups_sha256"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.periodic_runs(table(spark, sf_dir, "documents"),
                                                            change=periodic_runs.repeat_tail))


QUERIES |= {f.__name__: f for f in (
    op1_language_id, op2_trie_bpe, op3_quality, op4_secret_scan, op5_lm_score,
    op6_exact_dedup, op7_learned_partitions, op8_simhash,
    op9_chat_format, op10_packing, op11_decontamination, op12_token_alignment, op13_periodic_runs)}
