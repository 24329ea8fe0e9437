"""The corpus pipeline: raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; its output is written as Parquet
and read again, so a lost executor repeats one stage's tasks at most. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import exact_dedup, language_id, packing, secret_scan, simhash
from ledgerlake.llm.common import durable, table
from ledgerlake.llm.queries import BYTE_BPE, packing_digest, tokenizer_path

#: Language ID rejects texts without a letter, and those in which no language is likelier than this.
MIN_LANGUAGE_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is recognised; learns from all rows with a language."""
    model = language_id.fit(docs, F.lit(True))
    found = language_id.predict(docs, model)
    if model.languages:
        sure = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    else:  # nothing to learn from: only a text without a letter is rejected
        sure = F.regexp_like(F.col("row.text"), F.lit(r"\p{L}"))
    return found.filter(sure).select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, with the largest id."""
    return exact_dedup.keep_one_copy(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates one row stays, with the smallest id."""
    return simhash.keep_one_row(docs)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, its secrets replaced by a mark; n_chars, where the table has it, follows the text."""
    clean = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens packed into sequences, a row a piece."""
    return packing_digest(packing.pack_documents(docs, tokenizer_path(BYTE_BPE)))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scans", remove_secrets),
    ("packing", pack),
]

#: SQL cannot express the trained language model, so the stages are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
