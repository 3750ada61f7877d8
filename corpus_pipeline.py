"""The corpus pipeline: documents to packed training sequences.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` on all documents that the stage before it kept. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evalframe.llm import decontaminate, jaccard, language, packing, secrets
from evalframe.llm.graph import stage_table

#: The posterior that a document's language has to reach: as likely as all others together.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language the model tells with a score of ``LEAST_SCORE`` at least: null texts, texts without a letter and texts that no language explains go.

    A corpus without labels teaches no model; then all texts with a letter are kept.
    """
    return language.drop_undetermined(docs, language.fit(docs), min_score=LEAST_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by a Jaccard similarity of 0.8 of five-word shingles: the smallest id."""
    return jaccard.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold at least 0.8 of a benchmark item's five-word shingles."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace each secret by a mask; ``n_chars`` follows the text."""
    return secrets.redact(docs, length_col="n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of the documents' tokens."""
    return packing.pack(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: Packing needs a tokenizer, which SQL can't express; tests hold each stage and the whole against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``; each stage's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
