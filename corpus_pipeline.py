"""From raw documents to token ids: good, distinct, uncontaminated and without secrets.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. Its
result is written as Parquet and read again as the next stage's documents. All stages but
the last return the columns of `documents`, extra ones included, in their order.

Defined cases: null and empty texts pass or fail like any text (they have no shingles, leaks
or secrets; the quality classifier judges them); repeated rows are judged alike; an empty
table stays empty through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bitmaps, decontaminate, minhash, pieces, quality, secret_scan
from tallyloom.llm.queries import PIECE_MODEL
from tallyloom.llm.tables import bounded, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

QUALITY_THRESHOLD = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go. It learns from the labels of these documents."""
    model = quality.fit_quality(docs, table(bounded(spark), sf_dir, "labels"))
    return quality.good_documents(docs, model, QUALITY_THRESHOLD)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    bounded(spark)
    copies = minhash.near_duplicates(docs).filter("doc <> component")
    return bitmaps.without(docs, "doc_id", copies, "doc")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.without_contaminated(docs, table(bounded(spark), sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays. The recorded length follows the text."""
    bounded(spark)
    cleaned = secret_scan.redact_secrets(docs)
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    length = F.coalesce(F.length("text").cast(kind), F.col("n_chars"))
    return cleaned.withColumn("n_chars", length)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as piece ids."""
    bounded(spark)
    return pieces.encode_texts(docs, PIECE_MODEL, checked=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("SentencePiece encoding", encoding_stage),
]

# The classifier and the encoder have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
