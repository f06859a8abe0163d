"""A training-data pipeline over ``documents``: five stages, each on what the last one kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each to the shared folder and reads it again for the next one. All stages but
the last return the columns of ``documents``.

Every stage takes rows with nulls in any column, empty and very long texts,
rows that repeat or share an id, further columns of any name, and empty tables
(with the columns of ``documents``; an empty table of labels rejects nothing, an
empty benchmark drops nothing). What each does with them is said at the functions
it calls; in short: rows go by id and text, a null text is an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paymart.llm import decontaminate, mixing, near_dedup, quality, secrets
from paymart.llm.shared import staged, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the co-trained classifier takes for poor or toxic."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), quality.is_good())
    return quality.kept(docs, model)


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (five words, 0.8)."""
    return near_dedup.one_of_each(docs, percent=80, shingle=5)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a copy of a benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks the secrets in texts; every document stays."""
    return secrets.masked(docs, staged(secrets.scan(docs), "judged"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, with the words it takes of each; those it takes nothing of go."""
    words = mixing.word_count(F.col("text"))
    return mixing.mix_sources(docs, words, keep=tuple(c for c in docs.columns if c not in ("doc_id", "source"))).where("taken > 0")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicate_removal", near_duplicate_removal),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_masking", secret_masking),
    ("source_mixing", source_mixing),
]

ORACLE_SQL = None  # a classifier fitted in the run has no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
