"""From raw documents to token ids: five stages over the operators in maskflow.llm.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it
kept. All but the last return the columns of ``docs``; the last has ``ids`` in the
place of ``text``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from maskflow.llm import cotraining, decontaminate, exact_dedup, jaccard_join, pieces
from maskflow.llm.queries import PIECE_MODEL
from maskflow.llm.tables import stored
from maskflow.session import scratch_path

#: Near duplicates: five-word shingles with a similarity of 0.8 or more.
WIDTH, NUM, DEN = 5, 80, 100


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return cotraining.keep_good(spark, docs, labels, meta_cols=["lang", "source", "n_chars"])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    name = f"digest_index_{uuid.uuid4().hex}"
    return exact_dedup.keep_first(spark, docs, name, scratch_path(spark, "digest-index"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their shingles the one with the smallest id stays."""
    return jaccard_join.keep_one(spark, docs, WIDTH, NUM, DEN)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.remove_contaminated(spark, docs, items)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become piece ids."""
    return pieces.encode(spark, docs, PIECE_MODEL)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("ngram_jaccard_join", near),
    ("benchmark_decontamination", decontaminated),
    ("sentencepiece", encoded),
]

#: A trained classifier decides the first stage, so SQL cannot give the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
