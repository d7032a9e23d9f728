"""From raw documents to token ids: the stages of a training-data pipeline, each written before the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import decontaminate, exact_dedup, language_id, near_dedup, sentencepiece
from lotwise.llm.common import fold, free_name, table
from lotwise.llm.queries import piece_model
from lotwise.operators.staging import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are text in one of the languages learned from the documents given."""
    return language_id.keep_explained(docs, language_id.train(docs.where(fold("doc_id", 4) != 2)))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 over five-word shingles."""
    return near_dedup.keep_one(docs, words=5)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and what these decode to, which replace columns of those names."""
    into = free_name(docs, "pieces")
    coded = sentencepiece.with_pieces(docs, piece_model(), into=into)
    return coded.withColumns({c: F.col(into)[c] for c in ("ids", "n_tokens", "decoded")}).drop(into)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("benchmark", benchmark),
    ("pieces", pieces),
]

#: Language ID and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
