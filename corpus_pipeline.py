"""From raw documents to packed training sequences: five stages, each written before the next one reads it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm import exact_dedup, ngram_join, packing, secret_scan, toxicity
from salesloom.llm.shared import fresh_name, shared_folder, ship


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; all labels may be learned from."""
    labels = ship(spark).read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, F.lit(True))
    score = fresh_name("score")
    return toxicity.scored(docs, model, score_column=score).where(F.col(score) < 0.5).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    ship(spark)
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, a similarity of 0.8 or more."""
    ship(spark)
    return ngram_join.without_near_copies(docs, words=5, numerator=80, denominator=100)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets become ``[secret]``; the number of characters, where there is such a column, follows."""
    clean = secret_scan.redacted(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in full training sequences, with their token ids."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scan", redact_secrets),
    ("packing", pack_sequences),
]

#: Toxicity scores, Markov models and tokenizers are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
