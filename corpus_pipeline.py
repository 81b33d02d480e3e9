"""From documents to packed training sequences, in five stages.

``STAGES`` lists the stages in order. A stage takes ``(spark, docs, sf_dir)`` and returns what it
keeps; it is written as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of documents. When a stage is written, its input and what it stored on the way are removed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factorspark.llm import mixture, packing, quality, simhash, toxicity
from factorspark.sources.staging import discard, stage_alone


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return docs.filter(~toxicity.rejected("text", model))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose combined quality score reaches the threshold."""
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    found = quality.judged(docs, model, *quality.site_of(), keep=docs.columns)
    return found.filter(F.col("score") >= quality.THRESHOLD).select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 4-word shingles, at most 4 differing bits."""
    return simhash.one_of_each(docs, width=4, radius=4)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or sampled so that sources meet their target weights."""
    return mixture.mixed_documents(docs, weights=(5.0, 2.0, 1.0), max_epochs=3.0, seed=42)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in sequences of 1024 tokens."""
    paths = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
    return packing.pack(docs, *paths, end_id=2, capacity=1024)


STAGES = [
    ("toxicity", without_toxic),
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("mixture", mixed),
    ("packing", packed),
]

ORACLE_SQL = None  # models, fingerprints and tokenizers have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        before = docs
        docs = stage_alone(spark, lambda: apply(spark, before, sf_dir), name)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
