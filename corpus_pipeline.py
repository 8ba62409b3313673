"""Training-data pipeline: quality, language, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; its result is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitfeat.llm import langid, mixing, neardup, packing, quality
from pitfeat.session import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the passage-attention classifier predicts to be good."""
    return quality.keep_good(docs, quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose letters the language model knows, code-switched ones included."""
    return langid.keep_identified(docs, langid.learn(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8."""
    return neardup.deduplicate(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.emit(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 ids."""
    return packing.pack(docs)


STAGES = [("quality classifier", quality_classifier), ("language ID", language_id), ("MinHash near-dedup", near_dedup),
          ("mixing sources to target weights", mix_sources), ("packing", pack_sequences)]

#: Trained models and tokenizers have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name="pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
