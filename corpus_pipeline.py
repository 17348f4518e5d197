"""A corpus pipeline: from raw documents to shards, each stage written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattloom.llm.decontaminate import drop_contaminated
from wattloom.llm.mixing import MAX_REPEATS, mixed_documents
from wattloom.llm.sharding import shard_documents
from wattloom.llm.store import keep
from wattloom.llm.toxicity import drop_toxic
from wattloom.llm.triejoin import drop_near_copies


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a classifier trained on the labelled ones.

    Null and empty texts are scored like texts without words, repeated rows alike; without labels
    of both kinds, or documents, all of them stay.
    """
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by sets of five words and 80 percent.

    The smallest doc_id stays. Null and empty texts have no copies and stay, so do null ids; rows
    that share a doc_id stay or go together.
    """
    return drop_near_copies(docs, gram=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is in the benchmark.

    Null and empty texts stay, and rows that share a doc_id stay or go together.
    """
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once or more, no source read more than twice as often as another.

    A null source is one of its own, documents without words come once, and rows that share a
    source and a doc_id come equally often.
    """
    return mixed_documents(docs, max_repeats=MAX_REPEATS)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every copy of every document: ``doc_id, size, text_crc32, shard, slot``.

    A null text has no bytes and a null id a place; equal rows share a shard and have slots of
    their own.
    """
    return shard_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: SQL cannot express a trained classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
