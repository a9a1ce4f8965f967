"""A text pipeline of five stages, each written as Parquet into the shared folder and read again by the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from metricwatch.llm import language_id, line_dedup, mixing, ngram_join, packing
from metricwatch.llm.common import shared_dir, ship, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without an identified language go."""
    ship(spark)
    return language_id.keep_identified(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-identical lines one stays; documents left without a line go."""
    return line_dedup.without_repeats(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 75 % common 5-word shingles one stays."""
    ship(spark)
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    ship(spark)
    return packing.pack(docs)


STAGES = [("language ID", identify_language), ("line dedup", drop_repeated_lines), ("n-gram join", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack_windows)]

#: Trained models and token ids can't be put in SQL; the run is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, base = table(spark, sf_dir, "documents"), f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
