"""From raw documents to a training mix: five stages, each one operator of ``sediment.llm``.

A stage takes the documents its predecessor kept and returns those it keeps; all but the
last return the columns of ``documents``. The last returns the mix: each document taken,
once, with ``copies`` and ``taken`` words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sediment.llm import decontaminate, language, line_windows, pivotal, simhash
from sediment.session import materialise


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the corpus teaches; those without letters or a clear language go."""
    return language.keep_identified(docs, language.learn(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages cut; documents that lose every line go. ``n_chars`` stays as it came."""
    return line_windows.drop_emptied(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents each source gives to the mix, with their copies."""
    return pivotal.copies(docs)


STAGES = [
    ("language_id", languages),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark),
    ("source_mixing", mix),
]

#: Fingerprints, learned languages and drawn copies are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
