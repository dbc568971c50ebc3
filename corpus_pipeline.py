"""Documents to packed training sequences: the stages in order, each written and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegraph.llm import decontaminate, langid, packing, simhash, substring
from tidegraph.llm.shared import delete, passing, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in no language of the corpus go (null texts, texts without a letter or of unknown n-grams); a missing `lang` is filled in."""
    return langid.with_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-copies the smallest doc_id stays."""
    return simhash.simhash_dedup(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur again anywhere are cut; documents of nothing else go."""
    return substring.substring_dedup(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, packed."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark),
    ("packing", sequences),
]

#: SQL can't express the fingerprints' components, byte-pair encoding or packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what a stage wrote on the way, and its input, go when its output is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with passing(spark) as made:
            docs = written(stage(spark, docs, sf_dir), name)
            output = made.pop()  # the last path made
        if before:
            delete(spark, before)
        before = output
    return docs
