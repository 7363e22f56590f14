"""A training-data pipeline over `documents`: quality, near duplicates, contamination, personal data, packing.

STAGES lists (name, function) in order. A function takes (spark, docs, sf_dir), works on all rows of docs and returns
a DataFrame; all but the last return the columns of documents. Nulls, repeated rows and empty tables are
handled as the operators' modules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dailybars.llm.catalog import PSEUDONYM_KEY
from dailybars.llm.common import documents, stored
from dailybars.llm.decontaminate import without_contaminated
from dailybars.llm.near_dedup import one_of_each
from dailybars.llm.packing import best_fit_packing
from dailybars.llm.pseudonyms import refreshed_length, rewritten
from dailybars.llm.rule_ensemble import accepted, fit, training_rows

SEQUENCE = 2048


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled documents of the whole table."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return accepted(docs, fit(training_rows(documents(spark, sf_dir), labels)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: words in shingles of five, a similarity of 0.8 or more."""
    return one_of_each(docs, size=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced."""
    return refreshed_length(rewritten(docs, PSEUDONYM_KEY))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences."""
    return best_fit_packing(docs, "word_bpe_49k.json", capacity=SEQUENCE, end_id=0, cached_chunks=150_000)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pseudonyms", pseudonyms),
    ("pack", pack),
]

#: Model fitting and tokenizers are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
