"""The registered queries of this subpackage and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dailybars.llm import hard_negatives, mixing, oracles, periodic_runs, quality_rules
from dailybars.llm.common import documents, stored
from dailybars.llm.decontaminate import contamination
from dailybars.llm.lm_scoring import cross_entropy_difference
from dailybars.llm.near_dedup import near_duplicates
from dailybars.llm.packing import best_fit_packing
from dailybars.llm.pseudonyms import pseudonymised
from dailybars.llm.rule_ensemble import rule_ensemble
from dailybars.llm.substring_dedup import substring_dedup
from dailybars.llm.token_counts import token_counts
from dailybars.llm.token_files import token_files


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir), length=100)


#: A deployment gives its own secret; with a fixed one the registered query is repeatable.
PSEUDONYM_KEY = b"registered query"


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymised(documents(spark, sf_dir), PSEUDONYM_KEY)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), size=4, percent=80)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir), version=3)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(documents(spark, sf_dir), "byte_bpe_50k.json", end_id=0)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), "byte_bpe_50k.json", limit=512)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(documents(spark, sf_dir), "word_bpe_49k.json", capacity=2048, end_id=0)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_entropy_difference(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_period(documents(spark, sf_dir))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs, min_length=12))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(hard_negatives.relabelled(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    draws = mixing.drawn(documents(spark, sf_dir), percent=150, most=2)
    return mixing.mix_report(draws, stored(mixing.mixed(draws), "mix"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_pseudonyms": op2_pseudonyms,
    "op3_near_dedup": op3_near_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_token_files": op5_token_files,
    "op6_token_counts": op6_token_counts,
    "op7_packing": op7_packing,
    "op8_decontamination": op8_decontamination,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_source_mixing": op13_source_mixing,
}

ORACLES: dict[str, str] = {
    "op1_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op3_near_dedup": oracles.near_dedup(),
    "op4_quality_rules": quality_rules.ORACLE,
    "op11_periodic_runs": periodic_runs.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_source_mixing": mixing.ORACLE,
}
