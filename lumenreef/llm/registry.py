"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from lumenreef.llm import (
    ann_search,
    license_scan,
    line_dedup,
    mixing,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    sentencepiece_bpe,
    simhash,
    spelling_groups,
    toxicity,
    url_filter,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(_table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(_table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_report(_table(spark, sf_dir, "pages"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_report(_table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encoding_report(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_search.nearest_report(_table(spark, sf_dir, "embeddings"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_report(_table(spark, sf_dir, "documents"))


def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups.spelling_report(_table(spark, sf_dir, "documents"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_report(_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.runs_report(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_quality_rules": op2_quality_rules,
        "op3_packing": op3_packing,
        "op4_url_filter": op4_url_filter,
        "op5_simhash": op5_simhash,
        "op6_sentencepiece": op6_sentencepiece,
        "op7_toxicity": op7_toxicity,
        "op8_ann_search": op8_ann_search,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_line_dedup": op10_line_dedup,
        "op11_spelling_groups": op11_spelling_groups,
        "op12_mixing": op12_mixing,
        "op13_periodic_runs": op13_periodic_runs,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": quality_rules.REPORT_SQL, "op11_spelling_groups": spelling_groups.REPORT_SQL}
