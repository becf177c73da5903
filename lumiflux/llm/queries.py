"""The thin queries over whole tables and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lumiflux.llm import decontaminate, divergence, license, mixing, pii, search, secrets, simhash, substring, tokens, toxicity, urls, winnow
from lumiflux.llm.common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.report(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.report(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.report(table(spark, sf_dir, "documents"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.report(table(spark, sf_dir, "pages"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


OPERATORS = (op1_substring_dedup, op2_toxicity, op3_token_files, op4_license_scan, op5_pii, op6_winnowing, op7_simhash_near_dedup, op8_secret_scan, op9_mix_sources, op10_decontaminate, op11_url_filter, op12_ranked_search, op13_source_divergence)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {"op4_license_scan": license.SQL, "op9_mix_sources": mixing.SQL, "op10_decontaminate": decontaminate.SQL, "op11_url_filter": urls.SQL, "op12_ranked_search": search.SQL, "op13_source_divergence": divergence.SQL}
