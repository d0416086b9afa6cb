"""Registered queries of the operators here: each reads whole tables and returns the whole result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trolley.llm import oracles
from trolley.llm.common import prepared, table
from trolley.llm.decontamination import decontaminate
from trolley.llm.licenses import scan_licences
from trolley.llm.near_dedup import near_dedup
from trolley.llm.packing import pack
from trolley.llm.quality_classifier import classify
from trolley.llm.quality_rules import quality_rules
from trolley.llm.token_alignment import align
from trolley.llm.token_counts import section_token_counts
from trolley.llm.simhash_dedup import simhash_dedup
from trolley.llm.source_divergence import source_divergence
from trolley.llm.substring_dedup import substring_dedup
from trolley.llm.toxicity import score_toxicity
from trolley.llm.warc import round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = oracles.SQL


def register(function: Callable[[SparkSession, str], DataFrame]) -> Callable:
    QUERIES[function.__name__] = lambda spark, folder: function(prepared(spark), folder)
    return function


@register
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register
def op2_warc_normaliser(spark: SparkSession, folder: str) -> DataFrame:
    records = round_trip(table(spark, folder, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register
def op3_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licences(table(spark, folder, "documents"))


@register
def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("items")


@register
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(table(spark, folder, "documents"))


@register
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return section_token_counts(table(spark, folder, "documents"))


@register
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup(table(spark, folder, "documents"))


@register
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


@register
def op10_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup(table(spark, folder, "documents"))


@register
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align(table(spark, folder, "documents"))


@register
def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(table(spark, folder, "documents"))


@register
def op13_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_dedup(table(spark, folder, "documents"))
