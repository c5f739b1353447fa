"""The registered queries of this subpackage and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.llm import bpe, html, lines, mixing, periodic, quality, repeats, simhash, spelling, tokens, topk, urls, warc
from lectern.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql:
            CHECKS[name] = sql
        return build

    return add


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), drops_space=True)


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"))


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(read(spark, sf_dir, "documents")).drop("spans")


@query("op5_url_filter", urls.check_sql())
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.verdicts(read(spark, sf_dir, "pages"))


@query("op9_mixing", mixing.check_sql())
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.weights(read(spark, sf_dir, "documents"))


@query("op10_warc", warc.check_sql())
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


@query("op8_top_k", topk.check_sql())
def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"))


@query("op7_html")
def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages"))


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"), slips=97)


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.periodic_runs(periodic.planted(read(spark, sf_dir, "documents"))))


@query("op13_line_dedup", lines.check_sql())
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
