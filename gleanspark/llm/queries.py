"""The registered queries of this subpackage: thin, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanspark.llm import url_filter

    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), url_filter.QUERY_RULES)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanspark.llm import simhash

    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanspark.llm import secret_scan

    return secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanspark.llm import toxicity

    docs = _table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanspark.llm import token_count

    return token_count.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanspark.llm import html_text

    return html_text.extract_text(_table(spark, sf_dir, "pages"))


def op7_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanspark.llm import context_mixing

    return context_mixing.score_documents(_table(spark, sf_dir, "documents"))


def op8_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanspark.llm import merkle

    return merkle.fingerprint_documents(_table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanspark.llm import decontaminate

    return decontaminate.mark_contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanspark.llm import sampled_pieces

    return sampled_pieces.sample_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_url_filter, op2_simhash, op3_secret_scan, op4_toxicity, op5_token_count, op6_html_text, op7_context_mixing, op8_merkle, op9_decontaminate, op10_sampled_pieces)}


def oracle_sql() -> dict[str, str]:
    from gleanspark.llm import decontaminate, html_text, merkle, url_filter

    return {"op1_url_filter": url_filter.oracle_sql(), "op6_html_text": html_text.ORACLE_SQL, "op8_merkle": merkle.oracle_sql(), "op9_decontaminate": decontaminate.ORACLE_SQL}
