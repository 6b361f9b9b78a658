"""The queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from murmura.llm import (
    bpe,
    lines,
    mixing,
    outliers,
    prefixes,
    quality,
    records,
    secrets,
    simhash,
    spots,
    toxicity,
    urls,
    whitening,
)
from murmura.llm.common import documents, labels, table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.scored(docs, toxicity.fit(docs, labels(spark, sf_dir)))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, sf_dir), VOCABULARY)


def op4_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judged(documents(spark, sf_dir))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.scored(docs, quality.fit(docs, labels(spark, sf_dir)))


def op8_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.compared(documents(spark, sf_dir))


def op9_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.written_and_read(documents(spark, sf_dir), VOCABULARY)


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(documents(spark, sf_dir))


def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), urls.rule_table(spark))


def op12_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie_of_rebuilt(table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash": op2_simhash,
    "op3_bpe": op3_bpe,
    "op4_outliers": op4_outliers,
    "op5_secrets": op5_secrets,
    "op6_mixing": op6_mixing,
    "op7_quality": op7_quality,
    "op8_spots": op8_spots,
    "op9_records": op9_records,
    "op10_lines": op10_lines,
    "op11_urls": op11_urls,
    "op12_prefixes": op12_prefixes,
    "op13_whitening": op13_whitening,
}

ORACLE = {"op6_mixing": mixing.MIX_SQL, "op11_urls": urls.JUDGED_SQL, "op12_prefixes": prefixes.REBUILT_SQL}
