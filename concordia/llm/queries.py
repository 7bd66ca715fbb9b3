"""Registered queries of this package: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat,
    decontaminate,
    hard_negatives,
    language_model,
    mixing,
    oracles,
    packing,
    pii,
    quality_list,
    resampling,
    simhash,
    token_count,
    toxicity,
    url_rules,
)
from .common import source_table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "piece_bpe_32k.model"


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = source_table(spark, sf, "documents"), source_table(spark, sf, "labels")
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    return toxicity.scored(docs, model)


def op2_url_rules(spark: SparkSession, sf: str) -> DataFrame:
    pages = source_table(spark, sf, "pages")
    return url_rules.judged(pages, url_rules.mine(pages))


def op3_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = source_table(spark, sf, "documents"), source_table(spark, sf, "labels")
    rules = quality_list.fit(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
    return quality_list.judged(docs, rules).select("doc_id", *columns)


def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_count.token_counts(source_table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER))


def op5_simhash(spark: SparkSession, sf: str) -> DataFrame:
    marked = simhash.near_duplicates(source_table(spark, sf, "documents"))
    return marked.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_report(source_table(spark, sf, "documents"))


def op7_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(source_table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER))


def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    index = decontaminate.build_index(source_table(spark, sf, "documents"))
    found = decontaminate.search(index, source_table(spark, sf, "benchmark"), near=decontaminate.NEAR)
    return decontaminate.digest(found, proximity=True)


def op9_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    docs = source_table(spark, sf, "documents")
    found = pii.personal_data(docs, pii.fit(docs))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


def op10_chat(spark: SparkSession, sf: str) -> DataFrame:
    return chat.repair(source_table(spark, sf, "conversations"))


def op11_language_model(spark: SparkSession, sf: str) -> DataFrame:
    return language_model.scored(source_table(spark, sf, "documents"))


def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    vectors, number = source_table(spark, sf, "embeddings"), F.col("vec_id")
    label = F.when(number % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label), anchor=number % 50 == 0)


def op13_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return resampling.resample(source_table(spark, sf, "documents"), source_table(spark, sf, "benchmark"))


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_toxicity,
            op2_url_rules,
            op3_quality_rules,
            op4_token_counts,
            op5_simhash,
            op6_mixing,
            op7_packing,
            op8_decontamination,
            op9_personal_data,
            op10_chat,
            op11_language_model,
            op12_hard_negatives,
            op13_resampling,
        )
    }


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
