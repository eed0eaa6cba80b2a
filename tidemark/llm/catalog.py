"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (
    collocations,
    decontamination,
    lexical,
    near_duplicates,
    oracles,
    packing,
    personal,
    quality,
    repeats,
    secrets,
    sharding,
    token_store,
    toxicity,
    url_filters,
)
from tidemark.sources.shared import shared_folder

# The listed rules of the URL query.
URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _path(spark, "tokens")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_store.document_digests(spark, path)


def op2_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op3_prefix_filtered_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return decontamination.decontaminate(documents, table(spark, sf_dir, "benchmark"))


def op4_suffix_merge_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op5_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))


def op7_differencing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 40)


def op8_path_template_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    labels = url_filters.labels_by_path(pages, table(spark, sf_dir, "labels"))
    judged = url_filters.judge(pages, labels, URL_RULES)
    return judged.withColumn("purity", F.round("purity", 6))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find_personal(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_token_store": op1_token_store,
        "op2_minhash_near_duplicates": op2_minhash_near_duplicates,
        "op3_prefix_filtered_decontamination": op3_prefix_filtered_decontamination,
        "op4_suffix_merge_repeats": op4_suffix_merge_repeats,
        "op5_risk_controlled_rules": op5_risk_controlled_rules,
        "op6_noisy_channel_toxicity": op6_noisy_channel_toxicity,
        "op7_differencing_shards": op7_differencing_shards,
        "op8_path_template_filters": op8_path_template_filters,
        "op9_best_fit_packing": op9_best_fit_packing,
        "op10_secret_scan": op10_secret_scan,
        "op11_phrase_collocations": op11_phrase_collocations,
        "op12_ranked_search": op12_ranked_search,
        "op13_personal_data": op13_personal_data,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    """What cannot be put in SQL is tested against brute force instead: ids of a tokenizer, learned
    scores, a packing, a balanced partition, and spans of expressions."""
    return {
        "op2_minhash_near_duplicates": oracles.NEAR_DUPLICATES,
        "op3_prefix_filtered_decontamination": oracles.DECONTAMINATION,
        "op4_suffix_merge_repeats": oracles.REPEATS,
        "op8_path_template_filters": oracles.url_filters_sql(URL_RULES),
        "op11_phrase_collocations": oracles.COLLOCATIONS,
        "op12_ranked_search": oracles.LEXICAL,
    }
