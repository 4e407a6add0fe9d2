"""The registered query of each operator, with production parameters, and its SQL."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm import centroids, decontam, lexical, lm, minhash, mixing, quality_model, rules, simhash, tokens, toxicity, urls, warc
from sightline.llm import sql as S
from sightline.llm.common import table

#: Tokens beyond which a document is over the limit.
TOKEN_LIMIT = 2048
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.withColumn("fingerprint", simhash.hex_of(F.col("fingerprint")))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return tokens.count_tokens(table(spark, sf_dir, "documents"), path, TOKEN_LIMIT)


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.captures(table(spark, sf_dir, "pages")).drop("target_uri")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    items = F.col("found.items")
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustering(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64, seed="1:")


_QUERIES = [
    op1_simhash,
    op2_token_counts,
    op3_lm_scores,
    op4_quality,
    op5_mixing,
    op6_warc,
    op7_toxicity,
    op8_url_filter,
    op9_quality_rules,
    op10_decontamination,
    op11_lexical_search,
    op12_minhash,
    op13_centroids,
]


def queries():
    return {q.__name__: q for q in _QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return S.oracle_sql()
