"""The operators applied to the test tables, one query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardmart.llm import bpe_codec, mixing, near_dedup, neighbours, packing, page_template, prefix_trie, quality, spelling, token_counts, topk, toxicity, url_filter
from hazardmart.llm.common import read

RULES = url_filter.Rules(
    allow=frozenset({"com/", "www.example.com/en/"}),
    block=frozenset({"example.com/en/", "net/es/", "net/fr/"}),
)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return token_counts.count_tokens(docs, limit=512)


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return neighbours.nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_template.main_text(read(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip_digests(read(spark, sf_dir, "documents"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read(spark, sf_dir, "documents"), temperature=0.5, seed=7)


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return topk.exact_top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read(spark, sf_dir, "pages"), RULES)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(read(spark, sf_dir, "conversations"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), keep_ids=False)


QUERIES = {
    query.__name__: query
    for query in (
        op1_token_counts,
        op2_nearest_neighbours,
        op3_near_duplicates,
        op4_main_text,
        op5_toxicity,
        op6_quality,
        op7_bpe_codec,
        op8_source_mix,
        op9_exact_top_k,
        op10_url_filter,
        op11_prefix_trie,
        op12_spelling_variants,
        op13_best_fit_packing,
    )
}

ORACLE = {
    "op8_source_mix": mixing.oracle(temperature=0.5, seed=7),
    "op9_exact_top_k": topk.oracle(k=20, every=20),
    "op10_url_filter": url_filter.oracle(RULES),
    "op11_prefix_trie": prefix_trie.oracle(),
    "op12_spelling_variants": spelling.oracle(),
}
