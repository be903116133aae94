"""Registered queries of the training-data operators, each over its whole table,
and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cinelake.llm.block_naming import exact_groups
from cinelake.llm.bpe import encode_documents, with_digests
from cinelake.llm.byte_cnn import quality_rows
from cinelake.llm.interval_search import search_documents
from cinelake.llm.language_id import language_rows
from cinelake.llm.licenses import scan
from cinelake.llm.mixing import mix
from cinelake.llm.oracle import SQL  # noqa: F401 - registered with the queries
from cinelake.llm.recompression import find_runs, plant_repeats, run_rows
from cinelake.llm.rp_forest import nearest_neighbours
from cinelake.llm.secret_scan import secret_rows
from cinelake.llm.signature_tree import jaccard_components
from cinelake.llm.staging import table
from cinelake.llm.token_counts import count_tokens
from cinelake.llm.url_filter import judge
from cinelake.session import staging_path


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copies of ``documents``: 3-word shingles, similarity of at least 90 %."""
    return jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a mix of all sources takes, weights 3, 1, 2."""
    mixed = mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, through a cache that starts empty."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(table(spark, sf_dir, "documents"), path, staging_path(spark, "token_cache"), limit=512)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents and the one of each that stays."""
    return exact_groups(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_rows(table(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return with_digests(encode_documents(table(spark, sf_dir, "documents"), path))


#: Listed hosts and paths, and what they mean for a URL.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages"), rules)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return language_rows(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence lines of every document."""
    return scan(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, repetitions planted in a tenth."""
    return run_rows(find_runs(plant_repeats(table(spark, sf_dir, "documents")), least=6, repeats=4))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty best documents for every benchmark item."""
    return search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_source_mixing": op2_source_mixing,
    "op3_token_counts": op3_token_counts,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_bpe_round_trip": op7_bpe_round_trip,
    "op8_url_filter": op8_url_filter,
    "op9_language_id": op9_language_id,
    "op10_license_scan": op10_license_scan,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_ranked_search": op13_ranked_search,
}
