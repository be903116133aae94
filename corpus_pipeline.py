"""From raw documents to token ids, one stage after the other.

Every stage reads all that the one before kept, as Parquet written and read
again; all but the last return the columns of their input, whatever they are
called. Stages need ``doc_id`` (the key), ``text``, ``lang`` and ``source``.

1. ``language_id`` drops documents without a letter, and those for which no
   language reaches LEAST_SCORE.
2. ``exact_dedup`` keeps the smallest ``doc_id`` of each group of equal texts, and
   one of the rows that repeat it with that text (texts that only rows without an
   id have: one row).
3. ``near_dedup`` keeps the smallest ``doc_id`` of each component of documents
   whose sets of 5-word shingles are similar to at least 80 %.
4. ``source_mix`` repeats each document as often as the mix takes its first
   word (0 to 2 times).
5. ``bpe`` gives ids per row, whose decoded text is checked by digest.

An empty table passes through all stages as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.llm.block_naming import name_documents, normalised
from cinelake.llm.bpe import encode_documents
from cinelake.llm.language_id import UNKNOWN, fit, language_of
from cinelake.llm.mixing import mix
from cinelake.llm.signature_tree import jaccard_components
from cinelake.llm.staging import stage, table, unstage

LEAST_SCORE = 0.3
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0


def _packed(docs: DataFrame) -> DataFrame:
    """All columns in one, so that no name of theirs meets one of a stage."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def _keep(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose ``doc_id`` is in ``ids`` (``keep``), dealt out by it."""
    name = "keep"
    while name in (c.lower() for c in docs.columns):
        name += "_"
    ids = ids.select(F.col("keep").cast(docs.schema["doc_id"].dataType).alias(name))
    return docs.join(ids.hint("merge"), docs["doc_id"] == F.col(name), "left_semi")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = fit(docs)
    if net is None:  # nothing labelled to learn from: only texts without a letter go
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found = _packed(docs).withColumn("language", language_of(spark, net)(F.col("doc.text").cast("string")))
    return found.where((F.col("language.lang_pred") != UNKNOWN) & (F.col("language.score") >= LEAST_SCORE)).select("doc.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def key(doc_id: Column, digest: Column) -> Column:
        return F.concat_ws(":", F.coalesce(doc_id.cast("long").cast("string"), F.lit("null")), digest).alias("row_key")

    kept = name_documents(docs).where("doc_id <=> keep_id").select(key(F.col("doc_id"), F.col("text_sha256")))
    rows = _packed(docs).select("doc", key(F.col("doc.doc_id"), F.sha2(normalised(F.col("doc.text")), 256)))
    # Rows that repeat an id and its text go in the join's partitions.
    return rows.join(kept.hint("merge"), "row_key", "left_semi").dropDuplicates(["row_key"]).select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard_components(docs, SHINGLE_WORDS, SIMILAR_PERCENT)
    return _keep(docs, found.where("component_id = doc_id").select(F.col("doc_id").alias("keep")))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mix(docs, WEIGHTS, SHARE, MOST).where("copies > 0").select(F.col("doc_id").alias("taken_id"), "copies")
    rows = _packed(docs).join(mixed.hint("merge"), F.col("doc.doc_id").cast("long") == F.col("taken_id"))
    return rows.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc.*")


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("bpe", bpe),
]

#: No SQL for a trained network and a merge queue; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = table(spark, sf_dir, "documents"), None
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline_{name}")
        if written is not None:
            unstage(written)
        written = docs
    return docs
