"""Token counts through a digest cache.

A stored table keeps counts by (tokenizer digest, content digest). A run joins
the digests of its contents to the table, encodes one text of each digest that
misses, appends the counts to the table, and joins them to the rows. A digest
is the SHA-256 of the UTF-8 text: the tokenizers count every character, so the
normalised content is the text itself, with null as empty. The tokenizer's
version is the SHA-256 of its file.

Texts are encoded by the library that the file is for. A byte-level vocabulary
splits a text into pieces that are encoded apart from each other, so a worker
remembers a bounded number of pieces' counts; other files encode whole texts.

Defined results: null and empty texts have no tokens and 0 bytes; repeated
texts are encoded once; empty tables give no rows; only ``doc_id`` and ``text``
are read. A re-run over the same cache encodes nothing and agrees.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.bpe import _Memo
from cinelake.llm.staging import ship_package
from cinelake.llm.text import slices, utf8

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"

#: The split that byte-level files apply before merging (a fixed value), with
#: white space as the property that their library uses.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
).replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")


def _of_pieces(spec: dict) -> bool:
    pre = spec.get("pre_tokenizer") or {}
    plain = all(not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]) for t in spec["added_tokens"])
    return not spec.get("normalizer") and plain and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]


@lru_cache(maxsize=4)
def _counter(kind: str, digest: str, raw: bytes) -> Callable[[str], int]:
    if kind == ".model":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=raw)
        return lambda text: len(model.encode(text, num_threads=1)) if text else 0
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(raw.decode())
    library.no_truncation()
    library.no_padding()

    def whole(text: str) -> int:
        return len(library.encode(text, add_special_tokens=False).ids)

    spec = json.loads(raw)
    if not _of_pieces(spec):
        return whole
    counts, pieces = _Memo(whole), regex.compile(PIECES).findall
    special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
    cut = regex.compile("|".join(map(regex.escape, special))) if special else None

    def count(text: str) -> int:
        parts = cut.split(text) if cut else [text]
        return len(parts) - 1 + sum(sum(map(counts.__getitem__, pieces(p))) for p in parts if p)

    return count


def _encode(kind: str, digest: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(kind, digest, shared.value)
        for batch in batches:
            _, offsets = utf8(batch.column("text"))
            for a, b in slices(offsets):
                found = [count(t) for t in batch.column("text").slice(a, b - a).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest] * (b - a), pa.string()), batch.column("digest").slice(a, b - a), pa.array(np.array(found, np.int64))],
                    ["tokenizer", "digest", "n_tokens"],
                )

    return run


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str, limit: int) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per row of ``docs``.

    ``cache_path``: a folder that executors share; created if missing, else
    extended by the misses of this call.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer_path, "rb") as f:
        raw = f.read()
    version, kind = hashlib.sha256(raw).hexdigest(), os.path.splitext(tokenizer_path)[1]
    shared = spark.sparkContext.broadcast(raw)  # one vocabulary file, a few MB

    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_path)

    def cache() -> DataFrame:
        return spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer") == version).select("digest", "n_tokens")

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))
    one_each = keyed.groupBy("digest").agg(F.first("text").alias("text"))
    misses = one_each.join(cache(), "digest", "left_anti").select("digest", "text")
    misses.mapInArrow(_encode(kind, version, shared), CACHE_SCHEMA).write.mode("append").parquet(cache_path)

    counts = cache().groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))  # a retried append may repeat a row
    sizes = keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return sizes.join(counts, "digest", "left").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
