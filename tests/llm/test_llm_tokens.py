"""Token ids, counts and decoded texts against the libraries."""

import hashlib
import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cinelake.llm.bpe import WordBpe, encode_documents, with_digests
from cinelake.llm.token_counts import CACHE_SCHEMA, count_tokens
from tests.llm.helpers import documents

WORDS, BYTES, PIECES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def _texts(seed=0, count=400):
    rng = random.Random(seed)
    signs = list(" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0　'sStTrReEvVmMlLdD.,!09ΣςσİßÉ漢字😀‍½²ⅷ") + ["é", "ﬃ", "the ", "'LL", "<|endoftext|>", "<|startoftext|>", "<|", "it's"]
    out = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(count)]
    return [*out, "", "ab" * 20_000, "word " * 5000, "   ", "x" * 300]


def _library(path):
    library = Tokenizer.from_file(path)
    library.no_padding()
    library.no_truncation()
    return library


def test_ids_and_decoded_text_are_the_librarys():
    with open(WORDS) as f:
        mine = WordBpe(json.load(f))
    library = _library(WORDS)
    for text in _texts():
        want = library.encode(text, add_special_tokens=False).ids
        ids, decoded = mine.encode(text)
        assert ids.tolist() == want, repr(text[:60])
        assert decoded == library.decode(want, skip_special_tokens=False) == mine.decode(want)


def test_merges_reach_the_same_end_without_the_memo():
    with open(WORDS) as f:
        spec = json.load(f)
    a, b = WordBpe(spec), WordBpe(spec)
    for piece in ("hello", "a", "mississippi" * 30, "zzzzzzzzzzzz"):
        assert a.merge(piece) == b.merge(piece) == [int(x) for x in a.encode(piece)[0]]


def test_digests_of_a_table(spark):
    rows = list(enumerate([*_texts(2, 60), None]))
    got = {r.doc_id: r for r in with_digests(encode_documents(documents(spark, rows), WORDS)).collect()}
    library = _library(WORDS)
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert encode_documents(documents(spark, rows).where("doc_id < 0"), WORDS).count() == 0


@pytest.mark.parametrize("path", [BYTES, WORDS, PIECES])
def test_counts_are_the_librarys(spark, scratch, path):
    rows = list(enumerate([*_texts(3, 150), None, "again", "again"]))
    if path == PIECES:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        want = {i: len(model.encode(t)) if t else 0 for i, t in rows}
    else:
        library = _library(path)
        want = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in rows}
    got = {r.doc_id: r for r in count_tokens(documents(spark, rows), path, f"{scratch}/cache", 20).collect()}
    for i, text in rows:
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (want[i], len((text or "").encode()), want[i] > 20), repr(text)


def test_the_cache_is_used_and_extended(spark, scratch):
    cache = f"{scratch}/cache"
    first = documents(spark, [(1, "one two"), (2, "one two"), (3, None)])
    assert count_tokens(first, BYTES, cache, 512).count() == 3
    assert spark.read.parquet(cache).count() == 2  # one row per distinct text
    count_tokens(first, BYTES, cache, 512).collect()
    assert spark.read.parquet(cache).count() == 2
    count_tokens(documents(spark, [(1, "three")]), BYTES, cache, 512).collect()
    assert spark.read.parquet(cache).count() == 3
    count_tokens(first, WORDS, cache, 512).collect()
    assert spark.read.parquet(cache).groupBy("tokenizer").count().count() == 2
    # stored counts are believed, not made again
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache).selectExpr("tokenizer", "digest", "n_tokens + 100 AS n_tokens")
    stored.write.parquet(f"{scratch}/other")
    assert {r.n_tokens for r in count_tokens(first, BYTES, f"{scratch}/other", 512).collect()} == {102, 100}
    assert count_tokens(first.where("doc_id < 0"), BYTES, cache, 512).count() == 0
