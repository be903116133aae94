"""URL filter: a blocked Bloom filter over listed canonical URLs passes possible
hits to an exact hash join. DataFrame operations only.

A list entry is a host and a path that a URL's path must start with; it fits its
host and all subdomains, and the longest fitting entry decides. Its canonical
form is ``host + path``. A URL's possible canonical forms follow from the
entries' shapes (labels of the host, length of the path), so a URL has as many
as the list has shapes, whatever the list's length. Each form is hashed to one
block of the filter and tested there; forms that pass are joined exactly with
the list, which removes false positives.

The filter's size grows with the list up to ``MOST_BLOCKS`` blocks (about
1 MB, broadcast); a longer list passes more false positives to the exact join
and changes no result.

Defined results: null URLs and URLs without ``://`` have an empty host and path,
fit nothing and are allowed; so is any URL that no entry fits. Repeated rows get
repeated results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_WORDS, BITS_OF_KEY, KEYS_OF_BLOCK, MOST_BLOCKS = 4, 6, 16, 1 << 15
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path)."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _bits(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a key, and its bit positions there."""
    second = F.xxhash64(key, F.lit(1))
    return F.pmod(F.xxhash64(key), F.lit(blocks)), [F.shiftrightunsigned(second, 8 * k).bitwiseAND(F.lit(64 * BLOCK_WORDS - 1)) for k in range(BITS_OF_KEY)]


def _masks(bits: list[Column]) -> list[Column]:
    """The words of a block in which a key sets its bits."""
    out = []
    for w in range(BLOCK_WORDS):
        word = F.lit(0).cast("long")
        for bit in bits:
            one = F.expr("1L")
            word = word.bitwiseOR(F.when(F.floor(bit / 64) == w, F.call_function("shiftleft", one, (bit % 64).cast("int"))).otherwise(F.lit(0).cast("long")))
        out.append(word)
    return out


def bloom_blocks(entries: DataFrame, blocks: int) -> DataFrame:
    """``(block, w0..w3)`` of the blocks in which a key has bits."""
    block, bits = _bits(F.col("key"), blocks)
    masked = entries.select(block.alias("block"), *[m.alias(f"w{w}") for w, m in enumerate(_masks(bits))])
    return masked.groupBy("block").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(BLOCK_WORDS)])


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` per row of ``pages`` (``page_id``, ``url``).

    ``rules``: ``host``, ``path`` (starting with ``/``), ``verdict``; a repeated
    entry counts once, as the verdict that sorts last (``block`` over ``allow``).
    """
    entries = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).withColumn("key", F.concat("host", "path"))
    shapes = entries.select(labels(F.col("host")).alias("n"), F.length("path").alias("p")).distinct().collect()  # as many as forms of a URL
    count = entries.count()
    blocks = 1
    while blocks * KEYS_OF_BLOCK < count and blocks < MOST_BLOCKS:
        blocks *= 2

    host, path = split_url(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    forms = [
        F.when((labels(F.col("host")) >= s.n) & (F.length("path") >= s.p), F.struct(F.substring_index("host", ".", -s.n).alias("on"), F.substring("path", 1, s.p).alias("at")))
        for s in shapes
    ]
    if not forms:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    tried = rows.select("host", "path").distinct().select("host", "path", F.explode(F.array_compact(F.array(*forms))).alias("form"))
    tried = tried.select("host", "path", F.concat("form.on", "form.at").alias("key"), F.col("form.on").alias("on"))
    block, bits = _bits(F.col("key"), blocks)
    tried = tried.select("host", "path", "key", "on", block.alias("block"), *[m.alias(f"m{w}") for w, m in enumerate(_masks(bits))])
    passes = F.lit(True)
    for w in range(BLOCK_WORDS):
        passes = passes & (F.col(f"w{w}").bitwiseAND(F.col(f"m{w}")) == F.col(f"m{w}"))
    possible = tried.join(F.broadcast(bloom_blocks(entries, blocks)), "block").where(passes).select("host", "path", "key", "on")
    listed = entries.select("key", F.col("host").alias("on"), "verdict")
    hits = possible.join(listed, ["key", "on"])
    best = hits.groupBy("host", "path").agg(F.max(F.struct(F.length("key").alias("n"), "key", "verdict")).alias("best"))
    return rows.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
