"""Exact dedup by deterministic block naming, in DataFrame operations only.

White space runs become one space; the text is cut into fixed-size blocks. At
level 0 equal blocks at the same place get one integer name, then adjacent names
are paired and each pair is named again, until a document has one name. A name
is the smallest ``doc_id`` that has this block (or pair) at this place: two
different blocks at a place never share it, so names are free of collisions,
need no global counter, and the last one is the document to keep. Documents of
different block counts are named apart.

Naming is ``min`` by the sorted or hashed content, which pre-aggregates before
its shuffle, joined back by an equi-join that adaptive execution splits where
one block is very common. Levels above 0 hold integers only and are written to
the shared folder one by one.

Defined results: null text equals empty text; texts of any length are compared
whole; every row counts: rows that repeat a ``doc_id`` and its text are returned
each, a ``doc_id`` with several texts belongs to the group of each, a null one is
never the smallest (a group of null ids alone has none to keep and keeps its
rows). Where ids are null or have several texts, names are taken from numbers of
the distinct (id, text) instead of the ids, so that unequal texts stay apart.
Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.llm.staging import release, stage, unstage

#: Code points of a block.
BLOCK_CHARS = 4096


#: Runs of white space but for a space alone, which stays as it is.
_RUN = r"[\x20\x09-\x0D](?:(?<!\x20)|(?=[\x20\x09-\x0D]))[\x20\x09-\x0D]*"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), _RUN, " ")


def _named(rows: DataFrame, *content: str) -> DataFrame:
    """Replace ``content`` by the name of each group of equal content at a place."""
    place = ["blocks", "pos", *content]
    names = rows.groupBy(*place).agg(F.min("who").alias("name"))
    return rows.join(names, place).select("who", "blocks", "pos", "name", "text_sha256")


def _blocks_named(texts: DataFrame, block_chars: int) -> DataFrame:
    """Staged names of the blocks of ``(who, text)`` rows."""
    parts = F.when(F.length("text") <= block_chars, F.array("text")).otherwise(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0)))
    cut = texts.select("who", F.sha2("text", 256).alias("text_sha256"), parts.alias("parts"))
    rows = cut.select("who", F.size("parts").alias("blocks"), "text_sha256", F.posexplode("parts").alias("pos", "block"))
    rows = rows.withColumn("text_sha256", F.when(F.col("pos") == 0, F.col("text_sha256")))
    return stage(_named(rows, "block"), "names")


def _named_whole(now: DataFrame) -> DataFrame:
    """From the names of blocks the staged name ``(who, name)`` of each text;
    ``now`` is removed."""
    most = now.agg(F.max("blocks")).first()[0] or 1
    width = 1
    while width < most:
        even = F.col("pos") % 2 == 0
        pairs = now.groupBy("who", F.expr("pos div 2").cast("int").alias("pos")).agg(
            F.max("blocks").alias("blocks"),
            F.max(F.when(even, F.col("name"))).alias("a"),
            F.max(F.when(~even, F.col("name"))).alias("b"),
            F.max("text_sha256").alias("text_sha256"),
        )
        # Whether a pair is complete follows from the count and the place.
        above = stage(_named(pairs.withColumn("b", F.coalesce("b", "a")), "a", "b"), "names")
        unstage(now)
        now, width = above, width * 2
    out = stage(now.groupBy("who").agg(F.min("name").alias("name")), "identities")
    unstage(now)
    return out


def name_documents(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Staged ``(doc_id, text_sha256, copies, keep_id, group_size)``, one row per
    distinct ``doc_id`` and text: how many rows have it, the smallest ``doc_id`` of
    an equal text and the rows of that text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("who"), normalised(F.col("text")).alias("text"))
    now = _blocks_named(texts, block_chars)
    ids = stage(now.where("pos = 0").groupBy("who", "text_sha256").agg(F.count("*").alias("copies")), "ids")
    ids = ids.select(F.col("who").alias("doc_id"), "text_sha256", "copies")
    shared = ids.groupBy("doc_id").agg(F.count("*").alias("texts")).where("texts > 1 OR doc_id IS NULL")
    if shared.isEmpty():
        ids = ids.withColumn("who", F.col("doc_id"))
    else:
        unstage(now)
        ids = stage(ids.withColumn("who", F.monotonically_increasing_id()), "numbered")
        row = texts.select(F.col("who").alias("id"), "text", F.sha2("text", 256).alias("sha"))
        own = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("sha") == F.col("text_sha256"))
        now = _blocks_named(row.join(ids, own).select("who", "text"), block_chars)
    release(now.sparkSession)
    names = _named_whole(now)
    found = ids.join(names, "who")
    groups = found.groupBy("name").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    out = found.join(groups, "name").select("doc_id", "text_sha256", "copies", "keep_id", "group_size")
    out = stage(out, "groups")
    unstage(names)
    return out


def exact_groups(docs: DataFrame) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per row."""
    rows = name_documents(docs).select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return rows.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
