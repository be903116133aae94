"""Landed JSON payloads of the movie search/detail API.

The reference calls the API page by page; here the responses are assumed
to be landed as text (one payload per row) and parsed set-based with
``from_json`` against fixed schemas — no per-row Python.

Search: ``{"Response": "True"|"False", "Search": [{"imdbID": …}, …]}``.
A page answering ``"False"`` ends paging for its search term: later pages
of that term are ignored, like the reference's loop does.
Detail: ``{"Title", "Genre", "Year", "Country", "imdbRating"}``; a missing
Genre means ``""``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEARCH_SCHEMA = T.StructType([
    T.StructField("Response", T.StringType()),
    T.StructField("Search", T.ArrayType(T.StructType([T.StructField("imdbID", T.StringType())]))),
])

DETAIL_SCHEMA = T.StructType([
    T.StructField("Title", T.StringType()),
    T.StructField("Genre", T.StringType()),
    T.StructField("Year", T.StringType()),
    T.StructField("Country", T.StringType()),
    T.StructField("imdbRating", T.StringType()),
])


def search_hits(
    pages: DataFrame,
    term_col: str = "term",
    page_col: str = "page",
    payload_col: str = "payload",
    max_pages: int | None = None,
) -> DataFrame:
    """``(term, page, hit, imdbID)`` for every hit of every page that was
    read: pages of a term after its first ``"False"`` page are skipped.

    The per-term stop page is a grouped minimum over failed pages (one row
    per term), joined back; no group ever holds hit-level data.
    """
    parsed = pages.select(
        term_col, page_col, F.from_json(F.col(payload_col), SEARCH_SCHEMA).alias("_p")
    )
    if max_pages is not None:
        parsed = parsed.where(F.col(page_col) <= max_pages)
    failed = F.col("_p.Response") == F.lit("False")
    # One row per term that failed somewhere (partial min per task): bounded by
    # the search terms, so the parsed pages stay where they are.
    stops = parsed.where(failed).groupBy(term_col).agg(F.min(page_col).alias("_stop"))
    read = parsed.join(F.broadcast(stops), term_col, "left").where(
        F.col("_stop").isNull() | (F.col(page_col) < F.col("_stop"))
    )
    hits = read.select(
        term_col,
        page_col,
        F.posexplode(F.coalesce(F.col("_p.Search"), F.array().cast(SEARCH_SCHEMA["Search"].dataType))).alias(
            "hit", "_h"
        ),
    )
    return hits.select(term_col, page_col, F.col("hit").cast("int").alias("hit"), F.col("_h.imdbID").alias("imdbID"))


def detail_projection(details: DataFrame, id_col: str = "imdbID", payload_col: str = "payload") -> DataFrame:
    """Lake movie rows from detail payloads (missing Genre → ``""``)."""
    p = F.from_json(F.col(payload_col), DETAIL_SCHEMA)
    return details.select(id_col, p.alias("_d")).select(
        F.col(id_col),
        F.col("_d.Title").alias("title"),
        F.coalesce(F.col("_d.Genre"), F.lit("")).alias("genre"),
        F.col("_d.Year").alias("year"),
        F.col("_d.Country").alias("country"),
        F.col("_d.imdbRating").alias("imdbRating"),
    )
