"""Building the lake's movie file from landed API payloads.

The reference walks search terms page by page, looks up each new hit's
details and accepts it into the first target genre it contains whose quota
is still open. Set-based:

1. hits of every page that was read (``search_hits``), positioned by the
   struct (term priority, page, hit); hits of terms that are not searched are
   left out;
2. joined to the detail projection on the id (both sides grow with the
   data: a keyed shuffle join, AQE may broadcast a small side);
3. the priority-quota cascade (``quota_select``), which also skips ids
   already seen.

The reference stops fetching once every quota is full; that only avoids
work and never changes which titles are accepted.

``generate_lake`` then adds users with seeded categories and ``k`` sampled
ratings per user, and ``write_lake`` lands the three CSV files the load
reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.fixed_values import RATINGS_PER_USER, SEARCH_TERMS, SEED
from cinelake.operators.keys import dense_index
from cinelake.operators.sampling import (
    assign_categories,
    quota_select,
    sample_k,
    synthetic_scores,
)
from cinelake.sources.lake import write_lake_csv
from cinelake.sources.payloads import detail_projection, search_hits


def select_lake_movies(
    pages: DataFrame,
    details: DataFrame,
    targets: Sequence[str],
    quota: int,
    terms: Sequence[str] = SEARCH_TERMS,
    max_pages: int | None = None,
) -> DataFrame:
    """Accepted lake movie rows (``imdbID, title, genre, year, country,
    imdbRating``) with the target genre each was accepted for. ``max_pages``:
    read this many pages of a term at most (the reference: SEARCH_PAGES)."""
    order = F.array(*[F.lit(t) for t in terms])
    searched = pages.where(F.col("term").isin(*terms))
    hits = search_hits(searched, max_pages=max_pages).select(
        "imdbID", F.struct(F.array_position(order, F.col("term")).alias("priority"), "page", "hit").alias("pos")
    )
    candidates = hits.join(detail_projection(details), "imdbID", "inner")
    accepted = quota_select(candidates, targets, quota, id_col="imdbID", position="pos", text_col="genre")
    return accepted.select("imdbID", "title", "genre", "year", "country", "imdbRating", "target")


def generate_lake(
    movies: DataFrame,
    users: DataFrame,
    k: int = RATINGS_PER_USER,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three lake tables (text columns, as written to CSV).

    ``movies``: accepted lake movie rows (``select_lake_movies``);
    ``users``: ``user_id``/``name`` rows. Every user gets a seeded age group
    and country, and ``min(k, #movies)`` distinct titles with a seeded score
    and the fixed date; ratings are numbered 1..N by (user, draw).
    """
    lake_movies = movies.select("imdbID", "title", "genre", "year", "country", "imdbRating")
    cats = assign_categories(users.select("user_id"), "user_id", seed)
    lake_users = users.select("user_id", "name").join(cats, "user_id", "inner").select(
        F.col("user_id").cast("string").alias("id"), "name", "age_group", "country"
    )
    pairs = sample_k(users.select("user_id"), movies.select(F.col("imdbID").alias("movie_id")),
                     "user_id", "movie_id", k=k, seed=seed)
    scored = synthetic_scores(pairs.select("user_id", "movie_id", "draw"), ["user_id", "movie_id"], seed)
    numbered = dense_index(
        scored,
        [F.col("user_id").asc(), F.col("draw").asc()],
        name="id",
    )
    lake_ratings = numbered.select(
        F.col("id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("user_id"),
        "movie_id",
        F.col("score").cast("string").alias("score"),
        F.col("rated_at").cast("string").alias("rated_at"),
    )
    return lake_movies, lake_users, lake_ratings


def write_lake(out_dir: str, movies: DataFrame, users: DataFrame, ratings: DataFrame) -> None:
    """Write ``movies.csv``, ``users.csv`` and ``ratings.csv`` under ``out_dir``."""
    base = out_dir.rstrip("/")
    write_lake_csv(movies, f"{base}/movies.csv")
    write_lake_csv(users, f"{base}/users.csv")
    write_lake_csv(ratings, f"{base}/ratings.csv")
