"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The driver registers the raw test tables as views; every statement here
first derives the star schema (and any other fixture) from them with the
same mapping as ``cinelake.sources.adapters`` and then states the query
plainly, so the two engines share inputs but not code paths.

Conventions shared with the Spark side:
* averages are exact and rounded once, half away from zero; DuckDB's
  ``avg(decimal)`` is a DOUBLE, so the oracle rounds integer cents instead;
* DESC puts NULLs first, ASC puts them last, and every LIMIT/ROW_NUMBER
  ends with a key tie-break;
* decimals are returned as DOUBLE.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixture CTEs
# ---------------------------------------------------------------------------

CTE = {
    "dim_movie": """
SELECT CAST(p_partkey AS VARCHAR) AS movie_id, p_name AS title,
  CASE WHEN p_partkey % 31 = 0 THEN NULL
       WHEN p_partkey % 2 = 0 THEN p_type
       ELSE concat(p_type, ', ', p_brand) END AS genre,
  CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE CAST(1950 + p_size AS INT) END AS year,
  CASE WHEN p_partkey % 43 = 0 THEN NULL ELSE p_brand END AS country,
  CASE WHEN p_partkey % 47 = 0 THEN NULL
       ELSE CAST(CAST(p_partkey % 101 AS DECIMAL(5,1)) / 10 AS DECIMAL(3,1)) END AS imdb_rating
FROM part""",
    "dim_user": """
SELECT CAST(c_custkey AS INT) AS user_id, c_name AS name,
  CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_mktsegment END AS age_group,
  CASE WHEN c_nationkey = 13 THEN NULL ELSE n_name END AS country
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "fact_rating": """
SELECT l_orderkey * 10 + l_linenumber AS rating_id,
  CAST(CASE WHEN l_partkey > 0 AND l_partkey % 23 = 0 THEN l_partkey - 1 ELSE l_partkey END AS VARCHAR) AS movie_id,
  CAST(o_custkey AS INT) AS user_id,
  CASE WHEN l_linenumber = 7 OR l_partkey % 29 = 0 THEN NULL
       ELSE CAST(CAST(CAST(l_quantity AS INT) * 20 AS DECIMAL(6,2)) / 100 AS DECIMAL(4,2)) END AS score,
  CASE WHEN l_suppkey % 53 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS rated_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}

# Dependencies between fixture CTEs (each listed after what it reads).
_DEPS: dict[str, list[str]] = {}

_ORDER = list(CTE)


def with_fixtures(body: str, *names: str) -> str:
    """Prefix ``body`` with the fixture CTEs it reads (and their inputs).

    ``body`` may start with its own ``WITH`` list; it is merged.
    """
    needed: list[str] = []

    def add(n: str) -> None:
        for d in _DEPS.get(n, []):
            add(d)
        if n not in needed:
            needed.append(n)

    for n in names:
        add(n)
    needed.sort(key=_ORDER.index)
    parts = [f"{n} AS ({CTE[n].strip()})" for n in needed]
    body = body.strip()
    if body[:4].upper() == "WITH":
        return "WITH " + ",\n".join(parts) + ",\n" + body[4:].lstrip()
    return "WITH " + ",\n".join(parts) + "\n" + body


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------

SQL: dict[str, str] = {}

# Reduced ratings: one row per title, per user. An average is a pair (cents,
# scored) until it is rounded or ranked, so groups of rows add up exactly.
_SUMS = """CAST(coalesce(sum(score), 0) * 100 AS BIGINT) AS cents, count(score) AS scored,
  count(*) AS rated, max(score) AS best, min(score) AS worst"""
CTE["per_title"] = f"SELECT movie_id, {_SUMS} FROM fact_rating GROUP BY movie_id"
CTE["per_user"] = f"SELECT user_id, {_SUMS} FROM fact_rating GROUP BY user_id"
CTE["rated_titles"] = """
SELECT d.*, split_part(d.genre, ',', 1) AS first_genre, coalesce(t.cents, 0) AS cents, coalesce(t.scored, 0) AS scored,
  coalesce(t.rated, 0) AS rated, t.best, t.worst
FROM dim_movie d LEFT JOIN per_title t USING (movie_id)"""
CTE["rating_users"] = "SELECT * FROM dim_user JOIN per_user USING (user_id)"
_DEPS.update({
    "per_title": ["fact_rating"],
    "per_user": ["fact_rating"],
    "rated_titles": ["dim_movie", "per_title"],
    "rating_users": ["dim_user", "per_user"],
})
_ORDER[:] = list(CTE)


def _mean(cents: str = "cents", scored: str = "scored") -> str:
    """Cents over a count, rounded half up to whole cents, in units."""
    return f"CASE WHEN {scored} > 0 THEN CAST((2 * {cents} + {scored}) // (2 * {scored}) AS DOUBLE) / 100 END"


_GROUP_MEAN = _mean("sum(cents)::BIGINT", "sum(scored)::BIGINT")
_TITLE_RANK = "CASE WHEN scored > 0 THEN CAST(cents AS HUGEINT) * 1000000000000 // scored END DESC NULLS FIRST, rated DESC, movie_id"

# -- dashboards ---------------------------------------------------------------

SQL["dashboard_top_movies"] = with_fixtures(f"""
SELECT movie_id AS imdb_id, title, genre, year, CAST(imdb_rating AS DOUBLE) AS imdb_rating,
       rated AS num_ratings, {_mean()} AS avg_score
FROM rated_titles ORDER BY rated DESC, movie_id LIMIT 5""", "rated_titles")

SQL["dashboard_totals"] = with_fixtures(f"""
WITH whole AS (SELECT sum(rated)::BIGINT AS total_ratings, {_GROUP_MEAN} AS avg_rating FROM per_title),
     titles AS (SELECT count(*) AS total_movies FROM dim_movie),
     people AS (SELECT count(*) AS total_users FROM dim_user)
SELECT total_movies, total_users, total_ratings, avg_rating FROM titles, people, whole""",
                                         "dim_movie", "dim_user", "per_title")

SQL["catalog"] = with_fixtures(f"""
SELECT movie_id AS imdb_id, title, genre, year, country, CAST(imdb_rating AS DOUBLE) AS imdb_rating,
       rated AS num_ratings, {_mean()} AS avg_score
FROM rated_titles ORDER BY title NULLS LAST, movie_id""", "rated_titles")

# The detail page's bound parameter (a title that exists and has ratings).
DETAIL_MOVIE_ID = "1"

SQL["movie_record"] = with_fixtures(f"""
SELECT movie_id AS imdb_id, title, genre, year, country, CAST(imdb_rating AS DOUBLE) AS imdb_rating
FROM dim_movie WHERE movie_id = '{DETAIL_MOVIE_ID}'""", "dim_movie")

SQL["movie_ratings"] = with_fixtures(f"""
WITH chosen AS (SELECT user_id, score, rated_at FROM fact_rating WHERE movie_id = '{DETAIL_MOVIE_ID}')
SELECT name, age_group, country, CAST(score AS DOUBLE) AS score, rated_at
FROM chosen JOIN dim_user USING (user_id)
ORDER BY rated_at DESC NULLS FIRST, name, score DESC NULLS FIRST""", "fact_rating", "dim_user")

SQL["movie_stats"] = with_fixtures(f"""
WITH one AS (SELECT {_SUMS} FROM fact_rating WHERE movie_id = '{DETAIL_MOVIE_ID}')
SELECT rated AS total, {_mean()} AS avg, CAST(best AS DOUBLE) AS max_score, CAST(worst AS DOUBLE) AS min_score
FROM one""", "fact_rating")

# -- analytics ----------------------------------------------------------------

_MOST_RATED = "FROM rated_titles WHERE rated > 0 ORDER BY rated DESC, movie_id LIMIT 5"
SQL["popular_titles"] = with_fixtures(
    f"SELECT title, genre, rated AS total_ratings, {_mean()} AS avg_score {_MOST_RATED}", "rated_titles")
SQL["popular_titles_short"] = with_fixtures(
    f"SELECT title, rated AS total_ratings, {_mean()} AS avg_score {_MOST_RATED}", "rated_titles")

for _name, _rows in (("genre_by_primary", 10), ("genre_by_primary_top5", 5)):
    SQL[_name] = with_fixtures(f"""
SELECT first_genre AS primary_genre, sum(rated)::BIGINT AS total_ratings, {_GROUP_MEAN} AS avg_score
FROM rated_titles WHERE rated > 0 AND genre IS NOT NULL
GROUP BY first_genre ORDER BY avg_score DESC NULLS FIRST, primary_genre LIMIT {_rows}""", "rated_titles")

SQL["genre_by_full_list"] = with_fixtures(f"""
WITH lists AS (
  SELECT genre AS genre_list, first_genre, {_GROUP_MEAN} AS avg_score, sum(rated)::BIGINT AS num_ratings
  FROM rated_titles WHERE rated > 0 AND genre IS NOT NULL GROUP BY genre, first_genre),
     kept AS (SELECT * FROM lists ORDER BY avg_score DESC NULLS FIRST, genre_list LIMIT 10)
SELECT first_genre AS genre, avg_score, num_ratings FROM kept""", "rated_titles")

SQL["country_activity"] = with_fixtures(f"""
WITH seen AS (SELECT country, count(DISTINCT movie_id) AS distinct_movies_watched
              FROM (SELECT DISTINCT user_id, movie_id FROM fact_rating) JOIN dim_user USING (user_id)
              WHERE country IS NOT NULL GROUP BY country),
     sums AS (SELECT country, sum(rated)::BIGINT AS total_ratings, {_GROUP_MEAN} AS avg_score
              FROM rating_users GROUP BY country)
SELECT country, total_ratings, distinct_movies_watched, avg_score
FROM sums JOIN seen USING (country) ORDER BY total_ratings DESC, country LIMIT 10""", "rating_users", "fact_rating", "dim_user")


def _by_user(attribute: str, count: str, tail: str) -> str:
    return with_fixtures(f"""
SELECT {attribute}, sum(rated)::BIGINT AS {count}, {_GROUP_MEAN} AS avg_score
FROM rating_users WHERE {attribute} IS NOT NULL GROUP BY {attribute} {tail}""", "rating_users")


SQL["country_top5"] = _by_user("country", "total_ratings", "ORDER BY total_ratings DESC, country LIMIT 5")

# -- marts --------------------------------------------------------------------

_PLACED = f"""
WITH placed AS (
  SELECT first_genre AS primary_genre, movie_id, title, {_mean()} AS avg_score, rated AS total_ratings,
         row_number() OVER (PARTITION BY first_genre ORDER BY {_TITLE_RANK}) AS rk
  FROM rated_titles WHERE rated > 0 AND genre IS NOT NULL)
"""
SQL["mart_top10_by_genre"] = with_fixtures(_PLACED + """
SELECT primary_genre, movie_id, title, avg_score, total_ratings
FROM placed WHERE rk <= 10 ORDER BY primary_genre, rk""", "rated_titles")

SQL["mart_top10_display"] = with_fixtures(_PLACED + """
SELECT primary_genre, title, avg_score, total_ratings
FROM placed WHERE rk <= 10 ORDER BY primary_genre, rk""", "rated_titles")

SQL["mart_avg_by_age_group"] = _by_user("age_group", "total_ratings", "ORDER BY avg_score DESC NULLS FIRST, age_group")
SQL["mart_ratings_by_country"] = _by_user("country", "total_ratings", "ORDER BY total_ratings DESC, country")
SQL["mart_country_top10"] = _by_user("country", "num_ratings", "ORDER BY num_ratings DESC, country LIMIT 10")

# -- fixtures for cleaning, integrity, loads and sampling -------------------------

from cinelake.functions.scalar import NA_TOKENS, PLACEHOLDER  # noqa: E402
from cinelake.fixed_values import AGE_GROUPS, COUNTRIES, SEARCH_TERMS  # noqa: E402


def _na(col: str) -> str:
    tokens = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)
    return f"CASE WHEN {col} IN ({tokens}) THEN NULL ELSE {col} END"


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _number(col: str) -> str:
    """Plain decimal notation only (see the Spark side), else NULL."""
    pattern = r"\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*"
    return f"CASE WHEN regexp_full_match({col}, '{pattern}') THEN TRY_CAST(trim({col}) AS DOUBLE) END"


def _hash(expr: str, offset: int = 0, digits: int = 8) -> str:
    return f"CAST(('0x' || substr(md5({expr}), {1 + digits * offset}, {digits})) AS BIGINT)"


_MK = "CAST(movie_id AS BIGINT)"

CTE.update({
    "raw_movies": f"""
SELECT movie_id AS imdbID, concat('  ', title, ' ') AS title,
  CASE WHEN {_MK} % 11 = 0 THEN 'N/A' ELSE coalesce(genre, '') END AS genre,
  CASE WHEN {_MK} % 6 = 0 THEN '2010–2015' WHEN {_MK} % 6 = 1 THEN 'N/A' WHEN {_MK} % 12 = 2 THEN '1999.5'
       WHEN {_MK} % 12 = 8 THEN '1999d' WHEN {_MK} % 6 = 3 THEN ' 1999 '
       ELSE coalesce(CAST(year AS VARCHAR), '') END AS year,
  CASE WHEN {_MK} % 13 = 0 THEN 'null' ELSE coalesce(country, '') END AS country,
  CASE WHEN {_MK} % 8 = 0 THEN 'N/A' WHEN {_MK} % 8 = 4 THEN '0x1p3' WHEN {_MK} % 4 = 1 THEN '7.85'
       WHEN {_MK} % 4 = 2 THEN '8.05'
       ELSE coalesce(CAST(imdb_rating AS VARCHAR), '') END AS imdbRating
FROM dim_movie""",
    "raw_users": """
SELECT CAST(user_id AS VARCHAR) AS id, concat(' ', name, '  ') AS name,
  CASE WHEN user_id % 9 = 0 THEN 'NA' ELSE coalesce(age_group, '') END AS age_group,
  coalesce(country, '') AS country
FROM dim_user""",
    "raw_ratings": """
SELECT CAST(rating_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, movie_id,
  CASE WHEN rating_id % 14 = 0 THEN 'abc' WHEN rating_id % 14 = 7 THEN '7.5d' WHEN rating_id % 7 = 1 THEN ''
       WHEN rating_id % 7 = 2 THEN 'nan'
       ELSE coalesce(CAST(score AS VARCHAR), '') END AS score,
  CASE rating_id % 5 WHEN 0 THEN '15/02/2024' WHEN 1 THEN '2024-02-30'
       ELSE coalesce(CAST(rated_at AS VARCHAR), '') END AS rated_at
FROM fact_rating""",
    "lake_movies": "SELECT " + ", ".join(
        f"{_na(c)} AS {c}" for c in ["imdbID", "title", "genre", "year", "country", "imdbRating"]
    ) + " FROM raw_movies",
    "lake_users": "SELECT " + ", ".join(
        f"{_na(c)} AS {c}" for c in ["id", "name", "age_group", "country"]
    ) + " FROM raw_users",
    "lake_ratings": "SELECT " + ", ".join(
        f"{_na(c)} AS {c}" for c in ["id", "user_id", "movie_id", "score", "rated_at"]
    ) + " FROM raw_ratings",
    "clean_ratings": f"""
SELECT CAST(id AS BIGINT) AS lake_id, movie_id, CAST(user_id AS INT) AS user_id,
  CAST({_number('score')} AS DECIMAL(4,2)) AS score,
  CAST(try_strptime(rated_at, '%Y-%m-%d') AS DATE) AS rated_at
FROM lake_ratings""",
    "bad_dim_movie": f"""
SELECT CASE WHEN {_MK} % 89 <> 0 THEN CASE WHEN {_MK} % 83 = 1 THEN repeat('x', 300) ELSE movie_id END END AS movie_id,
  CASE WHEN {_MK} % 79 <> 0 THEN CASE WHEN {_MK} % 73 = 1 THEN repeat('x', 300) ELSE title END END AS title,
  CASE WHEN {_MK} % 71 = 0 THEN repeat('x', 300) ELSE genre END AS genre,
  CASE WHEN {_MK} % 67 = 0 THEN repeat('x', 300) ELSE country END AS country
FROM dim_movie""",
    "bad_dim_user": """
SELECT CASE WHEN user_id % 61 <> 0 THEN user_id END AS user_id,
  CASE WHEN user_id % 59 <> 0 THEN CASE WHEN user_id % 53 = 1 THEN repeat('x', 300) ELSE name END END AS name,
  CASE WHEN user_id % 47 = 0 THEN repeat('x', 300) ELSE age_group END AS age_group,
  CASE WHEN user_id % 43 = 0 THEN repeat('x', 300) ELSE country END AS country
FROM dim_user""",
    "bad_fact_rating": """
SELECT CASE WHEN rating_id % 101 <> 0 THEN rating_id END AS rating_id,
  CASE WHEN rating_id % 103 <> 0 THEN CASE WHEN rating_id % 107 = 1 THEN repeat('x', 300) ELSE movie_id END END AS movie_id,
  CASE WHEN rating_id % 109 <> 0 THEN user_id END AS user_id
FROM fact_rating""",
    "dim_movie_partial": f"SELECT * FROM dim_movie WHERE {_MK} % 19 <> 0",
    "dim_user_partial": "SELECT * FROM dim_user WHERE user_id % 19 <> 0",
    "candidates": f"""
SELECT movie_id AS id, title, genre, {_MK} AS pos FROM dim_movie
UNION ALL
SELECT movie_id AS id, title, genre, {_MK} + 1000000000000000 AS pos FROM dim_movie WHERE {_MK} % 7 = 0""",
    "first_candidates": """
SELECT id, title, genre, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS rn FROM candidates) WHERE rn = 1""",
    "quota_sel": """
WITH t1 AS (SELECT id, title, genre, pos, 'ECONOMY' AS target FROM first_candidates
            WHERE contains(coalesce(genre, ''), 'ECONOMY') ORDER BY pos, id LIMIT 15),
     t2 AS (SELECT id, title, genre, pos, 'Brand#1' AS target FROM first_candidates
            WHERE contains(coalesce(genre, ''), 'Brand#1') AND id NOT IN (SELECT id FROM t1)
            ORDER BY pos, id LIMIT 15),
     t3 AS (SELECT id, title, genre, pos, 'SMALL' AS target FROM first_candidates
            WHERE contains(coalesce(genre, ''), 'SMALL') AND id NOT IN (SELECT id FROM t1)
              AND id NOT IN (SELECT id FROM t2)
            ORDER BY pos, id LIMIT 15)
SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3""",
    "sample_pairs": f"""
WITH items AS (SELECT movie_id, row_number() OVER (ORDER BY movie_id) - 1 AS idx FROM dim_movie),
     n AS (SELECT count(*) AS n FROM items),
     keyed AS (SELECT user_id, {_hash("'42|' || CAST(user_id AS VARCHAR)", 0, 15)} AS h1,
                      {_hash("'42|' || CAST(user_id AS VARCHAR)", 1, 15)} AS h2 FROM dim_user),
     draws AS (SELECT user_id, n, h1 % n AS st, 1 + h2 % (n // least(5, n)) AS step,
                      unnest(range(0, least(5, n))) AS draw
               FROM keyed, n WHERE n > 0)
SELECT d.user_id, i.movie_id, CAST(d.draw AS INT) AS draw
FROM draws d JOIN items i ON i.idx = (d.st + d.draw * d.step) % d.n""",
})

_DEPS.update({
    "bad_dim_movie": ["dim_movie"],
    "bad_dim_user": ["dim_user"],
    "bad_fact_rating": ["fact_rating"],
    "raw_movies": ["dim_movie"],
    "raw_users": ["dim_user"],
    "raw_ratings": ["fact_rating"],
    "lake_movies": ["raw_movies"],
    "lake_users": ["raw_users"],
    "lake_ratings": ["raw_ratings"],
    "clean_ratings": ["lake_ratings"],
    "dim_movie_partial": ["dim_movie"],
    "dim_user_partial": ["dim_user"],
    "candidates": ["dim_movie"],
    "first_candidates": ["candidates"],
    "quota_sel": ["first_candidates"],
    "sample_pairs": ["dim_movie", "dim_user"],
})
_ORDER[:] = list(CTE)


def _strip(col: str) -> str:
    return f"regexp_replace(regexp_replace({col}, '^\\s+', ''), '\\s+$', '')"


# -- cleaning ---------------------------------------------------------------------------

SQL["clean_movies"] = with_fixtures(f"""
SELECT imdbID AS movie_id, {_strip('title')} AS title, genre,
  CAST(trunc({_number('year')}) AS INT) AS year, country,
  CAST(CAST({_number('imdbRating')} AS DECIMAL(3,1)) AS DOUBLE) AS imdb_rating
FROM lake_movies""", "lake_movies")

SQL["clean_users"] = with_fixtures(f"""
SELECT CAST(id AS INT) AS user_id, {_strip('name')} AS name, age_group, country
FROM lake_users""", "lake_users")

SQL["clean_ratings"] = with_fixtures("""
SELECT movie_id, user_id, CAST(score AS DOUBLE) AS score, rated_at FROM clean_ratings""", "clean_ratings")


def _missing_counts(table: str, cte: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS missing "
        f"FROM {cte}"
        for c in cols
    )


SQL["na_tokens"] = with_fixtures(
    _missing_counts("movies", "lake_movies", ["imdbID", "title", "genre", "year", "country", "imdbRating"])
    + "\nUNION ALL\n"
    + _missing_counts("users", "lake_users", ["id", "name", "age_group", "country"])
    + "\nUNION ALL\n"
    + _missing_counts("ratings", "lake_ratings", ["id", "user_id", "movie_id", "score", "rated_at"]),
    "lake_movies", "lake_users", "lake_ratings",
)

_CHECKS = {
    "dim_movie": [
        ("movie_id_not_null", "movie_id IS NULL"),
        ("movie_id_length", "length(movie_id) > 20"),
        ("title_not_null", "title IS NULL"),
        ("title_length", "length(title) > 255"),
        ("genre_length", "length(genre) > 255"),
        ("country_length", "length(country) > 255"),
    ],
    "dim_user": [
        ("user_id_not_null", "user_id IS NULL"),
        ("name_not_null", "name IS NULL"),
        ("name_length", "length(name) > 255"),
        ("age_group_length", "length(age_group) > 20"),
        ("country_length", "length(country) > 255"),
    ],
    "fact_rating": [
        ("rating_id_not_null", "rating_id IS NULL"),
        ("movie_id_not_null", "movie_id IS NULL"),
        ("movie_id_length", "length(movie_id) > 20"),
        ("user_id_not_null", "user_id IS NULL"),
    ],
}
SQL["violation_report"] = with_fixtures("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{name}' AS check_name, CAST(count_if({cond}) AS BIGINT) AS violations FROM bad_{t}"
    for t, checks in _CHECKS.items() for name, cond in checks
), "bad_dim_movie", "bad_dim_user", "bad_fact_rating")

SQL["duplicate_keys"] = with_fixtures("""
SELECT rating_id, COUNT(*) AS copies FROM fact_rating GROUP BY rating_id HAVING COUNT(*) > 1""",
                                      "fact_rating")

# -- referential integrity --------------------------------------------------------------

_FACT_COLS = "f.rating_id, f.movie_id, f.user_id, CAST(f.score AS DOUBLE) AS score, f.rated_at"

SQL["ratings_known_movies"] = with_fixtures(f"""
SELECT {_FACT_COLS} FROM fact_rating f
WHERE EXISTS (SELECT 1 FROM dim_movie_partial m WHERE m.movie_id = f.movie_id)""",
                                            "fact_rating", "dim_movie_partial")

SQL["orphan_movies"] = with_fixtures(f"""
SELECT {_FACT_COLS} FROM fact_rating f
WHERE NOT EXISTS (SELECT 1 FROM dim_movie_partial m WHERE m.movie_id = f.movie_id)""",
                                     "fact_rating", "dim_movie_partial")

SQL["orphan_users"] = with_fixtures(f"""
SELECT {_FACT_COLS} FROM fact_rating f
WHERE NOT EXISTS (SELECT 1 FROM dim_user_partial u WHERE u.user_id = f.user_id)""",
                                    "fact_rating", "dim_user_partial")

SQL["cascade_delete"] = with_fixtures(f"""
SELECT {_FACT_COLS} FROM fact_rating f
WHERE f.movie_id NOT IN (SELECT movie_id FROM dim_movie WHERE {_MK} % 19 = 0)
  AND f.user_id NOT IN (SELECT user_id FROM dim_user WHERE user_id % 17 = 0)""",
                                      "fact_rating", "dim_movie", "dim_user")

# -- loads -------------------------------------------------------------------------------

SQL["upsert_dim_movie"] = with_fixtures(f"""
WITH base AS (SELECT * FROM dim_movie WHERE {_MK} % 3 <> 0),
     batch AS (
       SELECT movie_id, 'v1 ' || title AS title, genre, year, country, imdb_rating, {_MK} AS pos
       FROM dim_movie WHERE {_MK} % 3 <> 1
       UNION ALL
       SELECT movie_id, 'v2 ' || title AS title, genre, year, country, imdb_rating, {_MK} + 1000000000000000 AS pos
       FROM dim_movie WHERE {_MK} % 5 = 0),
     all_rows AS (
       SELECT movie_id, title, genre, year, country, imdb_rating, 0 AS src, 0 AS pos FROM base
       UNION ALL
       SELECT movie_id, title, genre, year, country, imdb_rating, 1 AS src, pos FROM batch)
SELECT movie_id, title, genre, year, country, CAST(imdb_rating AS DOUBLE) AS imdb_rating FROM (
  SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY src DESC, pos DESC) AS rn FROM all_rows)
WHERE rn = 1""", "dim_movie")

SQL["upsert_dim_user"] = with_fixtures("""
WITH base AS (SELECT * FROM dim_user WHERE user_id % 3 <> 0),
     batch AS (
       SELECT user_id, 'v1 ' || name AS name, age_group, country, CAST(user_id AS BIGINT) AS pos
       FROM dim_user WHERE user_id % 3 <> 1
       UNION ALL
       SELECT user_id, 'v2 ' || name AS name, age_group, country, CAST(user_id AS BIGINT) + 1000000000000000 AS pos
       FROM dim_user WHERE user_id % 5 = 0),
     all_rows AS (
       SELECT user_id, name, age_group, country, 0 AS src, 0 AS pos FROM base
       UNION ALL
       SELECT user_id, name, age_group, country, 1 AS src, pos FROM batch)
SELECT user_id, name, age_group, country FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY src DESC, pos DESC) AS rn FROM all_rows)
WHERE rn = 1""", "dim_user")

SQL["refresh_fact"] = with_fixtures("""
SELECT row_number() OVER (ORDER BY lake_id NULLS FIRST, movie_id NULLS FIRST, user_id NULLS FIRST,
                                   score NULLS FIRST, rated_at NULLS FIRST) AS rating_id,
       movie_id, user_id, CAST(score AS DOUBLE) AS score, rated_at
FROM clean_ratings""", "clean_ratings")

SQL["surrogate_keys"] = with_fixtures(f"""
SELECT row_number() OVER (ORDER BY {_MK}) AS id, movie_id AS imdb_id, title FROM dim_movie""", "dim_movie")

SQL["load_counts"] = with_fixtures("""
SELECT 'dim_movie' AS table_name, COUNT(*) AS rows_loaded FROM dim_movie
UNION ALL SELECT 'dim_user', COUNT(*) FROM dim_user
UNION ALL SELECT 'fact_rating', COUNT(*) FROM fact_rating""", "dim_movie", "dim_user", "fact_rating")

# -- JSON payloads (expected hits derived from ``part`` directly) ------------------------

_HITS = f"""
WITH pg AS (SELECT CAST(p_partkey % 4 AS INT) AS ti, p_partkey // 40 + 1 AS page, p_partkey AS k FROM part),
     ends AS (SELECT ti, max(page) AS last FROM pg GROUP BY ti),
     stops AS (SELECT ti, CASE WHEN ti = 2 THEN last - last // 10 ELSE last + 1 END AS stop FROM ends)
SELECT {_list(SEARCH_TERMS)}[pg.ti + 1] AS term, pg.page,
       CAST(row_number() OVER (PARTITION BY pg.ti, pg.page ORDER BY pg.k) - 1 AS INT) AS hit,
       CAST(pg.k AS VARCHAR) AS imdbID
FROM pg JOIN stops USING (ti)
WHERE pg.page < stops.stop AND (pg.ti + pg.page) % 11 <> 0"""
SQL["search_hits"] = _HITS

SQL["detail_projection"] = with_fixtures("""
SELECT movie_id AS imdbID, title, coalesce(genre, '') AS genre, CAST(year AS VARCHAR) AS year,
       country, CAST(imdb_rating AS VARCHAR) AS imdbRating
FROM dim_movie""", "dim_movie")

# -- selection and sampling -----------------------------------------------------------------

SQL["quota_selection"] = with_fixtures("SELECT id, title, genre, pos, target FROM quota_sel", "quota_sel")

SQL["quota_counts"] = with_fixtures("""
SELECT t.target, coalesce(c.n, 0) AS accepted, CAST(sum(coalesce(c.n, 0)) OVER () AS BIGINT) AS total_accepted
FROM (VALUES ('ECONOMY'), ('Brand#1'), ('SMALL')) AS t(target)
LEFT JOIN (SELECT target, COUNT(*) AS n FROM quota_sel GROUP BY target) c ON c.target = t.target""", "quota_sel")

SQL["dedupe_first"] = with_fixtures("SELECT id, title, genre, pos FROM first_candidates", "first_candidates")

SQL["sample_k_per_user"] = with_fixtures("SELECT user_id, movie_id, draw FROM sample_pairs", "sample_pairs")

SQL["assign_categories"] = with_fixtures(f"""
SELECT user_id,
  {_list(AGE_GROUPS)}[1 + {_hash("'42|age|' || CAST(user_id AS VARCHAR)")} % {len(AGE_GROUPS)}] AS age_group,
  {_list(COUNTRIES)}[1 + {_hash("'42|country|' || CAST(user_id AS VARCHAR)")} % {len(COUNTRIES)}] AS country
FROM dim_user""", "dim_user")

SQL["synthetic_scores"] = with_fixtures(f"""
SELECT user_id, movie_id,
  CAST((10 * 4294967296 + 90 * {_hash("'42|score|' || CAST(user_id AS VARCHAR) || '|' || movie_id")}
        + 2147483648) // 4294967296 AS DOUBLE) / 10 AS score,
  DATE '2024-02-15' AS rated_at
FROM sample_pairs""", "sample_pairs")

# -- display ------------------------------------------------------------------------------------

SQL["display_rank"] = with_fixtures(f"""
SELECT row_number() OVER (ORDER BY rated DESC, movie_id) AS position, title, genre, rated AS total_ratings,
       {_mean()} AS avg_score
{_MOST_RATED}""", "rated_titles")

SQL["primary_genre_badge"] = with_fixtures(f"""
SELECT title, split_part(coalesce(nullif(genre, ''), '{PLACEHOLDER}'), ',', 1) AS genre_badge,
       rated AS total_ratings, {_mean()} AS avg_score
{_MOST_RATED}""", "rated_titles")

SQL["genre_headers"] = with_fixtures(_PLACED + """
SELECT primary_genre, title, avg_score, total_ratings, rk, rk = 1 AS is_header
FROM placed WHERE rk <= 10""", "rated_titles")


def _ph(col: str, zero: bool = True) -> str:
    text = f"CAST({col} AS VARCHAR)"
    cond = f"{col} IS NULL OR {text} = ''"
    if zero:
        cond += f" OR TRY_CAST({text} AS DOUBLE) = 0"
    return f"CASE WHEN {cond} THEN '{PLACEHOLDER}' ELSE {text} END"


_AVG_DEC = f"CAST({_mean()} AS DECIMAL(18,2))"

SQL["display_placeholders"] = with_fixtures(f"""
SELECT movie_id AS imdb_id, title, {_ph('genre', False)} AS genre, {_ph('year')} AS year,
       {_ph('country', False)} AS country, {_ph('imdb_rating')} AS imdb_rating,
       coalesce(imdb_rating, 0) <> 0 AS rating_badge, rated AS num_ratings, {_ph(_AVG_DEC)} AS avg_score
FROM rated_titles""", "rated_titles")

SQL["stats_if_rated"] = with_fixtures(f"""
SELECT movie_id AS imdb_id, rated AS total, rated > 0 AS show_stats,
       CASE WHEN rated > 0 THEN {_ph(_AVG_DEC)} END AS avg,
       CAST(best AS DOUBLE) AS max_score, CAST(worst AS DOUBLE) AS min_score
FROM rated_titles""", "rated_titles")

SQL["catalog_size"] = with_fixtures("SELECT count(*) AS num_titles FROM dim_movie", "dim_movie")

# -- lake acquisition ------------------------------------------------------------------------

SQL["lake_movie_selection"] = with_fixtures(f"""
WITH hits AS (
       SELECT imdbID, list_position({_list(SEARCH_TERMS)}, term) AS priority, page, hit
       FROM ({_HITS.strip()})),
     det AS (
       SELECT movie_id AS imdbID, title, coalesce(genre, '') AS genre, CAST(year AS VARCHAR) AS year,
              country, CAST(imdb_rating AS VARCHAR) AS imdbRating FROM dim_movie),
     cand AS (SELECT h.imdbID, d.title, d.genre, d.year, d.country, d.imdbRating, h.priority, h.page, h.hit
              FROM hits h JOIN det d ON d.imdbID = h.imdbID),
     firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY imdbID ORDER BY priority, page, hit) AS rn FROM cand)
                WHERE rn = 1),
     t1 AS (SELECT *, 'ECONOMY' AS target FROM firsts WHERE contains(genre, 'ECONOMY')
            ORDER BY priority, page, hit, imdbID LIMIT 15),
     t2 AS (SELECT *, 'Brand#1' AS target FROM firsts WHERE contains(genre, 'Brand#1')
              AND imdbID NOT IN (SELECT imdbID FROM t1) ORDER BY priority, page, hit, imdbID LIMIT 15),
     t3 AS (SELECT *, 'SMALL' AS target FROM firsts WHERE contains(genre, 'SMALL')
              AND imdbID NOT IN (SELECT imdbID FROM t1) AND imdbID NOT IN (SELECT imdbID FROM t2)
            ORDER BY priority, page, hit, imdbID LIMIT 15)
SELECT imdbID, title, genre, year, country, imdbRating, target FROM t1
UNION ALL SELECT imdbID, title, genre, year, country, imdbRating, target FROM t2
UNION ALL SELECT imdbID, title, genre, year, country, imdbRating, target FROM t3""", "dim_movie")

# -- loaded warehouse -------------------------------------------------------------------

_LOADED = {
    "dim_movie": f"""
SELECT imdbID AS movie_id, {_strip('title')} AS title, genre, CAST(trunc({_number('year')}) AS INT) AS year, country,
  CAST({_number('imdbRating')} AS DECIMAL(3,1)) AS imdb_rating FROM lake_movies""",
    "dim_user": f"SELECT CAST(id AS INT) AS user_id, {_strip('name')} AS name, age_group, country FROM lake_users",
    "fact_rating": f"""
SELECT row_number() OVER (ORDER BY CAST(id AS BIGINT), movie_id, user_id, score, rated_at) AS rating_id,
  movie_id, CAST(user_id AS INT) AS user_id, CAST({_number('score')} AS DECIMAL(4,2)) AS score,
  CAST(try_strptime(rated_at, '%Y-%m-%d') AS DATE) AS rated_at
FROM raw_ratings""",
}


def _over_loaded(query: str) -> str:
    """``query`` over the star as a load of the raw lake leaves it."""
    lake = with_fixtures("", "lake_movies", "lake_users", "raw_ratings").rstrip()
    for table, rows in _LOADED.items():
        lake = lake.replace(f"{table} AS (", f"star_{table} AS (").replace(f"FROM {table})", f"FROM star_{table})")
        query = query.replace(f"{table} AS ({CTE[table].strip()})", f"{table} AS ({rows.strip()})")
    return lake + ",\n" + query.strip()[4:].lstrip()


SQL["loaded_fact"] = _over_loaded(with_fixtures("""
SELECT rating_id, movie_id, user_id, CAST(score AS DOUBLE) AS score, rated_at FROM fact_rating""", "fact_rating"))

SQL["loaded_counts"] = _over_loaded(with_fixtures("""
SELECT CAST(run AS INT) AS run, table_name, rows_loaded FROM (VALUES (1), (2)) runs(run), (
  SELECT 'dim_movie' AS table_name, count(*) AS rows_loaded FROM dim_movie
  UNION ALL SELECT 'dim_user', count(*) FROM dim_user
  UNION ALL SELECT 'fact_rating', count(*) FROM fact_rating)""", "dim_movie", "dim_user", "fact_rating"))

SQL["loaded_dim_movie"] = SQL["upsert_dim_movie"]
SQL["view_top10_by_genre"] = _over_loaded(SQL["mart_top10_by_genre"])
SQL["view_avg_by_age_group"] = _over_loaded(SQL["mart_avg_by_age_group"])
SQL["view_ratings_by_country"] = _over_loaded(SQL["mart_ratings_by_country"])


def _text(table: str, key: str, cols: list[str], source: str) -> str:
    fields = " || '|' || ".join(f"coalesce({_na(c)}, 'NULL')" for c in cols)
    return f"SELECT '{table}' AS table_name, {_na(key)} AS id, {fields} AS fields FROM ({source})"


_QUOTED = """
SELECT imdbID, CASE WHEN CAST(imdbID AS BIGINT) % 17 = 0 THEN concat('"', title, '", part ""2""')
       WHEN CAST(imdbID AS BIGINT) % 41 = 1 THEN concat(title, chr(10), 'second, "line"') ELSE title END AS title,
  genre, year, country, imdbRating FROM raw_movies"""

SQL["lake_round_trip"] = with_fixtures(
    _text("movies", "imdbID", ["title", "genre", "year", "country", "imdbRating"], _QUOTED)
    + "\nUNION ALL\n" + _text("users", "id", ["name", "age_group", "country"], "SELECT * FROM raw_users")
    + "\nUNION ALL\n" + _text("ratings", "id", ["user_id", "movie_id", "score", "rated_at"], "SELECT * FROM raw_ratings"),
    "raw_movies", "raw_users", "raw_ratings",
)

# Only the planted values are unusable: each is listed with its reason.
SQL["load_rejects"] = with_fixtures("""
WITH m AS (SELECT imdbID AS id, CAST(imdbID AS BIGINT) AS k FROM raw_movies),
u AS (SELECT id, CAST(id AS BIGINT) AS k FROM raw_users),
r AS (SELECT id, user_id, CAST(id AS BIGINT) AS k FROM raw_ratings)
SELECT 'movies' AS table_name, id AS lake_id, 'title' AS column_name, 'missing' AS reason, NULL AS raw_value FROM m WHERE k % 59 = 0
UNION ALL SELECT 'movies', id, 'year', 'out of range', '3e9' FROM m WHERE k % 61 = 0
UNION ALL SELECT 'movies', id, 'imdbRating', 'not a finite number', '-Inf' FROM m WHERE k % 67 = 0
UNION ALL SELECT 'movies', id, 'imdbRating', 'out of range', '99.95' FROM m WHERE k % 67 = 1
UNION ALL SELECT 'users', 'u' || id, 'id', 'not a whole number', 'u' || id FROM u WHERE k % 29 = 0
UNION ALL SELECT 'users', CASE k % 29 WHEN 0 THEN 'u' || id WHEN 1 THEN id || '.0' ELSE id END, 'name', 'missing', NULL FROM u WHERE k % 31 = 0
UNION ALL SELECT 'ratings', id, 'user_id', 'missing', NULL FROM r WHERE k % 37 = 0
UNION ALL SELECT 'ratings', id, 'user_id', 'not a whole number', user_id || '.5' FROM r WHERE k % 37 = 1
UNION ALL SELECT 'ratings', id, 'user_id', 'out of range', '5e9' FROM r WHERE k % 37 = 2
UNION ALL SELECT 'ratings', id, 'movie_id', 'missing', NULL FROM r WHERE k % 43 = 0
UNION ALL SELECT 'ratings', id, 'score', 'not a finite number', 'inf' FROM r WHERE k % 53 = 0
UNION ALL SELECT 'ratings', id, 'score', 'out of range', '100' FROM r WHERE k % 53 = 1""", "raw_movies", "raw_users", "raw_ratings")
