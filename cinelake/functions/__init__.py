from cinelake.functions.scalar import (
    NA_TOKENS,
    PLACEHOLDER,
    as_double,
    avg_of,
    blank_to_null,
    exact_ratio,
    first_genre,
    genre_badge,
    na_to_null,
    or_placeholder,
    rounded_avg,
    strict_int,
    to_decimal_strict,
    to_imdb_rating,
    to_int_truncating,
    to_lake_date,
    to_score,
    unicode_strip,
)

__all__ = [
    "NA_TOKENS",
    "PLACEHOLDER",
    "as_double",
    "avg_of",
    "blank_to_null",
    "exact_ratio",
    "first_genre",
    "genre_badge",
    "na_to_null",
    "or_placeholder",
    "rounded_avg",
    "strict_int",
    "to_decimal_strict",
    "to_imdb_rating",
    "to_int_truncating",
    "to_lake_date",
    "to_score",
    "unicode_strip",
]
