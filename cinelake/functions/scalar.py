"""Column expressions shared by every query.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.fixed_values import GENRE_SEPARATOR, NA_TOKENS, PLACEHOLDER  # noqa: F401
from cinelake.schemas import IMDB_RATING_TYPE, SCORE_TYPE


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------------------
# Genre
# ---------------------------------------------------------------------------

def first_genre(genre: str | Column = "genre") -> Column:
    """First item of the comma-separated genre list, untrimmed.

    ``''`` stays ``''`` and NULL stays NULL; a string without a comma is
    returned whole.
    """
    return F.split_part(_c(genre), F.lit(GENRE_SEPARATOR), F.lit(1))


# ---------------------------------------------------------------------------
# Exact averages
# ---------------------------------------------------------------------------

def exact_ratio(total: str | Column, count: str | Column) -> Column:
    """Exact ``total / count`` on decimals; NULL when ``count`` is 0.

    ``sum(decimal(4,2)) / count`` is typed ``decimal(35,23)``, so no early
    rounding happens (``avg`` on ``decimal(4,2)`` would round to 6 digits
    first and could then round a second time).
    """
    return F.try_divide(_c(total), _c(count))


def rounded_avg(total: str | Column, count: str | Column, scale: int = 2) -> Column:
    """``ROUND(AVG(x), 2)`` with one rounding, half away from zero."""
    return F.round(exact_ratio(total, count), scale)


def avg_of(score: str | Column = "score", scale: int = 2) -> Column:
    """Aggregate expression: exact average of ``score`` rounded once."""
    return rounded_avg(F.sum(_c(score)), F.count(_c(score)), scale)


def as_double(col: str | Column) -> Column:
    """Decimal → double, used only at the result edge."""
    return _c(col).cast(T.DoubleType())


# ---------------------------------------------------------------------------
# Cleaning
# ---------------------------------------------------------------------------

_NA_SQL_LIST = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in NA_TOKENS)


def na_to_null(col: str | Column) -> Column:
    """Turn the reader's missing-value tokens into NULL (exact match).

    For a column name the test is one parsed SQL expression (one call into
    the JVM instead of one per token); the plan is the same.
    """
    if isinstance(col, str):
        name = "`" + col.replace("`", "``") + "`"
        return F.expr(f"CASE WHEN {name} IN ({_NA_SQL_LIST}) THEN NULL ELSE {name} END")
    return F.when(~col.isin(*NA_TOKENS), col)


def unicode_strip(col: str | Column) -> Column:
    """Strip leading/trailing Unicode whitespace (``str.strip`` semantics).

    ``trim`` only removes ASCII spaces; two anchored replacements handle tabs,
    no-break spaces and the rest of the Unicode space class.
    """
    c = _c(col)
    space = r"[\s\x1c-\x1f]+"
    return F.regexp_replace(F.regexp_replace(c, f"(?U)^{space}", ""), f"(?U){space}$", "")


def blank_to_null(col: str | Column) -> Column:
    """``x or None`` for text: empty string becomes NULL."""
    return F.nullif(_c(col), F.lit(""))


# Plain decimal notation, white space around it allowed. The engine's own cast
# also accepts type suffixes (``7.5d``) and hexadecimal floats (``0x1p3``).
_DECIMAL_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_INFINITE_TEXT = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def parsed_number(col: str | Column) -> Column:
    """Text → double: NULL unless it is plain decimal notation."""
    c = _c(col)
    # The shape is tested first: a cast of anything else costs an exception.
    return F.when(c.rlike(_DECIMAL_TEXT), F.trim(c).try_cast(T.DoubleType()))


def _short_decimal(c: Column, dtype: T.DecimalType) -> Column:
    """Whether text is plain digits whose value surely fits ``dtype``: cast as it is,
    since so few digits come through a double unchanged."""
    return c.rlike(rf"^[0-9]{{1,{dtype.precision - dtype.scale - 1}}}(\.[0-9]{{1,9}})?\z")


def to_int_truncating(col: str | Column) -> Column:
    """Numeric coercion: unparseable → NULL, fractions truncated toward zero."""
    return parsed_number(col).cast(T.IntegerType())


def to_decimal_strict(col: str | Column, dtype: T.DecimalType) -> Column:
    """Unparseable → NULL, but infinity and out-of-range values raise.

    Going through double first keeps ``'7.85'`` → ``7.9`` (half away from
    zero) and lets an overflow surface as an error instead of a silent NULL.
    A value in plain notation is matched once, and one of few digits is cast directly.
    """
    c = _c(col)
    value = F.trim(c).try_cast(T.DoubleType()).cast(dtype)
    refused = F.raise_error(F.concat(F.lit("not a finite number: "), c)).cast(dtype)
    return F.when(_short_decimal(c, dtype), c.cast(dtype)).when(c.rlike(_DECIMAL_TEXT), value).when(c.rlike(_INFINITE_TEXT), refused)


def to_score(col: str | Column) -> Column:
    return to_decimal_strict(col, SCORE_TYPE)


def to_imdb_rating(col: str | Column) -> Column:
    return to_decimal_strict(col, IMDB_RATING_TYPE)


def to_lake_date(col: str | Column) -> Column:
    """ISO date; malformed or impossible dates become NULL.

    Only text of the right shape is cast: a parse by pattern would throw and
    catch an exception for every malformed value, and the cast alone also takes
    dates without a day or with a time.
    """
    c = _c(col)
    return F.when(c.rlike(_DATE_TEXT), c.try_cast(T.DateType()))


def strict_int(col: str | Column, what: str, numeric: bool = False) -> Column:
    """Key coercion that refuses to guess: bad or missing text raises.

    ``numeric`` also takes numbers written otherwise whose value is whole
    (``3.0``, ``1e2``), as the warehouse loader does; the application loader
    takes digits only. Up to nine digits, nearly every key, need no double.
    """
    c = _c(col)
    missing = F.raise_error(F.lit(f"missing {what}")).cast(T.IntegerType())
    if not numeric:
        return F.when(c.isNull(), missing).otherwise(c.cast(T.IntegerType()))
    value = parsed_number(c)
    refused = F.raise_error(F.concat(F.lit(f"not a whole number for {what}: "), c)).cast(T.IntegerType())
    whole = F.when(value == F.floor(value), value.cast(T.IntegerType())).otherwise(refused)
    return F.when(c.isNull(), missing).when(c.rlike(r"^[0-9]{1,9}\z"), c.cast(T.IntegerType())).otherwise(whole)


_WHOLE_TEXT = r"^\s*[+-]?[0-9]+\s*$"
MISSING, NOT_WHOLE, NOT_FINITE, OUT_OF_RANGE = "missing", "not a whole number", "not a finite number", "out of range"


def parsed_key(col: str | Column, numeric: bool = False) -> Column:
    """``strict_int`` without raising: a struct of the ``value`` and, where there
    is none, the ``reason``."""
    c = _c(col)
    number = parsed_number(c)
    whole = (number == F.floor(number)) if numeric else c.rlike(_WHOLE_TEXT)
    value = number.try_cast(T.IntegerType()) if numeric else c.try_cast(T.IntegerType())
    value = F.when(whole, value)
    reason = (
        F.when(c.isNull(), F.lit(MISSING))
        .when(~F.coalesce(whole, F.lit(False)), F.lit(NOT_WHOLE))
        .when(value.isNull(), F.lit(OUT_OF_RANGE))
    )
    return F.struct(value.alias("value"), reason.alias("reason"))


def parsed_decimal(col: str | Column, dtype: T.DataType) -> Column:
    """``to_decimal_strict`` (or, for an integer type, ``to_int_truncating``)
    without raising: unparseable text has neither a value nor a reason."""
    c = _c(col)
    number = parsed_number(c)
    value = number.try_cast(dtype)
    refused = ~F.lit(isinstance(dtype, T.IntegerType)) & F.coalesce(c.rlike(_INFINITE_TEXT), F.lit(False))
    reason = F.when(refused, F.lit(NOT_FINITE)).when(number.isNotNull() & value.isNull(), F.lit(OUT_OF_RANGE))
    return F.struct(value.alias("value"), reason.alias("reason"))


def parsed_text(col: str | Column, value: Column | None = None) -> Column:
    """Text that must be there."""
    c = _c(col)
    return F.struct((c if value is None else value).alias("value"), F.when(c.isNull(), F.lit(MISSING)).alias("reason"))


# ---------------------------------------------------------------------------
# Display
# ---------------------------------------------------------------------------

def or_placeholder(col: str | Column, zero_is_missing: bool = True) -> Column:
    """``x or "–"``: NULL, blank text and (for numbers) zero show the dash."""
    c = _c(col)
    text = c.cast(T.StringType())
    missing = c.isNull() | (text == F.lit(""))
    if zero_is_missing:
        missing = missing | (text.try_cast(T.DoubleType()) == F.lit(0.0))
    return F.when(missing, F.lit(PLACEHOLDER)).otherwise(text)


def genre_badge(genre: str | Column = "genre") -> Column:
    """First genre of the list, or the dash when the genre is missing/blank."""
    c = _c(genre)
    return F.split_part(
        F.coalesce(F.nullif(c, F.lit("")), F.lit(PLACEHOLDER)), F.lit(GENRE_SEPARATOR), F.lit(1)
    )
