"""Lenient parsing of text: a value that cannot be read becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters no plain number has, and words that stand for special numbers.
NOT_IN_NUMBERS = "[a-df-zA-DF-Z_]"
INFINITY_WORDS = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity"]
NAN_WORDS = ["nan", "+nan", "-nan"]

# Text forms accepted as a time.
ISO_TIME = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?"
    r"(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)?)?$"
)
ZONE_OFFSET = r"[T ]\d{2}(:\d{2}){0,2}([.,]\d+)?(Z|[+-]\d{2}(:?\d{2}){0,2})$"
US_DATE = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})"
SLASHED_DATE = r"^\s*(\d{4})/(\d{1,2})/"
SHORTEST_DATE = len("2024-1-5")


def to_num(value: Column) -> Column:
    """Text to double; a trailing type letter, a word or NaN gives NULL, infinity is kept.

    One scan for a foreign letter keeps the cast away from forms only the JVM takes for numbers
    ('1d', '0x1p3') and from most text on which it would raise and catch an error.
    """
    number = value.try_cast("double")
    return F.when(~value.rlike(NOT_IN_NUMBERS), number) \
        .when(F.lower(F.trim(value)).isin(INFINITY_WORDS), number)


def is_nan_text(value: Column) -> Column:
    return F.lower(F.trim(value)).isin(NAN_WORDS)


def is_infinite(number: Column) -> Column:
    return F.coalesce(F.abs(number) == F.lit(float("inf")), F.lit(False))


def whole(number: Column, kind: str = "bigint") -> Column:
    """Double to integer, cut towards zero; a value outside the type gives NULL."""
    return number.try_cast(kind)


def flex_int(value: Column) -> Column:
    """Text such as '12.9', ' 7 ' or '1e3' to a whole number; anything else gives NULL."""
    return whole(to_num(value))


def has_offset(value: Column) -> Column:
    """True when a time text ends with Z or a numeric zone offset."""
    return value.rlike(ZONE_OFFSET)


def _naive(text: Column) -> Column:
    """Wall clock in the session zone, which is UTC: an offset is applied, none is taken as UTC."""
    return text.try_cast("timestamp").cast("timestamp_ntz")


def iso_ts(value: Column) -> Column:
    """ISO-8601 text to a naive time in UTC; partial or foreign forms give NULL."""
    return F.when(value.rlike(ISO_TIME), _naive(F.translate(value, ",", ".")))


def to_ts(value: Column) -> Column:
    """Date and time text of any known file family to a naive time, else NULL.

    Year-first text without a zone, the usual case, is cast as it is; an offset can only stand
    behind the date.
    """
    behind_date = F.substring(value, 11, 64)
    zoned = value.endswith("Z") | behind_date.contains("+") | behind_date.contains("-")
    year_first = F.regexp_replace(value, US_DATE, "$3-$1-$2")
    return (
        F.when(F.length(value) < SHORTEST_DATE, F.lit(None).cast("timestamp_ntz"))
        .when(value.contains("/"),
              _naive(F.regexp_replace(year_first, SLASHED_DATE, "$1-$2-")))
        .when(zoned, _naive(value))
        .otherwise(value.try_cast("timestamp_ntz"))
    )


def _micros(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from start to end as a double, fractions kept."""
    return (_micros(end) - _micros(start)) / F.lit(1000000.0)


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def or_default(value: Column, default: str) -> Column:
    """NULL or empty text becomes the default (rider age '0', member type 'casual')."""
    return F.coalesce(blank_to_null(value), F.lit(default))
