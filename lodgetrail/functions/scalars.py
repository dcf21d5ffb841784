"""Scalar expressions that hold up under ANSI mode and dirty input.

Everything here is a composition of built-in functions, so it stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType

TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"
# Calendar year: the week-year pattern "YYYY" is off by a year around New Year.
DAY_TEXT = "yyyy-MM-dd"


# Whole number types, and text cut at its decimal point before it is read as one: '12.7' counts as 12.
WHOLE = ("tinyint", "smallint", "short", "int", "integer", "bigint", "long")
WHOLE_TEXT = r"regexp_replace({0}, r'^(\s*[+-]?\d+)\.\d*(\s*)$', '$1$2')"

# What text of a type can look like at most, as a regular expression: a failed cast of other text costs many
# times a match, as it throws and catches an exception. Casts ignore ASCII blanks and control characters at both ends.
_BLANK = r"[\x00-\x20\x7F]*"
_WHOLE_LIKE = rf"^{_BLANK}[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]*){_BLANK}$"
# With exponents, type suffixes and hexadecimal digits.
_NUMBER_LIKE = rf"^{_BLANK}[+-]?(?:[0-9.][0-9a-fA-FxXpP.+-]*|(?i:inf|infinity|nan)){_BLANK}$"
TEXT_LIKE = {
    **dict.fromkeys(WHOLE, _WHOLE_LIKE),
    **dict.fromkeys(("double", "float"), _NUMBER_LIKE),
    "boolean": rf"^{_BLANK}(?i:t|true|y|yes|1|f|false|n|no|0){_BLANK}$",
    "date": rf"^{_BLANK}[+-]?[0-9]{{4}}",
}


def lenient(value: Column, to: str | DataType) -> Column:
    """Cast; what does not parse or does not fit becomes NULL instead of an error."""
    return value.try_cast(to)


def typed_null(to: str | DataType) -> Column:
    return F.lit(None).cast(to)


def joined(values: Column, separator: str = ",") -> Column:
    """Join an array as text: NULL elements are skipped, a NULL array gives ''."""
    return F.concat_ws(separator, values)


def joined_words(*values: Column) -> Column:
    """Join scalars with single spaces, skipping NULLs."""
    return F.concat_ws(" ", *values)


def epoch_text(millis: Column, pattern: str = TIMESTAMP_TEXT) -> Column:
    """Epoch milliseconds as text in the session time zone."""
    seconds = lenient(lenient(millis, "double") / 1000, "bigint")
    return F.from_unixtime(seconds, pattern)


def epoch_day(millis: Column) -> Column:
    return epoch_text(millis, DAY_TEXT)


def first_of(values: Column) -> Column:
    """First element; NULL for an empty or NULL array."""
    return F.get(values, F.lit(0))


def first_field(structs: Column, field: str) -> Column:
    """A field of the first struct of an array; NULL for an empty or NULL array."""
    return first_of(structs.getField(field))


def price_weight(flagged: Column, price: Column, factor: int = 1000) -> Column:
    """The price itself where flagged, otherwise the price times ``factor``."""
    return F.when(flagged, price).otherwise(price * F.lit(factor))
