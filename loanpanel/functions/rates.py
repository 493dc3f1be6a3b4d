"""Interest-rate texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .amounts import to_number
from .text import strip

# The 'per annum' mark, wherever it occurs, and the characters a
# rate without words is made of.
PER_ANNUM = r"(?iU)p\.?\s*a\.?"
WORD_CHARACTER = r"(?U)[^\d,.\s%\-+]"


def is_rate(raw: Column) -> Column:
    return F.coalesce(strip(raw) != "", F.lit(False))


def rate_number(raw: Column) -> Column:
    """The rate as a number, NULL when the text holds more than one number."""
    text = F.replace(strip(F.regexp_replace(raw, PER_ANNUM, "")), F.lit(","), F.lit("."))
    return to_number(strip(F.replace(text, F.lit("%"), F.lit(""))))


def rate_key(raw: Column) -> Column:
    """What two rates are compared by: the number, else the lower-case text.
    NULL for a missing or blank rate."""
    number = rate_number(raw)
    words = F.when(number.isNull(), strip(F.lower(raw)))
    return F.when(is_rate(raw), F.struct(number.alias("number"), words.alias("words")))


def has_words(raw: Column) -> Column:
    return is_rate(raw) & F.regexp_replace(raw, PER_ANNUM, "").rlike(WORD_CHARACTER)
