"""String expressions: trimming, padding, hashing, missing values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings a string table reader treats as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Every blank of the Unicode standard and the four information
# separators. Spark's own trim drops U+0020 only.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def na_to_null(text: Column) -> Column:
    """NULL for every spelling of a missing value."""
    return F.when(~text.isin(*NA_TOKENS), text)


def strip(text: Column) -> Column:
    """Trim blanks of every kind."""
    return F.btrim(text, F.lit(BLANKS))


def zero_fill(text: Column, width: int) -> Column:
    """Left-pad with zeros, after a leading sign, never cutting long text.
    Mentions ``text`` several times: give it a column rather than a long
    expression where speed matters."""
    zeros = F.repeat(F.lit("0"), F.lit(width) - F.length(text))
    signed = F.substring(text, 1, 1).isin("+", "-")
    return F.when(
        signed, F.concat(F.substring(text, 1, 1), zeros, F.substr(text, F.lit(2)))
    ).otherwise(F.concat(zeros, text))


def bare_id(raw: Column) -> Column:
    """Organisation ID without blanks and a float's '.0', '0' when missing."""
    text = F.regexp_replace(strip(raw), r"\.0$", "")
    return F.coalesce(F.nullif(text, F.lit("nan")), F.lit("0"))


def pad_id(raw: Column, width: int = 8) -> Column:
    """Organisation ID as used in loan keys: bare and zero-filled."""
    return zero_fill(bare_id(raw), width)


def registry_key(raw: Column) -> Column:
    """Organisation ID as looked up in the registry: cut at the first dot."""
    return zero_fill(F.substring_index(strip(raw), ".", 1), 8)


def text_or_nan(raw: Column) -> Column:
    """Trimmed text, with missing values spelt 'nan' as in existing keys."""
    return F.coalesce(strip(raw), F.lit("nan"))


def short_hash(raw: Column) -> Column:
    """First 8 hex digits of the md5 of the trimmed lower-case text."""
    return F.substring(F.md5(F.lower(text_or_nan(raw)).cast("binary")), 1, 8)


def is_filled(text: Column) -> Column:
    """True for text that is neither NULL, blank nor the word 'nan'."""
    return F.coalesce((strip(text) != "") & (F.lower(text) != "nan"), F.lit(False))
