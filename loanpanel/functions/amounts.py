"""Money expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# try_cast alone would also take '1d' or '0x1p3'.
NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def to_number(text: Column) -> Column:
    """Double for plain decimal notation, NULL for anything else."""
    return F.regexp_extract(text, NUMBER, 0).try_cast("double")


def parse_amount(raw: Column) -> Column:
    """Amount with blanks as thousands separators and a decimal comma, NULL
    when it is not a number."""
    return to_number(F.translate(strip(raw), ", ", "."))


def parse_amount_or_zero(raw: Column) -> Column:
    return F.coalesce(to_number(F.translate(raw, ", ", ".")), F.lit(0.0))


def whole_units(amount: Column) -> Column:
    """Amount cut to whole units, as text; out of range becomes the smallest
    64-bit integer."""
    whole = F.coalesce(amount.try_cast("bigint"), F.lit(-(2**63)))
    return whole.cast("string")


def within_tolerance(a: Column, b: Column, tolerance: float) -> Column:
    """Both zero, or differing by at most ``tolerance`` of the larger one.
    Never NULL."""
    larger = F.greatest(F.abs(a), F.abs(b))
    close = ((a == 0) & (b == 0)) | (
        (larger > 0) & (F.abs(a - b) / F.nullif(larger, F.lit(0.0)) <= tolerance)
    )
    return F.coalesce(close, F.lit(False))


def difference_percent(a: Column, b: Column) -> Column:
    """Relative difference in percent to three decimals, NULL if unknown."""
    larger = F.greatest(F.abs(a), F.abs(b), F.lit(1e-9))
    return F.bround(F.abs(a - b) / larger * 100, 3)
