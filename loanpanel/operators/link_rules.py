"""What makes two reports of consecutive years the same loan: the expressions
and pair tables the linkage is built from.

Rows are told apart within a year by ``pos``, their place in the file. Order
in the file decides who claims first, so ``pos`` is identity and order in one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.amounts import parse_amount, to_number, within_tolerance
from ..sources.scratch import stored
from .lookup import fits_broadcast

GROUP = ["muni_id", "lender_ico"]
AMOUNT_TOLERANCE = 0.001
SMALL_CHANGE_DAYS = 30
TYPO_DISTANCE = 2
AUTO = "auto"  # a pair the date rules accept without review

# Marks on a report and the reasons given for a link.
EXTENDED, SHORTENED = "Extended", "Shortened"
REPAID_EARLY, PENDING_REVIEW = "Repaid Early", "PENDING_REVIEW"
GAP_MARK = "Reporting Gap (%dy)"
REASON_AMOUNT = "Auto-matched by unique Sjednaná výše match. %s by %d days."
REASON_AUTO = "Auto-Matched 1:1. %s by %d days."
REASON_COLLISION = "Collision: Multiple loans share this start date."
REASON_SMALL = "Small duration change (%d days). Possible typo."
REASON_ODD = "Odd Pattern (Was %s, now %s) + Fuzzy Typo Match."
REASON_TYPO = "Fuzzy Typo Match (Dist: %d). Different start dates."
REASON_GAP = "Reporting-gap candidate (%d year(s) skipped)."
# How reasons are counted, by their beginning.
REASON_KINDS = {
    "Auto-matched by unique": "Auto-matched by unique Sjednaná výše",
    "Collision": "Collision (multiple loans share start date)",
    "Small duration change": "Small duration change (<30 days, possible typo)",
    "Odd Pattern": "Odd bounce pattern (Extended<->Shortened) + fuzzy match",
    "Fuzzy Typo Match": "Fuzzy typo match, different start dates",
}


def reason_kind(reason: Column) -> Column:
    kind = F
    for start, name in REASON_KINDS.items():
        kind = kind.when(F.startswith(reason, F.lit(start)), name)
    return kind.otherwise(F.when(reason == "", "(unknown)").otherwise(reason))


def _day(part: Column) -> Column:
    """Date of yyyyMMdd text; NULL outside the range of a nanosecond clock,
    which excludes placeholders such as 99991231. Only eight digits can give a
    date within it; as yyyy-MM-dd they are cast without a formatter's cost."""
    digits = part.rlike(r"\A[0-9]{8}\z") & part.between("16770922", "22620411")
    text = F.concat_ws("-", F.substring(part, 1, 4), F.substring(part, 5, 2), F.substring(part, 7, 2))
    return F.when(digits, text.try_cast("date"))


def with_dates(rows: DataFrame) -> DataFrame:
    """Add ``start_date``, ``mat_date`` and their text ``dates``, all from the
    ID, which after a link is that of the loan's first report."""
    parts = F.split("id", "-")
    dated = F.size(parts) >= 4
    return rows.withColumns(
        {
            "start_date": F.when(dated, _day(F.get(parts, F.lit(2)))),
            "mat_date": F.when(dated, _day(F.get(parts, F.lit(3)))),
            "dates": F.when(dated, F.concat_ws("-", F.get(parts, F.lit(2)), F.get(parts, F.lit(3)))).otherwise(""),
        }
    )


def period_pairs(loans: DataFrame) -> DataFrame:
    """Each period with the one that follows it in the panel."""
    years = loans.select("year").distinct()
    return years.withColumn("next_year", F.lead("year").over(Window.orderBy("year"))).na.drop()


def _neighbour(years: Sequence[int], step: int) -> Column:
    """The period before or after a row's own, by position."""
    pairs = zip(years, years[1:]) if step > 0 else zip(years[1:], years)
    year = F
    for own, other in pairs:
        year = year.when(F.col("year") == own, F.lit(other))
    return year.otherwise(F.lit(None)).cast("int")


def link_rows(loans: DataFrame, years: Sequence[int], presence_key: str | None) -> DataFrame:
    """The columns the linkage works on. ``missing`` marks a loan that matures
    in a later year than it is reported in, where no report of the next period
    has its ``presence_key``."""
    mark = F.col("yoy_change") if "yoy_change" in loans.columns else F.lit(None).cast("string")
    rows = loans.select(
        "year", "pos", "composite_id", "id", "dedup_suffix", *GROUP,
        parse_amount(F.col("agreed_amount")).alias("amount"),
        to_number(F.substring("matures_on", 1, 4)).alias("maturity_year"),
        F.coalesce(mark, F.lit("")).alias("yoy_change"),
    ).withColumns({"previous_year": _neighbour(years, -1), "next_year": _neighbour(years, 1)})
    missing = F.coalesce(F.col("maturity_year") > F.col("year"), F.lit(False)) & F.col("next_year").isNotNull()
    if presence_key is not None:
        present = loans
        if presence_key == "composite_id":
            # Of two years' rows with one key, one does not end in its own
            # year: only such keys, which the pipeline never makes, can match.
            own = F.endswith("composite_id", F.concat(F.lit("-"), F.col("year").cast("string")))
            odd = stored(loans.filter(~F.coalesce(own, F.lit(False))).select("composite_id").distinct())
            present = loans.join(F.broadcast(odd) if fits_broadcast(odd) else odd, "composite_id", "left_semi")
        present = stored(present.select(F.col("year").alias("next_year"), presence_key, F.lit(True).alias("_present")).distinct())
        rows = rows.join(F.broadcast(present) if fits_broadcast(present) else present, ["next_year", presence_key], "left")
        missing = missing & F.col("_present").isNull()
    return with_dates(rows.withColumn("missing", missing).drop("_present", "maturity_year"))


def group_label(muni: Column, lender: Column, start: Column) -> Column:
    """Municipality, lender and start date in one text."""
    return F.concat_ws(
        "_",
        F.coalesce(muni, F.lit("nan")),
        F.coalesce(lender, F.lit("nan")),
        F.coalesce(F.date_format(start, "yyyy-MM-dd"), F.lit("NaT")),
    )


def delta_days(earlier: Column, later: Column) -> Column:
    """Days by which the maturity moved, 0 when either is unknown."""
    return F.coalesce(F.date_diff(later, earlier), F.lit(0))


def start_of(dates: Column) -> Column:
    """Start date of a ``dates`` text."""
    return _day(F.substring_index(dates, "-", 1))


def direction(days: Column) -> Column:
    return F.when(days > 0, EXTENDED).when(days < 0, SHORTENED)


def turned_round(mark: Column, days: Column) -> Column:
    """Extended last time and shortened now, or the other way round."""
    return ((mark == EXTENDED) & (days < 0)) | ((mark == SHORTENED) & (days > 0))


def same_start_counts(rows: DataFrame) -> DataFrame:
    """Number of a year's loans of a municipality and lender with the same
    start. With ``n`` = 1 the other columns are those of the one loan. All columns are
    numbers or dates, so counting combines on the map side."""
    return (
        rows.filter(F.col("start_date").isNotNull())
        .na.drop("any", subset=GROUP)
        .groupBy("year", *GROUP, "start_date")
        .agg(
            F.count("*").alias("n"),
            F.max("pos").alias("pos"),
            F.max("mat_date").alias("mat_date"),
            F.bool_or(F.col("yoy_change") == EXTENDED).alias("was_extended"),
            F.bool_or(F.col("yoy_change") == SHORTENED).alias("was_shortened"),
            F.bool_or("missing").alias("missing"),
        )
    )


def shared_starts(rows1: DataFrame, rows2: DataFrame) -> DataFrame:
    """Starts in both years: (group columns, start_date, n_l, n_c, missing),
    and for loans alone with their start in both years their positions and the
    verdict of the date rules (l_pos, c_pos, signal)."""
    mark = F.when(F.col("a.was_extended"), EXTENDED).when(F.col("a.was_shortened"), SHORTENED).otherwise("")
    start, n_l, n_c = F.col("start_date"), F.col("a.n"), F.col("b.n")
    l_mat, c_mat = F.col("a.mat_date"), F.col("b.mat_date")
    # With equal starts the texts differ in the maturity only.
    l_text, c_text = F.date_format(l_mat, "yyyyMMdd"), F.date_format(c_mat, "yyyyMMdd")
    alone = (n_l == 1) & (n_c == 1) & F.col("a.missing")
    return (
        same_start_counts(rows1).alias("a")
        .join(same_start_counts(rows2).alias("b"), [*GROUP, "start_date"])
        .select(
            *GROUP, "start_date", n_l.alias("n_l"), n_c.alias("n_c"), F.col("a.missing").alias("missing"),
            F.when(alone, F.col("a.pos")).alias("l_pos"),
            F.when(alone, F.col("b.pos")).alias("c_pos"),
            F.when(
                alone, pair_signal(start, start, l_mat, c_mat, l_text, c_text, mark, n_l, n_c)
            ).alias("signal"),
        )
    )


def collisions(starts: DataFrame) -> DataFrame:
    """Starts that more than one loan has in either year."""
    return starts.filter(F.col("missing") & ((F.col("n_l") > 1) | (F.col("n_c") > 1))).select(*GROUP, "start_date")


def pair_signal(
    l_start: Column, c_start: Column, l_mat: Column, c_mat: Column,
    l_dates: Column, c_dates: Column, mark: Column, n_l: Column, n_c: Column,
) -> Column:
    """Verdict of the date rules on a pair: ``AUTO``, a reason for review, or
    NULL when nothing speaks for it. Rows of equal ID have equal dates, so a
    differing suffix needs no rule of its own."""
    days = delta_days(l_mat, c_mat)
    distance = F.levenshtein(l_dates, c_dates, TYPO_DISTANCE)
    same_start = F.coalesce(l_start == c_start, F.lit(False))
    moved = (
        F.when((n_l > 1) | (n_c > 1), REASON_COLLISION)
        .when((days != 0) & (F.abs(days) < SMALL_CHANGE_DAYS), F.format_string(REASON_SMALL, days))
        .when(
            turned_round(mark, days),
            F.when(distance >= 0, F.format_string(REASON_ODD, mark, direction(days))),
        )
        .when(days != 0, F.lit(AUTO))
    )
    typo = F.when(distance >= 0, F.format_string(REASON_TYPO, distance))
    return F.when(same_start, moved).otherwise(typo)


def amount_edges(left: DataFrame, right: DataFrame, by: list[str], tolerance: float) -> DataFrame:
    """Pairs of distinct amounts within ``tolerance`` of each other, joined on
    ``by`` and a logarithmic bucket as wide as the tolerance: close amounts lie
    in the same bucket or in neighbouring ones. ``left`` has ``l_amount``,
    ``right`` ``c_amount``, one row per ``by`` and amount each."""
    width = max(-math.log1p(-tolerance), 1e-9) * (1 + 1e-6)

    def bucket(amount: Column) -> Column:
        return F.coalesce(F.floor(F.ln(F.abs(amount)) / width), F.lit(0))

    near = F.array(*(bucket(F.col("l_amount")) + i for i in (-1, 0, 1)))
    a = left.filter(F.col("l_amount").isNotNull()).withColumns(
        {"_sign": F.signum("l_amount"), "_bucket": F.explode(near)}
    )
    b = right.filter(F.col("c_amount").isNotNull()).withColumns(
        {"_sign": F.signum("c_amount"), "_bucket": bucket(F.col("c_amount"))}
    )
    return a.join(b, [*by, "_sign", "_bucket"]).drop("_sign", "_bucket").filter(
        within_tolerance(F.col("l_amount"), F.col("c_amount"), tolerance)
    )
