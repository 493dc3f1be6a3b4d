"""Loan keys, duplicates and the rows excluded from analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import parse_amount_or_zero, whole_units
from ..functions.text import bare_id, short_hash, text_or_nan, zero_fill
from ..sources.scratch import stored
from .lookup import lookup

# Why a row is excluded, strongest first.
ZERO_LOAN = "ZERO_LOAN"
DEDUP_POPULATED = "DEDUP_POPULATED"
CROSS_REMOVED = "CROSS_REMOVED"


def loan_key(borrower: Column, lender: Column, agreed: Column) -> Column:
    """borrower-lender-signed-matures-amount, the same in every year."""
    return F.concat_ws(
        "-",
        zero_fill(borrower, 8),
        zero_fill(lender, 8),
        text_or_nan(F.col("signed_on")),
        text_or_nan(F.col("matures_on")),
        whole_units(agreed),
    )


def dedup_suffix() -> Column:
    """Tells duplicates apart by lender name and purpose."""
    return F.concat_ws("-", short_hash(F.col("lender_name")), short_hash(F.col("purpose")))


def with_loan_id(loans: DataFrame) -> DataFrame:
    """Add ``id`` and the parsed amounts. What the key mentions more than once
    is a column of its own, so that it is computed once."""
    parsed = loans.withColumns(
        {
            "agreed": parse_amount_or_zero(F.col("agreed_amount")),
            "drawn": parse_amount_or_zero(F.col("drawn_amount")),
            "_borrower": bare_id(F.col("borrower_ico")),
            "_lender": bare_id(F.col("lender_ico")),
        }
    )
    return parsed.withColumn(
        "id", loan_key(F.col("_borrower"), F.col("_lender"), F.col("agreed"))
    ).drop("_borrower", "_lender")


def repeated_ids(loans: DataFrame) -> DataFrame:
    """One row per ID that occurs more than once within a file: the ``files``
    it repeats in, ``real`` when any such row has an amount, and the number of
    rows ``n`` in those files.

    Counting by (ID, file) combines on the map side, so an ID shared by very
    many rows reaches the reducers as one row per task.
    """
    per_file = (
        loans.groupBy("id", "source_file")
        .agg(F.count("*").alias("n"), F.count_if(F.col("agreed") != 0).alias("n_real"))
        .filter(F.col("n") > 1)
    )
    return per_file.groupBy("id").agg(
        F.collect_list("source_file").alias("files"),
        F.bool_or(F.col("n_real") > 0).alias("real"),
        F.sum("n").alias("n"),
    )


def identify(loans: DataFrame) -> DataFrame:
    """Add ``id``, ``dedup_suffix``, ``composite_id`` and ``reason`` (NULL for
    rows that stay).

    A row goes when its amount is zero, else when its ID repeats within its
    file, else when the ID was removed as a repetition from any other file.
    """
    loans = with_loan_id(loans)
    repeated = stored(repeated_ids(loans))
    rows = lookup(loans, repeated, ["id"], weight="n")
    duplicate = F.coalesce(F.array_contains("files", F.col("source_file")), F.lit(False))
    rows = rows.withColumn("dedup_suffix", F.when(duplicate, dedup_suffix()))
    return rows.withColumns(
        {
            "composite_id": F.concat_ws("-", "id", "dedup_suffix", "year"),
            "reason": F.when(F.col("agreed") == 0, ZERO_LOAN)
            .when(F.col("dedup_suffix").isNotNull(), DEDUP_POPULATED)
            .when(F.col("real"), CROSS_REMOVED),
        }
    ).drop("files", "real")


def kept(identified: DataFrame) -> DataFrame:
    """Rows that stay in the analysis."""
    return identified.filter(F.col("reason").isNull()).drop("reason")


def excluded(identified: DataFrame) -> DataFrame:
    return identified.filter(F.col("reason").isNotNull())
