"""Data loss through exclusion, per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .identity import CROSS_REMOVED, DEDUP_POPULATED, ZERO_LOAN

# Lower bounds and labels of the histogram of agreed amounts.
# Each class reaches up to the next bound.
BIN_EDGES = (0.0, 10e6, 20e6, 30e6, 40e6, 50e6, 100e6)
BIN_LABELS = ("0-10m", "10-20m", "20-30m", "30-40m", "40-50m", "50-100m", "100m+")
BAR_WIDTH = 30


def _lost() -> Column:
    """Rows whose loss matters: zero loans carry no money."""
    return F.coalesce(F.col("reason") != ZERO_LOAN, F.lit(False))


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def loss_report(identified: DataFrame) -> DataFrame:
    """Counts, sums and shares of excluded rows for each file."""
    def n_of(reason: str) -> Column:
        return F.count_if(F.col("reason") == reason)

    totals = identified.groupBy("source_file", "year").agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("id").alias("n_ids"),
        n_of(DEDUP_POPULATED).alias("n_dedup"),
        n_of(ZERO_LOAN).alias("n_zero"),
        n_of(CROSS_REMOVED).alias("n_cross"),
        F.count("reason").alias("n_excluded"),
        F.sum("agreed").alias("agreed_total"),
        F.sum("drawn").alias("drawn_total"),
        F.sum(F.when(_lost(), F.col("agreed")).otherwise(0.0)).alias("agreed_lost"),
        F.sum(F.when(_lost(), F.col("drawn")).otherwise(0.0)).alias("drawn_lost"),
    )
    lost_rows = F.col("n_dedup") + F.col("n_cross")
    return totals.withColumns(
        {
            "pct_rows": _percent(lost_rows, F.col("n_rows")),
            "pct_agreed": _percent(F.col("agreed_lost"), F.col("agreed_total")),
            "pct_drawn": _percent(F.col("drawn_lost"), F.col("drawn_total")),
        }
    )


def amount_histogram(
    identified: DataFrame,
    edges: tuple[float, ...] = BIN_EDGES,
    labels: tuple[str, ...] = BIN_LABELS,
) -> DataFrame:
    """Agreed amounts of lost rows by class, empty classes included, for each
    file that lost any. Negative amounts belong to no class."""
    bin_no = F.lit(None).cast("int")
    for i, low in enumerate(edges):
        bin_no = F.when(F.col("agreed") >= low, F.lit(i)).otherwise(bin_no)
    counts = (
        identified.filter(_lost())
        .groupBy("source_file", "year", bin_no.alias("bin_no"))
        .agg(F.count("*").alias("n"))
    )
    per_file = counts.groupBy("source_file", "year").agg(
        F.map_from_entries(F.collect_list(F.struct(F.coalesce("bin_no", F.lit(-1)), "n"))).alias("by_bin")
    )
    classes = F.array(*(F.struct(F.lit(i).alias("bin_no"), F.lit(t).alias("bin")) for i, t in enumerate(labels)))
    filled = per_file.select("source_file", "year", "by_bin", F.inline(classes)).withColumn(
        "n", F.coalesce(F.try_element_at("by_bin", "bin_no"), F.lit(0)).cast("bigint")
    ).drop("by_bin")
    top = F.max("n").over(Window.partitionBy("source_file", "year"))
    width = F.when(top > 0, F.floor(F.col("n") / top * BAR_WIDTH)).otherwise(0).cast("int")
    return filled.withColumn("bar", F.repeat(F.lit("█"), width))


def report_lines(report: DataFrame, histogram: DataFrame) -> DataFrame:
    """The report as text, one row per file, in order of year."""
    bars = histogram.groupBy("source_file", "year").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("bin_no", "bin", "n", "bar"))),
                lambda b: F.format_string("    %8s: %4d | %s", b["bin"], b["n"], b["bar"]),
            ),
            "\n",
        ).alias("bars")
    )
    def line(template: str, *columns: str) -> Column:
        return F.format_string(template, *(F.col(c) for c in columns))

    return report.join(bars, ["source_file", "year"], "left").select(
        "source_file",
        "year",
        F.concat_ws(
            "\n",
            line("File: %s (%d)", "source_file", "year"),
            line("  rows read: %d, distinct IDs: %d", "n_rows", "n_ids"),
            line("  repeated within the file (DEDUP_POPULATED): %d", "n_dedup"),
            line("  amount zero (ZERO_LOAN, not counted as loss): %d", "n_zero"),
            line("  repeated in another file (CROSS_REMOVED): %d", "n_cross"),
            line("  excluded in all: %d", "n_excluded"),
            line("  rows lost: %.3f %%", "pct_rows"),
            line("  agreed amount lost: %.3f %% (%,.0f CZK)", "pct_agreed", "agreed_lost"),
            line("  drawn amount lost: %.3f %% (%,.0f CZK)", "pct_drawn", "drawn_lost"),
            F.col("bars"),
        ).alias("value"),
    ).orderBy("year", "source_file")


def control_total(loans: DataFrame) -> DataFrame:
    """Each file's footer states how many rows came before it."""
    footer = F.col("statement") == "ZZZ"
    return loans.groupBy("source_file", "year").agg(
        F.count_if(~F.coalesce(footer, F.lit(False))).alias("n_rows"),
        F.max(F.when(footer, F.col("paid_interest").try_cast("bigint"))).alias("n_stated"),
    ).withColumn("complete", F.coalesce(F.col("n_rows") == F.col("n_stated"), F.lit(False)))
