"""The steps of a full run, each from stored tables to stored tables.

Between the steps the panel is Parquet, one folder per year, with the name of
each row's file and its place in it. Text is read and written where people or
other tools take part: the yearly files, the codelist, the typo proposals, the
report, the review queue and the decision store.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import decisions, enrichment, identity, linkage, rate_panel, reports, typos
from ..sources import readers, writers
from ..sources.scratch import cut


def ingest(
    spark: SparkSession, folder: str, out: str, pattern: str = "*.csv", sep: str = ";", multi_line: bool = True,
    tables: str | None = None,
) -> dict[str, str]:
    """Yearly files to a panel. Returns the files left out and why. Quoted
    values may hold line breaks unless ``multi_line`` is off, which lets large
    files be read in parts. ``tables`` is a folder for the malformed rows and
    for the numbers of rows of each file by kind."""
    files = readers.read_panel(spark, folder, pattern, sep, multi_line=multi_line)
    writers.write_panel(files.panel, out)
    if tables is not None:
        writers.write_run_table(files.malformed, f"{tables}/malformed")
        writers.write_run_table(files.counts(), f"{tables}/row_counts")
    return files.problems


def resolve_lenders(spark: SparkSession, panel: str, registry: DataFrame, codelist: str, out: str, missing: str) -> None:
    """Registry columns for every loan, and the lender IDs without an entry."""
    loans = spark.read.parquet(panel)
    writers.write_panel(enrichment.enrich(loans, registry, readers.read_codelist(spark, codelist)), out)
    writers.write_exchange(enrichment.missing_ids(spark.read.parquet(out)), missing)


def propose_corrections(spark: SparkSession, enriched: str, out: str, max_distance: int = 1) -> None:
    """Known lenders near each unresolved ID: one row each in ``long``, and in
    ``wide`` side by side for a person."""
    loans = spark.read.parquet(enriched)
    found = typos.typo_candidates(
        enrichment.missing_ids(loans), typos.typo_reference(loans), max_distance
    )
    found = cut(found)
    writers.write_exchange(found, f"{out}/long")
    writers.write_exchange(typos.widen_candidates(found), f"{out}/wide")


def assign_keys(spark: SparkSession, panel: str, out: str, report: str, tables: str | None = None) -> None:
    """Keys and reasons of exclusion for every row, and the loss report. Kept
    rows are those in the folder of reason KEPT. ``tables`` is a folder for the
    comparison with the files' control totals."""
    writers.write_identified(identity.identify(spark.read.parquet(panel)), out)
    if tables is not None:
        writers.write_run_table(reports.control_total(spark.read.parquet(panel)), f"{tables}/control_total")
    rows = spark.read.parquet(out).withColumn("reason", F.nullif(F.col("reason"), F.lit("KEPT")))
    lines = reports.report_lines(reports.loss_report(rows), reports.amount_histogram(rows))
    writers.write_report(lines, report)


def kept_rows(spark: SparkSession, identified: str) -> DataFrame:
    """Kept rows of ``assign_keys``; the other folders are not read."""
    return spark.read.parquet(identified).filter(F.col("reason") == "KEPT").drop("reason")


def compare_rates(spark: SparkSession, identified: str, out: str, start_year: int = rate_panel.START_YEAR) -> DataFrame:
    """Rates side by side; returns how many loans fall in each class."""
    loans = kept_rows(spark, identified).filter(F.col("year") >= start_year)
    writers.write_exchange(rate_panel.rate_panel(loans, rate_panel.years_of(loans)), out)
    # Counted from the stored panel, not computed again.
    return rate_panel.rate_class_counts(spark.read.csv(out, sep="\t", header=True))


def _existing(read) -> DataFrame | None:
    """None where there is no such table yet; any other fault is one."""
    try:
        return read()
    except FileNotFoundError:
        return None
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@dataclass(frozen=True)
class FollowPaths:
    """Where following the loans reads and writes."""

    identified: str
    out: str
    early_payoffs: str
    queue: str
    store: str
    tables: str | None = None  # folder for the counts of the run
    texts: str | None = None  # folder for the linked panel as yearly texts


def follow_loans(
    spark: SparkSession, paths: FollowPaths, dry_run: bool = False, apply_review: bool = False, force: bool = False
) -> linkage.Linkage:
    """Link the loans of all years.

    Answers in the review queue go to the store with ``apply_review``; without
    it a queue with new answers stops the run, unless ``force`` discards them.
    A dry run writes nothing.
    """
    store = _existing(lambda: readers.read_decisions(spark, paths.store))
    queue = _existing(lambda: readers.read_review_queue(spark, paths.queue))
    none = spark.createDataFrame([], "y1_composite_id string, y2_composite_id string, decision string, seq bigint")
    if queue is not None and "decision" in queue.columns:
        if apply_review:
            writers.append_decisions(decisions.new_decisions(queue, none if store is None else store), paths.store)
            store = readers.read_decisions(spark, paths.store)
        elif not dry_run and not force:
            decisions.require_applied(queue, none if store is None else store)
    result = linkage.link_panel(kept_rows(spark, paths.identified), store, dry_run=dry_run)
    if not dry_run:
        writers.write_panel(result.panel(), paths.out)
        writers.write_exchange(result.early_payoffs(), paths.early_payoffs)
        writers.write_review_queue(result.review_queue(), paths.queue)
        if paths.texts is not None:
            writers.write_yearly(spark.read.parquet(paths.out).drop("year"), paths.texts)
        if paths.tables is not None:
            for name in ("stats", "reason_counts", "outcomes"):
                writers.write_run_table(getattr(result, name)(), f"{paths.tables}/{name}")
    return result
