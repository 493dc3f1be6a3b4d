"""The registered queries: every operator over the derived loan panel."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import amounts, rates, text
from ..operators import (
    decisions, enrichment, identity, link_claims, link_gaps, link_rules, linkage, reports, typos,
)
from ..operators import rate_panel as rate_panel_ops
from ..sources import readers, writers
from ..sources.scratch import materialise, scratch_folder
from .sample_panel import derive_panel

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

YEARS = (2021, 2022, 2023, 2024)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


_stored: dict[tuple, DataFrame] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, derive: Query) -> DataFrame:
    """A table written once per session and table folder, as the files between
    the steps of a real run are."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = materialise(derive(spark, sf_dir), name, partition_by=["year"])
    return _stored[key]


def raw_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "raw", derive_panel)


def identified_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.identify(raw_panel(spark, sf_dir))


# --- yearly files ------------------------------------------------------------

# Headers as files of different years might word them.
FILE_HEADERS = {
    "statement": '"Výkaz"ZC_VYKAZ:ZC_VYKAZ', "muni_id": "Účetní  jednotka ZC_UCJED:ZC_UCJED",
    "borrower_ico": " IČO ZC_ICO:ZC_ICO", "lender_ico": "IČO poskytovatele/BIC/ZC_PARTP:ZC_PARTP",
    "lender_name": '""Název""/BIC/ZC_NAZPOS:ZC_NAZPOS ', "purpose": "Účel/BIC/ZC_UCFP:ZC_UCFP",
    "rate_text": "Sazba/BIC/ZC_URSA:ZC_URSA", "signed_on": "Uzavření/BIC/ZC_DATUS:ZC_DATUS",
    "matures_on": "Splatnost/BIC/ZC_TERSPL:ZC_TERSPL", "agreed_amount": "Sjednaná   výše ZU_VYUV",
    "drawn_amount": "Čerpaná výše ZU_CEUV", "paid_interest": "Úroky ZU_ZAPUP",
}


def yearly_files(spark, sf_dir) -> str:
    """The panel written as yearly files into one folder, the first year
    without rates and the later ones in another order of columns, rows in order
    of ``pos``."""
    panel = raw_panel(spark, sf_dir)
    folder = f"{scratch_folder(spark)}/yearly-{uuid.uuid4().hex}"
    for year in YEARS:
        columns = [c for c in FILE_HEADERS if year > 2021 or c != "rate_text"]
        columns = columns if year % 2 else columns[::-1]
        rows = panel.filter(F.col("year") == year).orderBy("pos")
        rows.select(*(F.col(c).alias(FILE_HEADERS[c]) for c in columns)).write.csv(
            f"{folder}/loans_{year}012.csv", **writers.TEXT_TABLE | {"sep": ";"}
        )
    return folder


@query
def header_normalize(spark, sf_dir):
    """Yearly files of different headers read back from one folder, with the
    year from their names and each row's place in its file."""
    files = readers.read_panel(spark, yearly_files(spark, sf_dir), "*.csv", ";")
    return files.panel.select("source_file", "year", "pos", *FILE_HEADERS)


# --- scalar expressions ----------------------------------------------------

@query
def pad_id(spark, sf_dir):
    return raw_panel(spark, sf_dir).select(
        "year", "pos",
        text.pad_id(F.col("borrower_ico")).alias("borrower"),
        text.pad_id(F.col("lender_ico")).alias("lender"),
        text.registry_key(F.col("lender_ico")).alias("registry_key"),
    )


@query
def parse_money(spark, sf_dir):
    return raw_panel(spark, sf_dir).select(
        "year", "pos",
        amounts.parse_amount(F.col("agreed_amount")).alias("agreed"),
        amounts.parse_amount_or_zero(F.col("agreed_amount")).alias("agreed_or_zero"),
        amounts.parse_amount(F.col("drawn_amount")).alias("drawn"),
    )


@query
def dedup_suffix(spark, sf_dir):
    return raw_panel(spark, sf_dir).select("year", "pos", identity.dedup_suffix().alias("suffix"))


@query
def loan_id(spark, sf_dir):
    return identity.with_loan_id(raw_panel(spark, sf_dir)).select("year", "pos", "id")


# --- identity and exclusion ------------------------------------------------

@query
def duplicate_flag(spark, sf_dir):
    return identified_panel(spark, sf_dir).select(
        "year", "pos", F.col("dedup_suffix").isNotNull().alias("is_duplicate")
    )


@query
def exclusion_reason(spark, sf_dir):
    return identified_panel(spark, sf_dir).select(
        "year", "pos", "id", "dedup_suffix", "composite_id", "reason"
    )


@query
def cross_removed(spark, sf_dir):
    return identified_panel(spark, sf_dir).filter(
        F.col("reason") == identity.CROSS_REMOVED
    ).select("year", "pos", "id")


@query
def loss_report(spark, sf_dir):
    return reports.loss_report(identified_panel(spark, sf_dir))


@query
def amount_histogram(spark, sf_dir):
    return reports.amount_histogram(
        identified_panel(spark, sf_dir), edges=AMOUNT_EDGES, labels=AMOUNT_LABELS
    )


# The derived loans are smaller than the classes made for real ones.
AMOUNT_EDGES = (0.0, 100e3, 200e3, 300e3, 400e3, 500e3, 600e3)
AMOUNT_LABELS = ("0-100k", "100-200k", "200-300k", "300-400k", "400-500k", "500-600k", "600k+")


@query
def control_total(spark, sf_dir):
    return reports.control_total(raw_panel(spark, sf_dir))


# --- lenders and mistyped IDs ----------------------------------------------

def sample_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the registry of lenders; loans name those in debt by an
    ID that is not theirs."""
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr(
        "CAST(if(s_acctbal >= 0, 45000000, 85000000) + s_suppkey * 1001 AS STRING) AS ico",
        "s_name AS name",
        "get(array('121', '112', '801', '381', '999', NULL), s_nationkey % 6) AS form_code",
    )


def sample_codelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as lines of a codelist with repeated codes."""
    return spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr(
        "n_nationkey AS line_no",
        "get(array('121', '112', '801', '381', '331'), n_nationkey % 5) AS code",
        "n_name AS official",
        "concat('group ', n_regionkey) AS form_group",
    )


def enriched_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.enrich(
        raw_panel(spark, sf_dir), sample_registry(spark, sf_dir), sample_codelist(spark, sf_dir)
    )


@query
def codelist_lookup(spark, sf_dir):
    return enrichment.codelist_by_code(sample_codelist(spark, sf_dir))


@query
def form_abbr(spark, sf_dir):
    return sample_registry(spark, sf_dir).select(
        "ico", "form_code", enrichment.form_abbreviation(F.col("form_code")).alias("form_abbr")
    )


@query
def registry_status(spark, sf_dir):
    ids = raw_panel(spark, sf_dir).select("lender_ico").na.drop().distinct()
    return enrichment.registry_lookup(ids, sample_registry(spark, sf_dir))


@query
def enrich(spark, sf_dir):
    return enriched_panel(spark, sf_dir).select(
        "year", "pos", "lender_ico", "registry_name", "form_code", "form_official", "form_group", "form_abbr"
    )


@query
def missing_ids(spark, sf_dir):
    return enrichment.missing_ids(enriched_panel(spark, sf_dir))


@query
def typo_reference(spark, sf_dir):
    return typos.typo_reference(raw_panel(spark, sf_dir))


def sample_candidates(spark, sf_dir, max_distance):
    enriched = enriched_panel(spark, sf_dir)
    return typos.typo_candidates(
        enrichment.missing_ids(enriched), typos.typo_reference(enriched), max_distance
    )


@query
def typo_candidates(spark, sf_dir):
    return sample_candidates(spark, sf_dir, 1)


@query
def typo_candidates_2(spark, sf_dir):
    return sample_candidates(spark, sf_dir, 2)


@query
def typo_wide(spark, sf_dir):
    return typos.widen_candidates(sample_candidates(spark, sf_dir, 1))


# --- interest rates --------------------------------------------------------

def kept_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "kept", lambda *at: identity.kept(identified_panel(*at)))


def sample_rate_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_panel_ops.rate_panel(kept_panel(spark, sf_dir), range(rate_panel_ops.START_YEAR, 2025))


@query
def rate_classify(spark, sf_dir):
    rate = F.col("rate_text")
    return raw_panel(spark, sf_dir).select(
        "year", "pos", "rate_text",
        rates.rate_number(rate).alias("number"),
        rates.rate_key(rate)["words"].alias("words"),
        rates.has_words(rate).alias("has_words"),
    )


@query
def rate_panel(spark, sf_dir):
    return sample_rate_panel(spark, sf_dir)


@query
def rate_class_counts(spark, sf_dir):
    return rate_panel_ops.rate_class_counts(sample_rate_panel(spark, sf_dir))


@query
def suffix_guard(spark, sf_dir):
    return rate_panel_ops.suffix_violations(identified_panel(spark, sf_dir))


# --- linkage: its parts, before anything is claimed -------------------------

def sample_link_rows(spark, sf_dir, presence_key=None) -> DataFrame:
    return link_rules.link_rows(kept_panel(spark, sf_dir), YEARS, presence_key)


def sample_edges(rows: DataFrame) -> DataFrame:
    return link_claims.candidate_edges(rows, link_rules.AMOUNT_TOLERANCE)


@query
def period_pairs(spark, sf_dir):
    return link_rules.period_pairs(raw_panel(spark, sf_dir))


@query
def link_dates(spark, sf_dir):
    return sample_link_rows(spark, sf_dir).select("year", "pos", "start_date", "mat_date", "dates")


@query
def expected_loans(spark, sf_dir):
    return sample_link_rows(spark, sf_dir).filter("missing").select("year", "pos", "composite_id")


@query
def missing_next_year(spark, sf_dir):
    return sample_link_rows(spark, sf_dir, "id").filter("missing").select("year", "pos", "id")


@query
def link_candidates(spark, sf_dir):
    return link_claims.candidate_counts(sample_link_rows(spark, sf_dir))


@query
def collision_count(spark, sf_dir):
    return link_rules.same_start_counts(sample_link_rows(spark, sf_dir)).select(
        "year", "muni_id", "lender_ico", "start_date", "n"
    )


@query
def amount_matches(spark, sf_dir):
    return sample_edges(sample_link_rows(spark, sf_dir)).select(
        "year", "muni_id", "lender_ico", "l_amount", "c_amount", "n_l", "n_c"
    )


@query
def unique_amount_link(spark, sf_dir):
    rows = materialise(sample_link_rows(spark, sf_dir), "link-rows", partition_by=["year"])
    return link_claims.unique_amount_matches(rows, sample_edges(rows))


@query
def link_signals(spark, sf_dir):
    rows = materialise(sample_link_rows(spark, sf_dir), "link-rows", partition_by=["year"])
    of = {year: rows.filter(F.col("year") == year) for year in YEARS}
    return reduce(
        DataFrame.unionByName,
        (link_rules.shared_starts(of[y], of[z]).withColumn("year", F.lit(y)) for y, z in zip(YEARS, YEARS[1:])),
    )


@query
def gap_candidates(spark, sf_dir):
    rows = sample_link_rows(spark, sf_dir)
    loans = rows.filter("missing").select("year", *link_rules.GROUP, F.col("amount").alias("l_amount"))
    later = rows.select(F.col("year").alias("gap_year"), *link_rules.GROUP, F.col("amount").alias("c_amount"))
    return link_gaps.gap_edges(
        loans.na.drop("any", subset=link_rules.GROUP), later.na.drop("any", subset=link_rules.GROUP),
        link_rules.AMOUNT_TOLERANCE,
    )


# --- decisions --------------------------------------------------------------

def same_order_pairs(spark, sf_dir) -> DataFrame:
    """Reports of one order in different years, as a person would pair them."""
    kept = kept_panel(spark, sf_dir).select(
        F.floor(F.col("pos") / 2).alias("k"), "year", "composite_id"
    )
    a = kept.withColumnsRenamed({"composite_id": "y1_composite_id", "year": "y1"})
    b = kept.withColumnsRenamed({"composite_id": "y2_composite_id", "year": "y2"})
    return a.join(b, "k").filter("y1 < y2")


def sample_decisions(spark, sf_dir) -> DataFrame:
    """A decision store: earlier answers first, some of them revised. The
    pairs of every fourth order were never decided on."""
    return same_order_pairs(spark, sf_dir).selectExpr(
        "y1_composite_id", "y2_composite_id",
        "inline(array(named_struct('decision', IF((k + y2) % 5 < 2, 'N', 'Y'), 'seq', k * 20 + y2 - y1),"
        " named_struct('decision', IF((k + y2) % 5 = 0, 'Y', IF((k + y2) % 5 = 4, 'N', NULL)), 'seq', k * 20 + 10 + y2 - y1)))",
    ).filter("decision IS NOT NULL AND seq DIV 20 % 4 <> 3")


def sample_queue(spark, sf_dir) -> DataFrame:
    """A review queue, partly filled in."""
    return same_order_pairs(spark, sf_dir).selectExpr(
        "y1_composite_id", "y2_composite_id", "k * 100 + (y1 - 2020) * 10 + y2 - 2020 AS queue_no",
        "CASE k % 6 WHEN 0 THEN 'y ' WHEN 1 THEN 'N' WHEN 2 THEN 'maybe' WHEN 3 THEN ' n' WHEN 4 THEN 'Y' ELSE '' END"
        " AS decision",
    )


@query
def unapplied_reviews(spark, sf_dir):
    return decisions.unapplied_reviews(sample_queue(spark, sf_dir), sample_decisions(spark, sf_dir))


@query
def ingest_reviews(spark, sf_dir):
    return decisions.new_decisions(sample_queue(spark, sf_dir), sample_decisions(spark, sf_dir))


@query
def decisions_applied(spark, sf_dir):
    return decisions.apply_decisions(sample_queue(spark, sf_dir), sample_decisions(spark, sf_dir))


# --- linkage: whole runs ----------------------------------------------------

_runs: dict[tuple, linkage.Linkage] = {}


def linked(spark, sf_dir, dry_run=False) -> linkage.Linkage:
    """One run per session and table folder; its results are stored tables
    that several queries look at."""
    key = (spark.sparkContext.applicationId, sf_dir, dry_run)
    if key not in _runs:
        _runs[key] = linkage.link_panel(
            kept_panel(spark, sf_dir), sample_decisions(spark, sf_dir), dry_run=dry_run
        )
    return _runs[key]


@query
def link_outcome(spark, sf_dir):
    return linked(spark, sf_dir).outcomes()


@query
def linked_panel(spark, sf_dir):
    return linked(spark, sf_dir).panel().select(
        "year", "pos", "composite_id", "id", "dedup_suffix", "yoy_change"
    )


@query
def early_payoffs(spark, sf_dir):
    return linked(spark, sf_dir).early_payoffs().select("year", "pos", "composite_id", "id", "yoy_change")


@query
def review_queue(spark, sf_dir):
    return linked(spark, sf_dir).review_queue().drop("purpose_similarity")


@query
def purpose_similarity(spark, sf_dir):
    return linked(spark, sf_dir).review_queue().select(
        "y1_composite_id", "y2_composite_id", "y1_purpose", "y2_purpose", "purpose_similarity"
    )


@query
def link_stats(spark, sf_dir):
    return linked(spark, sf_dir).stats()


@query
def link_dry_run(spark, sf_dir):
    return linked(spark, sf_dir, dry_run=True).stats()


@query
def review_reason_counts(spark, sf_dir):
    return linked(spark, sf_dir, dry_run=True).reason_counts()
