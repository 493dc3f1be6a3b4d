from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loanpanel.operators import identity, lookup, reports

COLUMNS = (
    "source_file", "borrower_ico", "lender_ico", "lender_name", "purpose", "signed_on", "matures_on",
    "agreed_amount", "drawn_amount",
)
SCHEMA = "year int, pos long, " + ", ".join(f"{c} string" for c in COLUMNS)

# Rows of public loan reports with the keys they are known by.
KNOWN = [
    # (year, borrower, lender, lender name, purpose, signed, matures, agreed, id, suffix, reason)
    (2021, "665169", "45317054", "Komerční banka, a.s.", "výstavba kanalizace", "20120328", "20320131", "4000000",
     "00665169-45317054-20120328-20320131-4000000", "0baff4e5-8c118f2a", "DEDUP_POPULATED"),
    (2021, "665169", "45317054", "Komerční banka, a.s.", "výstavba vodovodu", "20120328", "20320131", "4000000",
     "00665169-45317054-20120328-20320131-4000000", "0baff4e5-9f1c4a22", "DEDUP_POPULATED"),
    (2021, "297054", "25722328", "RCI Financial Services, s.r.o.", "vozidlo Dacia Duster - hala", "20201209",
     "20241208", "408900.04", "00297054-25722328-20201209-20241208-408900", "f06831d0-a515f1b0", "DEDUP_POPULATED"),
    (2021, "297054", "25722328", "RCI Financial Services, s.r.o.", "vozidlo Dacia Duster - kanalizace", "20201209",
     "20241208", "408900.04", "00297054-25722328-20201209-20241208-408900", "f06831d0-a10b9b32", "DEDUP_POPULATED"),
    (2021, "259586", "111", "Bez úvěru", "Bez úvěru", "20221231", "20221231", "0",
     "00259586-00000111-20221231-20221231-0", None, "ZERO_LOAN"),
    (2021, "297062", "0", None, "0", "20211231", "20211231", "0",
     "00297062-00000000-20211231-20211231-0", "a3d2de76-cfcd2084", "ZERO_LOAN"),
    (2021, "297062", "0", None, "0", "20211231", "20211231", "0",
     "00297062-00000000-20211231-20211231-0", "a3d2de76-cfcd2084", "ZERO_LOAN"),
    (2022, "261238", "US", "EDISON DEVELOPMENT COMPANY", "Teplárna Děčín - Bynov", "19950918", "20250918", "4523200",
     "00261238-000000US-19950918-20250918-4523200", "72a93304-ad1f4b17", "DEDUP_POPULATED"),
    (2022, "261238", "US", " edison development company ", "TEPLÁRNA DĚČÍN - BYNOV", "19950918", "20250918",
     "4523200", "00261238-000000US-19950918-20250918-4523200", "72a93304-ad1f4b17", "DEDUP_POPULATED"),
    (2022, "579874", "45317054.0", "Komerční banka, a.s.", "kanalizace a ČOV", "20210610", "20280531", "5000000",
     "00579874-45317054-20210610-20280531-5000000", "0baff4e5-4aaad9fa", "DEDUP_POPULATED"),
    (2022, "579874", "45317054", "Komerční banka, a.s.", "kanalizace a ČOV", "20210610", "20280531", "5 000 000,00",
     "00579874-45317054-20210610-20280531-5000000", "0baff4e5-4aaad9fa", "DEDUP_POPULATED"),
    # The same loan once in a later file goes because of the earlier one.
    (2023, "579874", "45317054", "Komerční banka, a.s.", "kanalizace", "20210610", "20280531", "5000000",
     "00579874-45317054-20210610-20280531-5000000", None, "CROSS_REMOVED"),
    # A zero loan that repeats does not remove other years' rows.
    (2023, "297062", "0", None, "0", "20211231", "20211231", "0,50",
     "00297062-00000000-20211231-20211231-0", None, None),
    (2023, None, None, None, None, None, None, None, "00000000-00000000-nan-nan-0", None, "ZERO_LOAN"),
    (2023, "123456789", "-12", "x", "y", "20200101", "20300101", "-5",
     "123456789--0000012-20200101-20300101--5", None, None),
]


def panel(spark, rows=KNOWN):
    return spark.createDataFrame(
        [(r[0], i, f"loans_{r[0]}012.tsv", *r[1:8], r[7]) for i, r in enumerate(rows)], SCHEMA
    )


def result_of(df):
    return [
        (r.id, r.dedup_suffix, r.reason, r.composite_id) for r in df.orderBy("pos").collect()
    ]


def expected():
    return [
        (r[8], r[9], r[10], "-".join(x for x in (r[8], r[9], str(r[0])) if x)) for r in KNOWN
    ]


def test_known_keys_and_reasons(spark):
    assert result_of(identity.identify(panel(spark))) == expected()


@pytest.mark.parametrize("rows_per_key", [1, 10**6])
def test_same_without_broadcast(spark, monkeypatch, rows_per_key):
    """Heavy keys apart from the others, and all of them in a shuffle join."""
    def small(facts, table, keys, weight=None):
        return lookup.lookup(facts, table, keys, weight, broadcast_rows=3, rows_per_key=rows_per_key)

    monkeypatch.setattr(identity, "lookup", small)
    assert result_of(identity.identify(panel(spark))) == expected()


def test_one_id_in_most_rows(spark):
    """An ID that repeats thousands of times is counted and flagged whole."""
    hot = spark.range(20000).selectExpr(
        "2021 AS year", "id AS pos", "'loans_2021012.tsv' AS source_file",
        "IF(id % 3 < 2, '7', cast(id AS string)) AS borrower_ico", "'8' AS lender_ico", "'n' AS lender_name",
        "'p' AS purpose", "'20200101' AS signed_on", "'20300101' AS matures_on", "'5' AS agreed_amount",
        "'5' AS drawn_amount",
    )
    got = identity.identify(hot).groupBy("reason").count().collect()
    n_hot = hot.filter("borrower_ico = '7'").count()
    assert {r.reason: r["count"] for r in got} == {"DEDUP_POPULATED": n_hot, None: 20000 - n_hot}


def test_kept_and_excluded_are_all(spark):
    rows = identity.identify(panel(spark)).cache()
    assert identity.kept(rows).count() + identity.excluded(rows).count() == len(KNOWN)


def test_loss_report_and_histogram(spark):
    rows = identity.identify(panel(spark)).cache()
    report = {r.year: r for r in reports.loss_report(rows).collect()}
    assert (report[2021].n_rows, report[2021].n_dedup, report[2021].n_zero, report[2021].n_excluded) == (7, 4, 3, 7)
    assert (report[2023].n_cross, report[2023].agreed_lost) == (1, 5_000_000.0)
    assert report[2023].pct_rows == pytest.approx(25.0)
    bars = reports.amount_histogram(rows).filter("year = 2021").orderBy("bin_no").collect()
    assert [b.n for b in bars] == [4, 0, 0, 0, 0, 0, 0] and bars[0].bar == "█" * 30
    text = reports.report_lines(reports.loss_report(rows), reports.amount_histogram(rows)).collect()
    assert [t.year for t in text] == [2021, 2022, 2023] and "8,817,800 CZK" in text[0].value


def test_no_rows_lost_gives_zeros(spark):
    rows = identity.identify(panel(spark, KNOWN[-1:]))
    report = reports.loss_report(rows).first()
    assert (report.n_excluded, report.pct_rows, report.agreed_lost) == (0, 0.0, 0.0)


def test_control_total(spark):
    rows = panel(spark).withColumns(
        {"statement": F.when(F.col("pos") == 6, "ZZZ").otherwise("80"), "paid_interest": F.lit("6")}
    )
    got = {r.year: (r.n_rows, r.n_stated, r.complete) for r in reports.control_total(rows).collect()}
    assert got == {2021: (6, 6, True), 2022: (4, None, False), 2023: (4, None, False)}
