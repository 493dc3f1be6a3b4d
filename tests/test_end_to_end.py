from __future__ import annotations

import csv
import glob
import os

import pytest

from loanpanel.operators.decisions import UnappliedReviews
from loanpanel.plans import end_to_end as E
from test_files import COMMON, write


def read_text(folder: str) -> list[dict]:
    rows = []
    for path in sorted(glob.glob(f"{folder}/**/part-*.csv", recursive=True)):
        with open(path, encoding="utf-8", newline="") as f:
            rows += list(csv.DictReader(f, delimiter="\t"))
    return rows


def test_files_to_links(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    (tmp_path / "raw").mkdir()
    def loan(muni, lender, purpose, start, end, amount):
        return [muni, "1", lender, "Banka", purpose, start, end, amount, amount]

    same = loan("m1", "45317054", '"voda\nnebo"', "20200101", "20300101", "1000")
    write(tmp_path / "raw" / "loans_2022012.csv", [f'"{c}"' for c in COMMON], [
        same, loan("m2", "45317054", "škola", "20190101", "20300101", "500"), loan("m3", "4531705", "x", "20190101", "20300101", "7"),
        loan("m9", "1", "d", "20190101", "20300101", "3"), loan("m9", "1", "d", "20190101", "20300101", "3"),
    ], ";")
    write(tmp_path / "raw" / "loans_2023012.csv", COMMON, [
        loan("m1", "45317054", "voda", "20200101", "20310101", "1000"),
        loan("m2", "45317054", "skola", "20190102", "20300101", "900"),
    ], ";")
    assert E.ingest(spark, at("raw"), at("panel")) == {}
    purposes = [r.purpose for r in spark.read.parquet(at("panel")).filter("muni_id = 'm1'").orderBy("year").collect()]
    assert purposes == ["voda\nnebo", "voda"]

    (tmp_path / "codes.csv").write_text('"chodnota1","text1","text2"\n"121","Akciová společnost","A"\n', encoding="utf-8")
    registry = spark.createDataFrame([("45317054", "Komerční banka", "121")], "ico string, name string, form_code string")
    E.resolve_lenders(spark, at("panel"), registry, at("codes.csv"), at("enriched"), at("missing"))
    assert {r["missing_ico"] for r in read_text(at("missing"))} == {"4531705", "1"}
    E.propose_corrections(spark, at("enriched"), at("typos"))
    assert {(r["missing_ico"], r["found_ico_1"]) for r in read_text(at("typos/wide"))} >= {("4531705", "45317054")}

    E.assign_keys(spark, at("enriched"), at("keys"), at("report"))
    report = "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(at("report/part-*"))))
    assert "repeated within the file (DEDUP_POPULATED): 2" in report
    assert {r.n for r in E.compare_rates(spark, at("keys"), at("rates")).collect()} == set()  # no rate column

    paths = E.FollowPaths(at("keys"), at("linked"), at("early"), at("queue"), at("store"), at("tables"))
    E.follow_loans(spark, paths, dry_run=True)
    assert not glob.glob(at("linked"))
    E.follow_loans(spark, paths)
    marks = lambda: {(r.muni_id, r.year): r.yoy_change for r in spark.read.parquet(at("linked")).collect()}
    assert marks() == {
        ("m1", 2022): "", ("m2", 2022): "PENDING_REVIEW", ("m3", 2022): "Repaid Early",
        ("m1", 2023): "Extended", ("m2", 2023): "",
    }
    assert [r["muni_id"] for r in read_text(at("early"))] == ["m3"]
    queued = read_text(at("queue"))
    assert [(r["muni_id"], r["purpose_similarity"], r["amount_diff_pct"]) for r in queued] == [("m2", "0.8", "44.444")]

    for path in glob.glob(at("queue/*.csv")):
        text = open(path, encoding="utf-8").read().splitlines()
        open(path, "w", encoding="utf-8").write("\n".join([text[0], *(line + "y" for line in text[1:])]) + "\n")
    for checksum in glob.glob(at("queue/.part-*.crc")):
        os.remove(checksum)
    with pytest.raises(UnappliedReviews):
        E.follow_loans(spark, paths)
    E.follow_loans(spark, paths, apply_review=True)
    assert marks()["m2", 2022] == "" and read_text(at("queue")) == []
