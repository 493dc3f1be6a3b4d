from __future__ import annotations

import pytest

from loanpanel.operators import decisions as D
from loanpanel.sources import columns, readers, writers

COMMON = [
    "Účetní jednotkaZC_UCJED:ZC_UCJED", "IČOZC_ICO:ZC_ICO", "IČO poskytovatele/BIC/ZC_PARTP:ZC_PARTP",
    "Název poskytovatele/BIC/ZC_NAZPOS:ZC_NAZPOS", "Účel/BIC/ZC_UCFP:ZC_UCFP", "Uzavření/BIC/ZC_DATUS:ZC_DATUS",
    "Splatnost/BIC/ZC_TERSPL:ZC_TERSPL", "Sjednaná výše ZU_VYUV", "Čerpaná výše ZU_CEUV",
]
NAMES = [
    "muni_id", "borrower_ico", "lender_ico", "lender_name", "purpose", "signed_on", "matures_on", "agreed_amount",
    "drawn_amount",
]


def write(path, header, rows, sep="\t"):
    path.write_text("\n".join(sep.join(r) for r in [header, *rows]) + "\n", encoding="utf-8")


@pytest.fixture
def folder(tmp_path):
    row = ["m1", "1", "2", "Banka", "voda", "20200101", "20300101", "5", "4"]
    write(tmp_path / "loans_2021012.tsv", [f'"{c}" ' for c in COMMON], [row, ["N/A", *row[1:3], "", *row[4:]]])
    other = [*reversed(COMMON), "Sazba/BIC/ZC_URSA:ZC_URSA"]
    write(tmp_path / "loans_2022012.tsv", other, [[*reversed(row), "1,5"]] * 50)
    write(tmp_path / "loans_2023012.tsv", COMMON[1:], [row[1:]])
    write(tmp_path / "notes.tsv", COMMON, [row])
    return tmp_path


def test_headers_drift(spark, folder):
    files = readers.read_panel(spark, str(folder))
    rows = files.panel.orderBy("year", "pos").collect()
    assert [r.year for r in rows] == [2021] * 2 + [2022] * 50
    assert [rows[0][n] for n in NAMES] == [rows[5][n] for n in NAMES]
    assert (rows[0].rate_text, rows[5].rate_text) == (None, "1,5")
    assert (rows[1].muni_id, rows[1].lender_name) == (None, None)
    assert rows[0].source_file == "loans_2021012.tsv"
    assert files.problems == {
        "notes.tsv": "no period in the file name", "loans_2023012.tsv": "no column for muni_id",
    }


def test_start_year_leaves_files_unopened(spark, folder):
    files = readers.read_panel(spark, str(folder), start_year=2022)
    assert files.panel.select("year").distinct().collect() == [(2022,)]
    assert "loans_2021012.tsv" not in files.problems


def test_order_within_and_across_files(spark, tmp_path):
    """Rows keep their order when a file is read in many splits and a year
    comes in several files."""
    n = 3000
    for part, start in (("a", 0), ("b", n)):
        rows = [[str(i)] + ["x"] * 8 for i in range(start, start + n)]
        write(tmp_path / f"{part}_2021012.tsv", COMMON, rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        panel = readers.read_panel(spark, str(tmp_path)).panel.cache()
        assert panel.rdd.getNumPartitions() > 4
        got = [int(r.muni_id) for r in panel.orderBy("pos").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(range(2 * n))


def numbers(panel):
    got = {}
    for r in panel.orderBy("year", "pos").collect():
        got.setdefault(r.year, []).append((r.pos, r.source_file, int(r.muni_id)))
    return got


@pytest.mark.parametrize("multi_line", [False, True])
@pytest.mark.parametrize("split", ["4096", "128m"])
def test_places_of_files_that_share_a_task(spark, tmp_path, multi_line, split):
    """Small files read by one task after another, and large ones in parts,
    have dense places in order of file name and line."""
    sizes = {"A_2021012": 5, "B_2021012": 6000, "A_2022012": 300, "C d%20e_2022012": 7}
    for name, n in sizes.items():
        write(tmp_path / f"{name}.tsv", COMMON, [[str(i)] + ["x"] * 8 for i in range(n)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.minPartitionNum", "2")
    try:
        got = numbers(readers.read_panel(spark, str(tmp_path), multi_line=multi_line).panel)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
    want = {}
    for name, n in sorted(sizes.items()):
        rows = want.setdefault(int(name[-7:-3]), [])
        rows += [(len(rows) + i, f"{name}.tsv", i) for i in range(n)]
    assert got == want


def test_malformed_rows_are_listed(spark, tmp_path):
    row = [str(i) for i in range(9)]
    write(tmp_path / "a_2021012.tsv", COMMON, [row, row[:8], ['"0', *row[1:]], [*row, "9"], ['"x', 'y"', *row[1:]], row])
    write(tmp_path / "b_2021012.tsv", COMMON, [['"x\ny"', *row[1:8]], row])
    for multi_line, lists in ((True, 2), (False, 3)):
        files = readers.read_panel(spark, str(tmp_path), multi_line=multi_line)
        assert all(r.drawn_amount == "8" for r in files.panel.collect() if r.source_file[0] == "b" and multi_line)
        odd = {(r.source_file, r.pos, r.kind) for r in files.malformed.collect()}
        places = [r.pos for r in files.panel.collect()] + [p for _, p, _ in odd]
        assert sorted(places) == list(range(len(places)))
        assert ("a_2021012.tsv", 1, "short") in odd and len(odd) >= lists
        counts = {(r.source_file, r.kind): r.n for r in files.counts().collect()}
        assert sum(counts.values()) == len(places)
    clean = tmp_path / "clean"
    clean.mkdir()
    write(clean / "c_2021012.tsv", COMMON, [row, row[:8], [*row, "9"], ['"x\ty"', *row[1:]]])
    files = readers.read_panel(spark, str(clean))
    assert [(r.pos, r.kind, r.text) for r in files.malformed.orderBy("pos").collect()] == [
        (1, "short", "\t".join(row[:8])), (2, "long", "\t".join([*row, "9"]))
    ]
    assert [(r.pos, r.muni_id, r.drawn_amount) for r in files.panel.orderBy("pos").collect()] == [(0, "0", "8"), (3, "x\ty", "8")]


def test_headers_of_many_files_start_no_job(spark, tmp_path):
    for i in range(300):
        write(tmp_path / f"f{i:04d}_2021012.tsv", COMMON if i % 2 else ['"Two\nlines"', *COMMON], [["x"] * 10])
    paths = [p.path for p in readers.list_parts(spark, str(tmp_path), "*.tsv")]
    spark.sparkContext.setJobGroup("headers", "headers")
    found = readers.headers(spark, paths, "\t")
    spark.sparkContext.setJobGroup("", "")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    assert list(found) == paths and {len(h) for h in found.values()} == {9, 10} and found[paths[0]][0] == "Two lines"


def test_yearly_texts_keep_their_names(spark, folder, tmp_path):
    panel = readers.read_panel(spark, str(folder)).panel
    out = str(tmp_path / "texts")
    tokens = {n: f"{n} {t}" for n, t in columns.LOAN_TOKENS.items()}
    named = panel.drop("year").withColumnsRenamed(tokens)
    for _ in range(2):  # the second time replaces the first
        assert writers.write_yearly(named, out) == ["loans_2021012.tsv", "loans_2022012.tsv"]
        back = readers.read_panel(spark, out, "*.csv").panel.orderBy("year", "pos").collect()
        was = panel.select(back[0].__fields__).orderBy("year", "pos").collect()
        assert back == was


def test_headers():
    assert columns.normalise_headers(['"a"  b', " a b ", "c\t d"]) == ["a b", "a b.1", "c d"]
    assert columns.find_column(["xZC_ZPRUC", "b"], "ZC_ZPRU") == "xZC_ZPRUC"


def test_values_survive_exchange(spark, tmp_path):
    df = spark.createDataFrame(
        [("f_2021012.tsv", " a ", 'q"x', None), ("f_2021012.tsv", "tab\tinside", "", "z")],
        "source_file string, a string, b string, c string",
    )
    writers.write_exchange(df, str(tmp_path / "out"))
    parts = readers.list_parts(spark, str(tmp_path / "out" / "source_file=f_2021012.tsv"), "*.csv")
    back = readers.read_files(spark, parts, ("a", "b", "c"), "\t").collect()
    assert {(r.a, r.b, r.c) for r in back} == {(" a ", 'q"x', None), ("tab\tinside", None, "z")}


def test_split_sinks(spark, tmp_path):
    df = spark.createDataFrame(
        [(2021, 1, None), (2021, 2, "ZERO_LOAN"), (2022, 3, "ZERO_LOAN")], "year int, pos long, reason string"
    )
    writers.write_identified(df, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.reason, r.year, r.pos) for r in back.collect()} == {
        ("KEPT", 2021, 1), ("ZERO_LOAN", 2021, 2), ("ZERO_LOAN", 2022, 3),
    }


def test_codelist(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_text(
        '"kodjaz","chodnota1","text1","text2"\n"CS","801","Obec","Obec"\n"CS","801","Obec","Městská část, obvod"\n',
        encoding="utf-8",
    )
    rows = readers.read_codelist(spark, str(path)).orderBy("line_no").collect()
    assert [(r.code, r.official, r.form_group) for r in rows] == [
        ("801", "Obec", "Obec"), ("801", "Obec", "Městská část, obvod"),
    ]


def test_datasets_pair_by_name():
    pairs, alone = readers.pair_datasets(["d/a_MISSING_ICO.tsv", "d/b_MISSING_ICO.tsv"], ["d/a_ENRICHED.tsv"])
    assert pairs == [("d/a_MISSING_ICO.tsv", "d/a_ENRICHED.tsv")] and alone == ["d/b_MISSING_ICO.tsv"]


def test_reviews_go_into_the_store_once(spark, tmp_path):
    """Queue written, answered, applied; applying it again adds nothing."""
    store, queue = str(tmp_path / "store"), str(tmp_path / "queue")
    D_SCHEMA = "y1_composite_id string, y2_composite_id string, decision string, seq long"
    writers.append_decisions(spark.createDataFrame([("a", "b", "N", 1), ("a", "b", "Y", 2)], D_SCHEMA), store)
    answers = [("g2", "c", "d", " y "), ("g1", "a", "b", "N"), ("g1", "e", "f", "?"), ("g3", "c", "d", "N")]
    writers.write_review_queue(
        spark.createDataFrame(answers, "group_id string, y1_composite_id string, y2_composite_id string, decision string"),
        queue,
    )
    read = lambda: (readers.read_review_queue(spark, queue), readers.read_decisions(spark, store))
    with pytest.raises(D.UnappliedReviews):
        D.require_applied(*read())
    fresh = D.new_decisions(*read()).collect()
    assert [(r.y1_composite_id, r.y2_composite_id, r.decision) for r in fresh] == [("c", "d", "Y")] and fresh[0].seq > 2
    writers.append_decisions(spark.createDataFrame(fresh), store)
    D.require_applied(*read())
    latest = {(r.y1_composite_id, r.decision) for r in D.latest_decisions(read()[1]).collect()}
    assert latest == {("a", "Y"), ("c", "Y")}
