from __future__ import annotations

import random

import pytest

from brute_linkage import edit_distance
from loanpanel.operators import enrichment, typos

LOANS = "source_file string, pos long, lender_ico string, lender_name string"


def codelist(spark):
    return spark.createDataFrame(
        [
            (1, "381", "Fond (ze zákona)", "Garanční fond"),
            (2, "381", "Fond (ze zákona)", "Státní fond ze zákona"),
            (3, "381", "Fond (ze zákona)", "Státní fond nezapisující se"),
            (4, "801", "Obec", "Obec"),
            (5, "801", "Obec", "Městská část, městský obvod"),
            (6, "121", "Akciová společnost", "Akciová společnost"),
        ],
        "line_no long, code string, official string, form_group string",
    )


def registry(spark):
    return spark.createDataFrame(
        [("45317054", "Komerční banka, a.s.", "121"), ("00000381", "Fond", "381"), ("00000801", "Obec X", "801"),
         ("00000999", "Neznámá", "999"), ("00000777", None, None)],
        "ico string, name string, form_code string",
    )


def test_enrich(spark):
    ids = ["45317054", "45317054.0", "381", "801", "999", "777", "1", "0", "123456789", None]
    loans = spark.createDataFrame([("f", i, x, "n") for i, x in enumerate(ids)], LOANS)
    rows = enrichment.enrich(loans, registry(spark), codelist(spark)).orderBy("pos").collect()
    assert [(r.registry_name, r.form_code, r.form_official, r.form_group, r.form_abbr) for r in rows] == [
        ("Komerční banka, a.s.", "121", "Akciová společnost", "Akciová společnost", "a.s."),
        ("Komerční banka, a.s.", "121", "Akciová společnost", "Akciová společnost", "a.s."),
        ("Fond", "381", "Fond (ze zákona)", "Státní fond nezapisující se", "jiná"),
        ("Obec X", "801", "Obec", "Městská část, městský obvod", "obec"),
        ("Neznámá", "999", "Neznámá forma", "Neznámá klasifikace", "jiná"),
        (None, "", "N/A", "N/A", "N/A"),
        ("Not Found", "", "N/A", "N/A", "N/A"),
        ("Invalid ICO", "", "N/A", "N/A", "N/A"),
        ("Invalid ICO", "", "N/A", "N/A", "N/A"),
        (None, None, None, None, None),
    ]
    missing = enrichment.missing_ids(enrichment.enrich(loans, registry(spark), codelist(spark))).collect()
    assert {(r.missing_ico, r.status) for r in missing} == {
        ("1", "Not Found"), ("0", "Invalid ICO"), ("123456789", "Invalid ICO"),
    }


@pytest.mark.parametrize("distance", [1, 2])
def test_near_pairs_find_all(spark, distance):
    rng = random.Random(distance)
    texts = lambda n: {"".join(rng.choice("0123") for _ in range(rng.randint(0, 7))) for _ in range(n)}
    left, right = texts(150), texts(150)
    a = spark.createDataFrame([(1, x) for x in left], "g int, a string")
    b = spark.createDataFrame([(1, x) for x in right], "g int, b string")
    want = {(x, y) for x in left for y in right if edit_distance(x, y) <= distance}
    rows = [(r.a, r.b) for r in typos.near_pairs(a, b, ["g"], "a", "b", distance).collect()]
    assert set(rows) == want and len(rows) == len(want)


def test_near_pairs_of_long_texts(spark):
    """The number of keys does not grow with the text."""
    text = "0123456789" * 2_000
    a = spark.createDataFrame([(1, text), (1, None)], "g int, a string")
    b = spark.createDataFrame([(1, text[:7] + "x" + text[9:]), (1, text[4:]), (1, None)], "g int, b string")
    assert [len(r.b) for r in typos.near_pairs(a, b, ["g"], "a", "b", 2).collect()] == [19_999]


def test_candidates_long_and_wide(spark):
    loans = spark.createDataFrame(
        [("f", 1, "45317054", "KB"), ("f", 2, "45317054", "Komerční banka"), ("f", 3, "4531705", "KB"),
         ("f", 4, "45317054", "KB"), ("f", 5, "99", "X"), ("g", 6, "4531705", "KB"), ("f", 7, "9", None)],
        LOANS,
    )
    missing = spark.createDataFrame(
        [("f", "4531705"), ("f", "777"), ("g", "4531705"), ("f", None), ("f", "9")], "source_file string, missing_ico string"
    )
    found = typos.typo_candidates(missing, typos.typo_reference(loans)).cache()
    assert {(r.source_file, r.missing_ico, r.ico, r.name, r.pos) for r in found.collect()} == {
        ("f", "4531705", "45317054", "KB", 1), ("f", "4531705", "45317054", "Komerční banka", 2),
        ("f", "4531705", "4531705", "KB", 3), ("f", "777", None, None, None),
        ("g", "4531705", "4531705", "KB", 6), ("f", "9", "99", "X", 5),
    }
    wide = {(r.source_file, r.missing_ico): r for r in typos.widen_candidates(found).collect()}
    row = wide["f", "4531705"]
    assert row.n_matches == 3 and (row.found_ico_1, row.found_name_2, row.found_ico_3) == (
        "45317054", "Komerční banka", "4531705",
    )
    assert wide["f", "777"].n_matches == 0 and wide["f", "777"].found_ico_1 == ""
    pages = typos.widen_candidates(found, page=2).filter("missing_ico = '4531705' AND source_file = 'f'").orderBy("page").collect()
    assert [(r.page, r.n_matches, r.found_name_1, r.found_name_2) for r in pages] == [(0, 3, "KB", "Komerční banka"), (1, 3, "KB", "")]


def test_very_many_matches(spark):
    names = spark.range(1500).selectExpr("'f' AS source_file", "'90' AS lender_ico", "concat('n', id) AS lender_name", "id AS pos")
    missing = spark.createDataFrame([("f", "9")], "source_file string, missing_ico string")
    wide = typos.widen_candidates(typos.typo_candidates(missing, typos.typo_reference(names))).collect()
    assert len(wide) == 75 and {r.n_matches for r in wide} == {1500} and {r.found_name_20 for r in wide} == {f"n{i}" for i in range(19, 1500, 20)}


def test_registry_faults_and_repeats(spark):
    rows = [("00000001", "B", "121", None), ("00000001", "A", "112", None), ("00000002", None, None, "HTTP Error 500"), ("00000003", None, None, "Connection Error")]
    table = spark.createDataFrame(rows, "ico string, name string, form_code string, status string")
    ids = spark.createDataFrame([("1",), ("2",), ("3",)], "lender_ico string")
    got = {r.lender_ico: (r.registry_name, r.form_code) for r in enrichment.registry_lookup(ids, table).collect()}
    assert got == {"1": ("A", "112"), "2": ("HTTP Error 500", ""), "3": ("Connection Error", "")}
