from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from loanpanel.functions import amounts, rates, similarity, text
from loanpanel.operators import link_rules


def values(spark, expression, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string").repartition(2)
    return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_ids(spark):
    raw = ["123", " 45317054.0 ", None, "123456789", "US", "-12", "nan", "\x1f7　"]
    assert values(spark, text.pad_id, raw) == [
        "00000123", "45317054", "00000000", "123456789", "000000US", "-0000012", "00000000", "00000007",
    ]
    assert values(spark, text.registry_key, ["12.5.6", " 7 ", "123456789"]) == ["00000012", "00000007", "123456789"]


def test_missing_values(spark):
    assert values(spark, text.na_to_null, ["", "N/A", "nan", "None", "x", "Nan"]) == [None] * 4 + ["x", "Nan"]
    assert values(spark, text.is_filled, [None, " ", "nan", "NaN", "x"]) == [False] * 4 + [True]


def test_amounts(spark):
    raw = ["4 000 000", "1,5", "-2.5", "1d", "0x1p3", "1e3", ".5", "5.", "x", None, "1 000", " 7 "]
    assert values(spark, amounts.parse_amount, raw) == [
        4e6, 1.5, -2.5, None, None, 1000.0, 0.5, 5.0, None, None, None, 7.0,
    ]
    assert values(spark, amounts.parse_amount_or_zero, ["x", None, "1,5"]) == [0.0, 0.0, 1.5]
    whole = lambda x: amounts.whole_units(amounts.parse_amount_or_zero(x))
    assert values(spark, whole, ["408900.04", "-5.9", "1e30"]) == ["408900", "-5", str(-(2**63))]


@pytest.mark.parametrize("a, b, close", [
    (1000.0, 1000.9, True), (1000.0, 1001.1, False), (0.0, 0.0, True), (0.0, 1e-9, False), (-1000.0, -1000.5, True),
    (1.0, -1.0, False), (None, 1.0, False), (1000.0, 1001.0, True),
])
def test_tolerance(spark, a, b, close):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    assert df.select(amounts.within_tolerance(F.col("a"), F.col("b"), 0.001)).first()[0] is close


def test_amount_edges_find_every_close_pair(spark):
    rng = random.Random(5)
    base = [10 ** rng.uniform(-2, 9) * rng.choice((1, 1, 1, -1)) for _ in range(300)]
    left = sorted({*base, 0.0, 1000.0, 999.0, 1001.0})
    right = sorted({x * (1 + rng.uniform(-0.0021, 0.0021)) for x in base} | {0.0, 1000.0, 999.0, 1001.0})
    a = spark.createDataFrame([("g", x) for x in left], "g string, l_amount double")
    b = spark.createDataFrame([("g", x) for x in right], "g string, c_amount double")
    got = {(r.l_amount, r.c_amount) for r in link_rules.amount_edges(a, b, ["g"], 0.001).collect()}
    want = {
        (x, y) for x in left for y in right
        if x == y == 0 or max(abs(x), abs(y)) > 0 and abs(x - y) / max(abs(x), abs(y)) <= 0.001
    }
    assert got == want


def test_rates(spark):
    raw = ["0", "0,00", "1,32", "2,46%", "4.05", "4,20% p.a.", "bezúročná", "6M PRIBOR + přirážka 0,45%p.a.", " ", None]
    assert values(spark, rates.rate_number, raw) == [0.0, 0.0, 1.32, 2.46, 4.05, 4.2, None, None, None, None]
    assert values(spark, rates.has_words, raw) == [False] * 6 + [True, True, False, False]
    assert values(spark, rates.has_words, ["1 ,5", "5 P. A."]) == [False, False]
    keys = values(spark, rates.rate_key, ["Bezúročná ", "bezúročná", "0", "0,00", ""])
    assert keys[0] == keys[1] and keys[2] == keys[3] and keys[4] is None and keys[0] != keys[2]


def subsequence(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0] + [0] * len(b) if not b else _next(row, x, b)
    return row[-1]


def _next(row, x, b):
    new = [0]
    for j, y in enumerate(b):
        new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
    return new


def test_purpose_similarity(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abčř ") for _ in range(rng.randint(0, 90))) for _ in range(60)] + [None, "", "Kitten"]
    pairs = [(rng.choice(words), rng.choice(words)) for _ in range(200)] + [("kitten", "SITTING "), (None, "")]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", similarity.purpose_similarity("a", "b").alias("s")).collect():
        a, b = ((x or "").strip().lower() for x in (r.a, r.b))
        want = 1.0 if not a and not b else round(2 * subsequence(a, b) / (len(a) + len(b)), 3)
        assert r.s == want


def test_reason_kinds(spark):
    got = values(spark, link_rules.reason_kind, [link_rules.REASON_COLLISION, "Reporting-gap", ""])
    assert got == ["Collision (multiple loans share start date)", "Reporting-gap", "(unknown)"]
