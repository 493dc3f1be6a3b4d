"""Benchmark items that documents hold in another case, wrapping or part."""

from __future__ import annotations

from loanpanel.llm import decontamination
from loanpanel.sources.scratch import materialise

ITEM = (
    "Alice has 12 apples. She gives Bob 5 apples and keeps the rest; how many apples does Alice keep when Bob eats 2 kg?"
)


def found(spark, texts, items):
    docs = materialise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "docs")
    items = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return sorted((r.doc_id, r.item_id) for r in decontamination.findings(docs, items).collect())


def test_case_and_wrapping_hide_no_copy(spark):
    other = ITEM.replace("Alice", "Carol").replace("Bob", "Dave")
    mixed = other.replace("Dave eats", "Frank eats")
    texts = [
        ITEM.upper(), ITEM.lower(), ITEM.replace(" ", "\n"), ITEM.replace(" ", "  "), ITEM.replace(" ", "\u00a0"), ITEM.title(),
        other.replace(" ", "\n"), f"an intro\n{other}", mixed, mixed.upper(), ITEM.replace("12", "13").upper(),
    ]
    assert found(spark, texts, [ITEM]) == [(i, 0) for i in (0, 1, 2, 3, 4, 5, 6, 7, 10)]
    assert found(spark, ["DIE STRASSE VON OTTO IST SEHR LANG UND BREIT"], ["Die Straße von Otto ist sehr lang und breit"]) == [(0, 0)]


def test_rows_of_one_id_are_judged_apart(spark):
    docs = [(1, ITEM), (2, ITEM), (2, "Carol has 13 apples and Dave 7, says " + ITEM.replace("Bob eats", "Eve eats")), (2, ITEM), (None, ITEM)]
    docs = materialise(spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, item string, form int"), "docs")
    items = spark.createDataFrame([(7, ITEM), (7, ITEM)], "item_id long, text string")
    rows = decontamination.findings(docs, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(1, 7), (1, 7), (2, 7), (2, 7)]
    assert decontamination.clean(docs, items).count() == 1


def test_slots_of_windows_of_every_length(spark):
    """The answer for an item does not depend on longer ones in the table."""
    texts = ["he asked what is 3 plus 4 today", "he asked what is 3 plus 3 today", "WHAT IS 5\nPLUS 5"]
    for items in (["what is 12 plus 12"], ["what is 12 plus 12", ITEM]):
        assert found(spark, texts, items) == [(1, 0), (2, 0)]


def test_runs_and_short_items(spark):
    passage = " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300))
    words = passage.split()
    texts = [" ".join(["start", *words[100:113], "end"]), " ".join(["start", *words[100:112], "end"]),
             " ".join(words[100:112] + ["x"] + words[113:124]), "Paris", "in Paris now", "new\n york!", "New York and more"]
    assert found(spark, texts, [passage, "paris", "New York", "...", ""]) == [(0, 0), (3, 1), (5, 2)]
