"""Benchmark decontamination by canonical templates.

Texts become templates: names, numbers and units turn into placeholders of
their kind, everything else into lower-cased words. Windows of WINDOW words of
the items' templates are hashed and joined with those of the documents, so an
item is found with other numbers or names in it as well.

An item is in a document if at least SHARE of its windows are, or RUN words of
it in a row, and if its slots are filled consistently: where the item repeats a
value, the document repeats the value that stands in its place. Slots are
compared only for documents that have the windows.

Placeholders: a name is a capitalised word within a sentence (after a letter,
digit or comma and a space); a number may have points or commas inside; a unit
follows a number. Words in capitals throughout are plain words. Runs of white
space count as one space.

Texts with a name have a second form, in which names stay lower-cased words. An
item is in a document if it is so in one of the two forms: with other names in
it in the first, with any case and line breaks in the second. Both are made in
one pass over the texts; a text without a name has one.

Only DataFrame functions. The windows of all items are broadcast while they
are at most BROADCAST_WINDOWS, and joined by shuffle beyond. Items of fewer
than WINDOW words are one window of their own length. Items of fewer than
SHORTEST words, which many clean texts would hold, are found in documents that
consist of them.

Cases: null and empty texts hold nothing; null item texts, and those without a
word, are not found; rows that share an id are judged each for itself, and the id is
reported once an item; rows without id are not reported and
stay in `clean`; items that occur twice are both reported; an empty table on
either side gives no findings; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanpanel.llm.near_links import only, without
from loanpanel.sources.scratch import cut, materialise

WINDOW = 8
SHORTEST = 4
SHARE = 0.5
RUN = 13
BROADCAST_WINDOWS = 500_000

NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002"
#: Units that follow a number.
UNITS = (
    "km", "cm", "mm", "m", "miles", "mile", "feet", "foot", "ft", "inches", "inch", "yards", "kg", "g", "mg", "grams",
    "pounds", "pound", "lb", "lbs", "oz", "ounces", "tons", "l", "ml", "liters", "litres", "gallons", "seconds", "second",
    "minutes", "minute", "hours", "hour", "days", "day", "weeks", "months", "years", "dollars", "dollar", "cents", "euros",
    "euro", "percent", "degrees", "mph", "kmh", "hz", "watts", "volts", "joules",
)
_NAME = r"\p{Lu}(?<=[\p{L}\p{N},;:] \p{Lu})\p{Ll}+"
_NUMBER = r"[0-9]+(?:[.,][0-9]+)*"
_UNITS = f"(?:{'|'.join(UNITS)})(?![\\p{{L}}\\p{{N}}])"
#: White space other than a single space.
_SPACES = r"[\s\p{Z}&&[^ ]][\s\p{Z}]*| [\s\p{Z}]+"
_BETWEEN = r"[^\p{L}\p{N}\x{e000}-\x{e002}]+"


def _words(text: Column) -> Column:
    """The words of a marked text, without the empty ones at its ends."""
    return F.array_remove(F.split(text, _BETWEEN), "")


def _single_spaces(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, NAME + NUMBER + UNIT, "   "), _SPACES, " ")


def _lowered(text: Column) -> Column:
    return F.replace(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


def template(text: Column) -> Column:
    """Canonical words of a text whose names are marked, or stay words."""
    text = F.regexp_replace(_lowered(text), _NUMBER, NUMBER)
    units = F.regexp_replace(text, f"(?<={NUMBER}) ?{_UNITS}", f" {UNIT}")
    return _words(F.when(F.contains(text, F.lit(NUMBER)), units).otherwise(text))


def values(text: Column) -> Column:
    """The same words with what the placeholders stand for behind them; names
    are marked by a placeholder before them, or stay words."""
    text = F.regexp_replace(_lowered(text), r"(?<=[0-9])[.,](?=[0-9])", "")
    text = F.regexp_replace(text, "[0-9]+", f"{NUMBER}$0")
    return _words(F.regexp_replace(text, f"(?<=[0-9]) ?({_UNITS})", f" {UNIT}$1"))


#: Forms of a text: names as placeholders, names as words, both at once.
NAMED, WORDED, BOTH = 0, 1, 2


def _forms(rows: DataFrame, with_values: bool) -> DataFrame:
    """Rows (with text) as one row a form: form, words, and values if asked for."""
    rows = _once(rows, "spaced", _single_spaces(F.col("text"))).drop("text")
    rows = _once(rows, "marked", F.regexp_replace("spaced", _NAME, NAME))
    named = F.contains("marked", F.lit(NAME))
    kinds = {"form": "int", "text": "string", "full": "string"}
    full = F.regexp_replace("spaced", _NAME, f"{NAME}$0") if with_values else F.lit(None).cast("string")

    def form(k: int, text: str, whole: Column) -> Column:
        return F.struct(*(c.cast(t).alias(n) for (n, t), c in zip(kinds.items(), (F.lit(k), F.col(text), whole))))

    plain = F.col("spaced") if with_values else F.lit(None)
    forms = F.when(named, F.array(form(NAMED, "marked", full), form(WORDED, "spaced", plain))).otherwise(
        F.array(form(BOTH, "spaced", plain))
    )
    rows = rows.select("*", F.explode(forms).alias("of")).drop("spaced", "marked")
    rows = _once(rows, "words", template(F.col("of.text")))
    if with_values:
        rows = _once(rows, "values", values(F.col("of.full")))
    return rows.withColumn("form", F.col("of.form")).drop("of")


def _windows(hashes: str, lengths: list[int]) -> Column:
    """Hashes of all windows of the given lengths, those of the first length
    first, from the hashes of the words. A length under SHORTEST counts where
    it is the whole."""
    size = F.size(hashes)

    def of(n: int) -> Column:
        last = size - n
        fits = last == 0 if n < SHORTEST else last >= 0
        starts = F.when(fits, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(F.lit(n), *(F.get(hashes, i + k) for k in range(n))))

    return F.concat(*(of(n) for n in lengths)) if len(lengths) > 1 else of(lengths[0])


def _place(lengths: list[int]) -> tuple[Column, Column]:
    """First word and length of a window, by its place among those of a text
    of n_words words."""
    size, place = F.col("n_words"), F.col("place")
    start, length = place, F.lit(lengths[-1])
    before = F.lit(0)
    starts = []
    for n in lengths:
        starts.append((n, before))
        many = F.when(size == n, 1).otherwise(0) if n < SHORTEST else F.greatest(size - n + 1, F.lit(0))
        before = before + many
    for n, first in starts:
        start = F.when(place >= first, place - first).otherwise(start)
        length = F.when(place >= first, F.lit(n)).otherwise(length)
    return start, length


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column computed once a row, whatever uses it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _both(form: Column) -> Column:
    """The forms that a row of this form counts for."""
    return F.when(form == BOTH, F.array(F.lit(NAMED), F.lit(WORDED))).otherwise(F.array(form))


def findings(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row (doc_id, item_id, windows, coverage, slots) for each item in a
    document: windows of the item found, and their share of its windows, and slots
    that were compared."""
    known = items.filter("text IS NOT NULL").select("item_id", F.monotonically_increasing_id().alias("item"), "text")
    known = materialise(known, "items")
    forms = materialise(_forms(known.select("item", "text"), True).filter(F.size("words") > 0), "item-words")
    forms = forms.withColumn("length", F.least(F.size("words"), F.lit(WINDOW)))
    lengths = sorted(r.length for r in forms.select("length").distinct().collect())  # at most WINDOW of them
    windows = cut(_item_windows(forms, lengths or [WINDOW]))
    totals = windows.groupBy("item", "form").agg(F.countDistinct("at").alias("total"))

    # rows of one id and text are alike: the text's hash tells the others apart
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    texts = texts.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    hits = cut(_hits(texts, windows, lengths or [WINDOW]))
    key = ["doc_id", "tie", "item", "form"]
    found = hits.groupBy(key).agg(F.countDistinct("at").alias("windows")).join(totals, ["item", "form"])
    # places of an item met one after another at one shift
    order = Window.partitionBy(*key, "shift").orderBy("at")
    shifted = hits.filter(F.col("length") == WINDOW).select(*key, "at", (F.col("start") - F.col("at")).alias("shift")).distinct()
    island = (F.col("at") - F.row_number().over(order)).alias("island")
    runs = shifted.select("*", island).groupBy(*key, "shift", "island").count().filter(F.col("count") >= RUN - WINDOW + 1)
    runs = runs.select(key).distinct().withColumn("run", F.lit(True))
    found = found.join(runs, key, "left").filter((F.col("windows") >= SHARE * F.col("total")) | F.col("run"))
    found = cut(found.select(*key, "windows", (F.col("windows") / F.col("total")).alias("coverage")))

    fits = _slots(texts, forms, hits, found, key)
    out = found.join(fits, key, "left").filter("given IS NULL OR given = 1")
    # the form with more of the item
    best = F.max(F.struct("coverage", "windows", F.coalesce("slots", F.lit(0)).alias("slots"))).alias("best")
    out = out.groupBy("doc_id", "item").agg(best).select("doc_id", "item", "best.*")
    return out.join(known.select("item", "item_id"), "item").select("doc_id", "item_id", "windows", "coverage", "slots")


def _item_windows(forms: DataFrame, lengths: list[int]) -> DataFrame:
    """(item, form, at, hash, slots): the windows of items, form by form. An
    item within a sentence of a document may begin with what looks like a name."""
    inner = forms.filter(F.col("form") != WORDED).select(
        "item", F.lit(NAMED).alias("form"), F.concat(F.array(F.lit(NAME)), F.slice("words", 2, F.size("words") - 1)).alias("words"),
        "length", F.lit(True).alias("first"),
    )
    every = forms.select("item", "form", "words", "length", F.lit(False).alias("first")).unionByName(inner)
    every = _once(every, "hashes", F.transform("words", lambda w: F.xxhash64(w)))
    own = F.lit(None).cast("array<bigint>")
    for n in lengths:
        own = F.when(F.col("length") == n, _windows("hashes", [n])).otherwise(own)
    every = every.select("*", F.posexplode(own).alias("at", "hash")).filter("at = 0 OR NOT first")
    slots = F.arrays_overlap(F.slice("words", F.col("at") + 1, F.col("length")), F.array(*map(F.lit, (NAME, NUMBER, UNIT))))
    return every.select("item", F.explode(_both(F.col("form"))).alias("form"), "at", "hash", slots.alias("slots")).distinct()


def _hits(texts: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, tie, form, item, at, start, length, slots): windows of items in
    documents, from one pass over the texts."""
    words = _forms(texts, False)
    words = _once(words, "hashes", F.transform("words", lambda w: F.xxhash64(w))).drop("words")
    seen = words.select("doc_id", "tie", F.col("form").alias("doc_form"), F.size("hashes").alias("n_words"),
                        F.posexplode(_windows("hashes", lengths)).alias("place", "hash"))
    few = windows.count() <= BROADCAST_WINDOWS
    met = seen.join(F.broadcast(windows) if few else windows, "hash")
    met = met.filter((F.col("doc_form") == BOTH) | (F.col("doc_form") == F.col("form")))
    start, length = _place(lengths)
    return met.select("doc_id", "tie", "form", "item", "at", start.alias("start"), length.alias("length"), "slots")


def _slots(texts: DataFrame, forms: DataFrame, hits: DataFrame, found: DataFrame, key: list[str]) -> DataFrame:
    """key, `given` (1 if some place of the document fills the item's slots
    consistently) and the number of slots compared."""
    slots = cut(hits.filter("slots").join(found.select(key), key).drop("slots"))
    chosen = only(texts, slots.select("doc_id").distinct(), "doc_id")
    filled = _forms(chosen, True).select(
        "doc_id", "tie", F.explode(_both(F.col("form"))).alias("form"), F.col("values").alias("doc_values")
    )
    asked = forms.select(
        "item", F.explode(_both(F.col("form"))).alias("form"), F.col("words").alias("item_words"), F.col("values").alias("item_values")
    )
    met = slots.join(filled.dropDuplicates(["doc_id", "tie", "form"]), ["doc_id", "tie", "form"]).join(asked, ["item", "form"])
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("length") - 1),
        lambda k: F.struct(
            F.get("item_words", F.col("at") + k).alias("mark"),
            F.get("item_values", F.col("at") + k).alias("asked"),
            F.get("doc_values", F.col("start") + k).alias("given"),
        ),
    )
    compared = F.filter(pairs, lambda p: p.mark.isin(NAME, NUMBER, UNIT))
    each = met.select(*key, (F.col("start") - F.col("at")).alias("shift"), F.explode(compared).alias("slot"))
    same = each.groupBy(*key, "shift", "slot.asked").agg(F.countDistinct("slot.given").alias("given"), F.count("*").alias("slots"))
    fits = same.groupBy(*key, "shift").agg(F.max("given").alias("given"), F.sum("slots").alias("slots"))
    # one place of the document that fits is enough
    return fits.groupBy(key).agg(F.min("given").alias("given"), F.sum("slots").alias("slots"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, columns as they were, that hold no item."""
    return without(docs, findings(docs, items).select(F.col("doc_id").alias("gone")))
