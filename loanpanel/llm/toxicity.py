"""Toxicity scores by a counterfactual-regularised classifier.

A text is the set of its lower-cased words and of their first letters (PREFIXES),
hashed to PLACES places, so that inflected forms share evidence. The classifier
is logistic regression over the places whose frequencies in the two classes
differ beyond chance, each scaled by its log-ratio between the classes. Labelled texts that name a group are copied with the group's terms
swapped for others of the same kind, and differences between the scores of text
and copy are penalised, so that naming a group does not by itself raise a score.

It is fitted on the driver on at most TEXTS_PER_CLASS texts of each label, as
places (sets of small numbers, not texts); scoring reads every text whole.

Cases: null and empty texts get the score of a text without words; without
labels of both kinds every score is 0; rows are kept as they are, repeated ones
and null ids included; documents labelled twice count by their highest label;
other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanpanel.llm import pretokens

PLACE_BITS = 18
PLACES = 1 << PLACE_BITS
PREFIXES = (4, 5, 6)
TEXTS_PER_CLASS = 4_000
THRESHOLD = 0.7
#: Weights of the penalties on score differences and on large weights.
COUNTERFACTUAL, RIDGE = 1.0, 2e-3
STEPS = 120
#: Squared deviations from chance that a place needs to count.
SPREAD = 8.0

#: Terms that name groups, by kind; swaps stay within a row.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "woman", "man", "female", "male", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "heterosexual", "homosexual"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("american", "mexican", "chinese", "indian", "french", "german", "spanish", "turkish"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "katholiken"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "catholiques"),
    ("mujeres", "hombres", "chicas", "chicos"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "católicos"),
)
_SWAP = {term: (group, i) for group in IDENTITY_TERMS for i, term in enumerate(group)}


def swapped(text: str) -> str | None:
    """The text with every identity term replaced by the next of its kind;
    None if it names no group."""
    units = pretokens.split([text.lower()], leading_space=False)
    out, last, found = [], 0, False
    for a, b in zip(units.starts.tolist(), units.ends.tolist()):
        hit = _SWAP.get(units.text[a:b])
        if hit:
            group, i = hit
            out += [units.text[last:a], group[(i + 1) % len(group)]]
            last, found = b, True
    return "".join([*out, units.text[last:]]) if found else None


def features(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted places of every text."""
    seen, out = np.zeros(PLACES, bool), []
    lowered = [(t or "").lower() for t in texts]
    for run in pretokens.steps([len(t) for t in lowered]):
        units = pretokens.split(lowered[run], leading_space=False)
        word = pretokens.char_classes()[units.points[units.starts]] == pretokens.LETTER
        keys = [units.keys(n) >> np.uint64(64 - PLACE_BITS) for n in (None, *PREFIXES)]
        for a, b in zip(units.first[:-1], units.first[1:]):
            for key in keys:
                seen[key[a:b][word[a:b]]] = True
            found = np.flatnonzero(seen)
            seen[found] = False
            out.append(found.astype(np.uint32))
    return out


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(PLACES, np.float32))
    bias: float = -np.inf

    def scores(self, texts: list[str | None]) -> np.ndarray:
        logits = np.array([self.weights[f].sum(dtype=np.float64) + self.bias for f in features(texts)])
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-logits))


class _Rows:
    """Sets of places as one long array."""

    def __init__(self, rows: list[np.ndarray]):
        self.length = np.array([len(r) for r in rows], np.int64)
        self.places = np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(len(rows)), self.length)
        self.n = len(rows)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.places], minlength=self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.places, r[self.row], minlength=PLACES)


def fit(rows: list[np.ndarray], labels: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]] = ()) -> Model:
    """rows: places of every text; pairs: places of texts and their swapped copies."""
    labels = np.asarray(labels, np.float64)
    n1, n0 = labels.sum(), (1 - labels).sum()
    if not n1 or not n0:
        return Model()
    x = _Rows(list(rows))
    ones, zeros = x.back(labels), x.back(1 - labels)
    ratio = np.log((ones + 0.5) / (n1 + 1)) - np.log((zeros + 0.5) / (n0 + 1))
    ratio[ones + zeros < 3] = 0
    # places that the classes do not share evenly, by more than chance spreads them
    expected = (ones + zeros) * n1 / (n1 + n0)
    spread = (ones - expected) ** 2 / np.maximum(expected * n0 / (n1 + n0), 1e-9)
    ratio[(spread < SPREAD) | ((ratio < 0) & (ratio > -0.3))] = 0
    used = np.flatnonzero(ratio)
    kept = np.zeros(PLACES, bool)
    kept[used] = True
    x = _Rows([r[kept[r]] for r in rows])
    before, after = _Rows([a[kept[a]] for a, _ in pairs]), _Rows([b[kept[b]] for _, b in pairs])
    each = np.where(labels == 1, 0.5 / n1, 0.5 / n0)
    scaled, bias = np.zeros(PLACES), 0.0
    mean, square = np.zeros(PLACES + 1), np.zeros(PLACES + 1)
    for step in range(1, STEPS + 1):  # Adam over all rows
        w = scaled * ratio
        p = 1 / (1 + np.exp(-np.clip(x.times(w) + bias, -50, 50)))
        error = each * (p - labels)
        slope = x.back(error) * ratio + RIDGE * scaled
        if pairs:
            gap = (before.times(w) - after.times(w)) / len(pairs)
            slope += 2 * COUNTERFACTUAL * (before.back(gap) - after.back(gap)) * ratio
        slope = np.append(slope, error.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        move = 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        scaled, bias = scaled - move[:-1], bias - move[-1]
    return Model((scaled * ratio).astype(np.float32), float(bias))


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """At most TEXTS_PER_CLASS labelled texts of each label, by the order of a
    hash of the id: toxic, places, and the places of text and swapped copy."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    present = known.join(docs.select("doc_id").distinct(), "doc_id").withColumn("place", F.xxhash64("doc_id"))
    parts = [
        present.filter(F.col("toxic") == kind).orderBy("place", "doc_id").limit(TEXTS_PER_CLASS) for kind in (0, 1)
    ]
    chosen = parts[0].union(parts[1])
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(batches):
        for batch in batches:
            table = batch.to_pydict()
            places = features(table["text"])
            swaps = [swapped(t or "") for t in table["text"]]
            pairs = [None if s is None else features([s])[0].tobytes() for s in swaps]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(table["toxic"], pa.int32()),
                    pa.array(table["place"], pa.int64()),
                    pa.array([p.tobytes() for p in places], pa.binary()),
                    pa.array(pairs, pa.binary()),
                ],
                ["toxic", "place", "places", "copy"],
            )

    rows = texts.select("text", F.col("toxic").cast("int").alias("toxic"), "place")
    return rows.mapInArrow(run, "toxic int, place long, places binary, copy binary")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the bounded sample of the labelled documents given."""
    rows = sorted(sample(docs, labels).collect(), key=lambda r: (r.place, r.toxic, bytes(r.places)))[: 4 * TEXTS_PER_CLASS]
    places = [np.frombuffer(r.places, np.uint32) for r in rows]
    pairs = [(p, np.frombuffer(r.copy, np.uint32)) for p, r in zip(places, rows) if r.copy is not None]
    return fit(places, np.array([r.toxic for r in rows]), pairs)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row (doc_id, score, predicted) for each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = shared.value.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
