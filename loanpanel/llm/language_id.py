"""Language identification with string kernels.

A text is the set of its byte n-grams of lengths NGRAMS (lower-cased letters,
anything else one blank): the blended spectrum. The presence kernel of two
texts is the number of n-grams both have over the root of the product of their
numbers. n-grams are hashed to DIMENSIONS places.

The kernel is approximated by Nyström landmarks, labelled texts of every
language: features of a text are its kernel with the landmarks, whitened by
the inverse root of the kernel among the landmarks. Kernel ridge regression,
one versus rest, is then ridge regression on these features.

Scoring is a product of a batch's presence matrix with the landmarks and of
that with the weights. Since both are matrices, their product is formed once
(places x languages) and a batch needs one product.

Cases: null text and text without letters give `und` with score 0; without
any labelled text everything is `und`; rows are kept as they are, repeated
ones and null ids included; other columns are not read. Texts of every length
are read whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NGRAMS = (2, 3, 4)
DIMENSIONS = 1 << 17
#: Labelled texts a language: the bound of the sample that is fitted on.
TEXTS_PER_LANGUAGE = 400
#: Of these, landmarks: a language's, and of all languages together.
LANDMARKS_PER_LANGUAGE, LANDMARKS = 100, 800
#: Languages that are learned, the most frequent first.
LANGUAGES = 200
RIDGE = 1e-3
UNKNOWN = "und"
#: Score under which `recognised` rejects a text.
LEAST = 0.3

_TABLE = np.full(256, 32, np.uint8)
for _b in (*range(97, 123), *range(128, 256)):
    _TABLE[_b] = _b


def letters(text: str | None) -> np.ndarray:
    """Bytes of the lower-cased text, other characters as single blanks."""
    if not text or not any(map(str.isalpha, text)):
        return np.zeros(0, np.uint8)
    raw = _TABLE[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
    kept = np.ones(len(raw), bool)
    kept[1:] = (raw[1:] != 32) | (raw[:-1] != 32)
    return raw[kept]


def places(text: str | None, seen: np.ndarray) -> np.ndarray:
    """Sorted places of the text's n-grams. seen: all False, and left so."""
    raw = letters(text).astype(np.uint32)
    for n in NGRAMS:
        if len(raw) >= n:
            code = raw[: len(raw) - n + 1].copy()
            for k in range(1, n):
                code = (code << np.uint32(8)) | raw[k : len(raw) - n + 1 + k]
            seen[((code + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(32 - 17)] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # places x languages
    bias: np.ndarray

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Ridge outputs of a batch: presence matrix times weights."""
        seen = np.zeros(DIMENSIONS, bool)
        out = np.zeros((len(texts), len(self.languages)))
        for i, text in enumerate(texts):
            found = places(text, seen)
            if len(found):
                out[i] = self.weights[found].sum(0) / math.sqrt(len(found)) + self.bias
            else:
                out[i] = np.nan
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score (a softmax of the outputs) of every text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        outputs = self.scores(texts)
        known = ~np.isnan(outputs[:, 0])
        outputs[~known] = 0
        best = outputs.argmax(1)
        powers = np.exp(4 * (outputs - outputs.max(1, keepdims=True)))
        share = powers[np.arange(len(texts)), best] / powers.sum(1)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        return names, np.where(known, share, 0.0)


def fit(texts: list[str], labels: list[str]) -> Model:
    """Fit on a bounded sample, on the driver."""
    seen = np.zeros(DIMENSIONS, bool)
    rows = [(places(t, seen), label) for t, label in zip(texts, labels)]
    rows = [r for r in rows if len(r[0])]
    languages = sorted({label for _, label in rows})
    if not languages:
        return Model([], np.zeros((DIMENSIONS, 0), np.float32), np.zeros(0))
    taken: dict[str, int] = {}
    landmarks, chosen = [], []
    most = max(1, min(LANDMARKS_PER_LANGUAGE, LANDMARKS // len(languages)))
    for i, (found, label) in enumerate(rows):
        if taken.setdefault(label, 0) < most:
            taken[label] += 1
            landmarks.append(found)
            chosen.append(i)
    kernel = np.zeros((len(rows), len(landmarks)))
    for at in range(0, len(landmarks), 50):  # a few landmarks at a time bound the memory
        basis = np.zeros((DIMENSIONS, len(landmarks[at : at + 50])), np.float32)
        for j, found in enumerate(landmarks[at : at + 50]):
            basis[found, j] = 1 / math.sqrt(len(found))
        for i, (found, _) in enumerate(rows):
            kernel[i, at : at + 50] = basis[found].sum(0) / math.sqrt(len(found))
    among = kernel[chosen]
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    features = kernel @ whiten
    target = np.array([[1.0 if label == x else -1.0 for x in languages] for _, label in rows])
    # every language weighs the same
    share = np.array([1 / sum(y == label for _, y in rows) for _, label in rows])[:, None]
    share /= share.sum()
    middle, bias = (share * features).sum(0), (share * target).sum(0)
    centred = features - middle
    gram = centred.T @ (share * centred) + RIDGE * np.eye(features.shape[1])
    solved = np.linalg.solve(gram, centred.T @ (share * (target - bias)))
    weights = np.zeros((DIMENSIONS, len(languages)), np.float32)
    for found, share_of in zip(landmarks, whiten @ solved):
        weights[found] += share_of / math.sqrt(len(found))
    return Model(languages, weights, bias - middle @ solved)


def sample(docs: DataFrame) -> DataFrame:
    """At most TEXTS_PER_LANGUAGE labelled texts of each of the LANGUAGES most
    frequent languages, by the order of a hash of the id."""
    named = docs.filter("lang IS NOT NULL AND text IS NOT NULL")
    common = named.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    keys = named.select("doc_id", "lang", F.xxhash64("doc_id", "lang").alias("place"))
    keys = keys.join(F.broadcast(common.select("lang")), "lang")
    first = Window.partitionBy("lang").orderBy("place", "doc_id")
    chosen = keys.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= TEXTS_PER_LANGUAGE)
    # at most LANGUAGES x TEXTS_PER_LANGUAGE ids
    chosen = F.broadcast(chosen.groupBy("doc_id", "lang").agg(F.min("rank").alias("rank")))
    return named.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"]).select("lang", "rank", "text")


def train(docs: DataFrame) -> Model:
    rows = sample(docs).collect()
    rows.sort(key=lambda r: (r.rank, r.lang, r.text))
    rows = rows[: 2 * LANGUAGES * TEXTS_PER_LANGUAGE]  # ids that repeat may bring more rows
    return fit([r.text for r in rows], [r.lang for r in rows])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row (doc_id, lang_pred, score) for each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            names, scores = shared.value.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def recognised(docs: DataFrame, model: Model, least: float = LEAST) -> DataFrame:
    """The documents, columns as they were, that are in a learned language
    with a score of at least `least`; the others are rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            names, scores = shared.value.predict(batch.column(at).to_pylist())
            known = np.array([n != UNKNOWN for n in names], bool)
            yield batch.filter(pa.array(known & (scores >= least)))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id, parts: int, part: int) -> F.Column:
    """Whether a document is never learned from: crc32 of its id as text."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))
