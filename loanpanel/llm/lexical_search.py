"""Ranked lexical search by a scan with an Aho-Corasick automaton.

There is no index of documents. The terms of all items, each between two
boundary marks, make one automaton; documents, with their separators turned
into marks, run through it and yield how often each term stands in them. A
second table maps the automaton's terms to the items that hold them, and so
turns a document's counts into scores of items.

1. Scan: one row a document with its number of terms and the counts of item
   terms (`count_terms`), stored.
2. Statistics: documents, terms and documents a term, summed over all rows.
3. Score: every task keeps the best TOP documents of each item that it met;
   the best of these follow from one window an item, over at most TOP rows a task.

Automaton, weights and item lists are sent to every task. Items are therefore
dealt into slabs of at most SLAB_BYTES of text (a longer item has its own), and
each slab is scanned for by itself; there is no limit on their number.

A term's weight is floor(1000 * ln((2N + 2) / (2 df + 1))), a document's norm
m = 25 + (75 n N div L), its score for an item the sum over the item's terms,
repeats included, of weight * (10^9 tf div (1000 tf + 8 m)).

Cases: null and empty texts hold no term and are found by no item; items
without text or terms find nothing; items and documents that occur twice are
items and documents of their own; documents without id rank behind equal
scores with one; an empty table on either side gives no rows; other columns
are not read.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanpanel.sources.scratch import materialise

TOP = 10
#: Bytes of item texts that one automaton is made of.
SLAB_BYTES = 8 << 20
_NO_ID = np.iinfo(np.int64).max
_automata: dict = {}

# What a byte becomes: bytes of terms themselves (A-Z lower-cased, all of UTF-8
# beyond ASCII as it is), others the mark, which is a space.
_BYTES = np.full(256, 0x20, np.uint8)
for _low, _high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _BYTES[_low : _high + 1] = np.arange(_low, _high + 1)
_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)


def _terms(text: str | None) -> list[str]:
    marked = _BYTES[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)]
    return [t for t in marked.tobytes().decode("utf-8", "surrogatepass").split(" ") if t]


@dataclass
class Slab:
    """Items, their distinct terms, and for each term (in order) the items
    that hold it with the number of repeats."""

    name: str
    items: list[int]
    terms: list[str]
    first: np.ndarray  # where the postings of a term begin
    item: np.ndarray
    times: np.ndarray

    def automaton(self):
        """Built once a worker from the slab's terms."""
        if self.name not in _automata:
            _automata.clear()
            built = ahocorasick.Automaton()
            for i, t in enumerate(self.terms):
                built.add_word(f" {t} ", i)
            built.make_automaton()
            _automata[self.name] = built
        return _automata[self.name]


def slabs(items: DataFrame, slab_bytes: int = SLAB_BYTES):
    """Slabs of items, one after another: the driver holds one at a time."""
    rows = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "items")
    # numbers and sizes only go through one task, not texts
    so_far = F.sum("size").over(Window.orderBy("row").rowsBetween(Window.unboundedPreceding, -1))
    sizes = rows.select("row", (F.octet_length("text") + 16).cast("long").alias("size"))
    slab = F.floor(F.coalesce(so_far, F.lit(0)) / slab_bytes).alias("slab")
    dealt = materialise(rows.join(sizes.select("row", slab), "row"), "item-slabs")
    last = dealt.agg(F.max("slab")).first()[0]
    for k in range(-1 if last is None else last + 1):
        held = dealt.filter(F.col("slab") == k).orderBy("row").select("item_id", "text").collect()
        if held:
            yield _slab([r.item_id for r in held], [_terms(r.text) for r in held])


def _slab(ids: list[int], texts: list[list[str]]) -> Slab:
    postings: dict[str, dict[int, int]] = {}
    for i, terms in enumerate(texts):
        for t in terms:
            of = postings.setdefault(t, {})
            of[i] = of.get(i, 0) + 1
    first = np.cumsum([0, *(len(p) for p in postings.values())])
    item = np.array([i for p in postings.values() for i in p], np.int64)
    times = np.array([n for p in postings.values() for n in p.values()], np.int64)
    return Slab(uuid.uuid4().hex, ids, list(postings), first, item, times)


def count_terms(docs: DataFrame, slab: Slab) -> DataFrame:
    """One row (doc_id, n_terms, terms, counts) for each document with a term:
    the number of all its terms, and places in the slab's terms with counts."""
    shared = docs.sparkSession.sparkContext.broadcast(slab)

    def run(batches):
        automaton = shared.value.automaton() if shared.value.terms else None
        for batch in batches:
            ids, many, met, times, ends = [], [], [], [], [0]
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                if not text.is_valid:
                    continue
                marked = _BYTES[np.frombuffer(text.as_buffer(), np.uint8)]
                inside = marked != 0x20
                n = int(np.count_nonzero(inside[1:] & ~inside[:-1])) + int(inside[:1].sum())
                if not n:
                    continue
                found = np.zeros(0, np.int64)
                if automaton is not None:
                    plain = f" {marked.tobytes().decode('utf-8', 'surrogatepass')} "
                    found = np.fromiter((k for _, k in automaton.iter(plain)), np.int64)
                term, count = np.unique(found, return_counts=True)
                ids.append(doc_id.as_py())
                many.append(n)
                met.append(term)
                times.append(count)
                ends.append(ends[-1] + len(term))
            if ids:
                ends = pa.array(ends, pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x).astype(np.int32))) for x in (met, times)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(many, pa.int64()), *lists], ["doc_id", "n_terms", "terms", "counts"]
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(run, "doc_id long, n_terms long, terms array<int>, counts array<int>")


def weights(counted: DataFrame, slab: Slab, n_docs: int) -> np.ndarray:
    """Weight of every term of the slab, from the documents that hold it."""
    size = len(slab.terms)

    def run(batches):
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        term = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(held[term])], ["term", "df"])

    table = counted.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)  # one row a term of the slab at most
    for term, df in zip(table.column("term").to_pylist(), table.column("df").to_pylist()):
        out[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    return out


def _best(item, score, doc, top: int):
    """Places of the best `top` entries of every item."""
    order = np.lexsort((doc, -score, item))
    item = item[order]
    begins = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.zeros(0, np.int64)
    lengths = np.diff(np.append(begins, len(item)))
    return order[np.arange(len(item)) - np.repeat(begins, lengths) < top]


def _scored(counted: DataFrame, slab: Slab, weight: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item, doc_id, score): the best documents that each task met."""
    shared = counted.sparkSession.sparkContext.broadcast((slab, weight))

    def run(batches):
        slab, weight = shared.value
        of_term = np.diff(slab.first)
        kept = [np.zeros(0, np.int64)] * 3  # item, score, document
        for batch in batches:
            ids = batch.column(0).fill_null(_NO_ID).to_numpy()
            m = np.array([25 + 75 * n * n_docs // n_terms for n in batch.column(1).to_pylist()], np.int64)
            lists = batch.column(2)
            term = lists.flatten().to_numpy().astype(np.int64)
            tf = batch.column(3).flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
            part = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
            # a run of documents at a time, so that what their terms map to stays small
            at = 0
            places = np.cumsum(of_term[term])
            while at < len(term):
                until = int(np.searchsorted(places, (places[at - 1] if at else 0) + 1_000_000, "right"))
                until = max(until, at + 1)
                until = int(np.searchsorted(row, row[until - 1], "right"))  # whole documents
                t, r = term[at:until], row[at:until]
                times = of_term[t]
                total = int(times.sum())
                inner = np.arange(total) - np.repeat(np.cumsum(times) - times, times)
                posting = np.repeat(slab.first[t], times) + inner
                key = np.repeat(r, times) * len(slab.items) + slab.item[posting]
                value = np.repeat(part[at:until], times) * slab.times[posting]
                order = np.argsort(key, kind="stable")
                key, value = key[order], value[order]
                begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if total else np.zeros(0, np.int64)
                score = np.add.reduceat(value, begins) if total else value
                key = key[begins][score > 0]
                new = [key % len(slab.items), score[score > 0], ids[key // len(slab.items)]]
                both = [np.concatenate(x) for x in zip(kept, new)]
                chosen = _best(*both, top)
                kept = [x[chosen] for x in both]
                at = until
        item, score, doc = kept
        doc = pa.array(doc, mask=doc == _NO_ID)
        yield pa.RecordBatch.from_arrays([pa.array(item), doc, pa.array(score)], ["item", "doc_id", "score"])

    return counted.mapInArrow(run, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """The best documents of every item: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for slab in slabs(items, slab_bytes):
        counted = materialise(count_terms(docs, slab), "term-counts")
        n_docs, n_terms = counted.agg(F.count("*"), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        if not n_docs:
            break
        scored = _scored(counted, slab, weights(counted, slab, n_docs), n_docs, n_terms, top)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        names = spark.createDataFrame([*enumerate(slab.items)], "item long, item_id long")  # one slab
        best = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = out.union(materialise(best, "found"))
    return out


def oracle(top: int = TOP) -> str:
    """The same over `documents` and `benchmark` in DuckDB."""

    def terms(text: str) -> str:
        lower = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return f"unnest(regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"

    return f"""
WITH d AS (
    SELECT d, doc_id, {terms("text")} AS term FROM (SELECT row_number() OVER () AS d, doc_id, text FROM documents)
), i AS (
    SELECT i, item_id, {terms("text")} AS term FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)
), tf AS (
    SELECT d, doc_id, term, count(*) AS tf, sum(count(*)) OVER (PARTITION BY d) AS n FROM d GROUP BY 1, 2, 3
), s AS (
    SELECT count(DISTINCT d) AS N_, sum(tf)::BIGINT AS L FROM tf
), w AS (
    SELECT term, floor(1000 * ln((2 * N_ + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, s GROUP BY term, N_
), q AS (
    SELECT i, item_id, term, count(*) AS times FROM i GROUP BY 1, 2, 3
), x AS (
    SELECT i, item_id, d, doc_id,
           sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n::BIGINT * N_) // L))))::BIGINT AS score
    FROM q JOIN tf USING (term) JOIN w USING (term), s GROUP BY 1, 2, 3, 4
)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM x WHERE score > 0)
WHERE rank <= {top}
"""
