"""SuperMinHash signatures and near-duplicate documents.

Each element of a set draws a random permutation of the places of a signature
and a random number for every step along it. At step j it offers j plus the
number to the j-th place of its permutation, and a place keeps the least offer.
Since the steps of an element visit different places, equal places of two
signatures are less spread around the similarity than with independent hashes.
No offer of step j can beat what is under j already, so a signature is complete
when all its places are: a set larger than the signature needs very few steps.
Here a step is taken by all sets of a batch at once, and finished sets leave.

Documents: words -> 5-word shingles -> signatures -> bands of ROWS places;
documents that share a band are candidates, of which `near_links` confirms
links on whole sets and forms groups. Documents of equal sets are one node, so
a text held by a third of all rows is one candidate.

At a similarity of 0.75, 64 bands of 6 places miss a pair with a probability
of 4e-6; a pair with 0.2 is a candidate with one of 4e-3.

Cases: words are runs of other characters than blanks, tabs and line ends;
texts of fewer than five words are one shingle; null texts and texts without
words have no shingles and are linked with nothing; rows that share an id are
rows of their own, each in the group of its text; rows without id are linked
with nothing, keep component null and stay; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanpanel.llm import buckets, near_links
from loanpanel.llm.pretokens import distinct, mix, steps, text_runs
from loanpanel.sources.scratch import cut, materialise

BANDS, ROWS = 64, 6
SHINGLE = 5
PERCENT = 75
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Elements whose later steps are taken together; bounds memory.
GROUP = 150_000


def _draw(elements: np.ndarray, step: int, places: int) -> tuple[np.ndarray, np.ndarray]:
    """Number (32 bits) of every element at a step, and where it swaps to."""
    x = mix(elements + np.uint64((step + 1) * int(_GOLDEN) & 0xFFFFFFFFFFFFFFFF))
    swap = ((x & np.uint64(0xFFFFFFFF)) * np.uint64(places - step)) >> np.uint64(32)
    return x >> np.uint64(32), swap.astype(np.int64) + step


def _place(swaps: list[np.ndarray], step: int) -> np.ndarray:
    """What stands at `step` of the permutations after the swaps up to it."""
    at = swaps[step].copy()
    for i in range(step - 1, -1, -1):
        at[at == swaps[i]] = i
    return at


def signatures(elements: np.ndarray, length: np.ndarray, places: int) -> np.ndarray:
    """One row of `places` 32-bit numbers for each set; the sets' elements
    (64-bit hashes) follow one another. Empty sets get zeros."""
    n = len(length)
    out = np.full((n, places), np.uint64(0xFFFFFFFFFFFFFFFF))
    bounds = np.concatenate([[0], np.cumsum(length)])
    for run in steps(length.tolist(), GROUP):
        part = out[run]
        owner = np.repeat(np.arange(run.stop - run.start), length[run])
        _fill(elements[bounds[run.start] : bounds[run.stop]], owner, part, places)
    out[length == 0] = 0
    return mix(out).astype(np.uint32)


def _fill(elements: np.ndarray, owner: np.ndarray, out: np.ndarray, places: int) -> None:
    swaps: list[np.ndarray] = []
    table = None
    for step in range(places):
        number, swap = _draw(elements, step, places)
        offer = (np.uint64(step) << np.uint64(32)) | number
        if table is None:
            swaps.append(swap)
            at = _place(swaps, step)
            if step == 12:  # few and small sets are left: keep the permutations
                table = np.tile(np.arange(places, dtype=np.int32), (len(elements), 1))
                for i, s in enumerate(swaps):
                    _swap(table, i, s)
        else:
            _swap(table, step, swap)
            at = table[:, step]
        np.minimum.at(out.reshape(-1), owner * places + at, offer)
        # offers of the next step cannot beat places that are filled
        open_sets = (out == np.uint64(0xFFFFFFFFFFFFFFFF)).any(1)
        going = open_sets[owner]
        if not going.any():
            return
        if not going.all():
            elements, owner = elements[going], owner[going]
            swaps = [s[going] for s in swaps]
            table = table[going] if table is not None else None


def _swap(table: np.ndarray, step: int, swap: np.ndarray) -> None:
    rows = np.arange(len(table))
    held = table[rows, swap].copy()
    table[rows, swap] = table[:, step]
    table[:, step] = held


def bands(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Keys of every band, the number of the band included."""
    parts = signature[:, : bands * rows].reshape(len(signature), bands, rows).astype(np.uint64)
    key = np.arange(bands, dtype=np.uint64)[None, :] * _GOLDEN
    key = np.broadcast_to(key, parts.shape[:2])
    for i in range(rows):
        key = mix(key * np.uint64(0xD1342543DE82EF95) + parts[:, :, i])
    return key.view(np.int64) if key.flags.c_contiguous else np.ascontiguousarray(key).view(np.int64)


# words of bytes -------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
_MULTIPLY = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of every text, one
    text after another, and their numbers."""
    sets = [s for run in steps([len(t or "") for t in texts], 1_000_000) for s in _sets(texts[run], size)]
    length = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), length


def _sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    raw = np.frombuffer(b"\n".join((t or "").encode("utf-8", "surrogatepass") for t in texts) + b"\n", np.uint8)
    ends_of_text = np.cumsum([len((t or "").encode("utf-8", "surrogatepass")) + 1 for t in texts]) - 1
    low = _LOWER[raw]
    blank = _BLANK[low]
    change = np.flatnonzero(np.diff(np.concatenate([[True], blank]).view(np.int8)))
    start, end = change[0::2], change[1::2]  # the last byte is blank
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(_VALUES[low] * _powers(_MULTIPLY, len(low)), out=sums[1:])
    word = mix((sums[end] - sums[start]) * _powers(_INVERSE, len(low))[start])
    first = np.searchsorted(start, np.concatenate([[0], ends_of_text]))
    if len(word) >= size:
        joined = np.zeros(len(word) - size + 1, np.uint64)
        for k in range(size):
            joined = mix(joined * _MULTIPLY + word[k : len(word) - size + 1 + k])
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            yield distinct(joined[a : b - size + 1])
        elif b > a:
            short = np.zeros(1, np.uint64)
            for k in range(a, b):
                short = mix(short * _MULTIPLY + word[k : k + 1])
            yield short
        else:
            yield np.zeros(0, np.uint64)


# documents -------------------------------------------------------------------

_SIGNED = [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.string()), ("set_id", pa.int64())]
_SIGNED += [("slot", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("marks", pa.binary())]
#: Sets that a task remembers, to send the bands of equal ones once.
REMEMBERED = 1_000_000


def _digest(items: bytes) -> str | None:
    return hashlib.blake2b(items, digest_size=16).hexdigest() if items else None


def _node(digest: str) -> int:
    """A signed 64-bit id of a set."""
    return int.from_bytes(bytes.fromhex(digest[:16]), "big", signed=True)
def _sign(bits: int):
    """Size and digest of the whole set of every document, and packed rows of
    the bands of those sets that are new to the task."""

    def parts(batches: Iterator[pa.RecordBatch]):
        seen: set[str] = set()
        for batch in batches:
            ids = batch.column(0)
            for run, texts in text_runs(batch.column(1), 1_000_000):
                every, length = shingle_sets(texts)
                cuts = np.concatenate([[0], np.cumsum(length)])
                digests = [_digest(every[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
                nodes = [_node(d) if d else None for d in digests]
                if len(seen) > REMEMBERED:
                    seen.clear()
                new = np.zeros(len(digests), bool)
                for i, (digest, known) in enumerate(zip(digests, ids[run.start : run.stop].is_valid().to_pylist())):
                    if known and digest is not None and digest not in seen:
                        seen.add(digest)
                        new[i] = True
                columns = [ids[run.start : run.stop], pa.array(length), pa.array(digests, pa.string()), pa.array(nodes, pa.int64())]
                yield _row_batch(columns, ["doc_id", "n_shingles", "set_key", "set_id"])
                signed = signatures(every[np.repeat(new, length)], length[new], BANDS * ROWS)
                yield np.array([nodes[i] for i in np.flatnonzero(new)], np.int64), bands(signed, BANDS, ROWS)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in buckets.blocks(parts(batches), bits):
            yield batch if "doc_id" in batch.schema.names else _row_batch(batch.columns, batch.schema.names)

    return run


def _row_batch(columns: list, names: list[str]) -> pa.RecordBatch:
    """The columns, and nulls for the other ones that _sign gives."""
    of = dict(zip(names, columns))
    return pa.RecordBatch.from_arrays([of.get(n, pa.nulls(len(columns[0]), k)) for n, k in _SIGNED], [n for n, _ in _SIGNED])


def _read_sets(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        ids = batch.column(0)
        for run, texts in text_runs(batch.column(1), 1_000_000):
            every, length = shingle_sets(texts)
            cuts = np.concatenate([[0], np.cumsum(length)])
            sets = [every[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            sketches = [row.tobytes() for row in near_links.sketch(signatures(every, length, near_links.SKETCH))]
            columns = [ids[run.start : run.stop], pa.array(map(_digest, sets), pa.string())]
            columns += [pa.array(sketches, pa.binary()), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "set_key", "sketch", "items"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bits = buckets.slot_bits(rows)
    schema = "doc_id long, n_shingles long, set_key string, set_id long, " + buckets.PACKED
    every = materialise(rows.mapInArrow(_sign(bits), schema), "signatures")
    signed = every.filter("slot IS NULL").select("doc_id", "n_shingles", "set_key", "set_id")
    # documents of equal sets: one node, the smallest id
    known = signed.filter("set_key IS NOT NULL AND doc_id IS NOT NULL")
    # the smallest id may stand for two sets, where rows share an id: ids of sets tell them apart
    nodes = known.groupBy("set_key", "set_id").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"))
    nodes = materialise(nodes, "nodes")
    members = near_links.members(every.filter("slot IS NOT NULL").select("slot", "block", "keys", "marks"))
    involved = members.select("node").distinct()
    chosen = near_links.only(nodes.withColumnRenamed("node", "doc_id").withColumnRenamed("set_id", "node"), involved, "node")
    chosen = cut(chosen.select("node", "doc_id", "set_key"))
    texts = near_links.only(rows, chosen.select("doc_id").distinct(), "doc_id")
    sets = texts.mapInArrow(_read_sets, "doc_id long, set_key string, sketch binary, items binary")
    sets = sets.join(chosen, ["doc_id", "set_key"]).dropDuplicates(["node"]).select("node", "sketch", "items")
    label = near_links.groups(members, materialise(sets, "sets"), PERCENT)
    # the smallest document of a group of sets
    named = nodes.select("set_key", "copies", "node", "set_id").join(label.withColumnRenamed("node", "set_id"), "set_id", "left")
    named = cut(named.withColumn("component", F.coalesce("component", "set_id")))
    smallest = named.groupBy("component").agg(F.min("node").alias("component_id"), F.count("*").alias("sets"))
    named = near_links.by_key(named, smallest, "component", "sets").select("set_key", "copies", "component_id")
    out = near_links.by_key(signed.select("doc_id", "n_shingles", "set_key"), named, "set_key", "copies")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents, columns as they were, of which one of each group stays:
    the one with the smallest id."""
    gone = near_duplicates(docs).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("kept").alias("kept"))
    return near_links.without(docs, gone.filter("NOT kept").select(F.col("doc_id").alias("gone")))
