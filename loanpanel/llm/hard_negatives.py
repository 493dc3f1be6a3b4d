"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors become integers, floor(256 x) a component; scores are inner products.
An anchor's positives are its best rows of the same label; for each positive,
its hard negatives are the best rows of other labels whose score lies in a
window given by the positive's score.

1. Blocks. Rows are sorted by label and by their place on a Hilbert curve
   through the space of all components (BITS each, cut at mean and deviation),
   and packed into blocks of BLOCK rows of one label: the row groups of Parquet
   files. A zone map holds the least and the greatest value of every component
   in a block.
2. Anchors lie in their own blocks, so the order also puts anchors near each
   other into one slab. While blocks are written, each anchor's best rows within its
   own block give a floor for the scores of its positives.
3. Search. Each pair of a slab of anchors and a run of files is a unit of work
   of bounded size, joined by their numbers. From a zone map, interval
   arithmetic bounds the score of an anchor with any row of the block from below
   and above. A block is read only for the anchors whose windows, as far as they
   are still open, meet these bounds; then its exact scores are computed.
   Every unit returns its best rows; windows over these give the result.

All rows and anchors take part; bounds only skip what cannot count. On vectors
without any structure the bounds of 1,000 rows are wide and most blocks are
read: work is anchors times rows, in units that spread evenly.

Files go to the shared folder through its file system. Every attempt of a task
writes files of its own name, and the manifest names those that count.

Cases: rows with a null id, label, vector or component, or one that is not
finite, take no part; components that a shorter vector lacks count as zero;
rows equal in id, label and vector count once; other rows of the anchor's id
are not its positives; different rows of one anchor id are anchors of their
own; an anchor without positives, or a positive without negatives, gives no
row; ties go by id; an empty table gives no rows; other columns are not read.
Scores beyond 64 bits are computed exactly and cut to the greatest long.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pyspark
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanpanel.sources.scratch import materialise, scratch_folder

#: Rows of a block, rows of a run of files, anchors of a slab.
BLOCK = 1024
RUN = 1 << 19
SLAB = 1 << 13
FILE_ROWS = 1 << 16
#: Bits of the Hilbert curve a component.
BITS = 2
#: Anchors whose scores with one block are computed at once.
STEP = 512
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


@dataclass(frozen=True)
class Mining:
    """Positives of an anchor, negatives of a positive, and the window: a
    negative's score s fits a positive's p if least * p <= whole * s <= most * p."""

    positives: int = 5
    negatives: int = 3
    least: int = 50
    most: int = 95
    whole: int = 100


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve through `cells` (rows by components, values
    of `bits` bits) as bytes that sort like the curve: cells become the
    transposed index by exchanging and inverting low bits, then a Gray code."""
    x = cells.astype(np.uint8).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = np.uint8(q - 1)
        for i in range(n):
            inverted = (x[i] & q) != 0
            swapped = np.where(inverted, 0, (x[0] ^ x[i]) & low).astype(np.uint8)
            x[0] = np.where(inverted, x[0] ^ low, x[0] ^ swapped)
            x[i] ^= swapped
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint8)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0).astype(np.uint8)
        q >>= 1
    x ^= flip
    planes = [(x >> b) & 1 for b in range(bits - 1, -1, -1)]  # the highest bit of all components first
    return [row.tobytes() for row in np.packbits(np.concatenate(planes).T, axis=1)]


def whole_numbers(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, v) of the rows that take part, v as floor(256 x)."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("v"),
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(~odd).withColumn("v", F.transform("v", lambda x: F.floor(x * 256)))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows of equal length; missing components are zero."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), dim), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _fits(a: np.ndarray, b: np.ndarray, limit: int) -> bool:
    most = [max((abs(int(f(x))) for f in (np.min, np.max)), default=0) if x.size else 0 for x in (a, b)]
    return most[0] * most[1] * a.shape[1] < limit


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices."""
    if _fits(a, b, 1 << 53):
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if _fits(a, b, 1 << 63):
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, _LEAST + 1, _MOST).astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of `a` with any vector
    between low and high of each block, by interval arithmetic."""
    up, down = np.maximum(a, 0).astype(np.float64), np.minimum(a, 0).astype(np.float64)
    low, high = low.astype(np.float64).T, high.astype(np.float64).T
    least, most = up @ low + down @ high, up @ high + down @ low
    slack = 1e-12 * a.shape[1] * (up - down) @ np.maximum(np.abs(low), np.abs(high))  # of the sums' rounding
    return least - slack, most + slack


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def _best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the best `top` entries of each group: higher scores, then smaller ids."""
    order = np.lexsort((ids, -score, group))
    group = group[order]
    begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    lengths = np.diff(np.append(begins, len(group)))
    return order[np.arange(len(group)) - np.repeat(begins, lengths) < top]


class _Writer:
    """Packs sorted rows into blocks, one row group each, and collects anchors."""

    def __init__(self, stem: str, dim: int, every: int, mining: Mining):
        self.dim, self.every, self.mining, self.stem = dim, every, mining, stem
        system, path = _open(stem)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.schema = pa.schema([("vec_id", pa.int64()), ("vector", pa.binary(8 * dim))])
        self.sink = system.open_output_stream(f"{path}.blocks.parquet")
        self.blocks = pq.ParquetWriter(self.sink, self.schema, compression="zstd")
        self.zones: list[tuple] = []
        self.anchors: list[tuple] = []  # id, label, floor, vector
        self.rows = 0

    def add(self, label: int, ids: np.ndarray, v: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, v = ids[order], v[order]
        packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * self.dim), len(v), [None, pa.py_buffer(np.ascontiguousarray(v))])
        self.blocks.write_table(pa.table([pa.array(ids), packed], schema=self.schema), row_group_size=len(ids))
        self.zones.append((label, len(ids), v.min(0).tolist(), v.max(0).tolist()))
        self.rows += len(ids)
        at = np.flatnonzero(ids % self.every == 0)
        for step in range(0, len(at), STEP):
            part = at[step : step + STEP]
            s = scores(v[part], v)
            s[ids[part][:, None] == ids[None, :]] = _LEAST
            k = self.mining.positives
            floor = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] >= k else np.full(len(part), _LEAST)
            self.anchors += zip(ids[part].tolist(), [label] * len(part), floor.tolist(), v[part])

    def close(self) -> None:
        self.blocks.close()
        self.sink.close()
        system, path = _open(self.stem)
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        zones = pa.table([pa.array(c, k) for c, k in zip(zip(*self.zones), kinds)], ["label", "n", "low", "high"])
        with system.open_output_stream(f"{path}.zones.parquet") as sink:
            pq.write_table(zones, sink)


def _shape(rows: DataFrame) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Rows, components, and mean and deviation of every component."""
    n, dim = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    dim = dim or 1
    each = rows.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("dev"))
    mean, dev = np.zeros(dim), np.zeros(dim)
    for r in each.collect():  # one row a component
        mean[r.at], dev[r.at] = r.mean, r.dev
    return n, dim, mean, dev


def write_blocks(rows: DataFrame, folder: str, every: int, mining: Mining, block: int = BLOCK) -> tuple[DataFrame, int, int]:
    """Write the blocks; returns the stored manifest, the number of rows and
    of components. A manifest row is a file (part, stem, rows) with a chunk of
    its anchors (chunk, n_anchors, ids, labels, floors, vectors)."""
    n, dim, mean, dev = _shape(rows)
    name = f"{folder}/{uuid.uuid4().hex}"
    cuts = [mean - dev, mean, mean + dev]

    def keys(batches):
        for batch in batches:
            v = _matrix(batch.column(2), dim)
            cells = sum((v >= c).astype(np.uint8) for c in cuts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_keys(cells, BITS), pa.binary())], [*batch.schema.names, "curve"])

    def run(batches):
        part, attempt = pyspark.TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        stem, writer, last = f"{name}/{part:06d}-{attempt}", None, None
        held_label, held_ids, held = None, np.zeros(0, np.int64), np.zeros((0, dim), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            writer = writer or _Writer(stem, dim, every, mining)
            ids, labels, v = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), dim)
            new = np.ones(len(ids), bool)  # rows that are not the same as the one before
            new[1:] = (ids[1:] != ids[:-1]) | (labels[1:] != labels[:-1]) | (v[1:] != v[:-1]).any(1)
            new[0] = last is None or (ids[0], labels[0]) != last[:2] or bool((v[0] != last[2]).any())
            last = (ids[-1], labels[-1], v[-1])
            ids, labels, v = ids[new], labels[new], v[new]
            for label in dict.fromkeys(labels.tolist()):
                own = labels == label
                if held_label != label and len(held_ids):
                    writer.add(held_label, held_ids, held)
                    held_ids, held = held_ids[:0], held[:0]
                held_label, held_ids, held = label, np.concatenate([held_ids, ids[own]]), np.concatenate([held, v[own]])
                while len(held_ids) >= block:
                    writer.add(label, held_ids[:block], held[:block])
                    held_ids, held = held_ids[block:], held[block:]
        if writer is None:
            return
        if len(held_ids):
            writer.add(held_label, held_ids, held)
        writer.close()
        chunks = range(0, max(len(writer.anchors), 1), SLAB // 8)
        for k, at in enumerate(chunks):
            some = writer.anchors[at : at + SLAB // 8]
            vectors = np.concatenate([a[3] for a in some]).tobytes() if some else b""
            lists = [pa.array([[a[i] for a in some]], pa.list_(pa.int64())) for i in range(3)]
            narrow = [pa.array([x]) for x in (part, stem, 0 if k else writer.rows, k, len(some))]
            yield pa.RecordBatch.from_arrays(
                [*narrow, *lists, pa.array([vectors], pa.binary())],
                ["part", "stem", "rows", "chunk", "n_anchors", "ids", "labels", "floors", "vectors"],
            )

    files = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // FILE_ROWS))
    keyed = rows.mapInArrow(keys, "vec_id long, label long, v array<long>, curve binary")
    order = ["label", "curve", "vec_id", "v"]
    dealt = keyed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("curve")
    kinds = "part long, stem string, rows long, chunk long, n_anchors long, ids array<long>, labels array<long>, floors array<long>, vectors binary"
    return materialise(dealt.mapInArrow(run, kinds), "blocks"), n, dim


def _units(manifest: DataFrame, dim: int, cores: int) -> tuple[DataFrame, DataFrame]:
    """Runs of files (run, stems) and slabs of anchors (slab, anchors): groups
    of neighbouring files, of bounded numbers of rows and anchors."""
    total = manifest.agg(F.countDistinct("part"), F.sum("rows"), F.sum("n_anchors"), F.max("chunk"), F.max("part")).first()
    parts, rows, anchors, chunks, last = (x or 0 for x in total)
    per_run = max(1, min(RUN, -(-rows // cores)) * parts // max(rows, 1))
    per_slab = max(1, SLAB * parts // max(anchors, 1))
    runs = manifest.filter("chunk = 0").groupBy(F.expr(f"part div {per_run}").alias("run")).agg(F.collect_list("stem").alias("stems"))
    slab = F.expr(f"part div {per_slab}") * (chunks + 1) + F.col("chunk")
    held = F.struct("part", "chunk", "ids", "labels", "floors", "vectors")
    slabs = manifest.filter("n_anchors > 0").groupBy(slab.alias("slab")).agg(F.collect_list(held).alias("anchors"))
    slabs = slabs.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(last // per_run))))
    return runs, slabs


def _dealt(units: DataFrame) -> DataFrame:
    """As many tasks as units, within reason."""
    return units.repartition(max(1, min(units.count(), 20_000)))


class _Slab:
    """The anchors of a unit."""

    def __init__(self, packed: list[dict], dim: int):
        packed = sorted(packed, key=lambda p: (p["part"], p["chunk"]))
        self.key = np.concatenate([(p["part"] << 32) + (p["chunk"] * (SLAB // 8)) + np.arange(len(p["ids"])) for p in packed])
        self.ids, self.labels, self.floors = (
            np.concatenate([np.array(p[c], np.int64) for p in packed]) for c in ("ids", "labels", "floors")
        )
        self.v = np.concatenate([np.frombuffer(p["vectors"], np.int64).reshape(-1, dim) for p in packed])


def _blocks(stems: list[str], slab: _Slab, dim: int):
    """For every block of the files: its label, bounds for every anchor, and a
    call that reads its ids and vectors. Blocks of high scores come first."""
    for stem in stems:
        system, path = _open(stem)
        with system.open_input_file(f"{path}.zones.parquet") as f:
            zones = pq.read_table(f)
        low, high = (_matrix(zones.column(c).combine_chunks(), dim) for c in ("low", "high"))
        least, most = bounds(slab.v, low, high)
        labels = zones.column("label").to_pylist()
        with system.open_input_file(f"{path}.blocks.parquet") as f:
            file = pq.ParquetFile(f)

            def read(i):
                table = file.read_row_group(i)
                vectors = table.column("vector").combine_chunks()
                v = np.frombuffer(vectors.buffers()[1], np.int64)[vectors.offset * dim : (vectors.offset + len(vectors)) * dim]
                return table.column("vec_id").to_numpy(), v.reshape(-1, dim)

            for i in np.argsort(-most.max(0), kind="stable").tolist():
                yield labels[i], least[:, i], most[:, i], lambda i=i: read(i)


def positives(units: DataFrame, dim: int, mining: Mining) -> DataFrame:
    """(anchor, anchor_id, slab, vec_id, score): the best rows of the anchor's
    label that each unit holds."""
    top = mining.positives

    def run(batches):
        for batch in batches:
            for unit in batch.to_pylist():
                slab = _Slab(unit["anchors"], dim)
                floor = slab.floors.copy()
                kept = [np.zeros(0, np.int64)] * 3  # anchor's place, score, id
                for label, _, most, read in _blocks(unit["stems"], slab, dim):
                    asking = np.flatnonzero((slab.labels == label) & (most >= floor))
                    if not len(asking):
                        continue
                    ids, v = read()
                    for at in range(0, len(asking), STEP):
                        some = asking[at : at + STEP]
                        s = scores(slab.v[some], v)
                        row, place = np.nonzero((s >= floor[some][:, None]) & (slab.ids[some][:, None] != ids[None, :]))
                        both = [np.concatenate(x) for x in zip(kept, (some[row], s[row, place], ids[place]))]
                        chosen = _best(*both, top)
                        kept = [x[chosen] for x in both]
                    full = np.bincount(kept[0], minlength=len(floor)) >= top
                    worst = np.full(len(floor), _MOST)
                    np.minimum.at(worst, kept[0], kept[1])
                    floor[full] = np.maximum(floor[full], worst[full])
                who, score, ids = kept
                columns = [slab.key[who], slab.ids[who], np.full(len(who), unit["slab"]), ids, score]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "anchor_id", "slab", "vec_id", "score"])

    return units.mapInArrow(run, "anchor long, anchor_id long, slab long, vec_id long, score long")


def negatives(units: DataFrame, dim: int, mining: Mining) -> DataFrame:
    """(anchor, place, vec_id, score): the best rows of other labels in the
    window of the anchor's positive of that place that each unit holds."""
    top, many = mining.negatives, mining.positives

    def run(batches):
        for batch in batches:
            for unit in batch.to_pylist():
                slab = _Slab(unit["anchors"], dim)
                low = np.full((len(slab.ids), many), _MOST)  # windows; those of no positive stay empty
                high = np.full((len(slab.ids), many), _LEAST)
                at = np.searchsorted(slab.key, [w["anchor"] for w in unit["windows"]])
                place = np.array([w["place"] for w in unit["windows"]], np.int64)
                given = [w["score"] for w in unit["windows"]]  # Python's integers do not overflow
                low[at, place] = [-(-mining.least * p // mining.whole) for p in given]
                high[at, place] = [mining.most * p // mining.whole for p in given]
                kept = [np.zeros(0, np.int64)] * 3  # anchor and window, score, id
                for label, least, most, read in _blocks(unit["stems"], slab, dim):
                    open_ = (low <= high) & (low <= most[:, None]) & (high >= least[:, None])
                    asking = np.flatnonzero((slab.labels != label) & open_.any(1))
                    if not len(asking):
                        continue
                    ids, v = read()
                    for step in range(0, len(asking), STEP):
                        some = asking[step : step + STEP]
                        s = scores(slab.v[some], v)
                        row, place = np.nonzero((s >= low[some].min(1)[:, None]) & (s <= high[some].max(1)[:, None]))
                        s, who = s[row, place], some[row]
                        for w in range(many):
                            fits = (s >= low[who, w]) & (s <= high[who, w])
                            new = (who[fits] * many + w, s[fits], ids[place[fits]])
                            both = [np.concatenate(x) for x in zip(kept, new)]
                            chosen = _best(*both, top)
                            kept = [x[chosen] for x in both]
                    full = np.bincount(kept[0], minlength=low.size) >= top
                    worst = np.full(low.size, _MOST)
                    np.minimum.at(worst, kept[0], kept[1])
                    low.reshape(-1)[full] = np.maximum(low.reshape(-1)[full], worst[full])
                group, score, ids = kept
                columns = [slab.key[group // many], (group % many).astype(np.int64), ids, score]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "place", "vec_id", "score"])

    return units.mapInArrow(run, "anchor long, place long, vec_id long, score long")


def _first(rows: DataFrame, keys: list[str], top: int, name: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("vec_id"))
    return rows.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= top)


def mine(rows: DataFrame, every: int = 50, mining: Mining = Mining(), block: int = BLOCK) -> DataFrame:
    """Hard negatives for the rows (vec_id, label, v) whose vec_id is divisible
    by `every`: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score."""
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    manifest, _, dim = write_blocks(rows, f"{scratch_folder(spark)}/blocks", every, mining, block)
    runs, slabs = _units(manifest, dim, cores)
    units = slabs.join(runs, "run")
    found = _first(positives(_dealt(units), dim, mining), ["anchor"], mining.positives, "place")
    found = materialise(found.withColumn("place", F.col("place").cast("long") - 1), "positives")
    window = F.struct("anchor", "place", "score")
    asked = found.groupBy("slab").agg(F.collect_list(window).alias("windows"))  # SLAB anchors or so
    best = _first(negatives(_dealt(units.join(asked, "slab")), dim, mining), ["anchor", "place"], mining.negatives, "rank")
    best = best.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
    out = best.join(found.withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score"}), ["anchor", "place"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def oracle() -> str:
    """The query's result over `embeddings` in DuckDB."""
    return """
WITH v AS (
    SELECT row_number() OVER () AS r, * FROM (
        SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
), s AS (
    SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r
), p AS (
    SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same AND vec_id <> anchor_id
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER w::INT AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON p.r = s.r AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.r, positive_id ORDER BY s.score DESC, s.vec_id) QUALIFY row_number() OVER w <= 3
"""
