"""Exact deduplication by Grace hash partitioning.

Records are partitioned by a hash of the normalised text until every bucket
fits an open-addressing table in the memory of one task; the table compares
whole contents, so a clash of hashes never joins two texts.

1. Each input task collapses the copies it sees in such a table, so that a
   text held by a third of all rows leaves a task as few records, each with
   the ids of its copies.
2. Records are dealt to buckets by hash. A task fills a table of at most
   TABLE_BYTES of text; once it is full, records of texts that are not in it
   go to spill files in the shared folder, and the next level deals those by
   the next part of the hash, into more buckets, until nothing is left over.
   A text is in a table or not, so all its copies go the same way.
3. Texts found in several records get their smallest id and size by a grouped
   sum; a text found once is complete already. Records of texts with very many
   records meet that sum through a salted join.

Cases: a null text counts as empty, and empty texts are copies of each other;
of equal ids in a group each row is returned; rows without id are grouped as
well, and stay only if no row of the group has an id; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanpanel.sources.scratch import cut, materialise

#: Text that a table holds before records go to spill files.
TABLE_BYTES = 96_000_000
#: Ids in one record; a text with more has several records.
RECORD_IDS = 20_000
#: A text with more records than this is joined by salted keys.
HEAVY_RECORDS = 64
SALTS = 16

_RECORD = "hash long, text string, sha string, ids array<long>"


class OpenTable:
    """Texts by linear probing over a power of two of slots. Compares whole
    contents; takes no new text once `limit` bytes are held."""

    def __init__(self, limit: int):
        self.limit, self.bytes = limit, 0
        self.texts: list[str] = []
        self.hashes: list[int] = []
        self.slots = np.full(1024, -1, np.int64)

    def place(self, key: int, text: str) -> int:
        """Number of the text, or -1 if it is not here and the table is full."""
        mask = len(self.slots) - 1
        at = key & mask
        while (i := self.slots[at]) >= 0:
            if self.hashes[i] == key and self.texts[i] == text:
                return int(i)
            at = (at + 1) & mask
        if self.bytes >= self.limit:
            return -1
        self.slots[at] = len(self.texts)
        self.texts.append(text)
        self.hashes.append(key)
        self.bytes += len(text) + 64
        if 2 * len(self.texts) > len(self.slots):
            self._grow()
        return len(self.texts) - 1

    def _grow(self) -> None:
        self.slots = np.full(4 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for i, key in enumerate(self.hashes):
            at = key & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = i


def normalised(text) -> F.Column:
    """Runs of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _collapse(batches: Iterator[pa.RecordBatch], limit: int = TABLE_BYTES // 3):
    """Records of the copies within one task. When the table is full, its
    texts go out and it starts anew."""

    def records(table, ids):
        step = 2_000
        for at in range(0, len(table.texts), step):
            rows = [
                (table.hashes[i], table.texts[i], shas[i], part)
                for i in range(at, min(at + step, len(table.texts)))
                for part in (ids[i][k : k + RECORD_IDS] for k in range(0, len(ids[i]), RECORD_IDS))
            ]
            kinds = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["hash", "text", "sha", "ids"]
            )

    table, ids, shas = OpenTable(limit), [], []
    for batch in batches:
        for key, text, sha, doc_id in zip(*(batch.column(i).to_pylist() for i in range(4))):
            i = table.place(key, text)
            if i < 0:
                yield from records(table, ids)
                table, ids, shas = OpenTable(limit), [], []
                i = table.place(key, text)
            if i == len(ids):
                ids.append([])
                shas.append(sha)
            ids[i].append(doc_id)
    yield from records(table, ids)


_LEVEL = "class_id string, hash long, text string, sha string, ids array<long>"


def _fill(level: int, limit: int):
    """Class of every record of a task's buckets; those that do not fit keep
    their text and get no class."""

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        task, table = TaskContext.get().partitionId(), OpenTable(limit)
        for batch in batches:
            hashes, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            numbers = [table.place(k, t) for k, t in zip(hashes, texts)]
            classes = [None if i < 0 else f"{level}.{task}.{i}" for i in numbers]
            left = [t if i < 0 else None for t, i in zip(texts, numbers)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(classes, pa.string()), batch.column(0), pa.array(left, pa.string()), *batch.columns[2:]],
                ["class_id", "hash", "text", "sha", "ids"],
            )

    return run


def classes(docs: DataFrame, table_bytes: int = TABLE_BYTES, buckets: int | None = None) -> DataFrame:
    """Records (class_id, sha, ids): equal class_id means equal texts."""
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("text"))
    rows = rows.select(F.xxhash64("text").alias("hash"), "text", F.sha2("text", 256).alias("sha"), "doc_id")
    left = rows.mapInArrow(_collapse, _RECORD)
    done, level = [], 0
    while True:
        # the next digits of the hash at every level, and more buckets
        dealt = left.repartition(buckets << min(level, 6), F.shiftright("hash", 7 * level))
        filled = materialise(dealt.mapInArrow(_fill(level, table_bytes), _LEVEL), f"spill-{level}")
        done.append(filled.filter("class_id IS NOT NULL").select("class_id", "sha", "ids"))
        left = filled.filter("class_id IS NULL").select("hash", "text", "sha", "ids")
        level += 1
        if left.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def dedup(docs: DataFrame, **options) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256."""
    records = classes(docs, **options)
    sums = records.groupBy("class_id").agg(
        F.min(F.array_min("ids")).alias("keep_id"),
        F.sum(F.size("ids")).alias("group_size"),
        F.count("*").alias("records"),
    )
    sums = cut(sums)
    heavy = F.col("records") > HEAVY_RECORDS
    salts = F.when(heavy, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = sums.select("class_id", "keep_id", "group_size", F.explode(salts).alias("salt"))
    # a record cannot know whether its text is heavy; heavy texts are at most one in HEAVY_RECORDS records
    many = sums.filter(heavy).select("class_id", F.lit(True).alias("heavy"))
    left = records.join(many, "class_id", "left")
    salt = F.when(F.col("heavy"), F.pmod(F.xxhash64("ids"), F.lit(SALTS))).otherwise(0).cast("int")
    joined = left.withColumn("salt", salt).join(right, ["class_id", "salt"])
    return joined.select(F.explode("ids").alias("doc_id"), "keep_id", "group_size", F.col("sha").alias("text_sha256")).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
