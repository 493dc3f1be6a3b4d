"""Sharding by proportional stratified interleaving.

Rows of a source are shuffled by a seeded digest and ranked. A row's fraction
is (rank + 1/2) / rows of its source. Sorted by fraction, rows of all sources
are interleaved in proportion, and so are those of any run of the order: cut
into runs of equal length, every shard has its share of every source to within
2 + k p rows, where k is the number of sources and p the source's part of all
rows. Shards differ by one row at most (law `rows`).

Only DataFrame functions. Both ranks come from `_places`: rows are dealt by
ranges of a sort key that no two rows share, sorted in their partitions, and
numbered by the partition's first number plus the place within it, so neither
a source nor a group of copies meets in one task. The text is read once, for
its size and checksum; what is sorted are some 60 bytes a row.

Cases: a null text has size 1 and the checksum of the empty text; rows without
a source are a source of their own, apart from the empty name; rows without
doc_id and repeated rows are placed like others (rows equal in id, size and
checksum may change places); an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanpanel.operators.lookup import lookup
from loanpanel.sources.scratch import materialise

SHARDS = 16
SEED = "interleave-1"
#: Rows that a task sorts, more or less.
TASK_ROWS = 500_000


def _places(rows: DataFrame, order: list[str], n: int, name: str) -> DataFrame:
    """The rows with their place (from 0) in the order of these columns, which
    no two rows share."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_ROWS))
    dealt = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()  # the partition above 33 bits of the place within it
    dealt = dealt.select(
        "*", F.shiftright(number, 33).alias("_part"), number.bitwiseAND(F.lit(2**33 - 1)).alias("_within")
    )
    dealt = materialise(dealt, "places")
    # one row a partition: their number is n / TASK_ROWS
    before = F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = dealt.groupBy("_part").count().select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    placed = dealt.join(F.broadcast(starts), "_part")
    return placed.withColumn(name, F.col("_start") + F.col("_within")).drop("_part", "_within", "_start")


def assign(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """One row a document: doc_id, size, text_crc32, law, shard, slot (from 0
    in its shard), grown_shard (null under this law), and stratum."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("stratum"),
    )
    given = [F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size"), F.col("text_crc32")]
    rows = rows.select("*", F.md5(F.concat_ws("|", *given)).alias("shuffled"), F.monotonically_increasing_id().alias("copy"))
    rows = materialise(rows, "shuffled")  # texts are read once, not for the sampled ranges as well
    n = rows.count()
    ranked = _places(rows, ["stratum", "shuffled", "doc_id", "size", "text_crc32", "copy"], n, "place")
    ranked = materialise(ranked.drop("shuffled", "copy"), "ranked")
    strata = ranked.groupBy("stratum").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    strata = materialise(strata.withColumn("weight", F.col("rows")), "strata")
    mixed = lookup(ranked, strata, ["stratum"], "weight")
    fraction = (2 * (F.col("place") - F.col("first")) + 1).cast("double") / (2 * F.col("rows")).cast("double")
    mixed = mixed.withColumn("fraction", fraction).drop("first", "rows")
    placed = _places(mixed, ["fraction", "stratum", "place"], n, "at")
    shard = F.expr(f"at * {shards} div {max(n, 1)}")
    start = F.expr(f"(shard * {max(n, 1)} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("at") - start).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "stratum",
    )


def oracle(shards: int = SHARDS, seed: str = SEED) -> str:
    """The same over `documents` in DuckDB; the checksum is folded byte by byte."""
    return f"""
WITH k AS (
    SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda s, i: xor(s >> 1, (s & 1) * 3988292384), b)) AS t
), b AS (
    SELECT doc_id, coalesce('=' || source, '') AS stratum, strlen(coalesce(text, '')) + 1 AS size,
           list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x:
               (strpos('0123456789ABCDEF', x[1]) - 1) * 16 + strpos('0123456789ABCDEF', x[2]) - 1) AS bytes FROM documents
), c AS (
    SELECT doc_id, stratum, size,
           xor(list_reduce(bytes, lambda s, x: xor(s >> 8, t[1 + (xor(s, x) & 255)]), 4294967295::BIGINT), 4294967295) AS text_crc32
    FROM b, k
), r AS (
    SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY
               md5(concat_ws('|', '{seed}', coalesce(doc_id::VARCHAR, ''), size, text_crc32)), doc_id NULLS FIRST, size, text_crc32) - 1 AS place,
           count(*) OVER (PARTITION BY stratum) AS n FROM c
), a AS (
    SELECT *, row_number() OVER (ORDER BY (2 * place + 1)::DOUBLE / (2 * n)::DOUBLE, stratum, place) - 1 AS pos, count(*) OVER () AS whole FROM r
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (pos * {shards} // whole)::INT AS shard,
       pos - (pos * {shards} // whole * whole + {shards - 1}) // {shards} AS slot, NULL::INT AS grown_shard, stratum
FROM a
"""
