"""Groups of near-duplicates from candidate buckets, without all pairs.

Members of a bucket are candidates for one another. Links found join nodes
into components, and two nodes of one component need no more comparing:

1. Each node is compared with the heaviest members (hubs) of its buckets that
   are in other components than itself: with one of them at first, then with
   up to 8, 64, and so on until none is left.
2. Where a bucket still holds several components, which shows in a member that
   is apart from the hub, the members ranked 2nd to 8th are compared with those
   behind them in other components, then the 9th to 64th, and so on, until no
   bucket holds two components or its ranks are done.

So every two members of a bucket end up in one component or were compared: no
link is lost, nothing is capped, and a group of thousands of copies of each
other costs about one comparison a member.

Comparing has two steps, or only the second: sketches (SKETCH places of 16 bits) leave out pairs
whose estimated similarity is more than SLACK below the limit (eight standard
deviations), whole sets decide the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanpanel.llm import buckets
from loanpanel.llm.union_find import components
from loanpanel.sources.scratch import drop, materialise, stored

SKETCH = 128
SLACK = 0.30
#: Each round reaches this many times as many ranks.
GROWTH = 8
#: Pairs whose sets are in a worker's memory at a time.
COMPARED = 256
#: Ids (16 bytes each) that may be sent to every executor.
BROADCAST_IDS = 1_000_000


def sketch(signature: np.ndarray) -> np.ndarray:
    return (signature[:, :SKETCH] & np.uint32(0xFFFF)).astype("<u2")


def members(packed: DataFrame) -> DataFrame:
    """Stored (key, node, weight, hub, hub_weight) of the buckets that hold two
    nodes or more, from packed band keys. A node weighs as much as its buckets
    have members, and the heaviest of a bucket is its hub: what most others
    were copied from is more often near them than one of the copies is."""
    met = materialise(buckets.met(packed), "buckets")
    named = rows = stored(buckets.named(met).groupBy("key", "node").agg(F.max("many").alias("many")))
    drop(met)
    weights = rows.groupBy("node").agg(F.sum("many").alias("weight"))
    bucket = Window.partitionBy("key")
    rows = rows.select("key", "node").join(weights, "node")
    first = F.max(F.struct("weight", F.bitwise_not("node").alias("low"))).over(bucket)
    rows = rows.select("key", "node", "weight", first.alias("first"), F.min("node").over(bucket).alias("least"), F.max("node").over(bucket).alias("most"))
    hub = F.bitwise_not(F.col("first.low")).alias("hub")
    out = materialise(rows.filter("least < most").select("key", "node", "weight", hub, F.col("first.weight").alias("hub_weight")), "members")
    drop(named)
    return out


def only(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows whose `column` is among the ids: by broadcast up to BROADCAST_IDS,
    by shuffle beyond."""
    few = ids.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, column, "left_semi")


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id is not among the ids (column gone), columns
    as they were; documents without id stay."""
    ids = stored(ids.select("gone").distinct())
    few = ids.count() <= BROADCAST_IDS
    gone = (F.broadcast(ids) if few else ids).withColumnRenamed("gone", "gone doc_id")
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("gone doc_id"), "left_anti")


def by_key(left: DataFrame, right: DataFrame, key: str, rows: str) -> DataFrame:
    """Left outer join with a table of one row a key, whose column `rows` says
    how many rows of the left side have it. Keys with over a thousandth of all
    rows are at most a thousand and are looked up in a broadcast; the rest are
    joined by shuffle."""
    total = right.agg(F.sum(rows)).first()[0] or 0
    heavy = F.col(rows) > max(1_000, total // 1_000)
    hot, rest = right.filter(heavy).drop(rows), right.filter(~heavy).drop(rows)
    spread = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key, "left")
    return spread.unionByName(left.join(F.broadcast(hot), key))


def _alike(percent: int):
    limit = percent / 100 - SLACK

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, SKETCH) for c in ("sketch_a", "sketch_b")
            )
            kept = pa.array((left == right).mean(1) >= limit)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], ["a", "b"])

    return run


def common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    both = np.sort(np.concatenate([x, y]))
    return int((both[1:] == both[:-1]).sum())


def _reach(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    n, m = sorted((len(x), len(y)))
    both = common(x, y) if 100 * n >= percent * m else 0
    return both > 0 and 100 * both >= percent * (n + m - both)


def reaching(left: list[bytes], right: list[bytes], percent: int) -> list[bool]:
    """Whether pairs of sets, stored as sorted 64-bit hashes, reach the limit."""
    return [_reach(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(left, right)]


def _linked(percent: int, reaching: Callable[[list[bytes], list[bytes], int], list[bool]]):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in (b.slice(at, COMPARED) for b in batches for at in range(0, b.num_rows, COMPARED)):
            left, right = batch.column("items_a").to_pylist(), batch.column("items_b").to_pylist()
            kept = pa.array(reaching(left, right, percent), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], ["a", "b"])

    return run


def links(pairs: DataFrame, sets: DataFrame, percent: int, reaching=reaching) -> DataFrame:
    """The pairs (a, b) of different nodes that reach the limit, stored."""

    def with_both(pairs: DataFrame, column: str) -> DataFrame:
        few, joined = pairs.count() <= BROADCAST_IDS, pairs
        for end in ("a", "b"):
            one = sets.select(F.col("node").alias(end), F.col(column).alias(f"{column}_{end}"))
            if few:  # only what stands in a pair is shuffled
                one = one.join(F.broadcast(pairs.select(end).distinct()), end, "left_semi")
            joined = joined.join(one, end)
        return joined.select("a", "b", f"{column}_a", f"{column}_b")

    every = pairs = stored(pairs)
    if "sketch" in sets.columns:
        pairs = stored(with_both(pairs, "sketch").mapInArrow(_alike(percent), "a long, b long"))
    out = stored(with_both(pairs, "items").mapInArrow(_linked(percent, reaching), "a long, b long"))
    drop(every, pairs)
    return out


def _labelled(rows: DataFrame, label: DataFrame, node: str, component: str) -> DataFrame:
    """Adds the component of a node; a node without links is its own."""
    known = label.select(F.col("node").alias("of"), F.col("component").alias("in"))
    joined = rows.join(known, F.col(node) == F.col("of"), "left")
    return joined.withColumn(component, F.coalesce("in", node)).drop("of", "in")


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes in different components."""
    return _labelled(_labelled(pairs, label, "a", "of_a"), label, "b", "of_b").filter("of_a <> of_b").drop("of_a", "of_b")


def _joined(label: DataFrame, more: DataFrame) -> DataFrame:
    """Components with new links: those known stand as links to their roots.
    Takes the place of both tables, which are dropped."""
    known = label.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    out = stored(components(known.union(more)))
    drop(label, more)
    return out


def groups(members: DataFrame, sets: DataFrame, percent: int, reaching=reaching) -> DataFrame:
    """(node, component) of all nodes with a link. sets: node and items of all
    members, one row a node, and sketch if pairs are to be estimated first;
    reaching tells of two lists of items which pairs reach the limit."""
    every = members.filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"), "hub_weight").distinct()
    every = hubs = stored(every)
    label = members.sparkSession.createDataFrame([], "node long, component long")
    width, before = 1, None
    while True:
        turn = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("hub_weight"), "b"))
        now = stored(_apart(hubs, label).select("a", "b", "hub_weight", turn.alias("turn")))
        drop(before)
        before = now
        if now.isEmpty():
            break
        label = _joined(label, links(now.filter(F.col("turn") <= width).select("a", "b"), sets, percent, reaching))
        hubs = now.filter(F.col("turn") > width).select("a", "b", "hub_weight")
        width *= GROWTH

    # buckets of several components have a member that is apart from the hub
    left = stored(_apart(every, label).select(F.col("a").alias("node"), F.col("b").alias("hub"), F.lit(1).alias("apart")))
    drop(every, before)
    few, before = left.count(), None
    if not few:
        return label
    bucket = Window.partitionBy("key")
    marked = members.join(F.broadcast(left) if few <= BROADCAST_IDS else left, ["node", "hub"], "left")
    marked = marked.withColumn("apart", F.max("apart").over(bucket)).filter("apart = 1")
    ranked = marked.select("key", "node", F.row_number().over(bucket.orderBy(F.desc("weight"), "node")).alias("rank"))
    low, high = 2, GROWTH
    while True:
        # buckets with two components and ranks to come
        span = [f("component").over(bucket) for f in (F.min, F.max)]
        open_ = _labelled(ranked.select("key", "node", "rank"), label, "node", "component")
        open_ = open_.select("*", span[0].alias("least"), span[1].alias("most"), F.max("rank").over(bucket).alias("last"))
        open_ = open_.filter((F.col("least") < F.col("most")) & (F.col("last") > low))
        ranked = stored(open_.select("key", "node", "rank", "component"))
        drop(before)
        before = ranked
        if ranked.isEmpty():
            return label
        front = ranked.filter(F.col("rank").between(low, high)).select(
            "key", F.col("node").alias("b"), F.col("rank").alias("rank_b"), F.col("component").alias("component_b")
        )
        behind = (F.col("rank") > F.col("rank_b")) & (F.col("component") != F.col("component_b"))
        pairs = ranked.join(front, "key").filter(behind).select(F.col("node").alias("a"), "b").distinct()
        label = _joined(label, links(pairs, sets, percent, reaching))
        low, high = high + 1, high * GROWTH
