"""Connected components by distributed union-find.

Links are rows (a, b) of long numbers. Each task first joins the links it holds
and hands on a star a component. Up to LINKS_PER_TASK of what is left fit one
task, which joins them all. Beyond that, every round lets each node point to the
smallest node it knows and hands that on to its neighbours ("large star"), then
to the smaller ones only ("small star"); rounds are few (logarithmic for
chains), and each is two grouped minima and two joins. Minima are combined
before the shuffle, so a node with very many links sends a row a task. Nothing
is gathered per node, and nothing but a count and a checksum reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanpanel.sources.scratch import drop, stored

#: Links that a task holds at a time.
LINKS_PER_TASK = 100_000


def _stars(a: list[int], b: list[int]) -> pa.RecordBatch:
    """(a, b): every node with a smaller one in its component, and the smallest."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    for x, y in zip(a, b):
        x, y = root(x), root(y)
        parent[max(x, y)] = min(x, y)
    nodes = [x for x, up in parent.items() if x != up]
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(map(root, nodes), pa.int64())], ["a", "b"])


def _contracted(batches: Iterator[pa.RecordBatch]):
    a: list[int] = []
    b: list[int] = []
    for batch in batches:
        for at in range(0, batch.num_rows, LINKS_PER_TASK):
            part = batch.slice(at, LINKS_PER_TASK)
            if len(a) + part.num_rows > LINKS_PER_TASK:
                yield _stars(a, b)
                a, b = [], []
            a += part.column(0).to_pylist()
            b += part.column(1).to_pylist()
    yield _stars(a, b)


def _star(links: DataFrame, small: bool) -> DataFrame:
    """Links (a > b). Large: every larger neighbour of u meets the smallest of
    u and its neighbours. Small: every smaller neighbour of u, and u, do."""
    if small:
        pairs = links
    else:
        pairs = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    joined = pairs.join(least, "a")
    if small:
        out = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            least.select("a", F.col("least").alias("b"))
        )
    else:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return out.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has
    a link; null ends and loops are left out."""
    ends = links.filter("a <> b").select("a", "b")
    current, last = stored(ends.mapInArrow(_contracted, "a long, b long")), None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] <= LINKS_PER_TASK:
            before, current = current, stored(current.coalesce(1).mapInArrow(_contracted, "a long, b long"))
            drop(before)
            break
        if tuple(state) == last:
            break
        last = tuple(state)
        # a table of few links needs few tasks; one of many keeps its partitions
        before, few = current, current.coalesce(1 + state[0] // LINKS_PER_TASK)
        current = stored(_star(_star(few, small=False), small=True))
        drop(before)
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
