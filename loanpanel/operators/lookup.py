"""Joining a large table to a table with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup table has a handful of short columns: 200,000 rows stay far below
# 100 MB on each executor.
BROADCAST_ROWS = 200_000
# A key with more rows than this would make one task of a shuffle join slow.
ROWS_PER_KEY = 5_000_000


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a stored table has at most ``rows`` rows. Counting moves none
    of them."""
    return df.count() <= rows


def lookup(
    facts: DataFrame,
    table: DataFrame,
    keys: list[str],
    weight: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_key: int = ROWS_PER_KEY,
) -> DataFrame:
    """Left join ``facts`` to ``table``, which is stored and has one row per
    key.

    A table of checked size is broadcast. Beyond that the join shuffles, and
    ``weight`` (the number of facts per key) tells the keys too heavy for one
    task: those are few, at most facts / rows_per_key, so their rows are looked
    up in a broadcast instead and never shuffled.
    """
    plain = table.drop(weight) if weight else table
    if fits_broadcast(table, broadcast_rows):
        return facts.join(F.broadcast(plain), keys, "left")
    if weight is None:
        return facts.join(plain, keys, "left")
    heavy = table.filter(F.col(weight) > rows_per_key).drop(weight)
    light = table.filter(F.col(weight) <= rows_per_key).drop(weight)
    n_heavy = heavy.count()
    if not 0 < n_heavy <= broadcast_rows:
        # None, so that one reading of the facts does; or more than broadcast_rows
        # of them, with more than broadcast_rows * rows_per_key facts, where
        # adaptive execution splits the heavy partitions.
        return facts.join(plain, keys, "left")
    return facts.join(F.broadcast(heavy), keys).unionByName(
        facts.join(F.broadcast(heavy.select(keys)), keys, "left_anti").join(light, keys, "left")
    )
