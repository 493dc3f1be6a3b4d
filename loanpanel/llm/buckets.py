"""Buckets of band keys, met in packed form.

Most band keys occur once, so a row for each of them would be shuffled only to
be dropped. A task numbers its nodes by blocks and sends, for each slot of the
key space, one row a block: the sorted keys as differences (byte by byte,
compressed), and the number in the block and one byte of a hash of node and key
for each. About six bytes a key travel, instead of a key and a node. A slot's
rows meet in one group, which hands on the keys that different nodes have; the
numbers of these become nodes again by a join. Slots follow the shuffle
partitions of the session, so a group grows no faster than a partition.

Two nodes with one key are told apart by the byte in 255 of 256 cases, anew for
every key: a band is lost to a pair with that chance, where it shares others.
Keys are told apart by 32 bits and those of the slot; chance meetings are
candidates like others.

Numbers hold the partition that a task reads: the input must be files or
another table that reads the same twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark
import zstandard
from pyspark.sql import DataFrame

from loanpanel.llm.pretokens import mix

PACKED = "slot int, block long, keys binary, marks binary"
_MEMBERS = "key long, spot long, many long, node long"
#: Nodes of a block, at most 1 << 16, and keys of one.
NODES, KEYS = 1 << 15, 1_500_000


def slot_bits(df: DataFrame) -> int:
    """Bits of a key that tell its slot: about four slots a shuffle partition."""
    return max(1, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()


def _planes(values: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(raw.tobytes(), 1)


def _values(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(raw.T).view("<u4").ravel()


def _block(number: int, parts: list[tuple[np.ndarray, np.ndarray]], bits: int) -> pa.RecordBatch:
    """The rows of a block of parts (nodes, a row of keys for each)."""
    nodes = np.concatenate([n for n, _ in parts])
    keys = np.concatenate([k.reshape(-1) for _, k in parts])
    owner = np.repeat(np.arange(len(nodes)), np.concatenate([np.full(len(n), k.shape[1]) for n, k in parts]))
    order = np.argsort(keys)
    keys, owner = keys[order], owner[order]
    mark = (mix(mix(nodes[owner]) ^ keys) >> np.uint64(56)).astype(np.uint8)
    slot = (keys >> np.uint64(64 - bits)).astype(np.int64)
    low = ((keys >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    owner = owner.astype("<u2")
    starts = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(keys) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(keys))
    packed, marks = [nodes.tobytes()], [None]
    for a, b in zip(starts.tolist(), ends.tolist()):
        packed.append(_planes(np.diff(low[a:b], prepend=np.uint32(0))))
        marks.append(owner[a:b].tobytes() + mark[a:b].tobytes())
    slots = np.concatenate([[-1 - number % (1 << bits)], slot[starts]])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(slots, pa.int32()),
            pa.array(np.full(len(slots), number), pa.int64()),
            pa.array(packed, pa.binary()),
            pa.array(marks, pa.binary()),
        ],
        ["slot", "block", "keys", "marks"],
    )


def blocks(parts: Iterator[tuple[np.ndarray, np.ndarray] | pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Packed rows of the parts of a task: nodes (long), and the keys (unsigned)
    of their bands, a row a node. No part has more than NODES nodes. Other
    batches among them are handed on."""
    number = pyspark.TaskContext.get().partitionId() << 20
    held: list[tuple[np.ndarray, np.ndarray]] = []
    nodes = keys = 0
    for part in parts:
        if isinstance(part, pa.RecordBatch):
            yield part
            continue
        if not len(part[0]):
            continue
        if held and (nodes + len(part[0]) > NODES or keys + part[1].size > KEYS):
            yield _block(number, held, bits)
            number, held, nodes, keys = number + 1, [], 0, 0
        held.append((part[0].view(np.uint64), part[1].view(np.uint64)))
        nodes, keys = nodes + len(part[0]), keys + part[1].size
    if held:
        yield _block(number, held, bits)


def _meet(table: pa.Table) -> pa.Table:
    """Rows (key, spot, many) of the keys of a slot that different nodes have;
    of a slot of blocks, rows (spot, node)."""
    slot = table.column("slot")[0].as_py()
    block, packed, marks = (table.column(c).to_pylist() for c in ("block", "keys", "marks"))
    if slot < 0:
        nodes = [np.frombuffer(x, np.int64) for x in packed]
        spots = [np.arange(len(x)) + (number << 16) for number, x in zip(block, nodes)]
        node, spot = pa.array(np.concatenate(nodes)), pa.array(np.concatenate(spots))
        nothing = pa.nulls(len(node), pa.int64())
        return pa.Table.from_arrays([nothing, spot, nothing, node], ["key", "spot", "many", "node"])
    low = [np.cumsum(_values(x), dtype=np.uint32) for x in packed]
    spots = [np.frombuffer(x, "<u2", len(k)).astype(np.int64) + (number << 16) for number, x, k in zip(block, marks, low)]
    mark = np.concatenate([np.frombuffer(x, np.uint8, len(k), 2 * len(k)) for x, k in zip(marks, low)])
    low, spot = np.concatenate(low), np.concatenate(spots)
    order = np.argsort(low)
    low, spot, mark = low[order], spot[order], mark[order]
    same = low[1:] == low[:-1]
    group = np.concatenate([[0], np.cumsum(~same)])
    shared = np.zeros(group[-1] + 1, bool)
    shared[group[1:][same & (mark[1:] != mark[:-1])]] = True
    many, at = np.bincount(group)[group], np.flatnonzero(shared[group])
    key = low[at].astype(np.int64) | np.int64(slot << 32)
    columns = [pa.array(key), pa.array(spot[at]), pa.array(many[at]), pa.nulls(len(at), pa.int64())]
    return pa.Table.from_arrays(columns, ["key", "spot", "many", "node"])


def met(packed: DataFrame) -> DataFrame:
    """Rows (key, spot, many) of keys of different nodes, `many` spots in all,
    and rows (spot, node) that name the spots."""
    return packed.groupBy("slot").applyInArrow(_meet, _MEMBERS)


def named(rows: DataFrame) -> DataFrame:
    """(key, node, many) from the stored rows of `met`, which may repeat."""
    names = rows.filter("key IS NULL").select("spot", "node")
    return rows.filter("key IS NOT NULL").select("key", "spot", "many").join(names, "spot").select("key", "node", "many")


