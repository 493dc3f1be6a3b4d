"""Byte-pair encoding and decoding by a table of distinct words.

Texts are split in Spark tasks into the units that the vocabulary merges
within ("words"). A task numbers the distinct words of each block of documents
and sends every word of a block once, so a word meets the vocabulary once for
the whole table, however often it occurs. Its ids go back to the blocks, where
they are laid out by the positions of the words. Decoding looks the ids up in
the table of pieces, whose size the vocabulary fixes.

A block is a run of documents of one input partition with at most BLOCK_CHARS
characters (or one longer document). The input is read once for the words and
once for the positions, so it must be a table that reads the same twice, such
as files; `cut` or write anything else first.

Cases: a null text counts as empty and gives no ids; an id that the vocabulary
does not have decodes to nothing; a null list of ids decodes to null; rows are
kept as they are, repeated ones and null ids of documents included; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from loanpanel.llm import pretokens

BLOCK_CHARS = 4_000_000
#: Words whose ids a Python worker remembers; ids of forgotten ones are found anew.
REMEMBERED = 200_000
#: Documents decoded at a time.
DECODED = 500
_WORDS = "block long, bucket int, gaps binary, words binary"
_IDS = "block long, bucket int, gaps binary, many binary, ids binary"
_PLACES = "block long, row int, key binary, places binary"
_cache: dict[str, Tokenizer] = {}


class Vocabulary:
    """A byte-level vocabulary file, sent once to every executor."""

    def __init__(self, spark, path: str):
        with open(path, encoding="utf-8") as f:
            content = f.read()
        self.name = hashlib.sha256(content.encode()).hexdigest()
        self.content = spark.sparkContext.broadcast(content)
        self.pieces = spark.sparkContext.broadcast(_pieces(content))
        self.specials = tuple(t["content"] for t in json.loads(content)["added_tokens"])

    def tokenizer(self) -> Tokenizer:
        if self.name not in _cache:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            _cache.clear()  # one vocabulary a worker
            _cache[self.name] = _plain_tokenizer(self.content.value)
        return _cache[self.name]


def _plain_tokenizer(content: str) -> Tokenizer:
    tokenizer = Tokenizer.from_str(content)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _pieces(content: str) -> list[bytes]:
    """The bytes of every id."""
    byte_of = {c: b for b, c in pretokens.stand_ins().items()}
    vocabulary = _plain_tokenizer(content).get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        known = all(c in byte_of for c in token)
        out[i] = bytes(byte_of[c] for c in token) if known else token.encode()
    return out


def _pack(values: np.ndarray) -> bytes:
    """Unsigned numbers byte by byte, the low bytes first, compressed."""
    planes = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 3)


def _raw(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


class _Block:
    """The words of a run of documents, numbered as they come."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.known: dict[int, int] = {}
        self.words: list[str] = []
        self.keys: list = []
        self.rows: list[np.ndarray] = []

    def add(self, ids: list, units: pretokens.Units) -> None:
        self.size += len(units.text)
        key, at, place = units.distinct()
        numbers = np.empty(len(key), np.int32)
        for i, (k, position) in enumerate(zip(key.tolist(), at.tolist())):
            found = self.known.get(k)
            if found is None:
                found = self.known[k] = len(self.words)
                self.words.append(units[position])
            numbers[i] = found
        places = numbers[place] if len(place) else np.zeros(0, np.int32)
        self.rows += [places[a:b] for a, b in zip(units.first[:-1], units.first[1:])]
        self.keys += ids

    def ranks(self) -> np.ndarray:
        """New numbers of the words, the most frequent first."""
        every = np.concatenate(self.rows) if self.rows else np.zeros(0, np.int32)
        order = np.argsort(-np.bincount(every, minlength=len(self.words)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        return rank


def _blocks(batches: Iterator[pa.RecordBatch], specials: tuple[str, ...]) -> Iterator[_Block]:
    block = _Block(pyspark.TaskContext.get().partitionId() << 32)
    for batch in batches:
        ids = batch.column(0)
        for run, texts in pretokens.text_runs(batch.column(1)):
            if block.size and block.size + sum(map(len, texts)) > BLOCK_CHARS:
                yield block
                block = _Block(block.number + 1)
            block.add(ids[run.start : run.stop].to_pylist(), pretokens.split(texts, specials))
    if block.rows:
        yield block


def _words(docs: DataFrame, specials: tuple[str, ...], buckets: int) -> DataFrame:
    """The words of every block, dealt to buckets by hash: the words of a
    bucket joined by a byte that UTF-8 does not use, with the gaps of their
    places. Blocks without words have an empty bucket."""

    def run(batches):
        for block in _blocks(batches, specials):
            rank = block.ranks()
            order = np.argsort(rank)
            key = np.fromiter(block.known, np.uint64, len(block.known))[order]  # in the order of first sight
            bucket = (pretokens.mix(key) % np.uint64(buckets)).astype(np.int64)
            by_bucket = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[by_bucket])) + 1
            groups = [g for g in np.split(by_bucket, cuts)]
            words = [[block.words[order[i]].encode() for i in g.tolist()] for g in groups]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(groups), block.number), pa.int64()),
                    pa.array([int(bucket[g[0]]) if len(g) else 0 for g in groups], pa.int32()),
                    pa.array([_pack(np.diff(g, prepend=0)) for g in groups], pa.binary()),
                    pa.array([zstandard.compress(b"\xff".join(w), 3) for w in words], pa.binary()),
                ],
                ["block", "bucket", "gaps", "words"],
            )

    return docs.mapInArrow(run, _WORDS)


def _places(docs: DataFrame, specials: tuple[str, ...]) -> DataFrame:
    """The documents of every block as the numbers of their words."""

    def run(batches):
        for block in _blocks(batches, specials):
            n, rank = len(block.rows), block.ranks()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, block.number), pa.int64()),
                    pa.array(np.arange(n), pa.int32()),
                    pa.array([json.dumps(k).encode() for k in block.keys], pa.binary()),
                    pa.array([_pack(rank[r]) for r in block.rows], pa.binary()),
                ],
                ["block", "row", "key", "places"],
            )

    return docs.mapInArrow(run, _PLACES)


def _encode_words(words: DataFrame, vocabulary: Vocabulary, buckets: int) -> DataFrame:
    """Ids of the words of every block and bucket. Equal words share a bucket,
    so one task encodes a word once for all blocks."""

    def run(batches):
        model, known = vocabulary.tokenizer().model, {}
        for batch in batches:
            many, ids = [], []
            for packed in batch.column("words").to_pylist():
                words = zstandard.decompress(packed).split(b"\xff")
                if not known or len(known) > REMEMBERED:
                    known = {s.encode(): _raw([vocabulary.tokenizer().token_to_id(s)]) for s in vocabulary.specials}
                fresh = [w for w in words if w not in known]
                known.update(zip(fresh, map(_raw, pretokens.unit_ids(model, [w.decode() for w in fresh]))))
                found = [known[w] for w in words]
                many.append(_pack(np.array([len(x) // 4 for x in found], np.uint32)))
                ids.append(_pack(np.frombuffer(b"".join(found), np.uint32)))
            kept = [batch.column(c) for c in ("block", "bucket", "gaps")]
            names = ["block", "bucket", "gaps", "many", "ids"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(many, pa.binary()), pa.array(ids, pa.binary())], names)

    return words.repartition(buckets, "bucket").mapInArrow(run, _IDS)


def _word_ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a block's words in one array; start and length by place."""
    flat, places, lengths = [], [], []
    for gaps, many, ids in zip(*(table.column(c).to_pylist() for c in ("gaps", "many", "ids"))):
        places.append(np.cumsum(_unpack(gaps), dtype=np.int64))
        lengths.append(_unpack(many).astype(np.int64))
        flat.append(_unpack(ids))
    if not flat:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # a block without words has one empty word and no place for it
    many = np.concatenate(lengths)
    place = np.concatenate(places)[: len(many)]
    many = many[: len(place)]
    start, length = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    start[place], length[place] = np.cumsum(many) - many, many
    return np.concatenate(flat), start, length


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, ids) for each document."""
    kind = docs.schema[id_col].dataType
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = _encode_words(_words(docs, vocabulary.specials, buckets), vocabulary, buckets)
    key_kind = {"string": pa.string(), "int": pa.int32()}.get(kind.simpleString(), pa.int64())

    def lay_out(left: pa.Table, right: pa.Table) -> pa.Table:
        flat, start, length = _word_ids(left)
        ids, sizes = [], []
        for packed in right.column("places").to_pylist():
            places = _unpack(packed)
            many = length[places]
            total = int(many.sum())
            before = np.cumsum(many) - many
            ids.append(flat[np.repeat(start[places] - before, many) + np.arange(total)].astype(np.int32))
            sizes.append(total)
        keys = [json.loads(k) for k in right.column("key").to_pylist()]
        offsets = np.zeros(len(sizes) + 1, np.int32)
        np.cumsum(sizes, out=offsets[1:])
        values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
        return pa.Table.from_arrays([pa.array(keys, key_kind), listed], ["doc_id", "ids"])

    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    rows = _places(docs, vocabulary.specials)
    return words.groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(lay_out, schema)


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Adds the text of `ids` as `decoded`, and the digest of the ids: ids meet
    their pieces in a table of the vocabulary's size that every task holds."""
    schema = T.StructType(
        [*encoded.schema.fields, T.StructField("ids_sha256", T.StringType()), T.StructField("decoded", T.StringType())]
    )

    def run(batches):
        pieces = vocabulary.pieces.value
        for batch in (b.slice(at, DECODED) for b in batches for at in range(0, b.num_rows, DECODED)):
            column, texts, shas = batch.column(batch.schema.get_field_index("ids")), [], []
            offsets = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False)
            for i, valid in enumerate(column.is_valid().to_pylist()):
                ids = values[offsets[i] : offsets[i + 1]]
                shas.append(ids_digest(ids) if valid else None)
                if len(ids) and (ids.min() < 0 or ids.max() >= len(pieces)):
                    ids = ids[(ids >= 0) & (ids < len(pieces))]
                texts.append(b"".join([pieces[k] for k in ids.tolist()]).decode("utf-8", "replace") if valid else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shas, pa.string()), pa.array(texts, pa.string())], schema.names
            )

    return encoded.mapInArrow(run, schema)


def ids_digest(ids: np.ndarray) -> str:
    """sha256 of ids as little-endian unsigned 32-bit integers."""
    return hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest()


def digests(decoded: DataFrame) -> DataFrame:
    """Count and digests of ids and decoded text."""
    size, sha = F.size("ids").cast("long"), F.sha2("decoded", 256)
    return decoded.select("doc_id", size.alias("n_tokens"), "ids_sha256", sha.alias("decoded_sha256"))
