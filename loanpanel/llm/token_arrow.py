"""Token ids in Arrow files of equal-length sequences.

A shard holds the ids of a range of documents, one after another, cut into
sequences of SEQUENCE ids. Its file is in Arrow's stream-file format (a stream
with a footer): record batches of two fixed-size lists, `ids` and `mask`
(true where an id stands, false in the padding of the last sequence); ids take
two bytes where the vocabulary allows. A memory-mapped
reader reaches sequence k of a batch by one multiplication, without copying.
A second file of the shard lists its documents: doc_id, start within the
shard, number of ids.

Shards are ranges of doc_id in ascending order (null first; equal ids in the
order of their texts), so the start of a document in the whole corpus is the
start of its shard plus its start within it. Shard totals, one row a shard,
are summed in order by a window.

Files go to the shared folder through its file system. Every attempt of a task
writes files of its own name and the manifest names those of the attempt that
counted, so a lost executor leaves unread files, never half a shard.

Cases: a null text counts as empty; the end id follows every document; an
empty table gives no rows; repeated rows and ids are kept; other columns are
not read.
"""

from __future__ import annotations

import json
import os
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark
from pyarrow import fs, ipc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loanpanel.llm import pretokens
from loanpanel.sources.scratch import materialise, scratch_folder

SEQUENCE = 2048
#: Sequences of a record batch.
BATCH = 512
#: Words whose ids a Python worker remembers.
REMEMBERED = 300_000
_cache: dict = {}


class _Known:
    """Ids of the words that a worker has met, by the hash of the word."""

    def __init__(self):
        self.keys = np.zeros(0, np.uint64)  # sorted
        self.start = self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def of(self, keys: np.ndarray, words, model) -> tuple[np.ndarray, np.ndarray]:
        """Start and length in `ids` of sorted keys. words(places) gives the
        words of those that are new."""
        if len(self.keys) > REMEMBERED:
            self.__init__()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        fresh = np.flatnonzero(new)
        if len(fresh):
            ids = pretokens.unit_ids(model, words(fresh))
            many = np.array([len(x) for x in ids], np.int64)
            begin = len(self.ids) + np.cumsum(many) - many
            self.ids = np.concatenate([self.ids, np.array([i for x in ids for i in x], np.uint32)])
            self.keys = np.insert(self.keys, at[fresh], keys[fresh])
            self.start = np.insert(self.start, at[fresh], begin)
            self.length = np.insert(self.length, at[fresh], many)
            at = np.searchsorted(self.keys, keys)
        return self.start[at], self.length[at]


class WordVocabulary:
    """A lower-casing vocabulary with word ends, sent once to every executor."""

    def __init__(self, spark, path: str):
        with open(path, encoding="utf-8") as f:
            content = f.read()
        self.name = str(zlib.crc32(content.encode()))
        self.content = spark.sparkContext.broadcast(content)
        parsed = json.loads(content)
        self.specials = tuple(t["content"] for t in parsed["added_tokens"])
        self.size = 1 + max([*parsed["model"]["vocab"].values(), *(t["id"] for t in parsed["added_tokens"])])

    def _tokenizer(self) -> Tokenizer:
        if self.name not in _cache:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            tokenizer = Tokenizer.from_str(self.content.value)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            _cache[self.name] = (tokenizer, _Known())
        return _cache[self.name][0]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text. Each distinct word of a run of texts meets the
        vocabulary once; words seen by this worker before are remembered.
        Texts that spell a special token are encoded whole."""
        tokenizer = self._tokenizer()
        known = _cache[self.name][1]
        out: list[np.ndarray] = []
        for run in pretokens.steps([len(t) for t in texts]):
            plain = [self._plain(t) for t in texts[run]]
            spelled = [i for i, t in enumerate(plain) if "<|" in t and any(s in t for s in self.specials)]
            units = pretokens.split(plain, leading_space=False)
            keys, at, place = units.distinct()
            start, length = known.of(keys, lambda fresh: [units[k] for k in at[fresh].tolist()], tokenizer.model)
            many = length[place]
            after = np.cumsum(many)
            total = int(after[-1]) if len(after) else 0
            laid = known.ids[np.repeat(start[place] - after + many, many) + np.arange(total)].astype(np.uint32)
            ends = np.concatenate([[0], after])[units.first]
            laid_out = [laid[a:b] for a, b in zip(ends[:-1], ends[1:])]
            for i in spelled:
                laid_out[i] = np.array(tokenizer.encode(texts[run][i], add_special_tokens=False).ids, np.uint32)
            out += laid_out
        return out

    def _plain(self, text: str) -> str:
        """The text as the vocabulary normalises it."""
        if text.isascii():
            return text.lower()
        if any(unicodedata.category(c) == "Cn" for c in set(text)):  # newer than Python's tables
            return self._tokenizer().normalizer.normalize_str(text)
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def _schema(sequence: int, kind: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(kind, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])


_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class _Writer:
    """Packs ids into sequences as they come."""

    def __init__(self, sink, sequence: int, kind: pa.DataType):
        self.sequence, self.schema, self.kind = sequence, _schema(sequence, kind), kind.to_pandas_dtype()
        self.out = ipc.new_file(sink, self.schema)
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= self.sequence * BATCH:
            self._flush(self.size // self.sequence * self.sequence)

    def _flush(self, n: int) -> None:
        every = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        ids, rest = every[:n], every[n:]
        pad = -len(ids) % self.sequence
        mask = np.ones(len(ids) + pad, bool)
        mask[len(ids) :] = False
        ids = np.concatenate([ids, np.zeros(pad, np.uint32)]).astype(self.kind)
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.sequence) for x in (ids, mask)]
        for at in range(0, len(columns[0]), BATCH):
            self.out.write_batch(pa.RecordBatch.from_arrays([c[at : at + BATCH] for c in columns], schema=self.schema))
        self.held, self.size = [rest], len(rest)

    def close(self) -> None:
        if self.size:
            self._flush(self.size)
        self.out.close()


def write(
    docs: DataFrame,
    vocabulary: WordVocabulary,
    folder: str,
    end_id: int = 1,
    sequence: int = SEQUENCE,
    shards: int | None = None,
) -> DataFrame:
    """Write the shards under `folder`. Returns the stored manifest: shard,
    tokens, index (paths), n_docs, n_tokens and `before`, the number of ids in
    all shards before."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = uuid.uuid4().hex
    kind = pa.uint16() if vocabulary.size <= 1 << 16 else pa.uint32()

    def run(batches: Iterator[pa.RecordBatch]):
        shard, attempt = pyspark.TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        writer = sink = None
        index: list[tuple] = []
        start = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                system, path = _open(f"{folder}/{name}")
                system.create_dir(path, recursive=True)
                sink = system.open_output_stream(f"{path}/{shard:06d}-{attempt}.tokens.arrow")
                writer = _Writer(sink, sequence, kind)
            doc_ids = batch.column(0).to_pylist()
            for part, texts in pretokens.text_runs(batch.column(1)):
                for doc_id, x in zip(doc_ids[part], vocabulary.encode(texts)):
                    x = np.append(x, np.uint32(end_id))
                    writer.add(x)
                    index.append((doc_id, start, len(x)))
                    start += len(x)
        if writer is None:
            return
        writer.close()
        sink.close()
        stem = f"{folder}/{name}/{shard:06d}-{attempt}"
        with system.open_output_stream(f"{path}/{shard:06d}-{attempt}.index.arrow") as f, ipc.new_file(f, _INDEX) as out:
            out.write_table(pa.table([pa.array(c, pa.int64()) for c in zip(*index)], schema=_INDEX))
        row = [[shard], [f"{stem}.tokens.arrow"], [f"{stem}.index.arrow"], [len(index)], [start]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v) for v in row], ["shard", "tokens", "index", "n_docs", "n_tokens"]
        )

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(shards, "doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    manifest = materialise(
        ordered.mapInArrow(run, "shard long, tokens string, index string, n_docs long, n_tokens long"), "manifest"
    )
    # one row a shard: their number is a setting, not the data's size
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return manifest.withColumn("before", F.coalesce(before, F.lit(0)))


def _sequences(path: str):
    """Ids and masks of a shard, batch by batch, by memory map where the file is local."""
    system, name = _open(path)
    source = pa.memory_map(name) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(name)
    with source:
        reader = ipc.open_file(source)
        for i in range(reader.num_record_batches):
            batch = reader.get_batch(i)
            ids, mask = batch.column(0).flatten(), batch.column(1).flatten()
            yield ids.to_numpy(zero_copy_only=True)[: mask.true_count]  # padding stands at the very end only


def read(manifest: DataFrame) -> DataFrame:
    """One row (doc_id, start, ids) for each document, from the files."""
    spark = manifest.sparkSession
    schema = "doc_id long, start long, ids array<int>"

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                system, name = _open(row["index"])
                with system.open_input_file(name) as f:
                    index = ipc.open_file(f).read_all()
                doc_ids, starts, lengths = (index.column(c).to_pylist() for c in ("doc_id", "start", "n_tokens"))
                held, base, k = np.zeros(0, np.uint16), 0, 0
                for ids in _sequences(row["tokens"]):
                    held = np.concatenate([held, ids])
                    first = k
                    while k < len(starts) and starts[k] + lengths[k] <= base + len(held):
                        k += 1
                    if k > first:
                        end = starts[k - 1] + lengths[k - 1] - base
                        cuts = np.array([*[s - base for s in starts[first:k]], end], np.int32)
                        lists = pa.ListArray.from_arrays(pa.array(cuts - cuts[0]), pa.array(held[cuts[0] : end].astype(np.int32)))
                        whole = [row["before"] + s for s in starts[first:k]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(doc_ids[first:k], pa.int64()), pa.array(whole, pa.int64()), lists],
                            ["doc_id", "start", "ids"],
                        )
                        held, base = held[end:], base + end

    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(shards, "shard").mapInArrow(run, schema)


def digests(documents: DataFrame) -> DataFrame:
    @F.pandas_udf("long")
    def checksum(ids):
        return ids.map(lambda x: zlib.crc32(np.asarray(x, "<u4").tobytes()))

    return documents.select(
        "doc_id", "start", F.size("ids").cast("long").alias("n_tokens"), checksum("ids").alias("ids_crc32")
    )


def folder(spark) -> str:
    return f"{scratch_folder(spark)}/token-files"
