"""URL filters: rules by host and path, and a Bloom filter cascade.

A rule (host, path) fits its host and all hosts under it where the url's path
begins with the rule's; the longest fitting rule decides. Urls without a rule
are blocked if their host is listed.

Listed hosts are tested by a cascade of Bloom filters instead of a join. Level
0 holds the listed hosts; level 1 those other hosts of the corpus that pass
level 0 by mistake; level 2 the listed hosts that pass level 1 by mistake; and
so on, until no mistake is left. A host is listed if the first level it does
not pass is an odd one. Levels are built over all hosts of the corpus, so for
these hosts the answer is exact.

Bits of a level are found by Spark: each host sets its bits in words of 64,
which are combined by `bit_or` before and after the shuffle. What reaches the
driver and every task are the levels' words, about BITS_PER_KEY bits a key of
the level and at most MAX_BITS in all. A list too long for that is joined by
shuffle instead, with the same answer.

Cases: null urls and urls without `://` have empty host and path, no rule, and
are looked up like any host; repeated rows are kept; an empty list blocks
nothing; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanpanel.sources.scratch import cut

BITS_PER_KEY = 12
HASHES = 6
#: Bits of all levels together that may be sent to every task (64 MB).
MAX_BITS = 1 << 29
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    block: bool

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z in lower case;
    path: from there up to ? # or the end."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, *_LOWER), path


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Name and decision of the longest fitting rule, or null."""
    out = F.lit(None).cast("struct<rule:string,block:boolean>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.block).alias("block"))).otherwise(out)
    return out


def _bits(hosts: list[str], level: int, size: int) -> np.ndarray:
    """Bits of every host at a level, HASHES each, by double hashing."""
    whole = [xxhash.xxh3_128_intdigest(h.encode("utf-8", "surrogatepass"), seed=level) for h in hosts]
    low = np.array([w & 0xFFFFFFFFFFFFFFFF for w in whole], np.uint64)
    high = np.array([w >> 64 for w in whole], np.uint64) | np.uint64(1)
    steps = np.arange(HASHES, dtype=np.uint64)
    return (low[:, None] + steps[None, :] * high[:, None]) % np.uint64(size)


@dataclass
class Cascade:
    levels: list[np.ndarray]  # words of 64 bits

    def passes(self, hosts: list[str], level: int) -> np.ndarray:
        words = self.levels[level]
        bits = _bits(hosts, level, 64 * len(words))
        return ((words[bits // np.uint64(64)] >> (bits % np.uint64(64))) & np.uint64(1)).all(1)

    def listed(self, hosts: list[str]) -> np.ndarray:
        """A host is listed if the first level that it fails is odd, or if it
        passes all and the last is even."""
        out = np.zeros(len(hosts), bool)
        going = np.arange(len(hosts))
        for level in range(len(self.levels)):
            if not len(going):
                break
            passed = self.passes([hosts[i] for i in going], level)
            out[going[~passed]] = level % 2 == 1
            going = going[passed]
        out[going] = len(self.levels) % 2 == 1
        return out


def _level(keys: DataFrame, level: int, size: int) -> np.ndarray:
    """Words of the filter over the keys (column host)."""

    def run(batches):
        for batch in batches:
            bits = _bits(batch.column(0).to_pylist(), level, size).ravel()
            word, place = (bits // np.uint64(64)).astype(np.int64), bits % np.uint64(64)
            at, inverse = np.unique(word, return_inverse=True)
            values = np.zeros(len(at), np.uint64)
            np.bitwise_or.at(values, inverse, np.uint64(1) << place)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(values.view(np.int64))], ["word", "bits"])

    words = keys.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    table = words.toArrow()  # size / 64 rows at most
    out = np.zeros(size // 64, np.uint64)
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return out


def _passing(hosts: DataFrame, words: np.ndarray, level: int) -> DataFrame:
    one = Cascade([np.zeros(0, np.uint64)] * level + [words])
    shared = hosts.sparkSession.sparkContext.broadcast(one)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(shared.value.passes(batch.column(0).to_pylist(), level)))

    return cut(hosts.mapInArrow(run, "host string"))


def build(listed: DataFrame, universe: DataFrame) -> Cascade | None:
    """A cascade that tells the listed hosts from the others of the universe
    (columns host); None where it would exceed MAX_BITS."""
    inside = cut(listed.select("host").filter("host IS NOT NULL").distinct())
    outside = cut(universe.select("host").filter("host IS NOT NULL").distinct().join(inside, "host", "left_anti"))
    levels: list[np.ndarray] = []
    used = 0
    while not inside.isEmpty():
        size = max(64, -(-inside.count() * BITS_PER_KEY // 64) * 64)
        used += size
        if used > MAX_BITS:
            return None
        levels.append(_level(inside, len(levels), size))
        wrong = _passing(outside, levels[-1], len(levels) - 1)
        inside, outside = wrong, inside
    return Cascade(levels)


def judge(pages: DataFrame, rules: list[Rule], listed: DataFrame) -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict."""
    rest = pages.select("page_id", *(c.alias(n) for c, n in zip(host_and_path(F.col("url")), ("host", "path"))))
    cascade = build(listed, rest.select("host"))
    rows = rest.withColumn("longest", longest_rule(F.col("host"), F.col("path"), rules))
    if cascade is None:
        keys = listed.select("host").distinct().withColumn("listed", F.lit(True))
        rows = rows.join(keys, "host", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    else:
        shared = pages.sparkSession.sparkContext.broadcast(cascade)

        @F.pandas_udf("boolean")
        def is_listed(host):
            import pandas as pd

            # a dict: numpy's arrays of texts are as wide as the longest, and end texts at a NUL
            each: dict[str, int] = {}
            place = [each.setdefault(h, len(each)) for h in host]
            return pd.Series(shared.value.listed(list(each))[place])

        rows = rows.withColumn("listed", is_listed("host"))
    blocked = F.coalesce("longest.block", "listed")
    verdict = F.when(blocked, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", F.col("longest.rule").alias("rule"), verdict.alias("verdict"))
