"""Hard negatives, shards and lexical search against plain versions."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from loanpanel.llm import hard_negatives, lexical_search, sharding
from loanpanel.sources.scratch import materialise
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_interleave", "op13_aho_search"])
def test_queries_against_sql(spark, name):
    assert compare(entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name]) is None


# --- hard negatives


@pytest.mark.parametrize("n, bits", [(2, 2), (3, 2), (4, 1), (2, 3)])
def test_curve_goes_from_cell_to_neighbour(n, bits):
    side = 1 << bits
    cells = np.array(np.meshgrid(*[range(side)] * n)).reshape(n, -1).T
    keys = hard_negatives.hilbert_keys(cells, bits)
    assert len(set(keys)) == side**n
    walk = cells[sorted(range(len(keys)), key=lambda i: keys[i])]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_bounds_hold_and_skip_far_blocks():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 4000, (20, 16))
    blocks = [np.floor(c + rng.normal(0, 60, (100, 16))).astype(np.int64) for c in centres]
    anchors = np.array([b[0] for b in blocks])
    least, most = hard_negatives.bounds(anchors, np.array([b.min(0) for b in blocks]), np.array([b.max(0) for b in blocks]))
    for j, b in enumerate(blocks):
        s = hard_negatives.scores(anchors, b)
        assert (s >= least[:, j : j + 1]).all() and (s <= most[:, j : j + 1]).all()
    own = np.array([np.partition(hard_negatives.scores(a[None], b)[0], -5)[-5] for a, b in zip(anchors, blocks)])
    assert (most >= own[:, None]).sum() < 0.2 * most.size  # blocks that must be read


def test_scores_are_exact():
    a = np.array([[3, -(2**26)], [2**27, 2**27]])
    assert (hard_negatives.scores(a, a) == [[9 + 2**52, 3 * 2**27 - 2**53], [3 * 2**27 - 2**53, 2**55]]).all()
    large = np.array([[2**62, 0], [0, 5]])
    assert hard_negatives.scores(large, large).tolist() == [[2**63 - 1, 0], [0, 25]]


def plain_negatives(rows, every, m=hard_negatives.Mining()):
    good = set()
    for vec_id, label, v in rows:
        if vec_id is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.add((vec_id, label, tuple(math.floor(256 * x) for x in v)))
    out = []
    for a in good:
        if a[0] % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in good if b is not a]
        same = sorted(s for s in scored if s[2] == a[1] and s[1] != a[0])[: m.positives]
        for p, pid, _ in same:
            fits = sorted(s for s in scored if s[2] != a[1] and m.least * -p <= m.whole * -s[0] <= m.most * -p)
            out += [(a[0], pid, r, nid, -p, -n) for r, (n, nid, _) in enumerate(fits[: m.negatives], 1)]
    return Counter(out)


def test_negatives_of_awkward_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, i % 3, rng.normal(0.3, 1, 6).round(1).tolist()) for i in range(90)]
    rows += [(i, 1, rows[10][2]) for i in range(100, 160)]  # a hot label and a group of copies
    rows += rows[:5] + [(10, 2, [0.5] * 6), (0, 0, [1.0] * 6)]  # repeated rows; repeated ids
    rows += [(None, 1, [1.0] * 6), (200, None, [1.0] * 6), (210, 1, None), (220, 1, [1.0, None]), (230, 1, [float("nan")]),
             (240, 1, [float("inf")]), (250, 2, []), (260, 2, [9.0, 9.0]), (270, 5, [1.0] * 6), (-10, 0, [2.0] * 6)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, score string, rank int")
    rounded = [(i, label, v and [None if x is None else float(np.float32(x)) for x in v]) for i, label, v in rows]
    for block in (hard_negatives.BLOCK, 7):
        got = hard_negatives.mine(hard_negatives.whole_numbers(df), 10, block=block).collect()
        assert Counter(tuple(r) for r in got) == plain_negatives(rounded, 10)
    assert hard_negatives.mine(hard_negatives.whole_numbers(df.limit(0))).collect() == []


# --- shards


def test_shards_of_awkward_rows(spark):
    rows = [(i, f"text {i}", "hot" if i % 3 else f"s{i % 7}") for i in range(400)]
    rows += [(5000, "the same", "hot")] * 150 + [(None, None, None)] * 20 + [(1, "", ""), (2, "é" * 50_000, None), (None, "x", "hot")]
    docs = materialise(spark.createDataFrame([(*r, 1, "y") for r in rows], "doc_id long, text string, source string, shard int, law string"), "docs")
    out = sharding.assign(docs).collect()
    con = connect(SF)
    con.execute("DROP VIEW documents")
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    assert compare(sharding.assign(docs), con, sharding.oracle()) is None
    sizes = Counter((r.doc_id, r.size, r.text_crc32) for r in out)
    assert sizes == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    shards = {k: [r for r in out if r.shard == k] for k in range(16)}
    counts = [len(s) for s in shards.values()]
    assert max(counts) - min(counts) <= 1 and {r.law for r in out} == {"rows"}
    for held in shards.values():
        assert sorted(r.slot for r in held) == list(range(len(held)))
        assert {r.grown_shard for r in held} == {None}
    strata = Counter(r.stratum for r in out)
    for name, n in strata.items():
        most = 2 + len(strata) * n / len(rows)
        assert all(abs(sum(r.stratum == name for r in held) - n / 16) <= most for held in shards.values())
    assert sharding.assign(docs.limit(0)).collect() == []


def test_seed_and_number_of_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = ({r.doc_id: r.shard for r in sharding.assign(docs, 3, seed).collect()} for seed in ("a", "b"))
    assert set(a.values()) == {0, 1, 2} and a != b


# --- lexical search


def plain_search(docs, items, top=10):
    def terms(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)

    counts = [(i, Counter(terms(t))) for i, t in docs]
    N, L = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, c in counts:
            m = 25 + 75 * sum(c.values()) * N // L
            weight = {t: math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) for t in c}
            s = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if s:
                found.append((-s, doc_id is None, doc_id))
        out += [(item_id, r, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda x: x[:2] + (x[2] or 0,))[:top], 1)]
    return Counter(out)


def test_search_of_awkward_rows(spark):
    long = " ".join(f"word{i % 500}" for i in range(60_000))
    docs = [(1, None), (2, ""), (3, " \n.,!"), (4, "one two"), (5, "One  TWO,two"), (6, long), (7, "é x 日本語 ÄB"), (8, "twofold two-fold"), (None, "one two"),
            (9, "one two"), (9, "one two"), (10, "a_b a`b {c}\x00d\x7fe")] + [(100 + i, "rare copies of a text") for i in range(40)]
    items = [(1, "one TWO two"), (1, "one TWO two"), (2, None), (3, ""), (4, "é x Äb äb"), (5, "copies"), (None, "rare word3"), (6, "d e fold two"), (7, "no such thing"), (8, "b a c")]
    d = materialise(spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score int, rank string"), "docs")
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    for slab_bytes in (lexical_search.SLAB_BYTES, 40):
        got = lexical_search.search(d, i, slab_bytes=slab_bytes).collect()
        assert Counter(tuple(r) for r in got) == plain_search(docs, items)
    assert lexical_search.search(d.limit(0), i).collect() == [] == lexical_search.search(d, i.limit(0)).collect()
    assert lexical_search.search(d.filter("doc_id < 4"), i).collect() == []
