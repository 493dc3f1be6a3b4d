"""Operators against brute force and on awkward rows."""

from __future__ import annotations

import hashlib
import itertools
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from loanpanel.llm import (
    bpe,
    decontamination,
    exact_dedup,
    language_id,
    license_scan,
    line_dedup,
    near_links,
    pretokens,
    superminhash,
    token_arrow,
    toxicity,
    url_filter,
)
from loanpanel.llm.union_find import components
from loanpanel.sources.scratch import materialise
from oracle_check import compare, connect
from test_lines import sets as line_sets

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i} of a very long text," for i in range(20_000))
AWKWARD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "one two"), (5, "One  TWO"), (6, LONG), (7, LONG + " end"), (8, "12 345 !?"),
    (9, "a b c d e f g h\nanother line that repeats\nanother line that repeats"), (9, "a b c d e f g h\nanother line that repeats"),
    (None, "a row without id\nanother line that repeats"), (None, None), (12, "é e\u0301 ﬁ 日本語 don't <|endoftext|>'s Σ"),
    (13, "a b c d e f g h\nanother line that repeats\nanother line that repeats"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    """Rows with names that clash with columns of the operators."""
    rows = [(i, t, "x", 1, "y", 2, None) for i, t in AWKWARD]
    kinds = "doc_id long, text string, kept string, n_tokens int, component_id string, score int, keys string"
    return materialise(spark.createDataFrame(rows, kinds), "awkward")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text):
    w = words(text)
    return frozenset(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def grouped(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def linked(sets, percent):
    pairs = itertools.combinations(sets, 2)
    return [(a, b) for a, b in pairs if (n := len(sets[a] & sets[b])) and 100 * n >= percent * len(sets[a] | sets[b])]


# SuperMinHash ---------------------------------------------------------------


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    for n in (4, 40, 900):
        errors = []
        for _ in range(20):
            both, a, b = (rng.integers(0, 2**63, k, dtype=np.uint64) for k in (3 * n, n, n))
            s = superminhash.signatures(np.concatenate([both, a, both, b]), np.array([4 * n, 4 * n]), 384)
            errors.append((s[0] == s[1]).mean() - 0.6)
        assert abs(np.mean(errors)) < 0.03
    assert not superminhash.signatures(np.zeros(0, np.uint64), np.array([0]), 8).any()


def test_steps_walk_a_permutation():
    elements = np.arange(50, dtype=np.uint64)
    swaps = [superminhash._draw(elements, s, 20)[1] for s in range(20)]
    places = np.array([superminhash._place(swaps, s) for s in range(20)])
    assert all(sorted(places[:, e]) == list(range(20)) for e in range(50))


def check_near(rows, table):
    sets = {i: shingles(t) for i, t in rows}
    group = grouped(sets, linked(sets, 75))
    for r in table.collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), group[r.doc_id], group[r.doc_id] == r.doc_id)


def test_near_duplicates(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    check_near(rows, superminhash.near_duplicates(documents))


def test_near_duplicates_in_a_crowd(spark):
    """Copies of one text with different edits: not all pairs are links."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(90):
        w = list(base)
        for k in rng.integers(0, 80, rng.integers(0, 5)):
            w[k] = f"x{i}-{k}"
        rows.append((i, " ".join(w)))
    docs = materialise(spark.createDataFrame(rows, "doc_id long, text string"), "crowd")
    check_near(rows, superminhash.near_duplicates(docs))


def test_near_duplicates_of_awkward_rows(awkward):
    got = {(r.doc_id, r.n_shingles): r for r in superminhash.near_duplicates(awkward).collect()}
    assert got[1, 0].kept and got[1, 0].component_id == 1
    assert got[5, 1].component_id == 4 and not got[5, 1].kept
    assert got[13, len(shingles(AWKWARD[8][1]))].component_id == 9
    assert all(r.component_id is None and r.kept for (i, _), r in got.items() if i is None)
    assert got[7, len(shingles(LONG)) + 1].component_id == 6
    assert superminhash.near_duplicates(awkward.limit(0)).count() == 0
    stays = superminhash.deduplicated(awkward)
    assert stays.columns == awkward.columns and {r.doc_id for r in stays.collect()} == {1, 2, 3, 4, 6, 8, 9, None, 12}


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(60, 59), (3, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(7, 61)}}


def test_by_key_splits_hot_keys(spark):
    left = spark.createDataFrame([(k,) for k in [1] * 3000 + [2, 3]], "key long")
    right = spark.createDataFrame([(1, "a", 3000), (2, "b", 1)], "key long, name string, rows long")
    got = near_links.by_key(left, right, "key", "rows").groupBy("key", "name").count().collect()
    assert {tuple(r) for r in got} == {(1, "a", 3000), (2, "b", 1), (3, None, 1)}


# Line dedup -------------------------------------------------------------------


def fuzzy_lines(rows):
    lines = [(i, k, line_dedup.plain(x)) for i, t in sorted(rows) for k, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    order = {x: n for n, x in enumerate(dict.fromkeys(x for *_, x in lines))}
    kinds: dict = {}
    for x in order:
        for width, held in line_sets(x).items():
            kinds.setdefault(width, {})[x] = held
    links = [(order[a], order[b]) for held in kinds.values() for a, b in linked(held, line_dedup.PERCENT)]
    group = grouped(range(len(order)), links)
    first, gone = {}, {}
    for i, k, x in lines:
        if first.setdefault(group[order[x]], (i, k)) != (i, k):
            gone.setdefault(i, set()).add(k)
    return {i: "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in gone.get(i, ())) for i, t in rows}


def test_lines(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    out = line_dedup.dedup_lines(documents)
    assert out.columns == documents.columns
    assert {r.doc_id: r.text for r in out.collect()} == fuzzy_lines(rows)


def test_lines_of_awkward_rows(awkward):
    got = [(r.doc_id, r.text, r.kept) for r in line_dedup.dedup_lines(awkward).collect()]
    assert len(got) == len(AWKWARD) and all(r[2] == "x" for r in got)
    assert sum((t or "").count("another line that repeats") for _, t, _ in got) == 1
    texts = {i: t for i, t, _ in got}
    assert texts[1] is None and texts[2] == "" and texts[4] == "one two" and texts[5] == "" and texts[7] == ""
    left = line_dedup.without_emptied(awkward)
    assert left.columns == awkward.columns and {1, 2, 3, 8} <= {r.doc_id for r in left.collect()} and not {5, 7} & {r.doc_id for r in left.collect()}
    assert line_dedup.dedup_lines(awkward.limit(0)).count() == 0


# Exact dedup ------------------------------------------------------------------


def test_exact_copies_with_small_tables(documents):
    """Tables of a few kilobytes force several levels of spill files."""
    rows = {r.doc_id: re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in documents.collect()}
    first, size = {}, {}
    for i in sorted(rows):
        first.setdefault(rows[i], i)
        size[rows[i]] = size.get(rows[i], 0) + 1
    for r in exact_dedup.dedup(documents, table_bytes=40_000, buckets=2).collect():
        text = rows[r.doc_id]
        assert (r.keep_id, r.group_size, r.kept) == (first[text], size[text], first[text] == r.doc_id)
        assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_exact_copies_of_awkward_rows(spark, awkward):
    got = {(r.doc_id, r.text_sha256): r for r in exact_dedup.dedup(awkward).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert {(got[i, empty].keep_id, got[i, empty].group_size) for i in (1, 2, None)} == {(1, 3)}
    assert len(got) == len(AWKWARD) and exact_dedup.dedup(awkward.limit(0)).count() == 0
    many = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    assert exact_dedup.dedup(many).filter("keep_id = 0 AND group_size = 5000").count() == 5000


def test_open_table_compares_contents():
    table = exact_dedup.OpenTable(10_000)
    assert [table.place(7, t) for t in ("a", "b", "a", "c")] == [0, 1, 0, 2]
    assert len({table.place(i * 4096, f"t{i}") for i in range(100)}) == 100
    table.limit = 0
    assert table.place(7, "b") == 1 and table.place(7, "new") == -1


# Tokens -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def byte_level():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_bpe_equals_the_library(spark, documents, awkward, byte_level):
    vocabulary = bpe.Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.json"))
    for docs in (documents, awkward):
        want = []
        for r in docs.select("doc_id", "text").collect():
            ids = byte_level.encode(r.text or "", add_special_tokens=False).ids
            text = byte_level.decode(ids, skip_special_tokens=False)
            shas = [hashlib.sha256(x).hexdigest() for x in (struct.pack(f"<{len(ids)}I", *ids), text.encode())]
            want.append((r.doc_id, len(ids), *shas))
        got = bpe.digests(bpe.decode(bpe.encode(docs, vocabulary), vocabulary)).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe.encode(awkward.limit(0), vocabulary).count() == 0
    odd = spark.createDataFrame([(1, [50256, 99999, -1]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert [r.decoded for r in bpe.decode(odd, vocabulary).orderBy("doc_id").collect()] == ["<|endoftext|>", None, ""]


def test_units_of_random_texts(byte_level):
    lower = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = np.random.default_rng(1)
    parts = ["a", "B", "'", "s", "t", "re", "ll", "'s", " ", "  ", "\n", "\t", "1", "22", "!", "é", "\u00a0", "²", "\u2028", "日"]
    for _ in range(3000):
        text = "".join(rng.choice(parts, rng.integers(0, 12)))
        for tokenizer, joined in ((byte_level, True), (lower, False)):
            units = pretokens.split([text], leading_space=joined)
            want = [at for _, at in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
            assert list(zip(units.starts.tolist(), units.ends.tolist())) == want


def test_token_files(spark, documents, awkward):
    path = public_tokenizers.path("word_bpe_49k.json")
    vocabulary, tokenizer = token_arrow.WordVocabulary(spark, path), Tokenizer.from_file(path)
    for docs, sequence in ((documents, 64), (awkward, 2048)):
        manifest = token_arrow.write(docs, vocabulary, token_arrow.folder(spark), sequence=sequence, shards=3)
        got = token_arrow.digests(token_arrow.read(manifest)).collect()
        want = []
        for r in docs.select("doc_id", "text").collect():
            ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
            want.append((r.doc_id, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
        ordered = sorted(got, key=lambda r: r.start)
        assert [r.start for r in ordered] == [sum(x.n_tokens for x in ordered[:i]) for i in range(len(ordered))]
        ids = [r.doc_id for r in ordered]
        assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    row = manifest.first()
    system, name = token_arrow._open(row.tokens)
    batch = token_arrow.ipc.open_file(system.open_input_file(name)).get_batch(0)
    assert str(batch.schema.field("ids").type).startswith("fixed_size_list<") and batch.schema.names == ["ids", "mask"]
    empty = token_arrow.write(documents.limit(0), vocabulary, token_arrow.folder(spark), shards=2)
    assert token_arrow.read(empty).count() == 0


# Classifiers ------------------------------------------------------------------


def test_language(spark, awkward):
    got = entry.queries()["op4_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = got.filter("held_out").join(docs, "doc_id").select("doc_id", "lang", "lang_pred").collect()
    assert held and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in held)
    model = language_id.fit(["the cat and the dog", "le chat et le chien"], ["en", "fr"])
    rows = {(r.doc_id, r.lang_pred, r.score) for r in language_id.identify(awkward, model).collect()}
    assert {(i, "und", 0.0) for i in (1, 2, 3, 8)} <= rows and all(0 <= r[2] <= 1 for r in rows)
    nothing = language_id.fit([], [])
    assert {r.lang_pred for r in language_id.identify(awkward, nothing).collect()} == {"und"}
    left = language_id.recognised(awkward, model)
    assert left.columns == awkward.columns and not {1, 2, 3, 8} & {r.doc_id for r in left.collect()}


def test_toxicity(spark, awkward):
    got = {r.doc_id: r for r in entry.queries()["op5_toxicity"](spark, "/root/testdata/sf0.1").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    held = [(r.toxic, got[r.doc_id]) for r in labels if r.doc_id in got and got[r.doc_id].held_out]
    assert all(g.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, g in got.items())
    assert sum(t == g.predicted for t, g in held) >= 0.97 * len(held)
    assert sum(g.predicted for t, g in held if t) >= 0.8 * sum(t for t, _ in held)
    model = toxicity.fit(toxicity.features(["bad awful words"] * 9 + ["kind good words"] * 9), np.array([1] * 9 + [0] * 9))
    rows = toxicity.score(awkward, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in toxicity.score(awkward, toxicity.Model()).collect()} == {0.0}


def test_swapped_identities_pull_scores_together():
    """Toxic texts name one group more often; neutral mentions must not suffer."""
    toxic = ["women are idiots today"] * 20 + ["you idiots go away"] * 5
    neutral = ["men went to market"] * 20 + ["we went to market"] * 20
    rows, labels = toxicity.features(toxic + neutral), np.array([1] * 25 + [0] * 40)
    pairs = [tuple(toxicity.features([t, s])) for t in toxic + neutral if (s := toxicity.swapped(t))]
    plain, fair = toxicity.fit(rows, labels), toxicity.fit(rows, labels, pairs)
    mention = ["women went to market", "men went to market"]
    gap = lambda m: abs(np.diff(m.scores(mention))[0])
    assert gap(fair) < gap(plain) and fair.scores(["women are idiots today"])[0] > 0.7
    assert toxicity.swapped("nothing here") is None and toxicity.swapped("Men, and women!") == "girls, and men!"


# Lookups ----------------------------------------------------------------------


def test_licences(spark):
    rows = [
        (1, "LICENSED under the apache licence, version 2.0!!"), (2, "text\n\nAll rights reserved\n\nmore"), (3, None), (4, ""),
        (5, "Copyright (c) 2020 Somebody\nReleased under the MIT Licence"), (None, "Released under the MIT License."), (7, "All rights"),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, license string")
    got = {r.doc_id: r for r in license_scan.scan(docs, license_scan.known_digests(spark)).collect()}
    assert [got[i].license for i in (1, 2, 3, 4, 5, None, 7)] == ["Apache-2.0", None, None, None, "MIT", "MIT", None]
    assert got[2].licenses == "proprietary" and got[2].n_units == 1 and got[3].digest is None
    assert license_scan.scan(docs.limit(0), license_scan.known_digests(spark)).count() == 0


URLS = [
    "https://WWW.Example.com/en/x?y#z", "http://example.com/en/", "http://a.example.com/en", "http://example.com", "x://net/es/q",
    "x://b.net/fr/?a", "x://c.org/p://q", None, "nothing", "http://bad.org/#x", "http://bad.org?q=/x", "://", "http://bad.org.uk/",
]


@pytest.mark.parametrize("bits", [1 << 29, 0])
def test_urls(spark, bits, monkeypatch):
    """Both ways of testing the list, the second for lists beyond the bound."""
    from loanpanel.llm.queries import RULES

    monkeypatch.setattr(url_filter, "MAX_BITS", bits)
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    listed = spark.createDataFrame([("bad.org",), ("b.net",), (None,)], "host string")
    got = {r.page_id: r for r in url_filter.judge(pages, RULES, listed).collect()}
    for i, url in enumerate(URLS):
        at = (url or "").find("://")
        host, path = re.fullmatch(r"([^/?#]*)([^?#]*).*", url[at + 3 :]).groups() if at >= 0 else ("", "")
        host = host.lower()
        fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        block = best.block if best else host in ("bad.org", "b.net")
        want = (host, path, best and best.name, "block" if block else "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == want, url
    assert url_filter.judge(pages.limit(0), RULES, listed.limit(0)).count() == 0


def test_odd_hosts(spark):
    """A host of a million characters among many, NUL at the end of a host, repeated rows."""
    hosts = ["bad.org", "bad.org\0", "x" * 1_000_000, "bad.org", "B.net"] + [f"h{i}" for i in range(3000)]
    pages = spark.createDataFrame([(i, f"http://{h}") for i, h in enumerate([*hosts, *hosts])], "page_id long, url string")
    listed = spark.createDataFrame([("bad.org",), ("b.net",), ("x" * 1_000_000,)], "host string")
    got = url_filter.judge(pages, [], listed).filter("verdict = 'block'").collect()
    n = len(hosts)
    assert sorted(r.page_id for r in got) == [0, 2, 3, 4, n, n + 2, n + 3, n + 4]


def test_cascade_is_exact(spark):
    hosts = spark.range(20_000).select(F.concat(F.lit("h"), "id").alias("host"))
    listed = hosts.filter("CAST(substr(host, 2) AS INT) % 7 = 0")
    cascade = url_filter.build(listed, hosts)
    names = [f"h{i}" for i in range(20_000)]
    assert cascade.listed(names).tolist() == [i % 7 == 0 for i in range(20_000)] and len(cascade.levels) > 2


ITEM = (
    "Alice has 12 apples. She gives Bob 5 apples and keeps the rest; how many apples does Alice keep when Bob eats 2 kg?"
)


def test_contaminated(spark, documents):
    items = spark.createDataFrame(
        [(1, ITEM), (2, None), (3, "too few"), (4, "what is seven times eight"), (5, "")], "item_id long, text string"
    )
    rows = [
        (1, f"intro words. {ITEM} the end"),
        (2, "Carol has 1,300 apples. She gives Dave 7.5 apples and keeps the rest; how many apples does Carol keep when Dave eats 3 lbs?"),
        (3, "Carol has 13 apples. She gives Dave 7 apples and keeps the rest; how many apples does Erin keep when Frank eats 3 lbs?"),
        (4, "a clean text about apples and 12 people"), (5, None), (6, "he asked: What is seven times eight?"), (7, ""), (None, ITEM), (9, LONG),
        (10, ITEM.upper()),
    ]
    docs = materialise(spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, item_id int"), "docs")
    got = {(r.doc_id, r.item_id) for r in decontamination.findings(docs, items).collect()}
    assert got == {(1, 1), (2, 1), (6, 4), (10, 1)}
    stays = decontamination.clean(docs, items)
    assert stays.columns == docs.columns and {r.doc_id for r in stays.collect()} == {3, 4, 5, 7, None, 9}
    assert decontamination.findings(docs.limit(0), items).count() == decontamination.findings(docs, items.limit(0)).count() == 0


def test_contaminated_like_plain_windows(spark):
    """Without names and numbers, an item is found where its words stand."""
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, re.findall(r"[^\W_]+", r.text.lower())) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, re.findall(r"[^\W_]+", r.text.lower())) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    windows = {}
    for i, w in items:
        for k in range(len(w) - 7):
            windows.setdefault(tuple(w[k : k + 8]), []).append((i, k))
    want = set()
    for d, w in docs:
        found = {x for k in range(len(w) - 7) for x in windows.get(tuple(w[k : k + 8]), ())}
        for i, item in items:
            if len(item) >= 8 and sum(x[0] == i for x in found) >= decontamination.SHARE * (len(item) - 7):
                want.add((d, i))
    got = {(r.doc_id, r.item_id) for r in entry.queries()["op9_decontamination"](spark, sf).collect()}
    assert got == want


# The contract -----------------------------------------------------------------


@pytest.mark.parametrize("name", ["op2_license_scan", "op7_url_filter", "op8_exact_dedup"])
def test_equals_sql(spark, name):
    assert compare(entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name]) is None


def test_pipeline(spark):
    """Every stage by brute force on what the stages before left."""
    import corpus_pipeline

    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    known = corpus_pipeline.identify_language(spark, docs, SF).select("doc_id", "text").collect()
    lines = fuzzy_lines([(r.doc_id, r.text) for r in known])
    texts = {r.doc_id: lines[r.doc_id] for r in known if lines[r.doc_id] == (r.text or "") or re.search(r"[^\W_]", lines[r.doc_id])}
    sets = {i: shingles(t) for i, t in texts.items()}
    kept = [i for i, c in grouped(sets, linked(sets, 75)).items() if i == c]
    left = spark.createDataFrame([(i, texts[i]) for i in kept], "doc_id long, text string")
    leaks = {r.doc_id for r in decontamination.findings(materialise(left, "left"), spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert leaks and set(out) == set(kept) - leaks and 0.8 * docs.count() < len(out)
    for i, r in out.items():
        assert r.decoded_sha256 == hashlib.sha256(texts[i].encode()).hexdigest()
