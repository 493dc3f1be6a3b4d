"""Registered queries of the training-data operators, with their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanpanel.llm import (
    bpe,
    decontamination,
    exact_dedup,
    hard_negatives,
    language_id,
    lexical_search,
    license_scan,
    line_dedup,
    sharding,
    superminhash,
    token_arrow,
    toxicity,
    url_filter,
)

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicates among all documents."""
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query
def op3_bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; digests of both."""
    vocabulary = bpe.Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.json"))
    encoded = bpe.encode(table(spark, sf_dir, "documents"), vocabulary)
    return bpe.digests(bpe.decode(encoded, vocabulary))


@_query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    held = language_id.held_out("doc_id", 5, 0)
    model = language_id.train(docs.filter(~held))
    return language_id.identify(docs, model).withColumn("held_out", held)


@_query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from two thirds of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = language_id.held_out("doc_id", 3, 1)
    model = toxicity.train(docs, labels.filter(~held))
    return toxicity.score(docs, model).withColumn("held_out", held)


@_query
def op6_token_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, count and checksum of every document's ids, read from the files."""
    vocabulary = token_arrow.WordVocabulary(spark, public_tokenizers.path("word_bpe_49k.json"))
    manifest = token_arrow.write(table(spark, sf_dir, "documents"), vocabulary, token_arrow.folder(spark))
    return token_arrow.digests(token_arrow.read(manifest))


@_query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document, up to white space."""
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


ORACLE["op8_exact_dedup"] = r"""
WITH t AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents
), g AS (
    SELECT sha256(x) AS text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, g.text_sha256
FROM t JOIN g ON sha256(t.x) = g.text_sha256
"""


@_query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document before and after fuzzy line deduplication."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), counts=True)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


@_query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences of every document."""
    return license_scan.scan(table(spark, sf_dir, "documents"), license_scan.known_digests(spark))


ORACLE["op2_license_scan"] = license_scan.oracle()

RULES = [
    url_filter.Rule("com", "/", block=False),
    url_filter.Rule("example.com", "/en/", block=True),
    url_filter.Rule("www.example.com", "/en/", block=False),
    url_filter.Rule("net", "/es/", block=True),
    url_filter.Rule("net", "/fr/", block=True),
]
#: Parts of hosts that the list of the query is made of.
SPAM_HOSTS = "casino|pills|bets|spam|adult|ads-"


@_query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every page. The list: hosts of the corpus with spam words."""
    pages = table(spark, sf_dir, "pages")
    hosts = pages.select(url_filter.host_and_path(F.col("url"))[0].alias("host"))
    return url_filter.judge(pages, RULES, hosts.filter(F.col("host").rlike(SPAM_HOSTS)))


ORACLE["op7_url_filter"] = rf"""
WITH r AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r
), f AS (
    SELECT *, CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                   WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
                   WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
                   WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
                   WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM p
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN regexp_matches(host, '{SPAM_HOSTS}') THEN 'block' ELSE 'allow' END AS verdict
FROM f
"""


@_query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that stand in documents."""
    return decontamination.findings(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op12_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of all documents, each with the mixture of sources."""
    return sharding.assign(table(spark, sf_dir, "documents"))


ORACLE["op12_interleave"] = sharding.oracle()


@_query
def op13_aho_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op13_aho_search"] = lexical_search.oracle()


@_query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector; every 7th has another label."""
    rows = hard_negatives.whole_numbers(table(spark, sf_dir, "embeddings"))
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", other))


ORACLE["op11_hard_negatives"] = hard_negatives.oracle()
