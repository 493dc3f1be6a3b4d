"""Reading yearly files, the codelist and the decision store.

Headers differ from year to year, in wording and in order, and a reader given
files of several years would align their columns by position. Files are
therefore grouped by header, each group is read at once, and the groups are
put together by canonical name.

The place of a row in its file decides about claims later on, so rows are
numbered exactly, however Spark cuts large files into splits and packs small
files into one task: see ``numbered``.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import na_to_null
from ..operators.lookup import lookup
from .columns import REQUIRED, MissingColumns, normalise_headers, to_canonical
from .scratch import materialise

# Period in a file name: four digits of the year before three of the month.
PERIOD = r"_(\d{4})\d{3}\.\w+$"
OPEN_AT_ONCE = 32  # headers that the driver reads at the same time
_UNUSABLE = "_malformed"


@dataclass(frozen=True)
class Part:
    """A file of text. ``source`` is the name of the yearly file: the file's
    own, or that of its folder where a yearly file is a folder of parts."""

    path: str
    uri: str  # as Spark names it next to rows
    source: str


@dataclass(frozen=True)
class YearlyFiles:
    """A panel, the files that are not in it with the reason, and the rows with
    more or fewer values than their file has columns: (source_file, year, pos,
    kind, text)."""

    panel: DataFrame
    problems: dict[str, str]
    malformed: DataFrame

    def counts(self) -> DataFrame:
        """Rows of every file: usable, too short, too long or otherwise not readable."""
        rows = self.panel.select("source_file", "year", F.lit("usable").alias("kind"))
        rows = rows.unionByName(self.malformed.select("source_file", "year", "kind"))
        return rows.groupBy("source_file", "year", "kind").agg(F.count("*").alias("n"))


def list_parts(spark: SparkSession, folder: str, pattern: str) -> list[Part]:
    """The matching files in a folder or one level below it, in order. File
    contents are not read."""
    files = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True).load(folder)
    paths = sorted(row.path for row in files.select("path").collect())
    if not paths:
        return []
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    top = hadoop(folder)
    root = top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toString().rstrip("/")
    parts = []
    for path in paths:
        inner = path.removeprefix(root).lstrip("/").split("/") if path.startswith(root + "/") else [file_name(path)]
        if len(inner) <= 2:
            parts.append(Part(path, hadoop(path).toUri().toString(), inner[0]))
    return sorted(parts, key=lambda p: (p.source, p.path))


def file_name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def first_record(spark: SparkSession, path: str, sep: str) -> list[str]:
    """The values of a file's first record, which may hold quoted line breaks.
    Only the file's beginning is read, by the file system's client: no job."""
    jvm = spark._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(spark._jsc.hadoopConfiguration()).open(file)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        text = reader.readLine()
        while text is not None and not text.strip():
            text = reader.readLine()
        while text is not None and text.count('"') % 2:
            more = reader.readLine()
            if more is None:
                break
            text += "\n" + more
    finally:
        reader.close()
    return next(csv.reader([text.removeprefix("\ufeff")], delimiter=sep), []) if text else []


def headers(spark: SparkSession, paths: list[str], sep: str) -> dict[str, tuple[str, ...]]:
    """Normalised column names of every file."""
    with ThreadPoolExecutor(OPEN_AT_ONCE) as pool:
        names = pool.map(lambda p: tuple(normalise_headers(first_record(spark, p, sep))), paths)
        return dict(zip(paths, names))


def scan(
    spark: SparkSession, paths: list[str], header: tuple[str, ...], sep: str, multi_line: bool = False
) -> DataFrame:
    """Files of one header as text columns, every spelling of a missing value
    as NULL, with where a row was read (``_uri``, ``_split``, ``_in_task``) and,
    for rows of more or fewer values than columns, their text. ``multi_line``
    allows line breaks in values, at the price of one task per file."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*header, _UNUSABLE)])
    rows = spark.read.csv(
        paths, schema=schema, sep=sep, header=True, quote='"', escape='"', multiLine=multi_line, mode="PERMISSIVE",
        columnNameOfCorruptRecord=_UNUSABLE,
    )
    return rows.select(
        F.col("_metadata.file_path").alias("_uri"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_in_task"),
        _UNUSABLE,
        *(na_to_null(F.col(f"`{name}`")).alias(name) for name in header),
    )


def numbered(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Stored rows of ``scan`` with the columns of ``files`` (``_uri``,
    ``_rank``, ``scope`` and others) and ``pos``, their place from 0 among the
    rows of the scope, in order of rank, split and place in the split.

    A task numbers the rows of all splits it reads one after another, so the
    place in a split is the number less the split's first one, and the rows
    before it are those of earlier splits: sums over one row per split."""
    splits = rows.groupBy("_uri", "_split").agg(F.min("_in_task").alias("_first"), F.count("*").alias("_n"))
    files = files.withColumnRenamed("_uri", "_of")
    splits = splits.join(F.broadcast(files), F.col("_uri") == F.col("_of")).drop("_of")  # a row for each file listed
    earlier = Window.partitionBy("scope").orderBy("_rank", "_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = materialise(splits.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))), "splits")
    placed = lookup(rows, splits, ["_uri", "_split"], weight="_n")
    pos = F.col("_before") + F.col("_in_task") - F.col("_first")
    return placed.withColumn("pos", pos).drop("_uri", "_split", "_in_task", "_first", "_before", "_rank")


def _listed(spark: SparkSession, parts: Iterable[Part], scopes: Iterable[int]) -> DataFrame:
    rows = [(p.uri, i, scope, p.source) for i, (p, scope) in enumerate(zip(parts, scopes))]
    return spark.createDataFrame(rows, "_uri string, _rank long, scope int, source_file string")


def read_files(spark: SparkSession, parts: list[Part], header: tuple[str, ...], sep: str) -> DataFrame:
    """Files of one header as text columns with ``source_file`` and ``pos``."""
    rows = materialise(scan(spark, [p.path for p in parts], header, sep), "lines")
    return numbered(rows, _listed(spark, parts, [0] * len(parts))).drop("scope", _UNUSABLE)


def malformed_kind(text, n_columns, sep: str):
    """Whether a malformed row has too few or too many values. Separators
    within quotes do not count."""
    plain = F.regexp_replace(text, '"[^"]*"', "")
    n = F.length(plain) - F.length(F.replace(plain, F.lit(sep), F.lit(""))) + 1
    return F.when(n < n_columns, "short").when(n > n_columns, "long").otherwise("unreadable")


def read_panel(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.tsv",
    sep: str = "\t",
    period: str = PERIOD,
    start_year: int | None = None,
    required: tuple[str, ...] = REQUIRED,
    multi_line: bool = False,
) -> YearlyFiles:
    """All yearly files of a folder as one panel of canonical columns with
    ``year``, and ``pos`` numbering the rows of a year by file name and place.
    A yearly file may be a folder of parts, as Spark writes it. Files before
    ``start_year`` are not opened. A file without a period in its name or
    without a required column is left out and named; a row whose number of
    values is not that of the header is listed as malformed, neither padded
    nor cut. The rows are stored once, to be numbered."""
    problems, parts, years = {}, [], {}
    for part in list_parts(spark, folder, pattern):
        found = re.search(period, part.source)
        if found is None:
            problems[part.source] = "no period in the file name"
        elif start_year is None or int(found.group(1)) >= start_year:
            parts.append(part)
            years[part.source] = int(found.group(1))
    groups = defaultdict(list)
    for part, header in zip(parts, headers(spark, [p.path for p in parts], sep).values()):
        groups[header].append(part)
    tables = []
    for header, group in groups.items():
        rows = scan(spark, [p.path for p in group], header, sep, multi_line)
        try:
            columns = to_canonical(rows, required).columns
        except MissingColumns as missing:
            problems |= {p.source: str(missing) for p in group}
            continue
        where = ["_uri", "_split", "_in_task", _UNUSABLE]
        kind = F.when(F.col(_UNUSABLE).isNotNull(), malformed_kind(F.col(_UNUSABLE), F.lit(len(header)), sep))
        chosen = to_canonical(rows.withColumn("kind_", kind), required, extra=(*where, "kind_"))
        tables.append(chosen.select(*where, "kind_", *columns))
    if not tables:
        raise FileNotFoundError(f"no usable files in {folder}: {problems}")
    rows = materialise(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables), "panel-lines")
    panel = numbered(rows, _listed(spark, parts, [years[p.source] for p in parts])).withColumnRenamed("scope", "year")
    odd = panel.filter(F.col(_UNUSABLE).isNotNull()).select(
        "source_file", "year", "pos", F.col("kind_").alias("kind"), F.col(_UNUSABLE).alias("text")
    )
    return YearlyFiles(panel.filter(F.col(_UNUSABLE).isNull()).drop(_UNUSABLE, "kind_"), problems, odd)


def read_codelist(spark: SparkSession, path: str) -> DataFrame:
    """Legal forms with their line, as the last of several lines counts."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    file = file.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(file)
    part = Part(path, file.toUri().toString(), file_name(path))
    rows = read_files(spark, [part], headers(spark, [path], ",")[path], ",")
    return rows.select(
        F.col("pos").alias("line_no"),
        F.col("chodnota1").alias("code"),
        F.col("text1").alias("official"),
        F.col("text2").alias("form_group"),
    )


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """The decision store; rows without a decision do not count."""
    columns = ("y1_composite_id", "y2_composite_id", "decision", "seq")
    schema = ", ".join(f"{c} string" for c in columns)
    rows = spark.read.csv(path, schema=schema, sep="\t", header=True, quote='"', escape='"')
    return rows.filter(F.col("decision").isNotNull()).withColumn("seq", F.col("seq").cast("bigint"))


def read_review_queue(spark: SparkSession, path: str) -> DataFrame:
    """A review queue as a person left it, blanks for missing values."""
    parts = list_parts(spark, path, "*.csv")
    if not parts:
        raise FileNotFoundError(f"no review queue in {path}")
    header = headers(spark, [parts[0].path], "\t")[parts[0].path]
    return read_files(spark, parts, header, "\t").drop("source_file").withColumnRenamed("pos", "queue_no").na.fill("")


def pair_datasets(missing_files: list[str], enriched_files: list[str]) -> tuple[list[tuple[str, str]], list[str]]:
    """Files of unresolved IDs with the enriched file of the same name, and
    those that have none."""
    enriched = {file_name(p).replace("_ENRICHED.tsv", ""): p for p in enriched_files}
    pairs, alone = [], []
    for path in missing_files:
        other = enriched.get(file_name(path).replace("_MISSING_ICO.tsv", ""))
        pairs.append((path, other)) if other else alone.append(path)
    return pairs, alone
