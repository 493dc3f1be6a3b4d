"""Writing panels, excluded rows, reviews and reports."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tab-separated text that keeps values as they are: Spark's writer would trim
# them and write "" for blanks.
TEXT_TABLE = {
    "sep": "\t", "header": True, "quote": '"', "escape": '"', "nullValue": "", "emptyValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def write_panel(panel: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The panel as Parquet, one folder per year."""
    panel.write.mode(mode).partitionBy("year").parquet(path)


def write_run_table(table: DataFrame, path: str) -> None:
    """Counts and lists that a run leaves for its operators."""
    table.write.mode("overwrite").parquet(path)


def write_identified(identified: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Kept and excluded rows in one pass, one folder per reason and year."""
    reason = F.coalesce("reason", F.lit("KEPT"))
    identified.withColumn("reason", reason).write.mode(mode).partitionBy("reason", "year").parquet(path)


def write_exchange(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated text for other tools, missing values blank. Rows that name
    their file go to one folder per file."""
    writer = df.write.mode(mode)
    if "source_file" in df.columns:
        writer = writer.partitionBy("source_file")
    writer.csv(path, **TEXT_TABLE)


def write_yearly(panel: DataFrame, path: str) -> list[str]:
    """Yearly texts under the names of the files the rows came from, in order
    of ``pos``, each a folder of parts as ``read_panel`` reads them. Parts are
    written aside and take their names when all are complete; what had such a
    name before is replaced. Returns the names."""
    spark = panel.sparkSession
    aside = f"{path.rstrip('/')}/_writing-{uuid.uuid4().hex}"
    ordered = panel.repartitionByRange("source_file", "pos").sortWithinPartitions("source_file", "pos").drop("pos")
    ordered.write.partitionBy("source_file").csv(aside, **TEXT_TABLE)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(aside).getFileSystem(spark._jsc.hadoopConfiguration())
    names = []
    for found in files.listStatus(hadoop(aside)):
        name = found.getPath().getName()
        if name.startswith("source_file="):
            to = hadoop(hadoop(path), unquote(name.removeprefix("source_file=")))
            files.delete(to, True)
            if not files.rename(found.getPath(), to):
                raise OSError(f"could not name {to}")
            names.append(to.getName())
    files.delete(hadoop(aside), True)
    return sorted(names)


def append_decisions(decisions: DataFrame, path: str) -> None:
    """Add decisions to the store."""
    columns = ["y1_composite_id", "y2_composite_id", "decision", "seq"]
    decisions.select(columns).write.mode("append").csv(path, **TEXT_TABLE)


def write_review_queue(queue: DataFrame, path: str) -> None:
    """The review queue in order of group and loan; an empty one replaces what
    was there."""
    ordered = queue.orderBy("group_id", "y1_composite_id", "y2_composite_id")
    ordered.write.mode("overwrite").csv(path, **TEXT_TABLE)


def write_report(lines: DataFrame, path: str) -> None:
    """Report texts, one per file, in order."""
    lines.select("value").write.mode("overwrite").text(path)
