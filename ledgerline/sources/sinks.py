"""Sinks: delimited tables, id lists, JSON, Markdown and manifests.

Tables of any size are written by Spark as folders (``write_table``); reports
are small results that a person reads, as single files, local or in any store that
Spark can write to.
"""

from __future__ import annotations

import csv
import hashlib
import io
import json
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, sep: str = ",", columns: list[str] | None = None) -> None:
    """A folder of delimited files with headers, written in parallel; an empty table has a header too."""
    df = df.select(*columns) if columns else df
    df.write.mode("overwrite").csv(path, sep=sep, header=True, quote='"', escape='"', emptyValue="")


def write_text(text: str, path: str) -> None:
    """A report as one UTF-8 file: by Hadoop's file systems where the path names one (``scheme://``), else by the driver's own."""
    if "://" not in path:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_bytes(text.encode())
        return
    spark = SparkSession.getActiveSession()
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_bytes(path: str) -> bytes:
    """A report file of either kind."""
    if "://" not in path:
        return Path(path).read_bytes()
    found = SparkSession.getActiveSession().read.format("binaryFile").load(path).select("content").first()
    return bytes(found[0]) if found else b""


def write_report_csv(df: DataFrame, path: str, sep: str = ",", columns: list[str] | None = None) -> None:
    """A small result as one file, its header first; rows come to the driver a partition at a time."""
    columns = columns or df.columns
    write_rows_csv(columns, df.select(*columns).toLocalIterator(), path, sep)


def write_rows_csv(columns: list[str], rows: Iterable, path: str, sep: str = ",") -> None:
    """Rows of a small result as one file, its header first."""
    text = io.StringIO()
    out = csv.writer(text, delimiter=sep, lineterminator="\n")
    out.writerow(columns)
    out.writerows(tuple(r) for r in rows)
    write_text(text.getvalue(), path)


def write_dicts_csv(records: list[dict], path: str) -> None:
    """Records as one file with the first one's keys as header; no records give an empty file."""
    text = io.StringIO()
    if records:
        out = csv.DictWriter(text, fieldnames=list(records[0]), lineterminator="\n")
        out.writeheader()
        out.writerows(records)
    write_text(text.getvalue(), path)


def write_id_list(ids: DataFrame, path: str, column: str = "s1_id") -> None:
    """Sorted ids, one a line, in files whose names keep the order."""
    ids.select(F.col(column).cast("string").alias("value")).orderBy("value").write.mode("overwrite").text(path)


def write_match_lists(lists: DataFrame, path: str) -> None:
    """A results table, tab-separated, one row an entity, lists empty where there is no match."""
    write_table(lists, path, sep="\t")


def write_json(data: object, path: str) -> None:
    write_text(json.dumps(data, indent=2, default=str, ensure_ascii=False), path)


def markdown_table(columns: list[str], rows: list) -> str:
    """A table in Markdown; ``*Empty table*`` without rows."""
    if not rows:
        return "*Empty table*"
    line = lambda cells: "| " + " | ".join("" if c is None else str(c) for c in cells) + " |"
    return "\n".join([line(columns), line(["---"] * len(columns)), *map(line, rows)])


def frame_markdown(df: DataFrame, limit: int = 200) -> str:
    return markdown_table(df.columns, [tuple(r) for r in df.limit(limit).collect()])


def file_facts(spark: SparkSession, glob: str) -> DataFrame:
    """``path, size_bytes, line_count, sha256, valid_utf8`` of files, read by the executors."""
    files = spark.read.format("binaryFile").load(glob)
    lines = F.length(F.regexp_replace(F.col("content").cast("string"), "[^\n]", ""))
    last = F.when((F.col("length") > 0) & ~F.col("content").cast("string").endswith("\n"), 1).otherwise(0)
    return files.select("path", F.col("length").alias("size_bytes"), (lines + last).cast("long").alias("line_count"), F.sha2("content", 256).alias("sha256"), F.expr("is_valid_utf8(cast(content as string))").alias("valid_utf8"))


def manifest(paths: list[str]) -> dict[str, dict]:
    """Size, lines and SHA-256 of report files."""
    out = {}
    for p in paths:
        raw = read_bytes(p)
        lines = raw.count(b"\n") + (raw != b"" and not raw.endswith(b"\n"))
        out[p.rsplit("/", 1)[-1]] = {"path": p, "size_bytes": len(raw), "line_count": lines, "sha256": hashlib.sha256(raw).hexdigest()}
    return out


def write_validation_log(verdict, path: str, command: str = "") -> None:
    """Status, command, statistics, errors and warnings of a validation, a line each."""
    lines = [f"status: {verdict.status} ({verdict.exit_code})", f"command: {command}"]
    lines += [f"{name}: {s['n_rows']:,} rows ({s['n_empty']:,} empty, {s['n_non_empty']:,} non-empty)" for name, s in verdict.statistics.items()]
    lines += [f"error: {e}" for e in verdict.errors] + [f"warning: {w}" for w in verdict.warnings]
    write_text("\n".join(lines) + "\n", path)
