"""Tab-separated sources: records, nested match lists, id columns and list files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.measures import or_unknown
from ledgerline.functions.text import strip
from ledgerline.operators.edges import last_row_wins, repeated_in_list

#: Headers.
RECORD_HEADER = ("entity_id", "business_name", "business_address", "country")
TRUTH_HEADER = ("source1_entity_id", "matched_entity_ids")
CANDIDATE_HEADER = ("source1_entity_id", "candidate_entity_ids")


def _strings(names: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


#: Where a row that isn't of as many fields as the header is kept, to tell a missing field from an empty one.
_ODD_ROW = "__odd_row"


def _parsed_records(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """Records with ``country`` as it is: empty where the field is, Unknown where the row ends before it."""
    schema = _strings((*RECORD_HEADER, _ODD_ROW))
    # All fields are parsed whatever is asked for, or short rows wouldn't show.
    rows = spark.read.schema(schema).option("columnPruning", False).csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=multi_line, mode="PERMISSIVE", enforceSchema=True, columnNameOfCorruptRecord=_ODD_ROW)
    short = F.col("country").isNull() & F.col(_ODD_ROW).isNotNull() & (F.size(F.split(_ODD_ROW, "\t")) < len(RECORD_HEADER))
    return rows.withColumn("country", or_unknown(F.when(~short, F.coalesce("country", F.lit(""))))).drop(_ODD_ROW)


def read_records(spark: SparkSession, path: str, multi_line: bool = False, limit: int | None = None) -> DataFrame:
    """Records of a source file: four text columns, missing fields empty, a missing country Unknown, blank lines left out, ids stripped, doubled quotes within quotes.

    A large file is split; ``multi_line=True`` is for files with line breaks
    within fields, which are read whole. With ``limit`` that many records, from
    as few splits as hold them.
    """
    rows = _parsed_records(spark, path, multi_line)
    rows = rows if limit is None else rows.limit(limit)
    return rows.na.fill("").withColumn("entity_id", strip(F.col("entity_id")))


def ingest_records(records: DataFrame, path: str) -> None:
    """Stores records as Parquet by country, so that later scans are split, pruned by column and by country."""
    records.withColumn("country_part", F.col("country")).write.mode("overwrite").partitionBy("country_part").parquet(path)


def read_lists(spark: SparkSession, path: str, header: tuple[str, ...] = TRUTH_HEADER, check_duplicates: bool = True) -> DataFrame:
    """Lists of a match file, an entity a row: the last row of a repeated entity counts. Raises ValueError for another header, or a list that repeats an id."""
    head = spark.read.text(path).limit(1).collect()
    names = [c.strip() for c in head[0][0].lstrip("﻿").split("\t")] if head else []
    if names[: len(header)] != list(header):
        raise ValueError(f"{path}: header {names}, expected {list(header)}")
    rows = spark.read.schema(_strings(header)).csv(path, sep="\t", header=True, quote='"', escape='"').na.fill("")
    rows = rows.withColumn(header[0], strip(F.col(header[0]))).filter(F.col(header[0]) != "")
    if check_duplicates and (bad := repeated_in_list(rows, header[1], header[0]).limit(1).collect()):
        raise ValueError(f"{path}: {bad[0][0]} repeats an id")
    return last_row_wins(rows.withColumn("ord", F.monotonically_increasing_id()), header[0]).drop("ord")


def read_countries(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """``s1_id, country`` of a record file; an empty country stays empty, a missing one is Unknown."""
    return _parsed_records(spark, path, multi_line).select(F.col("entity_id").alias("s1_id"), "country")


def read_ids(spark: SparkSession, *paths: str) -> DataFrame:
    """Distinct ``id`` of first columns, lines split at tabs alone, headers and blank ids left out."""
    parts = []
    for path in paths:
        first = spark.read.text(path).limit(1).collect()
        lines = spark.read.text(path).select(strip(F.split("value", "\t", 2)[0]).alias("id"))
        parts.append(lines.filter((F.col("id") != "") & (F.col("id") != (first[0][0].split("\t", 1)[0].strip() if first else ""))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line, value`` of a text file, from 1. Only counts of partitions pass over the driver: a first pass counts them, a second adds where each starts."""
    lines = spark.read.text(path).select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), "value")
    sizes = dict(lines.groupBy("part").count().collect())
    start, at = [], 0
    for part in sorted(sizes):
        start.append((part, at))
        at += sizes[part]
    first = spark.createDataFrame(start, "part int, first long")
    within = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return lines.join(first, "part").select((F.col("first") + within + 1).alias("line"), "value")


@dataclass
class Catalog:
    """Logical names of files, such as ``train_S1``, and the headers that they must have."""

    spark: SparkSession
    paths: dict[str, str]
    headers: dict[str, tuple[str, ...]] = field(default_factory=dict)
    #: Whether record files have line breaks within fields.
    multi_line: bool = False

    def exists(self, name: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.paths[name])
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def checks(self) -> DataFrame:
        """``check, passed``: each file's existence and header."""
        rows = []
        for name, path in self.paths.items():
            there = self.exists(name)
            head = self.spark.read.text(path).limit(1).collect() if there else []
            want = self.headers.get(name, TRUTH_HEADER if name.endswith("GT") else RECORD_HEADER)
            rows += [(f"{name}_exists", there), (f"{name}_header_valid", bool(head) and [c.strip() for c in head[0][0].split("\t")] == list(want))]
        return self.spark.createDataFrame(rows, "check string, passed boolean")

    def records(self, name: str, limit: int | None = None) -> DataFrame:
        return read_records(self.spark, self.paths[name], self.multi_line, limit)

    def truth(self, name: str = "train_GT") -> DataFrame:
        return read_lists(self.spark, self.paths[name])


def telemetry(spark: SparkSession) -> dict[str, object]:
    """What the session runs on, and the driver's peak memory in MB."""
    import os
    import platform
    import resource
    import sys

    peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    return {
        "python": platform.python_version(),
        "platform": platform.platform(),
        "cpus": os.cpu_count(),
        "spark": spark.version,
        "master": spark.sparkContext.master,
        "parallelism": spark.sparkContext.defaultParallelism,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "peak_rss_mb": peak / (1024 * 1024 if sys.platform == "darwin" else 1024),
    }
