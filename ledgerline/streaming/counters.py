"""Running counters over file streams; each restarts from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.functions.measures import or_unknown, source_tag
from ledgerline.operators.audits import placeholder_field_summary
from ledgerline.sources.tsv import RECORD_HEADER, _strings


def record_stream(spark: SparkSession, folder: str, files_per_batch: int = 16) -> DataFrame:
    """Records of tab-separated files as they arrive in a folder."""
    reader = spark.readStream.schema(_strings(RECORD_HEADER)).option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder, sep="\t", header=True, quote='"', escape='"').na.fill("")


def running_placeholder_summary(records: DataFrame, dataset: str, source: str) -> DataFrame:
    """The missingness summary of all records so far (complete mode); its state is a row a group."""
    return placeholder_field_summary(records.withColumn("dataset", F.lit(dataset)).withColumn("source", F.lit(source)))


def running_country_counts(edges: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """Edges so far by entity country and target source, and those within one country (complete mode). Records are static tables; an edge counts as often as it arrives."""
    left = s1.select(F.col("entity_id").alias("s1_id"), or_unknown(F.col("country")).alias("s1_country"))
    right = targets.select(F.col("entity_id").alias("target_id"), or_unknown(F.col("country")).alias("target_country"))
    rows = edges.join(left, "s1_id").join(right, "target_id").withColumn("target_source", source_tag(F.col("target_id")))
    return rows.groupBy("s1_country", "target_source").agg(F.count(F.lit(1)).alias("total_edges"), F.count_if(F.col("s1_country") == F.col("target_country")).alias("same_country_edges"))


def _states(spark: SparkSession, path: str) -> list:
    """Folders of whole states, in order."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/*/_SUCCESS")
    found = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(top)
    return sorted((f.getPath().getParent() for f in found or []), key=lambda p: p.getName())


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The last whole state that ``start`` wrote; raises ValueError where there is none."""
    states = _states(spark, path)
    if not states:
        raise ValueError(f"{path} has no state")
    return spark.read.parquet(states[-1].toString())


def start(df: DataFrame, path: str, checkpoint: str, mode: str = "complete", once: bool = True) -> StreamingQuery:
    """Writes each state of a running table in a folder of its own under ``path``; with ``once``, for what is there now.

    A state is whole once its folder has Spark's mark of success; only then do
    those before it go, so a crash loses none. ``latest`` reads the last.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{number:020d}")
        for older in _states(batch.sparkSession, path)[:-1]:
            older.getFileSystem(batch.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(older, True)

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(save)
    return (writer.trigger(availableNow=True) if once else writer).start()
