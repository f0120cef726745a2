"""Tables that are written to the folder all executors share, to cut lineage."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset and driver and executors are one process, a temporary one is set for the session. Raises RuntimeError on a cluster without it."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder.rstrip("/")


#: Rows that go to a Python worker at a time, and the setting that says so.
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
SPARKS_OWN, TEXTS_AT_ONCE = 10_000, 1000


def small_batches(df: DataFrame) -> DataFrame:
    """The same table in a copy of its session that sends texts to Python workers in small batches, which bounds the workers' memory.

    The caller's session keeps its settings. Where it has another batch size
    than Spark's own, that holds and the table stays as it is.
    """
    spark = df.sparkSession
    if int(spark.conf.get(BATCH_SETTING)) != SPARKS_OWN:
        return df
    copy = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    copy._jsparkSession.conf().set(BATCH_SETTING, str(TEXTS_AT_ONCE))
    plan = df._jdf.queryExecution().analyzed()
    return DataFrame(spark.sparkContext._jvm.org.apache.spark.sql.classic.Dataset.ofRows(copy._jsparkSession, plan), copy)


class Shared:
    """Writes tables under one run's own folder and reads them back: computed once, and kept when executors are lost.

    Results read from them, so they stay until ``close``, or the driver's end.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        atexit.register(self.close)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _delete(self, folder: str) -> None:
        path = self._path(folder)
        path.getFileSystem(self._hadoop).delete(path, True)

    def drop(self, name: str) -> None:
        """Removes a table that no later step reads."""
        self._delete(f"{self.root}/{name}")

    def close(self) -> None:
        """Removes all tables; nothing is left to do where the JVM is gone."""
        atexit.unregister(self.close)
        with contextlib.suppress(OSError, Py4JError):
            self._delete(self.root)
