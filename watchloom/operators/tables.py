"""Tables written to the cluster's shared folder, and row numbers without a single task."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Bytes of an Arrow batch that is sent to a Python worker; one row may exceed them. Bytes that opening a small file counts as.
BATCH_BYTES, OPEN_BYTES = 4 << 20, 64 << 10


def bounded(spark: SparkSession) -> SparkSession:
    """The session with Arrow batches bounded by bytes: what a Python worker holds doesn't grow with long rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def few_tasks(spark: SparkSession) -> SparkSession:
    """The session with many small files listed and read in a few tasks a core; as set, a folder or every few files are a task."""
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * spark.sparkContext.defaultParallelism))
    spark.conf.set("spark.sql.files.openCostInBytes", str(OPEN_BYTES))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir. Only a local session without that setting gets one of its own; a cluster must name it."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        top = "file://" + tempfile.mkdtemp(prefix="watchloom-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df as Parquet in a new shared folder, read again."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, *order: Column | str, name: str = "nth", start: int = 0) -> DataFrame:
    """rows with `name` from `start` on in this order: a range shuffle, a count a range, a window within each range."""
    parts = written(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    at, starts = start, []
    for r in parts.groupBy("_range").count().orderBy("_range").collect():  # a row a partition
        starts.append((r["_range"], at))
        at += r["count"]
    first = F.broadcast(parts.sparkSession.createDataFrame(starts, "_range int, _start long"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return parts.withColumn(name, place).join(first, "_range").withColumn(name, (F.col(name) + F.col("_start")).cast("long")).drop("_range", "_start")
