"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import math
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How many rows one task may be asked to sort at once; beyond it ordered work is split into value ranges.
ROWS_PER_BUCKET = 2_000_000
ROWS_PER_BUCKET_CONF = "binoscope.rowsPerBucket"
# Rows that are read again and again, as by a fit: tables of more than so many rows are worth several tasks, a few a core.
ROWS_PER_TASK = 20_000
TASKS_PER_CORE = 3


def get_session(app: str = "binoscope", cores: str | int = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session spark-submit gives you."""
    builder = (SparkSession.builder.appName(app).master(f"local[{cores}]")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def rows_per_bucket(spark: SparkSession) -> int:
    return int(spark.conf.get(ROWS_PER_BUCKET_CONF, str(ROWS_PER_BUCKET)))


def held(df: DataFrame) -> DataFrame:
    """The rows, kept for many passes in tasks of about equal size; the caller lets them go by `unpersist`.

    A file with one row group is one task, however many cores there are. Such rows are dealt out once, round robin; rows
    that lie in tasks enough, and small tables, stay where they are.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    sizes = [r["n"] for r in kept.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()]
    rows = sum(sizes)
    tasks = min(math.ceil(rows / ROWS_PER_TASK), TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)
    if tasks <= 1 or max(sizes) <= 2 * rows / tasks:
        return kept
    dealt = kept.repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    dealt.count()               # now it is there, and the first copy can go
    kept.unpersist()
    return dealt


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster; local sessions get one of their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that every executor can reach.")
    folder = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage through a reliable checkpoint, which survives lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
