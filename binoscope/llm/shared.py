"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from binoscope.session import shared_folder


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, computed once and kept as Parquet in the shared folder until the driver's JVM ends.

    It survives lost executors and cuts the lineage; later reads take only the columns they need.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(folder)


def findable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver did; a cluster gets it by --py-files."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
