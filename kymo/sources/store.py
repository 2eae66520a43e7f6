"""The cluster's shared folder, and the columns recordings are partitioned by."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

PARTITIONS = ("dataset_id", "recording_id")


def scratch_dir(spark: SparkSession) -> str:
    """New folder below the cluster's shared one.

    Only a local session, whose tasks share the driver's disk, may go without the setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="spark-")
    return f"{shared.rstrip('/')}/kymo-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """The table written to the shared folder and read back: computed once, whoever is lost."""
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
