"""Frames written to the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder's URI below the cluster's ``spark.checkpoint.dir``.

    Only where none is named and driver and executors are one process (tests, a single machine) a temporary folder is set instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            base = current.get()
        elif not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        else:
            base = "file://" + tempfile.mkdtemp(prefix="prospectra-")
            spark.sparkContext.setCheckpointDir(base)
    if "://" not in base and base.startswith("/"):
        base = f"file://{base}"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it again: lineage ends there and no executor's loss undoes it."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out to all cores by their keys, for work that is large beside its input.

    A file is read by as many tasks as it has row groups, often one; and few bytes are put into few partitions, unless their number is given.
    """
    spark = df.sparkSession
    return df.repartition(max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)
