"""Where intermediate tables go.

Lineage is cut with written tables in the folder the cluster names in ``spark.checkpoint.dir``, so
a lost executor never loses an intermediate result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named
    if current is not None:
        return current
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Computes ``df`` once, as a table in the shared folder, and continues from there.

    Unlike a checkpoint the table has a known size and separate columns, so later joins are planned
    from real sizes and read only what they use.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stored")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Spreads a table scan with fewer splits than cores over all cores, before heavy row work.

    A large table has enough splits and is left alone, so its rows are not moved.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)
