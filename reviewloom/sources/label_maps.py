"""Label maps as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_label_map(label_map: DataFrame, path: str) -> None:
    label_map.write.mode("overwrite").parquet(path)


def load_label_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
