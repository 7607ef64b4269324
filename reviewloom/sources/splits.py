"""Split tables as CSV or Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Quotes are doubled inside fields and an empty text stays different from a missing one.
_CSV = {"header": "true", "escape": '"', "nullValue": "\\N", "emptyValue": ""}


def write_split_csv(df: DataFrame, path: str) -> None:
    """Loss-free CSV: texts may hold quotes, line breaks, commas and outer blanks."""
    (
        df.write.options(**_CSV)
        .option("quoteAll", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


def read_split_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Reads with a given schema. Texts may span lines, so a file is one task: write many files."""
    return (
        spark.read.schema(schema)
        .options(**_CSV)
        .option("multiLine", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_split_parquet(df: DataFrame, path: str) -> None:
    df.write.partitionBy("split").parquet(path)


def read_split_parquet(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """All splits, or one of them: the others' folders are not read."""
    table = spark.read.parquet(path)
    return table if split is None else table.filter(F.col("split") == split)
