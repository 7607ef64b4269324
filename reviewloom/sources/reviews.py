"""Raw reviews: one object per line, as JSON or as a literal, usually gzipped."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_FIELDS = (
    "reviewerID string, asin string, reviewerName string, helpful array<bigint>, "
    "reviewText string, overall double, summary string, unixReviewTime bigint, reviewTime string"
)
REVIEW_SCHEMA = f"{_FIELDS}, _corrupt_record string"


def _as_json(line: str | None) -> str | None:
    """The JSON of a line that is a dictionary literal; None for anything else. Nothing is ever evaluated."""
    if line is None:
        return None
    try:
        found = ast.literal_eval(line.strip())
        return json.dumps(found) if isinstance(found, dict) else None
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None


@F.pandas_udf(StringType())
def _literals(lines: pd.Series) -> pd.Series:
    return lines.map(_as_json)


def read_reviews(
    spark: SparkSession, path: str, mode: str = "PERMISSIVE", partitions: int | None = None, literals: bool = True
) -> DataFrame:
    """Reads with a fixed schema: absent keys are null, unreadable lines land in _corrupt_record.

    Single-quoted keys and values are accepted. Lines that are no JSON but literals, as with a bare ``None`` or ``True``,
    are read in a second step, in batches, unless ``literals`` is off; JSON lines never leave the JVM as text. A
    gzip file cannot be split, so one huge file needs ``partitions`` to spread its rows after the read; many files
    need nothing.
    """
    lenient = literals and mode == "PERMISSIVE"
    reviews = spark.read.schema(REVIEW_SCHEMA).option("mode", mode).json(path)
    if partitions:
        reviews = reviews.repartition(partitions)
    if not lenient:
        return reviews
    names = [f.split(" ")[0] for f in _FIELDS.split(", ")]
    # A literal that does not fit the schema stays unreadable.
    second = F.from_json(_literals("_corrupt_record"), REVIEW_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt_record"})
    found = reviews.withColumn("__second", second)
    told = F.col("__second").isNotNull() & F.col("__second._corrupt_record").isNull()
    return found.select(
        *[F.when(told, F.col(f"__second.{n}")).otherwise(F.col(n)).alias(n) for n in names],
        F.when(~told, F.col("_corrupt_record")).alias("_corrupt_record"),
    )


def line_counts(reviews: DataFrame) -> DataFrame:
    """One row (n_lines, n_unreadable)."""
    # Spark reads no file for the unreadable part alone, and a line is judged by the columns that are read: take all.
    known = F.xxhash64(*reviews.columns) % 2 == 0
    return reviews.agg(
        (F.count_if(known) + F.count_if(~known)).alias("n_lines"), F.count("_corrupt_record").alias("n_unreadable")
    )


def write_reviews(reviews: DataFrame, path: str) -> None:
    reviews.write.option("compression", "gzip").json(path)
