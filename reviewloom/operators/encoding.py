"""Label maps: fit, apply, invert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.plans.joins import lookup_join
from reviewloom.plans.ordering import rank_distinct


def fit_label_map(df: DataFrame, label: str) -> DataFrame:
    """Sorted distinct labels, in the order of their own type, numbered from 0."""
    distinct = df.select(F.col(label).alias("label")).filter(F.col("label").isNotNull()).distinct()
    return rank_distinct(distinct, [F.col("label")], "idx")


def target_list(df: DataFrame, label: str, order: str) -> DataFrame:
    """Distinct labels by first appearance."""
    firsts = df.groupBy(F.col(label).alias("label")).agg(F.min(order).alias("first_seen"))
    return rank_distinct(firsts, [F.col("first_seen"), F.col("label")], "position")


def unseen_labels(df: DataFrame, label_map: DataFrame, label: str) -> DataFrame:
    """Labels of ``df`` that the map does not know."""
    present = df.select(F.col(label).alias("label")).filter(F.col("label").isNotNull()).distinct()
    return present.join(label_map, "label", "left_anti")


def encode_labels(
    df: DataFrame, label_map: DataFrame, label: str, out: str = "labels", invalid: str = "error"
) -> DataFrame:
    """Adds the index of each label; unknown labels raise, or with ``invalid`` stay null or go."""
    if invalid == "error" and not unseen_labels(df, label_map, label).isEmpty():
        raise ValueError(f"{label} holds labels the map was not fitted on")
    named = label_map.select(F.col("label").alias(label), F.col("idx").alias(out))
    return lookup_join(df, named, label, "inner" if invalid == "skip" else "left")


def decode_labels(
    df: DataFrame, label_map: DataFrame, index: str, out: str = "prediction"
) -> DataFrame:
    """Adds the label of each index; a missing index gives a missing label."""
    typed = label_map.select(
        F.col("idx").cast(df.schema[index].dataType).alias(index), F.col("label").alias(out)
    )
    return lookup_join(df, typed, index, "left")
