"""Exact, reproducible splits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from reviewloom.plans.joins import lookup_join, small_rows
from reviewloom.plans.ordering import (
    bucket_sizes,
    hash_cuts,
    hash_ordered_index,
    rank_distinct,
    seeded_hash,
)

TRAIN, VAL, TEST = "train", "val", "test"


def shuffled(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Every row with its place in a seeded random order."""
    return hash_ordered_index(df, key, seed)


def largest_remainder(sizes: Sequence[int], target: int) -> list[int]:
    """Shares ``target`` places in proportion to ``sizes``; equal remainders favour the earlier."""
    total = sum(sizes)
    if total == 0:
        return [0 for _ in sizes]
    shares = [size * target // total for size in sizes]
    by_remainder = sorted(range(len(sizes)), key=lambda i: (-(sizes[i] * target % total), i))
    for i in by_remainder[: target - sum(shares)]:
        shares[i] += 1
    return shares


def allocate(classes: DataFrame, label: str, size: str, target: int, out: str) -> DataFrame:
    """:func:`largest_remainder` as a distributed plan, for more classes than the driver takes.

    Ties go to the smaller label. All arithmetic is on integers.
    """
    total = classes.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    if total == 0:
        return classes.withColumn(out, F.lit(0).cast("bigint"))
    product = F.col(size).cast("decimal(19,0)") * F.lit(target).cast("decimal(19,0)")
    shares = (
        classes.withColumn("__product", product)
        .withColumn("__floor", F.expr(f"__product div {total}"))
        .withColumn("__remainder", F.col("__product") % F.lit(total))
    )
    left = target - shares.agg(F.sum("__floor")).first()[0]
    ranked = rank_distinct(shares, [F.col("__remainder").desc(), F.col(label)], "__place")
    extra = (F.col("__place") < F.lit(left)).cast("bigint")
    return ranked.withColumn(out, F.col("__floor") + extra).select(*classes.columns, out)


def _class_sizes(sizes: DataFrame, label: str) -> tuple[DataFrame, int, list | None]:
    """Rows per class, their total, and the sorted rows themselves when there are few classes."""
    classes = sizes.groupBy(label).agg(F.sum("__size").alias("n"))
    rows = small_rows(classes)
    if rows is None:
        total, missing = classes.agg(F.sum("n"), F.count(F.when(F.col(label).isNull(), 1))).first()
    else:
        total = sum(row["n"] for row in rows)
        missing = sum(row[label] is None for row in rows)
    if missing:
        raise ValueError(f"{label} has missing values; drop them first")
    return classes, total, sorted(rows, key=lambda r: r[label]) if rows is not None else None


def _split_ranks(sizes: DataFrame, label: str) -> DataFrame:
    """(label, train_upto, val_upto): where train and val end in the order of each class."""
    classes, total, rows = _class_sizes(sizes, label)
    hold = (total + 4) // 5
    n_train, n_val = total - hold, hold - (hold + 1) // 2
    if rows is None:
        if not classes.filter(F.col("n") < 2).isEmpty():
            raise ValueError("a class with fewer than two rows cannot be split")
        with_train = allocate(classes, label, "n", n_train, "train_upto")
        rest = with_train.withColumn("left", F.col("n") - F.col("train_upto"))
        with_val = allocate(rest, label, "left", n_val, "val_n")
        return with_val.select(
            label, "train_upto", (F.col("train_upto") + F.col("val_n")).alias("val_upto")
        )
    counts = [row["n"] for row in rows]
    if any(count < 2 for count in counts):
        raise ValueError("a class with fewer than two rows cannot be split")
    train = largest_remainder(counts, n_train)
    val = largest_remainder([count - t for count, t in zip(counts, train)], n_val)
    schema = StructType([sizes.schema[label]]).add("train_upto", LongType()).add("val_upto", LongType())
    return sizes.sparkSession.createDataFrame(
        [(row[label], t, t + v) for row, t, v in zip(rows, train, val)], schema
    )


def stratified_split(df: DataFrame, label: str, key: str, seed: int = 0) -> DataFrame:
    """Adds a ``split`` column: train 80 %, val and test 10 % each, every class in proportion.

    The hold-out is a fifth of the rows, rounded up, and its test half is rounded up too. Within a
    class, rows go to train, val and test by their seeded hash order. That takes two cut points per
    class, found from narrow counts, so no row has to move: each one is compared with the cuts.
    """
    sizes = bucket_sizes(df, key, seed, label)
    cuts = hash_cuts(df, key, seed, label, sizes, _split_ranks(sizes, label), ["train_upto", "val_upto"])
    point = F.struct(seeded_hash(key, seed).alias("hash"), F.col(key).alias("key"))
    return (
        lookup_join(df, cuts, label, "left")
        .withColumn(
            "split",
            F.when(point <= F.col("train_upto"), F.lit(TRAIN))
            .when(point <= F.col("val_upto"), F.lit(VAL))
            .otherwise(F.lit(TEST)),
        )
        .drop("train_upto", "val_upto")
    )


def stratified_sample(df: DataFrame, label: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows with every class in proportion; all rows when there are no more than that."""
    sizes = bucket_sizes(df, key, seed, label)
    classes, total, rows = _class_sizes(sizes, label)
    if total <= n:
        return df
    if rows is None:
        ranks = allocate(classes, label, "n", n, "upto")
    else:
        shares = largest_remainder([row["n"] for row in rows], n)
        ranks = df.sparkSession.createDataFrame(
            [(row[label], share) for row, share in zip(rows, shares)],
            StructType([df.schema[label]]).add("upto", LongType()),
        )
    cuts = hash_cuts(df, key, seed, label, sizes, ranks.select(label, "upto"), ["upto"])
    point = F.struct(seeded_hash(key, seed).alias("hash"), F.col(key).alias("key"))
    return lookup_join(df, cuts, label).filter(point <= F.col("upto")).drop("upto")


def final_training_set(*splits: DataFrame) -> DataFrame:
    """All splits under each other, columns matched by name, duplicates kept."""
    result = splits[0]
    for other in splits[1:]:
        result = result.unionByName(other, allowMissingColumns=True)
    return result


def split_overlaps(df: DataFrame, key: str) -> DataFrame:
    """For every pair of splits, the number of keys found in both."""
    flags = [F.max((F.col("split") == s).cast("int")).alias(s) for s in (TRAIN, VAL, TEST)]
    per_key = df.groupBy(key).agg(*flags)
    pairs = [(TRAIN, VAL), (TRAIN, TEST), (VAL, TEST)]
    return per_key.agg(
        *[
            F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0)).cast("bigint").alias(f"{a}_{b}")
            for a, b in pairs
        ]
    )
