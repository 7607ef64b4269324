"""Dense row numbers, cut points and running maxima without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.plans.joins import local_copy
from reviewloom.plans.storage import materialise

# Leading hex digits of the hash that name a bucket: 65,536 even buckets in hash order.
BUCKET_DIGITS = 4
# Rows per chunk in the two-level running maximum.
CHUNK = 65_536


def seeded_hash(key: Column | str, seed: int | str) -> Column:
    column = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), column.cast("string")))


def _with_group(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The group as one struct column: unlike plain columns, structs holding nulls still join."""
    if not by:
        return df, []
    return df.withColumn("__group", F.struct(*by)), ["__group"]


def _bucket_offsets(bucketed: DataFrame, group: Sequence[str], weight: Column) -> DataFrame:
    """Total weight in earlier buckets of the same group; one row per group and bucket."""
    sizes = bucketed.groupBy(*group, "__bucket").agg(F.sum(weight).alias("__size"))
    running = Window.partitionBy(*group).orderBy("__bucket")
    return sizes.select(
        *group, "__bucket", (F.sum("__size").over(running) - F.col("__size")).alias("__before")
    )


def hash_ordered_index(
    df: DataFrame, key: str, seed: int | str, by: Sequence[str] = (), out: str = "row_index"
) -> DataFrame:
    """0-based position of each row in the seeded hash order of its unique ``key``.

    The hash prefix is a bucket whose order is the global order, so ranking inside buckets and
    adding the sizes of the earlier buckets gives the global position.
    """
    grouped, group = _with_group(df, by)
    keyed = grouped.withColumn("__hash", seeded_hash(key, seed)).withColumn(
        "__bucket", F.substring("__hash", 1, BUCKET_DIGITS)
    )
    offsets = _bucket_offsets(keyed, group, F.lit(1))
    inside = Window.partitionBy(*group, "__bucket").orderBy("__hash", key)
    return (
        keyed.withColumn("__rank", F.row_number().over(inside))
        .join(offsets, [*group, "__bucket"])
        .withColumn(out, (F.col("__before") + F.col("__rank") - 1).cast("bigint"))
        .select(*df.columns, out)
    )


def _range_buckets(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Stores ``df`` with the number of its range partition; buckets are in sort order."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(
        df.repartitionByRange(parts, *order).withColumn("__bucket", F.spark_partition_id())
    )


def sorted_index(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str = "position"
) -> DataFrame:
    """0-based position of each row inside its group under a total ``order``.

    A group may hold most of the table: it is spread over range partitions, ranked there and
    shifted by the rows of the group in earlier partitions.
    """
    grouped, group = _with_group(df, by)
    bucketed = _range_buckets(grouped, [*[F.col(c) for c in group], *order])
    offsets = _bucket_offsets(bucketed, group, F.lit(1))
    inside = Window.partitionBy(*group, "__bucket").orderBy(*order)
    return (
        bucketed.withColumn("__rank", F.row_number().over(inside))
        .join(offsets, [*group, "__bucket"])
        .withColumn(out, (F.col("__before") + F.col("__rank") - 1).cast("bigint"))
        .select(*df.columns, out)
    )


def sum_before(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], weight: str, out: str
) -> DataFrame:
    """Sum of ``weight`` over the earlier rows of the group; the order must be unique per group."""
    grouped, group = _with_group(df, by)
    bucketed = _range_buckets(grouped, [*[F.col(c) for c in group], *order])
    offsets = _bucket_offsets(bucketed, group, F.col(weight))
    inside = Window.partitionBy(*group, "__bucket").orderBy(*order)
    return (
        bucketed.withColumn("__upto", F.sum(weight).over(inside))
        .join(offsets, [*group, "__bucket"])
        .withColumn(out, F.col("__before") + F.col("__upto") - F.col(weight))
        .select(*df.columns, out)
    )


def competition_rank(
    df: DataFrame, by: Sequence[str], value: str, tie: str, out: str = "rank"
) -> DataFrame:
    """1-based rank by falling ``value`` inside each group; equal values share the first place.

    Neither a large group nor a value shared by many rows ends up in one task: the unique ``tie``
    column splits both over range partitions, and each partition learns where its values start.
    """
    grouped, group = _with_group(df, by)
    order = [F.col(value).desc(), F.col(tie)]
    bucketed = _range_buckets(grouped, [*[F.col(c) for c in group], *order])
    inside = Window.partitionBy(*group, "__bucket").orderBy(*order)
    placed = bucketed.withColumn("__rank", F.row_number().over(inside))
    offsets = _bucket_offsets(bucketed, group, F.lit(1))
    starts = (
        placed.groupBy(*group, "__bucket", value)
        .agg(F.min("__rank").alias("__first"))
        .join(offsets, [*group, "__bucket"])
        .withColumn(
            out,
            F.min(F.col("__before") + F.col("__first"))
            .over(Window.partitionBy(*group, value))
            .cast("bigint"),
        )
        .select(*group, "__bucket", value, out)
    )
    return bucketed.join(starts, [*group, "__bucket", value]).select(*df.columns, out)


def rank_distinct(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """0-based position over a whole table of distinct values.

    A checked small table is ranked by one window; a larger one by :func:`sorted_index`.
    """
    local = local_copy(df)
    if local is None:
        return sorted_index(df, [], order, out)
    return local.withColumn(out, (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint"))


def running_max(
    df: DataFrame, by: Sequence[str], position: str, value: str, out: str, chunk: int = CHUNK
) -> DataFrame:
    """Maximum of ``value`` over the positions up to and including the row's own.

    Positions are dense integers, so chunks of them are bounded: the maxima of whole chunks are
    scanned first, then each chunk on its own.
    """
    grouped, group = _with_group(df, by)
    chunked = grouped.withColumn("__chunk", F.floor(F.col(position) / chunk))
    peaks = chunked.groupBy(*group, "__chunk").agg(F.max(value).alias("__peak"))
    earlier = (
        Window.partitionBy(*group).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = peaks.select(*group, "__chunk", F.max("__peak").over(earlier).alias("__carried"))
    inside = Window.partitionBy(*group, "__chunk").orderBy(position)
    return (
        chunked.withColumn("__inside", F.max(value).over(inside))
        .join(carried, [*group, "__chunk"])
        .withColumn(out, F.greatest("__carried", "__inside"))
        .select(*df.columns, out)
    )


def bucket_sizes(df: DataFrame, key: str, seed: int | str, group: str) -> DataFrame:
    """Stored rows per group and hash bucket: all that class sizes and cuts need of most rows."""
    bucket = F.substring(seeded_hash(key, seed), 1, BUCKET_DIGITS).alias("__bucket")
    return materialise(
        df.select(F.col(group), bucket).groupBy(group, "__bucket").agg(F.count(F.lit(1)).alias("__size"))
    )


def hash_cuts(
    df: DataFrame,
    key: str,
    seed: int | str,
    group: str,
    sizes: DataFrame,
    ranks: DataFrame,
    cuts: Sequence[str],
) -> DataFrame:
    """The (hash, key) pair found at given 1-based ranks of each group's seeded hash order.

    ``sizes`` comes from :func:`bucket_sizes`; ``ranks`` has one row per group with a rank per column
    in ``cuts``. Only the rows of the few buckets that hold a cut are ranked, so finding the cuts
    moves counts, not rows. The result has one row per group with a struct column per cut, null
    where the rank is 0.
    """
    running = Window.partitionBy(group).orderBy("__bucket")
    spans = sizes.withColumn("__upto", F.sum("__size").over(running))
    wanted = ranks.select(
        F.col(group),
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("cut"), F.col(c).alias("rank")) for c in cuts])
        ).alias("__w"),
    ).select(group, "__w.cut", "__w.rank")
    before = F.col("__upto") - F.col("__size")
    holders = (
        spans.join(wanted, group)
        .filter((F.col("rank") > before) & (F.col("rank") <= F.col("__upto")))
        .select(group, "__bucket", "cut", (F.col("rank") - before).alias("__local"))
    )
    known = local_copy(holders)
    holders = holders if known is None else F.broadcast(known)
    buckets = holders.select(group, "__bucket").distinct()
    if known is not None:
        buckets = F.broadcast(buckets)
    keyed = (
        df.select(F.col(group), F.col(key))
        .withColumn("__hash", seeded_hash(key, seed))
        .withColumn("__bucket", F.substring("__hash", 1, BUCKET_DIGITS))
    )
    inside = Window.partitionBy(group, "__bucket").orderBy("__hash", key)
    candidates = keyed.join(buckets, [group, "__bucket"]).withColumn(
        "__rank", F.row_number().over(inside)
    )
    found = candidates.join(holders, [group, "__bucket"]).filter(F.col("__rank") == F.col("__local"))
    point = F.struct(F.col("__hash").alias("hash"), F.col(key).alias("key"))
    return found.groupBy(group).agg(
        *[F.max(F.when(F.col("cut") == c, point)).alias(c) for c in cuts]
    )
