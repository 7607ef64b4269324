"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from reviewloom.plans import limits
from reviewloom.plans.storage import materialise


def small_rows(df: DataFrame) -> list[Row] | None:
    """The rows of ``df``, or None when there are more than the driver should hold."""
    rows = df.limit(limits.SMALL_ROWS + 1).collect()
    return None if len(rows) > limits.SMALL_ROWS else rows


def local_copy(df: DataFrame) -> DataFrame | None:
    """``df`` as a local relation, or None when it has too many rows."""
    rows = small_rows(df)
    if rows is None:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def computed_once(df: DataFrame) -> DataFrame:
    """``df`` computed once: as a local relation while it is small, else as a stored table."""
    local = local_copy(df)
    return materialise(df) if local is None else local


def fits_broadcast(stored: DataFrame) -> bool:
    """Size check for a stored table: its rows, and if they are few enough their written length."""
    if stored.count() > limits.BROADCAST_ROWS:
        return False
    length = F.octet_length(F.to_json(F.struct(*stored.columns)))
    return (stored.agg(F.sum(length)).first()[0] or 0) <= limits.BROADCAST_BYTES


def skew_join(facts: DataFrame, dim: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Equi-join where the keys of ``facts`` may be hot; ``how`` is inner or left.

    Rows of hot keys meet a broadcast of just those keys' dimension rows, the others are shuffled.
    Both parts together hold every row. Rows without a key never match and skip the shuffle too.
    ``dim`` has one row per key, so the broadcast has at most HOT_SHARE rows.
    """
    counts = materialise(facts.groupBy(on).count())
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    hot = counts.filter(F.col(on).isNotNull() & (F.col("count") * limits.HOT_SHARE >= F.lit(total)))
    hot_keys = [row[0] for row in hot.select(on).limit(limits.HOT_SHARE).collect()]
    keyless = F.col(on).isNull()
    is_hot = F.col(on).isin(hot_keys) if hot_keys else F.lit(False)
    hot_part = facts.filter(keyless | is_hot).join(F.broadcast(dim.filter(is_hot)), on, how)
    cold_part = facts.filter(~keyless & ~is_hot).join(dim.filter(~is_hot), on, how)
    return hot_part.unionByName(cold_part)


def lookup_join(facts: DataFrame, dim: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Attaches a dimension: broadcast when a check shows it small, else :func:`skew_join`."""
    local = local_copy(dim)
    if local is not None:
        return facts.join(F.broadcast(local), on, how)
    return skew_join(facts, dim, on, how)


def stored_lookup_join(facts: DataFrame, stored: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """:func:`lookup_join` for a stored dimension, which is cheap to measure."""
    if fits_broadcast(stored):
        return facts.join(F.broadcast(stored), on, how)
    return skew_join(facts, stored, on, how)


def common_and_rare(stored: DataFrame, weight: Column) -> tuple[DataFrame, DataFrame | None]:
    """The most common rows of a stored table that fit the broadcast bounds, by ``weight``, and the others if any."""
    level = F.floor(F.log2(weight))
    length = F.octet_length(F.to_json(F.struct(*stored.columns)))
    sizes = stored.groupBy(level.alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(length).alias("length")
    )
    rows = total = 0
    cut = None
    # One row per power of two, so there are only a few dozen.
    by_level = sorted(sizes.collect(), key=lambda r: -r["level"])
    for size in by_level:
        rows, total = rows + size["n"], total + size["length"]
        if rows > limits.BROADCAST_ROWS or total > limits.BROADCAST_BYTES:
            break
        cut = size["level"]
    else:
        return stored, None
    return (stored.limit(0), stored) if cut is None else (stored.filter(level >= cut), stored.filter(level < cut))


def frequency_join(facts: DataFrame, stored: DataFrame, on: str, weight: Column) -> DataFrame:
    """Left join to a stored dimension, one row per key, whose ``weight`` tells how common a key is.

    The most common keys that fit the broadcast bounds meet nearly all rows where they are; only
    the rows left over are shuffled, by :func:`skew_join`. Every row is in one of the two parts.
    """
    common, rare = common_and_rare(stored, weight)
    if rare is None:
        return facts.join(F.broadcast(common), on, "left")
    # Stored, as what was not met is read several times.
    tried = materialise(facts.join(F.broadcast(common.withColumn("__met", F.lit(True))), on, "left"))
    met = tried.filter(F.col("__met").isNotNull()).drop("__met")
    rest = tried.filter(F.col("__met").isNull()).select(*facts.columns)
    return met.unionByName(skew_join(rest, rare, on, "left"))
