"""Nearest centroid for more classes than the driver should hold: blocks of centroids meet batches of rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.plans.ordering import sorted_index
from reviewloom.plans.storage import materialise

# Centroids that others are grouped around; every task holds them.
PIVOTS = 256
# Centroids in a block, until there would be more than MOST_BLOCKS; then blocks grow, so that their
# list (four numbers each) stays bounded for any number of classes.
BLOCK_ROWS = 256
MOST_BLOCKS = 4_096
# Rows of the table in a batch, and batches that meet a block in one task.
BATCH_ROWS = 256
BATCHES_A_TASK = 64
# Bounds are widened by this part, far above the rounding of a distance.
SLACK = 1e-9


def _matrix(vectors) -> np.ndarray:
    return np.stack(list(vectors)).astype("float64")


def _squares(rows: np.ndarray, mean: np.ndarray) -> np.ndarray:
    return ((rows - mean) ** 2).sum(axis=1)


def _pivot_distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([_squares(rows, pivot) for pivot in pivots], axis=1))


def _blocks(stored: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(block, pivot, near, far, labels, means): centroids by nearest pivot and by distance from it."""

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                away = _pivot_distances(_matrix(frame["centroid"]), pivots)
                yield frame.assign(pivot=away.argmin(axis=1), away=away.min(axis=1))

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.schema)
    assigned = materialise(stored.mapInPandas(assign, f"{types}, pivot long, away double"))
    width = max(BLOCK_ROWS, -(-assigned.count() // MOST_BLOCKS))
    # A pivot may hold most centroids: its order is made by range partitions.
    placed = sorted_index(assigned, ["pivot"], [F.col("away"), F.col("label")], "place")
    ring = F.floor(F.col("place") / width)
    members = F.sort_array(F.collect_list(F.struct("label", "centroid")))
    return materialise(
        placed.groupBy("pivot", ring.alias("ring"))
        .agg(F.min("away").alias("near"), F.max("away").alias("far"), members.alias("members"))
        .select(
            (F.col("ring") * PIVOTS + F.col("pivot")).alias("block"),
            "pivot",
            "near",
            "far",
            F.col("members.label").alias("labels"),
            F.flatten("members.centroid").alias("means"),
        )
    )


def _visits(rows: DataFrame, vector: str, pivots: np.ndarray, known: pd.DataFrame) -> DataFrame:
    """(block, ids, rows): the rows of a batch that may have their nearest centroid in the block.

    The nearest pivot is a centroid, so no farther one counts. Triangle inequality: a centroid between
    ``near`` and ``far`` from a pivot is at least as far from a row as the row is from that ring.
    """
    ring_pivot = known["pivot"].to_numpy()
    near, far, names = (known[c].to_numpy() for c in ("near", "far", "block"))

    def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), BATCH_ROWS):
                part = frame.iloc[start : start + BATCH_ROWS]
                ids, points = part["__row"].to_numpy(), _matrix(part[vector])
                away = _pivot_distances(points, pivots)
                # Distances are compared with room for the rounding of the largest number involved.
                reach = away.min(axis=1) + SLACK * away.max(axis=1)
                out = []
                for block, pivot, low, high in zip(names, ring_pivot, near, far):
                    bound = np.maximum(away[:, pivot] - high, low - away[:, pivot])
                    kept = np.flatnonzero(bound <= reach + SLACK * high)
                    if len(kept):
                        out.append((block, ids[kept].tobytes(), points[kept].tobytes()))
                if out:
                    yield pd.DataFrame(out, columns=["block", "ids", "points"])

    return rows.select("__row", vector).mapInPandas(visit, "block long, ids binary, points binary")


def _nearest(met: DataFrame, label_type: str) -> DataFrame:
    """(__row, distance, pred) of every batch within its block; equal distances go to the smaller label."""

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for ids, points, labels, means in frame[["ids", "points", "labels", "means"]].itertuples(index=False):
                ids, labels = np.frombuffer(ids, "int64"), np.asarray(labels)
                rows = np.frombuffer(points).reshape(len(ids), -1)
                best, shortest = np.zeros(len(ids), "int64"), np.full(len(ids), np.inf)
                for place, mean in enumerate(np.asarray(means).reshape(len(labels), -1)):
                    distance = _squares(rows, mean)
                    closer = distance < shortest
                    best[closer], shortest[closer] = place, distance[closer]
                yield pd.DataFrame({"__row": ids, "distance": shortest, "pred": labels[best]})

    return met.mapInPandas(compare, f"__row long, distance double, pred {label_type}")


def predict_in_blocks(
    df: DataFrame, vector: str, centroids: DataFrame, carried: Sequence[str] = ()
) -> DataFrame:
    """As :func:`centroids.predict_centroid`, without a copy of all centroids anywhere.

    Only pivots and the list of blocks, both of bounded length, are held by the driver. Batches meet
    the blocks that their bounds leave, a block with many batches in several tasks, and the nearest
    of a row's blocks is taken by a partial aggregate.
    """
    stored = materialise(centroids.select("label", "centroid"))
    drawn = stored.orderBy(F.xxhash64("label"), "label").limit(PIVOTS).collect()
    pivots = _matrix(row["centroid"] for row in drawn)
    blocks = _blocks(stored, pivots)
    known = blocks.select("block", "pivot", "near", "far").toPandas()

    rows = materialise(
        df.select(*carried, F.col(vector).alias("__vector")).withColumn("__row", F.monotonically_increasing_id())
    )
    visits = materialise(_visits(rows, "__vector", pivots, known))
    # One row a block, so it is as small as the list of blocks.
    shares = materialise(
        visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BATCHES_A_TASK).cast("long").alias("shares"))
    )
    share = F.pmod(F.xxhash64("ids"), F.col("shares")).alias("share")
    dealt = visits.join(F.broadcast(shares), "block").select("block", share, "ids", "points")
    copies = blocks.join(F.broadcast(shares), "block").select(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"), "labels", "means"
    )
    label_type = stored.schema["label"].dataType.simpleString()
    answers = _nearest(dealt.join(copies, ["block", "share"]), label_type)
    best = answers.groupBy("__row").agg(F.min(F.struct("distance", "pred")).alias("__best"))
    return rows.join(best, "__row", "left").select(*carried, "__best.pred", "__best.distance")
