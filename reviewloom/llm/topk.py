"""Exact top-k by inner product: columnar branch and bound.

Vectors are packed into blocks that hold one row per dimension (vertical layout). A block of queries meets a
block of candidates in one task. Scores are accumulated some dimensions at a time, those with the most mass
first; by Cauchy-Schwarz, the mass that remains bounds what a candidate can still gain or lose. A candidate
whose best possible score lies below the k-th worst possible one of a query is out for it; candidates that are
out for all queries at hand are removed by compaction. Each pair of blocks yields k rows a query, which are
reduced once more. Nothing is broadcast, and every candidate row is scored or bounded.

Components become floor(scale * x) with x as double; scores are exact integers. Vectors that are null or hold a
null or non-finite component, and rows without an id, take no part; an empty vector scores 0, and components that
a shorter vector lacks count as 0. A scaled component of 2**62 or more, or a score of the result beyond 64 bits,
raises an error that names the row or the query. Ties go to the smaller id. A row is never its own answer; rows of one id are
one vector's rows. Repeated candidate rows count each. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.plans.storage import materialise

BLOCK_ROWS = 4096
QUERIES_AT_ONCE = 64
DIMENSIONS_AT_ONCE = 16


def usable(embedding: Column) -> Column:
    """True for a vector without null or non-finite components."""
    bad = F.exists(
        embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")).cast("double"))
    )
    return embedding.isNotNull() & ~bad


def _blocks(rows: DataFrame, scale: float, block_rows: int) -> DataFrame:
    """Rows packed by the batch: the smallest id, ids and, dimension by dimension, components as <i8 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, block_rows):
                part = batch.slice(a, block_rows)
                ids = part.column(0).to_numpy(zero_copy_only=False).astype("<i8")
                vectors = part.column(1)
                sizes = np.diff(vectors.offsets.to_numpy())
                flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                width = int(sizes.max()) if len(sizes) else 0
                table = np.zeros((len(ids), width))
                table[np.arange(width) < sizes[:, None]] = np.floor(scale * flat)
                large = (np.abs(table) >= 2.0**62).any(axis=1)
                if large.any():
                    raise ValueError(f"row {ids[large.argmax()]}: a component is too large for an exact integer score")
                by_dimension = np.ascontiguousarray(table.T).astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(ids.min())]),
                        pa.array([ids.tobytes()], pa.binary()),
                        pa.array([by_dimension.tobytes()], pa.binary()),
                    ],
                    names=["first", "ids", "data"],
                )

    return rows.select(F.col("id").cast("long"), "v").mapInArrow(run, "first long, ids binary, data binary")


def search(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, columns: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The k best candidates (ids ascending within ties) of each query: (query ids, ids, scores).

    ``queries`` is queries by dimensions, ``columns`` dimensions by candidates.
    """
    order = np.argsort(ids, kind="stable")
    ids, columns = ids[order], columns[:, order]
    width = max(queries.shape[1], columns.shape[0])
    queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    columns = np.pad(columns, ((0, width - columns.shape[0]), (0, 0)))
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(columns).max(initial=0)) * max(width, 1)
    # Sums below 2**53 are exact as doubles; larger ones are kept as Python integers.
    kind = np.float64 if largest < 2.0**53 else object
    queries, columns = queries.astype(kind), columns.astype(kind)
    steps = [range(d, min(d + DIMENSIONS_AT_ONCE, width)) for d in range(0, width, DIMENSIONS_AT_ONCE)]
    mass = np.stack([_norm(columns[list(s)], 0) for s in steps]) if steps else np.zeros((0, len(ids)))
    for a in range(0, len(query_ids), QUERIES_AT_ONCE):
        own, vectors = query_ids[a : a + QUERIES_AT_ONCE], queries[a : a + QUERIES_AT_ONCE]
        weight = np.stack([_norm(vectors[:, list(s)], 1) for s in steps]) if steps else np.zeros((0, len(own)))
        plan = np.argsort(-weight.sum(axis=1), kind="stable")
        alive = np.arange(len(ids))
        scores = np.zeros((len(own), len(ids)), kind)
        for done, step in enumerate(plan.tolist(), 1):
            dims = list(steps[step])
            scores += vectors[:, dims] @ columns[dims][:, alive]
            if done < len(plan) and len(alive) > 4 * k:
                rest = plan[done:]
                slack = np.sqrt((weight[rest] ** 2).sum(axis=0))[:, None] * np.sqrt((mass[rest][:, alive] ** 2).sum(axis=0))
                slack = slack * (1 + 1e-9) + 1
                known = scores.astype(np.float64)
                # One more than k, as a query itself may be among the best.
                floor = np.partition(known - slack, len(alive) - k - 1, axis=1)[:, len(alive) - k - 1]
                stay = (known + slack >= floor[:, None]).any(axis=0)
                alive, scores = alive[stay], scores[:, stay]
        for row, query_id in enumerate(own):
            others = np.flatnonzero(ids[alive] != query_id)
            found = scores[row, others]
            best = others[np.argsort(-found, kind="stable")[:k]]
            yield np.full(len(best), query_id), ids[alive[best]], scores[row, best]


def _norm(x: np.ndarray, axis: int) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(axis=axis))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 256.0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank from 1, ``id_col``, score) of the k best other rows for each row with ``is_query``."""
    rows = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("q")
    )
    asked = rows.where("q").select("id", "v")
    n_asked = asked.count()
    queries, n_queries = _numbered(
        _blocks(asked.repartition(max(1, -(-n_asked // block_rows))), scale, block_rows), "qb"
    )
    candidates, n_candidates = _numbered(_blocks(rows.select("id", "v"), scale, block_rows), "cb")
    left = queries.select(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(max(n_candidates - 1, 0)))).alias("cb"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data")
    )
    right = candidates.select(
        "cb", F.explode(F.sequence(F.lit(0), F.lit(max(n_queries - 1, 0)))).alias("qb"), "ids", "data"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_ids, q_data, ids, data in zip(*(c.to_pylist() for c in batch.columns)):
                q, c = np.frombuffer(q_ids, "<i8"), np.frombuffer(ids, "<i8")
                found = list(
                    search(q, np.frombuffer(q_data, "<i8").reshape(-1, len(q)).T, c, np.frombuffer(data, "<i8").reshape(-1, len(c)), k)
                )
                for own, _, scores in found:
                    if any(not -(1 << 63) <= int(x) < 1 << 63 for x in scores):
                        raise ValueError(f"query {own[0]}: a score does not fit in 64 bits")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([f[i] for f in found]).astype(np.int64)) for i in range(3)],
                    names=["query_id", "id", "score"],
                )

    found = left.join(right, ["qb", "cb"]).select("q_ids", "q_data", "ids", "data").mapInArrow(
        run, "query_id long, id long, score long"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
    )


def _numbered(blocks: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Blocks with numbers from 0, and their count; one small row a block goes through the numbering."""
    stored = materialise(blocks.withColumn("key", F.expr("uuid()")))
    numbers = stored.select("key", (F.row_number().over(Window.orderBy("first", "key")) - 1).alias(name))
    return stored.join(numbers, "key").drop("key", "first"), stored.count()
