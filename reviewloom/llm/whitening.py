"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation on Spark.

Entries become integers x = floor(scale * c) + offset, and rows are centred in integers before anything is
rounded. The centred rows X then stay where they are, packed in blocks, while X v and X'u alternate, one pass a
step: it finds u from X v and v from X'u, each orthogonalised twice against all earlier ones, so that U'XV is an
upper bidiagonal matrix B on the driver. B has at most one row a dimension, whatever the number of rows; its singular
value decomposition gives components and standard deviations. Left vectors have one entry a row and are never
kept: u_i = X w_i with W = V / B, so every task finds its part of all of them again from its rows, and a lost
executor loses nothing. What a task returns are sums over its rows, added up by a grouped aggregate.

When the space of the start vector is exhausted (eigenvalues that are equal, or fewer rows than dimensions), a new
start vector is drawn in the row space. Steps end when the wanted values have converged, or the space is complete.

Rows whose vector is null or holds a null or non-finite entry are left out. A shorter vector lacks entries: they count
as c = 0. Repeated rows and repeated or null ids each count as a row. A direction whose deviation is below a
millionth of the largest has no component, so there are at most ``min(components, dimensions, rows - 1)`` of them, and none for
equal rows, a single row or an empty table: the result is then empty. An entry whose scaled value is 2**62 or more raises an
error naming the row. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.topk import usable
from reviewloom.plans.storage import materialise

BLOCK_ROWS = 4096
# A component needs this part of the largest standard deviation.
LEAST_DEVIATION = 1e-6
CONVERGED = 1e-14


def pack(vectors: DataFrame, id_col: str, vector_col: str, scale: float, offset: int) -> DataFrame:
    """Blocks of the usable rows: their ids, and x row by row as <i8 bytes with the block's width."""
    rows = vectors.where(usable(F.col(vector_col))).select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")
    )
    kind = rows.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                sizes = np.diff(part.column(1).offsets.to_numpy())
                flat = np.floor(scale * part.column(1).flatten().to_numpy(zero_copy_only=False))
                width = int(sizes.max(initial=0))
                filled = np.arange(width) < sizes[:, None]
                table = np.zeros((part.num_rows, width))
                table[filled] = flat
                large = ~(np.abs(table) < 2.0**62 - abs(offset)).all(axis=1)
                if large.any():
                    raise ValueError(f"row {part.column(0)[int(large.argmax())]}: an entry is too large for whitening")
                x = table.astype("<i8") + offset
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0)),
                        pa.array([width], pa.int32()),
                        pa.array([x.tobytes()], pa.binary()),
                    ],
                    names=["ids", "width", "x"],
                )

    schema = f"ids array<{kind.simpleString()}>, width int, x binary"
    return rows.mapInArrow(run, schema)


def _table(width: int, data: bytes, dims: int, offset: int) -> np.ndarray:
    x = np.frombuffer(data, "<i8").reshape(-1, width) if width else np.zeros((0, 0), "<i8")
    return np.pad(x, ((0, 0), (0, dims - width)), constant_values=offset) if width < dims else x


@dataclass
class Centre:
    """n rows with per-dimension sums; x is centred as (x - shift) - rest / n with |rest| at most n / 2."""

    n: int
    sums: list[int]
    offset: int

    def __post_init__(self):
        self.shift = np.array([round(Fraction(s, self.n)) for s in self.sums], np.int64)
        self.rest = [s - self.n * int(k) for s, k in zip(self.sums, self.shift)]

    def rows(self, width: int, data: bytes) -> np.ndarray:
        """Centred rows as doubles; the integer part is exact."""
        off = np.array([float(Fraction(r, self.n)) for r in self.rest])
        return (_table(width, data, len(self.sums), self.offset) - self.shift).astype(np.float64) - off

    def deviations(self, width: int, data: bytes) -> list[int]:
        """Per row the exact sum of (n * x - S) squared."""
        moved = _table(width, data, len(self.sums), self.offset) - self.shift
        if (self.n * (int(np.abs(moved).max(initial=0)) + 1)) ** 2 * max(len(self.sums), 1) < 2**62:
            return ((self.n * moved - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        return [sum((self.n * int(x) - r) ** 2 for x, r in zip(row, self.rest)) for row in moved]


def _totals(blocks: DataFrame, offset: int) -> tuple[int, list[int]]:
    """Rows and exact sums by dimension, a vector's missing entries counting as ``offset``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, data, n in zip(*(c.to_pylist() for c in batch.columns)):
                x = _table(width, data, width, offset)
                # Halves of 31 bits add up in a long whatever the block.
                high, low = (x >> 31).sum(axis=0), (x & (2**31 - 1)).sum(axis=0)
                sums = [int(a) * 2**31 + int(b) for a, b in zip(high, low)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(-1, width), pa.int32()),
                        pa.array([n] * (width + 1), pa.int64()),
                        pa.array(list(map(str, [0, *sums])), pa.string()),
                    ],
                    names=["at", "n", "part"],
                )

    found = blocks.select("width", "x", F.size("ids").cast("long")).mapInArrow(run, "at int, n long, part string")
    by_place = found.groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(30,0)")).alias("s"))
    rows = {r.at: (r.n, int(r.s)) for r in by_place.collect()}
    if not rows:
        return 0, []
    n = rows[-1][0]
    return n, [rows[k][1] + offset * (n - rows[k][0]) for k in range(len(rows) - 1)]


class Rows:
    """Centred rows in blocks, seen from the driver by sums over all of them."""

    def __init__(self, blocks: DataFrame, centre: Centre):
        self.blocks, self.centre = blocks, centre

    def total(self, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all blocks of an array that ``part`` makes of a block's centred rows."""
        centre = self.centre

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = None
            for batch in batches:
                for width, data in zip(*(c.to_pylist() for c in batch.columns)):
                    own = part(centre.rows(width, data))
                    found = own if found is None else found + own
            if found is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(found), dtype=np.int32)), pa.array(found.astype(np.float64))], names=["at", "part"]
                )

        sums = self.blocks.select("width", "x").mapInArrow(run, "at int, part double")
        found = sums.groupBy("at").agg(F.sum("part").alias("s")).collect()
        out = np.zeros(len(found))
        for r in found:
            out[r.at] = r.s
        return out


def _unit_against(vector: np.ndarray, basis: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """``vector`` orthogonalised twice against ``basis``, at length 1, and the length it had."""
    for _ in range(2):
        for b in basis:
            vector = vector - (b @ vector) * b
    size = float(np.linalg.norm(vector))
    return (vector / size if size else vector), size


def bidiagonalise(rows: Rows, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, right vectors as rows) of the centred rows, the ``wanted`` largest ones."""
    dims = len(rows.centre.sums)
    random = np.random.default_rng(seed)

    def start() -> np.ndarray:
        drawn = random.normal(size=dims)
        return rows.total(lambda x: x.T @ (x @ drawn))

    first = start()
    v, size = _unit_against(first, [])
    if not size:
        return np.zeros(0), np.zeros((0, dims))
    scale = np.sqrt(size / np.sqrt(dims))
    right: list[np.ndarray] = []
    backs: list[np.ndarray] = []
    b = np.zeros((dims, dims))
    while True:
        k = len(right)
        # Column i of w gives u_i = X w_i.
        w = np.linalg.solve(b[:k, :k].T, np.array(right)).T if k else np.zeros((dims, 0))

        # U'(X v) is known from the X'u of earlier steps; what is left of it in y shows in the same pass.
        h = np.array(backs) @ v if k else np.zeros(0)

        def both(x, w=w, v=v, h=h):
            u = x @ w
            y = x @ v - u @ h
            return np.concatenate([u.T @ y, [y @ y], x.T @ y])

        found = rows.total(both)
        more, square, moved = found[:k], found[k], found[k + 1 :]
        h, alpha = h + more, np.sqrt(max(square - float(more @ more), 0.0))
        if alpha <= LEAST_DEVIATION * scale:
            break
        if k:
            moved = moved - more @ np.array(backs)
        backs.append(moved / alpha)
        b[:k, k], b[k, k] = h, alpha
        right.append(v)
        scale = max(scale, float(np.linalg.norm(b[: k + 1, : k + 1], 2)))
        if len(right) == dims:
            break
        v, beta = _unit_against(backs[-1], right)
        left, sizes, _ = np.linalg.svd(b[: k + 1, : k + 1])
        if len(sizes) >= wanted and (np.abs(beta * left[-1, :wanted]) <= CONVERGED * sizes[0]).all():
            break
        if beta <= LEAST_DEVIATION * scale:
            v, size = _unit_against(start(), right)
            if size <= LEAST_DEVIATION**2 * scale**2:
                break
    k = len(right)
    _, sizes, turned = np.linalg.svd(b[:k, :k])
    kept = sizes[:wanted] > LEAST_DEVIATION * sizes[:1]
    return sizes[:wanted][kept], (turned[:wanted] @ np.array(right))[kept]


def whiten(
    vectors: DataFrame,
    components: int = 32,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 64.0,
    offset: int = 1_000_000,
) -> DataFrame:
    """A row per usable row and component, numbered from 1 by falling variance.

    (``id_col``, component int, n long, deviation decimal(38,0), whitened double, explained double,
    identity_error double): the whitened value is the centred row's projection over the square root of the
    component's variance; explained is that variance's part of the total. All rows are fitted on.
    """
    blocks = materialise(pack(vectors, id_col, vector_col, scale, offset))
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    n, sums = _totals(blocks, offset)
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    centre = Centre(n, sums, offset)
    rows = Rows(blocks, centre)
    sizes, axes = bidiagonalise(rows, components)
    if not len(sizes):
        return vectors.sparkSession.createDataFrame([], schema)
    turn = (axes / (sizes[:, None] / np.sqrt(n))).T
    own = len(sizes)
    # The last sum is the total variance times n.
    seen = rows.total(lambda x: np.concatenate([((z := x @ turn).T @ z).ravel(), z.sum(axis=0), [(x * x).sum()]]))
    mean = seen[own * own : -1] / n
    error = float(np.abs(seen[: own * own].reshape(own, own) / n - np.outer(mean, mean) - np.eye(own)).max())
    explained = sizes**2 / seen[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                width, data = batch.column(1)[place].as_py(), batch.column(2)[place].as_py()
                ids = batch.column(0)[place].values
                z, deviations = centre.rows(width, data) @ turn, centre.deviations(width, data)
                exact = pa.array(list(map(str, deviations)), pa.string()).cast(pa.decimal128(38, 0))
                each = np.repeat(np.arange(len(ids)), own)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, own + 1, dtype=np.int32), len(ids))),
                        pa.array(np.full(len(each), n, np.int64)),
                        exact.take(pa.array(each)),
                        pa.array(z.ravel()),
                        pa.array(np.tile(explained, len(ids))),
                        pa.array(np.full(len(each), error)),
                    ],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return blocks.mapInArrow(run, schema)
