"""Hard negatives by exact search in cover trees.

For each anchor its best rows of the same label are positives, and for each positive the best rows of other labels
whose score lies in a window below the positive's are hard negatives. Candidates are dealt to the nearest of some
pivots, large cells further by a hash, and each part of bounded size becomes one cover tree over norm-augmented
vectors (``cover_tree``). An anchor first descends the tree it is in itself, which tells how good a row must be;
then the roots of all trees are compared with all anchors, in blocks, and an anchor goes only to trees
whose root may reach one of its windows. There the descent opens the nodes with the highest bound first, skips those outside of
every window, and verifies buckets by exact integer products. Nothing is approximated or dropped.

Rows without an id or a label, or whose vector is null or holds a null or non-finite component, take no part. A scaled
component of 2**150 or more raises an error naming its row. Labels are compared as text. Rows that agree in id, label and vector
are one row; other rows of one id are rows of their own (told apart by a 64-bit hash), none of them another's positive or
negative. Components that a shorter vector lacks count as 0. Scores are exact; one beyond 64 bits among the
results raises an error naming its anchor. A positive with a negative score has no window. Other columns are ignored,
whatever their names; an empty table, or one without anchors, gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm import cover_tree
from reviewloom.llm.topk import usable
from reviewloom.plans.storage import materialise

TREE_ROWS = 2048
ANCHORS_AT_ONCE = 256
ROOTS_AT_ONCE = 512
# Pivots go to every task; 4096 of them bound that copy whatever the number of rows.
MOST_PIVOTS = 4096
SALTS = 32
LARGEST = 2.0**150

_WINDOW = "struct<positive_id:bigint,positive_score:bigint,low:bigint,high:bigint>"
_REQUEST = f"id long, h long, label string, v binary, cell int, home long, windows array<{_WINDOW}>"
_FOUND = "w int, other long, score long"
_FOUND_LIST = "array<struct<w:int,other:bigint,score:bigint>>"


def _prepare(
    vectors: DataFrame, is_anchor: Column, id_col: str, label_col: str, vector_col: str, scale: float
) -> DataFrame:
    """(id, label, v, anchor, h): distinct usable rows with floored components."""
    scaled = F.transform(F.col(vector_col).cast("array<double>"), lambda x: F.lit(scale) * x)
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & usable(F.col(vector_col)))
    rows = rows.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        scaled.alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            ends = vectors.offsets.to_numpy()
            # Adding 0 turns -0 into 0.
            flat = np.floor(vectors.values.to_numpy(zero_copy_only=False)) + 0.0
            large = np.flatnonzero(~(np.abs(flat) < LARGEST))
            if len(large):
                row = batch.column(0)[int(np.searchsorted(ends, large[0], "right")) - 1]
                raise ValueError(f"row {row}: a component is too large for exact search")
            data = [flat[a:b].astype("<f8").tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(data, pa.binary()), batch.column(3)],
                names=["id", "label", "v", "anchor"],
            )

    # The same row may be an anchor by one copy only.
    packed = rows.mapInArrow(run, "id long, label string, v binary, anchor boolean")
    return packed.groupBy("id", "label", "v").agg(F.max("anchor").alias("anchor")).withColumn("h", F.xxhash64("id", "label", "v"))


def _matrix(data: list[bytes]) -> np.ndarray:
    """Vectors of doubles as rows, padded to the longest."""
    width = max((len(d) for d in data), default=0) // 8
    out = np.zeros((len(data), width))
    for row, d in zip(out, data):
        row[: len(d) // 8] = np.frombuffer(d, "<f8")
    return out


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows with the cell of their nearest pivot and the tree (``home``) that they belong to."""
    rows = materialise(rows)
    n = rows.count()
    wanted = max(1, min(MOST_PIVOTS, n // TREE_ROWS))
    pivots = _matrix([bytes(r.v) for r in rows.select("h", "v").orderBy("h").limit(wanted).collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TREE_ROWS):
                part = batch.slice(at, TREE_ROWS)
                points = _matrix(part.column("v").to_pylist())
                width = max(points.shape[1], pivots.shape[1])
                points, around = cover_tree.padded(points, width), cover_tree.padded(pivots, width)
                cells = ((around * around).sum(axis=1) - 2 * points @ around.T).argmin(axis=1)
                yield part.append_column("cell", pa.array(cells, pa.int32()))

    routed = materialise(rows.mapInArrow(run, "id long, label string, v binary, anchor boolean, h long, cell int"))
    # At most one row a pivot.
    parts = routed.groupBy("cell").agg(F.ceil(F.count("*") / TREE_ROWS).cast("long").alias("parts"))
    home = F.col("cell").cast("long") * (1 << 40) + F.pmod(F.col("h"), F.col("parts"))
    return routed.join(F.broadcast(parts), "cell").withColumn("home", home).drop("parts")


def _trees(rows: DataFrame) -> DataFrame:
    """(tree, root's centre, mass, covering angle and range of labels, the tree itself)."""

    def grow(table: pa.Table) -> pa.Table:
        points = _matrix(table.column("v").to_pylist())
        tree = cover_tree.build(table.column("id").to_numpy(), table.column("label").to_pylist(), points)
        centre = tree.points[tree.centre[0]].astype("<f8").tobytes()
        return pa.table(
            {
                "tree": pa.array([table.column("home")[0].as_py()], pa.int64()),
                "centre": pa.array([centre], pa.binary()),
                "mass": [tree.mass],
                "angle": [float(tree.angle[0])],
                "least": [tree.labels[0]],
                "most": [tree.labels[-1]],
                "data": pa.array([pickle.dumps(tree)], pa.binary()),
            }
        )

    schema = "tree long, centre binary, mass double, angle double, least string, most string, data binary"
    return rows.select("home", "id", "label", "v").groupBy("home").applyInArrow(grow, schema)


def _ends(window: dict) -> tuple[float, float]:
    """The ends of a window; null is none."""
    low, high = window["low"], window["high"]
    return -np.inf if low is None else low, np.inf if high is None else high


def _descend(tree: cover_tree.Tree, request: dict, same: bool, k: int) -> list[cover_tree.Window]:
    windows = [cover_tree.Window(*_ends(w), k) for w in request["windows"]]
    tree.search(request["id"], np.frombuffer(request["v"], "<f8"), request["label"], same, windows)
    for w in windows:
        if any(not -(1 << 63) <= int(s) < 1 << 63 for s in w.scores):
            raise ValueError(f"anchor {request['id']}: a score does not fit in 64 bits")
    return windows


def _search(trees: DataFrame, requests: DataFrame, same: bool, k: int) -> DataFrame:
    """(id, h, w, other, score, rank): the k best rows in each window w of each request."""
    names = [f.strip().split(" ")[0] for f in _REQUEST.split(", ")]
    struct = F.struct(*names)

    # A tree's own anchors are no more than its rows.
    at_home = requests.groupBy("home").agg(F.collect_list(struct).alias("asked"))
    at_home = at_home.join(trees.select(F.col("tree").alias("home"), "data"), "home").select("data", "asked")

    def first_look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, asked in zip(batch.column(0), batch.column(1)):
                tree, out = pickle.loads(data.as_py()), []
                for request in asked.as_py():
                    windows = _descend(tree, request, same, k)
                    found = [
                        {"w": n, "other": int(i), "score": int(s)}
                        for n, w in enumerate(windows)
                        for i, s in zip(w.ids, w.scores)
                    ]
                    raised = [{**old, "low": None if w.low == -np.inf else w.low} for old, w in zip(request["windows"], windows)]
                    out.append({**request, "windows": raised, "found": found})
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = _arrow_request(found=True)
    looked = materialise(at_home.mapInArrow(first_look, f"{_REQUEST}, found {_FOUND_LIST}"))

    # Anchors of one cell in blocks; one row a cell, of which there are at most as many as pivots.
    parts = looked.groupBy("cell").agg(F.ceil(F.count("*") / ANCHORS_AT_ONCE).cast("long").alias("parts"))
    block = F.col("cell").cast("long") * (1 << 40) + F.pmod(F.xxhash64("id", "h"), F.col("parts"))
    blocks = looked.join(F.broadcast(parts), "cell").groupBy(block.alias("block")).agg(F.collect_list(struct).alias("asked"))
    pairs = _meetings(materialise(blocks), trees, same)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data, asked in zip(*(batch.column(c) for c in range(3))):
                number, tree, out = number.as_py(), pickle.loads(data.as_py()), []
                for request in asked.as_py():
                    if request["home"] == number:
                        continue
                    for n, w in enumerate(_descend(tree, request, same, k)):
                        out += [(request["id"], request["h"], n, int(i), int(s)) for i, s in zip(w.ids, w.scores)]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                        names=["id", "h", "w", "other", "score"],
                    )

    away = pairs.mapInArrow(visit, f"id long, h long, {_FOUND}")
    found = looked.select("id", "h", F.inline("found")).unionByName(away)
    best = Window.partitionBy("id", "h", "w").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _arrow_request(found: bool) -> pa.Schema:
    window = pa.struct([(c, pa.int64()) for c in ("positive_id", "positive_score", "low", "high")])
    fields = [
        ("id", pa.int64()), ("h", pa.int64()), ("label", pa.string()), ("v", pa.binary()),
        ("cell", pa.int32()), ("home", pa.int64()), ("windows", pa.list_(window)),
    ]
    if found:
        fields.append(("found", pa.list_(pa.struct([("w", pa.int32()), ("other", pa.int64()), ("score", pa.int64())]))))
    return pa.schema(fields)


def _meetings(blocks: DataFrame, trees: DataFrame, same: bool) -> DataFrame:
    """(tree, data, asked) of every tree and block of anchors in which the root may reach a window."""
    groups = F.ceil(F.lit(trees.count()) / ROOTS_AT_ONCE).cast("int")
    roots = trees.withColumn("g", F.pmod(F.xxhash64("tree"), groups)).groupBy("g").agg(
        F.collect_list(F.struct("tree", "centre", "mass", "angle", "least", "most")).alias("roots")
    )
    # Copies by salt, so that many blocks of anchors are met by many tasks.
    salted = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    left = blocks.select("block", "asked", F.pmod(F.xxhash64("block"), F.lit(SALTS)).cast("int").alias("salt"))
    met = roots.select("roots", salted).join(left, "salt").select("block", "roots", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, roots, asked in zip(*(batch.column(c) for c in range(3))):
                roots, asked = roots.as_py(), asked.as_py()
                centres, queries = _matrix([r["centre"] for r in roots]), _matrix([a["v"] for a in asked])
                width = max(centres.shape[1], queries.shape[1])
                centres, queries = cover_tree.padded(centres, width), cover_tree.padded(queries, width)
                sizes = np.sqrt((queries**2).sum(axis=1))[:, None] * np.array([r["mass"] for r in roots])
                low, high = cover_tree.bounds(queries @ centres.T, sizes, np.array([r["angle"] for r in roots]))
                wanted = np.zeros(len(roots), bool)
                for a, least, most in zip(asked, low, high):
                    fits = np.zeros(len(roots), bool)
                    for start, end in map(_ends, a["windows"]):
                        fits |= (most >= start) & (least <= end)
                    for n in np.flatnonzero(fits & ~wanted):
                        r = roots[n]
                        holds = r["least"] <= a["label"] <= r["most"] if same else not r["least"] == a["label"] == r["most"]
                        wanted[n] = holds and a["home"] != r["tree"]
                kept = [r["tree"] for r, x in zip(roots, wanted) if x]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.as_py()] * len(kept), pa.int64()), pa.array(kept, pa.int64())], names=["block", "tree"]
                )

    pairs = materialise(met.mapInArrow(run, "block long, tree long"))
    return pairs.join(blocks, "block").join(trees.select("tree", "data"), "tree").select("tree", "data", "asked")


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: float = 256.0,
) -> DataFrame:
    """(anchor_id, positive_id, rank from 1, negative_id, positive_score, negative_score).

    Components become floor(scale * x), scores are integer inner products, ties go to the smaller id. A negative's score
    is at least ``low_percent`` and at most ``high_percent`` of the positive's.
    """
    rows = materialise(_dealt(_prepare(vectors, is_anchor, id_col, label_col, vector_col, scale)))
    trees = materialise(_trees(rows))
    anchors = rows.where("anchor").select("id", "h", "label", "v", "cell", "home")
    everything = F.expr(f"array(cast(struct(null, null, null, null) as {_WINDOW}))")
    best = materialise(_search(trees, anchors.withColumn("windows", everything), True, positives))
    # At most ``positives`` windows an anchor. Percent of a 64-bit score go through decimals.
    exact = F.col("score").cast("decimal(25,0)")
    low, high = F.ceil(exact * low_percent / 100), F.floor(exact * high_percent / 100)
    window = F.struct(F.col("other").alias("positive_id"), F.col("score").alias("positive_score"), low.cast("long").alias("low"), high.cast("long").alias("high"))
    asked = best.where("score >= 0").groupBy("id", "h").agg(F.sort_array(F.collect_list(F.struct("rank", window.alias("window")))).alias("ranked"))
    asked = asked.withColumn("windows", F.expr(f"cast(transform(ranked, r -> r.window) as array<{_WINDOW}>)")).drop("ranked")
    requests = materialise(anchors.join(asked, ["id", "h"]).select("id", "h", "label", "v", "cell", "home", "windows"))
    found = _search(trees, requests, False, negatives)
    names = requests.select("id", "h", F.posexplode("windows").alias("w", "window"))
    return found.join(names, ["id", "h", "w"]).select(
        F.col("id").alias("anchor_id"),
        "window.positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("other").alias("negative_id"),
        "window.positive_score",
        F.col("score").alias("negative_score"),
    )
