"""Whitening and hard negatives against brute force."""

from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from reviewloom.llm import cover_tree, hard_negatives, whitening


def brute_white(rows, components):
    """By id, (deviation, {component: (whitened, explained)}) from an eigendecomposition."""
    width = max(len(v) for _, v in rows)
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in [*v, *[0.0] * (width - len(v))]] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(row, sums)] for row in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    kept = values > 1e-11 * values[0]
    return deviations, centred @ axes[:, kept] / np.sqrt(values[kept]), values[kept] / (centred**2).sum() * n


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS n", "'k' AS ids", "2 AS component")


def against_brute(spark, rows, components):
    got = whitening.whiten(vectors_of(spark, rows), components).collect()
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    deviations, white, explained = brute_white(good, components)
    assert len(got) == len(good) * white.shape[1]
    table = {}
    for r in got:
        table[r.vec_id, r.component] = r
        assert r.n == len(good) and r.identity_error < 1e-9
        assert abs(r.explained - explained[r.component - 1]) < 1e-10 * r.explained
    for place, (vec_id, _) in enumerate(good):
        assert all(int(table[vec_id, k + 1].deviation) == deviations[place] for k in range(white.shape[1]))
    for k in range(white.shape[1]):
        own = np.array([table[i, k + 1].whitened for i, _ in good])
        sign = np.sign(own @ white[:, k])
        assert np.abs(sign * own - white[:, k]).max() < 1e-7


@pytest.mark.parametrize("block", [50, 4096])
def test_whitening(spark, monkeypatch, block):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(rng.normal(size=(230, 12)) * np.linspace(1, 5, 12))]
    rows += [(500, None), (501, [None] * 12), (502, [float("nan")] * 12), (503, [float("-inf")] * 12)]
    rows += [(600, []), (601, [3.0, 4.0]), (602, [0.5] * 13)]
    against_brute(spark, rows, 32)
    against_brute(spark, rows, 5)


def test_whitening_of_flat_and_degenerate_rows(spark):
    # Fewer rows than dimensions, and a constant dimension.
    rng = np.random.default_rng(4)
    against_brute(spark, [(k, [7.0, *map(float, v)]) for k, v in enumerate(rng.normal(size=(6, 9)))], 32)
    # All eigenvalues equal: any basis will do, but it must be complete.
    cross = [(2 * k + s, [float((-1) ** s) if j == k else 0.0 for j in range(5)]) for k in range(5) for s in range(2)]
    got = whitening.whiten(vectors_of(spark, cross)).collect()
    assert Counter(r.component for r in got) == {k: 10 for k in range(1, 6)}
    assert all(abs(r.explained - 0.2) < 1e-12 and r.identity_error < 1e-12 for r in got)


def test_whitening_without_variance(spark):
    same = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])]
    assert whitening.whiten(vectors_of(spark, same)).collect() == []
    assert whitening.whiten(vectors_of(spark, same[:1])).collect() == []
    assert whitening.whiten(vectors_of(spark, same).limit(0)).collect() == []


def test_whitening_of_large_entries(spark):
    # Sums of squares beyond 64 bits are exact, larger entries raise an error that names the row.
    rows = [(1, [2.0**50, 1.0]), (2, [-(2.0**50), 2.0]), (2, [0.0, 3.0]), (None, [1.0, -3.0])]
    got = whitening.whiten(vectors_of(spark, rows), 1).collect()
    deviations, _, _ = brute_white(rows, 1)
    assert Counter(int(r.deviation) for r in got) == Counter(deviations)
    with pytest.raises(Exception, match="row 9"):
        whitening.whiten(vectors_of(spark, [*rows, (9, [1e30, 0.0])])).collect()


def brute_negatives(rows, positives=5, negatives=10):
    usable = []
    for i, v, label in dict.fromkeys((i, None if v is None else tuple(v), label) for i, v, label in rows):
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            usable.append((i, [int(np.floor(256 * x)) for x in v], label))
    out = Counter()
    for a, va, la in usable:
        if a % 20:
            continue
        scored = [(-sum(x * y for x, y in zip(va, v)), i, label) for i, v, label in usable if i != a]
        for p, i, _ in sorted(x for x in scored if x[2] == la)[:positives]:
            below = sorted((s, n) for s, n, label in scored if label != la and 30 * -p <= 100 * -s <= 90 * -p)
            for r, (s, n) in enumerate(below[:negatives], 1):
                out[a, i, r, n, -p, -s] += 1
    return out


def labelled_vectors(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    return frame.selectExpr("*", "1 AS id", "2 AS score", "'x' AS h", "3 AS cell")


@pytest.mark.parametrize("tree_rows", [12, 2048])
def test_hard_negatives(spark, monkeypatch, tree_rows):
    monkeypatch.setattr(hard_negatives, "TREE_ROWS", tree_rows)
    monkeypatch.setattr(hard_negatives, "ANCHORS_AT_ONCE", 3)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 8))
    rows = [(k, [float(x) for x in centres[k % 6] * rng.uniform(0.2, 2) + rng.normal(size=8) / 3], f"l{k % 4}") for k in range(240)]
    rows[60] = (60, rows[61][1], "l1")
    rows += [rows[40], rows[41], (40, rows[3][1], "l2"), (45, rows[3][1], "l0"), (80, [0.0] * 8, "l0"), (81, [], "l0"), (300, [1.0, 2.0], "l1"), (320, None, "l1")]
    rows += [(340, [None] * 8, "l1"), (360, [float("nan")] * 8, "l1"), (380, rows[0][1], None), (None, rows[0][1], "l1"), (400, rows[2][1], "alone"), (420, [-0.0] * 8, "l0")]
    vectors = labelled_vectors(spark, rows)
    got = hard_negatives.mine(vectors, vectors["vec_id"] % 20 == 0).collect()
    assert Counter(map(tuple, got)) == brute_negatives(rows)
    assert hard_negatives.mine(vectors.limit(0), vectors["vec_id"] % 20 == 0).collect() == []
    assert hard_negatives.mine(vectors, vectors["vec_id"] < 0).collect() == []


def test_hard_negatives_of_large_components(spark):
    rows = [(20 * k, [2.0**20 * k, 2.0**21 + k], "ab"[k % 2]) for k in range(12)]
    vectors = labelled_vectors(spark, rows)
    got = hard_negatives.mine(vectors, vectors["vec_id"] % 20 == 0).collect()
    assert Counter(map(tuple, got)) == brute_negatives(rows) and got
    huge = labelled_vectors(spark, [(20, [1e30], "a"), (21, [1e30], "a"), (22, [1e29], "b")])
    with pytest.raises(Exception, match="anchor 20"):
        hard_negatives.mine(huge, huge["vec_id"] % 20 == 0).collect()
    with pytest.raises(Exception, match="row 21"):
        wide = labelled_vectors(spark, [(20, [1.0], "a"), (21, [1.0, 1e200], "a")])
        hard_negatives.mine(wide, wide["vec_id"] % 20 == 0).collect()


def test_cover_tree_invariants_and_skips():
    rng = np.random.default_rng(9)
    points = np.floor(np.repeat(rng.normal(size=(40, 6)) * 200, 50, axis=0) + rng.normal(size=(2000, 6)) * 4)
    tree = cover_tree.build(np.arange(2000), [str(k % 3) for k in range(2000)], points)
    assert sorted(tree.ids.tolist()) == list(range(2000)) and len(tree.centre) > 20
    moved = tree.points.astype(float)
    assert (moved == points[tree.ids]).all()
    full = np.column_stack([moved, np.sqrt(np.maximum(tree.mass**2 - (moved**2).sum(axis=1), 0))]) / tree.mass

    def below(node):
        rows = list(range(*tree.bucket[node]))
        return rows + [r for child in range(*tree.children[node]) for r in below(child)]

    for node in range(len(tree.centre)):
        angles = np.arccos(np.clip(full[below(node)] @ full[tree.centre[node]], -1, 1))
        assert angles.max() <= tree.angle[node] + 1e-7
        # Centres of one parent's children are farther apart than the radius that covers them.
        centres = full[tree.centre[slice(*tree.children[node])]]
        if len(centres) > 1:
            apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))[~np.eye(len(centres), dtype=bool)].min()
            inner = max(2 * np.sin(min(a, np.pi) / 2) for a in tree.angle[slice(*tree.children[node])])
            assert apart >= inner - 1e-5
    verified = []
    seen = cover_tree.Window.add
    try:
        cover_tree.Window.add = lambda self, ids, scores: (verified.append(len(ids)), seen(self, ids, scores))[1]
        window = cover_tree.Window(-(10**9), 10**9, 5)
        tree.search(-1, points[7], "1", True, [window])
    finally:
        cover_tree.Window.add = seen
    scores = sorted(((-int(points[7] @ p), k) for k, p in enumerate(points) if k % 3 == 1))[:5]
    assert [(-int(s), int(i)) for i, s in zip(window.ids, window.scores)] == scores
    assert sum(verified) < 700  # most nodes are skipped
