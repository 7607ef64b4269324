import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import splitting
from reviewloom.plans import ordering


def _frame(spark, sizes, seed=0):
    rows = [(k, label) for k, label in enumerate(x for label, n in sizes.items() for x in [label] * n)]
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, "k bigint, y string"), dict(rows)


def _expected(labels, seed=0):
    """Split by sorting each class in memory."""
    total = len(labels)
    hold = -(-total // 5)
    classes = sorted(set(labels.values()))
    members = {
        c: sorted((k for k in labels if labels[k] == c), key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))
        for c in classes
    }
    train = splitting.largest_remainder([len(members[c]) for c in classes], total - hold)
    left = [len(members[c]) - t for c, t in zip(classes, train)]
    val = splitting.largest_remainder(left, hold - -(-hold // 2))
    result = {}
    for c, t, v in zip(classes, train, val):
        for place, k in enumerate(members[c]):
            result[k] = "train" if place < t else "val" if place < t + v else "test"
    return result


@pytest.mark.parametrize("large", [False, True])
@pytest.mark.parametrize("sizes", [{"a": 700, "b": 13, "c": 290}, {"a": 2, "b": 3}, {"a": 101}])
def test_split_matches_sorting(spark, sizes, large, request):
    if large:
        request.getfixturevalue("tiny_limits")
    df, labels = _frame(spark, sizes)
    split = {r["k"]: r["split"] for r in splitting.stratified_split(df, "y", "k").collect()}
    assert split == _expected(labels)


def test_split_does_not_depend_on_partitions(spark):
    df, _ = _frame(spark, {"a": 300, "b": 40})
    one = splitting.stratified_split(df.repartition(1), "y", "k", 3).collect()
    many = splitting.stratified_split(df.repartition(7), "y", "k", 3).collect()
    other = splitting.stratified_split(df, "y", "k", 4).collect()
    assert sorted(one) == sorted(many) != sorted(other)


def test_split_quotas_are_within_one_row(spark):
    sizes = {"a": 333, "b": 77, "c": 19}
    df, _ = _frame(spark, sizes)
    counts = Counter((r["y"], r["split"]) for r in splitting.stratified_split(df, "y", "k").collect())
    for label, n in sizes.items():
        assert abs(counts[label, "train"] - 0.8 * n) < 1.2


def test_split_moves_no_text(spark):
    """The wide rows meet only a broadcast; nothing but the narrow counts was exchanged before."""
    df, _ = _frame(spark, {"a": 60, "b": 40})
    wide = df.withColumn("text", F.repeat(F.col("y"), 50))
    plan = splitting.stratified_split(wide, "y", "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_split_rejects_small_and_missing_classes(spark):
    with pytest.raises(ValueError):
        splitting.stratified_split(_frame(spark, {"a": 9, "b": 1})[0], "y", "k")
    with pytest.raises(ValueError):
        splitting.stratified_split(spark.createDataFrame([(1, "a"), (2, None)], "k int, y string"), "y", "k")


@pytest.mark.parametrize("large", [False, True])
def test_sample_is_exact(spark, large, request):
    if large:
        request.getfixturevalue("tiny_limits")
    df, _ = _frame(spark, {"a": 600, "b": 31, "c": 5})
    sample = splitting.stratified_sample(df, "y", "k", 100).collect()
    assert len(sample) == 100 and len({r["k"] for r in sample}) == 100
    assert Counter(r["y"] for r in sample) == {"a": 94, "b": 5, "c": 1}
    assert splitting.stratified_sample(df, "y", "k", 636).count() == 636
    assert splitting.stratified_sample(df, "y", "k", 9_999).count() == 636


def test_allocation_ties_go_to_the_smaller_label(spark):
    assert splitting.largest_remainder([5, 5, 5], 4) == [2, 1, 1]
    classes = spark.createDataFrame([("c", 5), ("a", 5), ("b", 5)], "y string, n bigint")
    rows = splitting.allocate(classes, "y", "n", 4, "q").collect()
    assert {r["y"]: r["q"] for r in rows} == {"a": 2, "b": 1, "c": 1}


def test_overlaps(spark):
    df = spark.createDataFrame([(1, "train"), (1, "val"), (2, "test"), (2, "test"), (3, "train")], "k int, split string")
    assert tuple(splitting.split_overlaps(df, "k").first()) == (1, 0, 0)


def test_union_matches_columns_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, t string")
    b = spark.createDataFrame([("y", 2), ("y", 2)], "t string, k int")
    rows = splitting.final_training_set(a, b, a.withColumn("z", F.lit(5))).collect()
    assert sorted((r["k"], r["t"], r["z"] or 0) for r in rows) == [(1, "x", 0), (1, "x", 5), (2, "y", 0), (2, "y", 0)]


def _groups(n, seed):
    """One group holds two thirds of the rows; some rows have no group."""
    rng = random.Random(seed)
    return [(i, "hot" if rng.random() < 0.66 else rng.choice(["a", "b", None]), rng.randrange(50)) for i in range(n)]


def test_sorted_index_in_a_hot_group(spark):
    rows = _groups(500, 1)
    df = spark.createDataFrame(rows, "i int, g string, v int")
    got = {r["i"]: r["p"] for r in ordering.sorted_index(df, ["g"], [F.col("v"), F.col("i")], "p").collect()}
    seen, want = Counter(), {}
    for i, g, _ in sorted(rows, key=lambda r: (r[2], r[0])):
        want[i] = seen[g]
        seen[g] += 1
    assert got == want


def test_sum_before_in_a_hot_group(spark):
    rows = _groups(300, 2)
    df = spark.createDataFrame(rows, "i int, g string, v bigint")
    got = {r["i"]: r["s"] for r in ordering.sum_before(df, ["g"], [F.col("i")], "v", "s").collect()}
    seen, want = Counter(), {}
    for i, g, v in rows:
        want[i] = seen[g]
        seen[g] += v
    assert got == want


def test_rank_with_a_value_shared_by_most_rows(spark):
    rng = random.Random(3)
    rows = [(i, "hot" if i % 3 else "b", 7.0 if rng.random() < 0.7 else float(rng.randrange(15))) for i in range(400)]
    df = spark.createDataFrame(rows, "i int, g string, v double")
    got = {r["i"]: r["rank"] for r in ordering.competition_rank(df, ["g"], "v", "i").collect()}
    want = {i: 1 + sum(1 for _, h, w in rows if h == g and w > v) for i, g, v in rows}
    assert got == want


def test_running_max_over_chunks(spark):
    rng = random.Random(4)
    rows = [(g, p, rng.randrange(1000)) for g in ("hot", None) for p in range(1, 80 if g else 9)]
    df = spark.createDataFrame(rows, "g string, p int, v int")
    got = {(r["g"], r["p"]): r["m"] for r in ordering.running_max(df, ["g"], "p", "v", "m", chunk=10).collect()}
    assert got == {(g, p): max(w for h, q, w in rows if h == g and q <= p) for g, p, _ in rows}


def test_hash_order_is_a_permutation(spark):
    df = spark.range(257).withColumnRenamed("id", "k")
    rows = ordering.hash_ordered_index(df, "k", 9).collect()
    order = sorted(range(257), key=lambda k: hashlib.md5(f"9:{k}".encode()).hexdigest())
    assert {r["k"]: r["row_index"] for r in rows} == {k: i for i, k in enumerate(order)}
