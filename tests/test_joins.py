import random

import pytest
from pyspark.sql import functions as F

from reviewloom.plans import joins, limits


def _facts(spark, n=400):
    """One key holds two fifths of the rows, some keys are missing, some are unknown."""
    rng = random.Random(6)
    rows = [(i, "hot" if rng.random() < 0.4 else rng.choice([None, "new", *"abcdefgh"])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "i int, k string")


DIM = {"hot": 900, "a": 500, "b": 300, "c": 20, "d": 9, "e": 8, "f": 3, "g": 1}


def _dim(spark):
    return spark.createDataFrame(list(DIM.items()), "k string, n int")


@pytest.mark.parametrize("share", [1, 3, 100])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_keeps_every_row(spark, monkeypatch, share, how):
    monkeypatch.setattr(limits, "HOT_SHARE", share)
    rows, facts = _facts(spark)
    got = joins.skew_join(facts, _dim(spark), "k", how).select("i", "k", "n").collect()
    want = [(i, k, DIM.get(k)) for i, k in rows if how == "left" or k in DIM]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


@pytest.mark.parametrize("bound", [0, 1, 3, 5, 8])
def test_frequency_join_keeps_every_row(spark, monkeypatch, bound):
    monkeypatch.setattr(limits, "BROADCAST_ROWS", bound)
    rows, facts = _facts(spark)
    got = joins.frequency_join(facts, _dim(spark), "k", F.col("n")).select("i", "k", "n").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, k, DIM.get(k))) for i, k in rows)


def test_size_checks(spark, monkeypatch):
    dim = _dim(spark)
    assert joins.local_copy(dim).count() == len(DIM) and joins.fits_broadcast(dim)
    monkeypatch.setattr(limits, "BROADCAST_BYTES", 50)
    assert not joins.fits_broadcast(dim)
    monkeypatch.setattr(limits, "SMALL_ROWS", 7)
    assert joins.local_copy(dim) is None
