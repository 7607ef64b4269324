"""The factorisation machine against sums over all pairs, and its accuracy on held-out rows."""

import zlib
from collections import Counter
from itertools import combinations

import numpy as np

from reviewloom.llm import quality, queries


def brute_margin(model, places, values):
    """The constant, each weight, and each pair of features, one by one."""
    pairs = sum(
        float(model.factors[a] @ model.factors[b]) * float(x) * float(y)
        for (a, x), (b, y) in combinations(zip(places.tolist(), values.tolist()), 2)
    )
    return float(model.weights[0]) + sum(float(model.weights[a + 1]) * float(x) for a, x in zip(places, values)) + pairs


def random_model():
    rng = np.random.default_rng(5)
    return quality.Model(rng.normal(size=quality.FEATURES + 1) / 9, rng.normal(size=(quality.FEATURES, quality.RANK)) / 9)


def test_scores_are_sums_over_all_pairs(spark, odd_documents, no_documents):
    model = random_model()
    got = quality.score(odd_documents, model, ["doc_id", "n_tokens", "source"], ["lang", "n_tokens"]).collect()
    assert [f for f in got[0].asDict()] == ["doc_id", "n_tokens", "source", "score", "predicted"]
    want = []
    for r in odd_documents.collect():
        places, values = quality.features(r.text, (r.lang, r.n_tokens), quality.Tokens())
        want.append((r.doc_id, 1 / (1 + np.exp(-brute_margin(model, places, values)))))
    assert len(got) == len(want)
    for key in {d for d, _ in want}:
        mine, theirs = sorted(r.score for r in got if r.doc_id == key), sorted(s for d, s in want if d == key)
        assert np.allclose(mine, theirs, atol=1e-9)
    assert all(r.predicted == (r.score >= 0.5) for r in got)
    assert quality.score(no_documents, model, ["doc_id"]).collect() == []
    # Extra columns with the names of the results or of internal ones do no harm.
    clashing = odd_documents.selectExpr("*", "1 AS score", "2 AS predicted", "3 AS t", "4 AS m", "5 AS h", "6 AS label")
    assert Counter(quality.score(clashing, model, ["doc_id"], ["lang", "n_tokens"]).collect()) == Counter(r for r in quality.score(odd_documents, model, ["doc_id"], ["lang", "n_tokens"]).collect())


def test_features():
    tokens = quality.Tokens()
    places, values = quality.features("Ab ab, AB!! 12 é ab\nab ab", (None,), tokens)
    words = dict(zip(places[:-1].tolist(), values.tolist()))
    bucket = zlib.crc32(b"ab") % quality.WORD_BUCKETS
    # "Ab", "ab,", "AB!!" and "ab" (3 times) are one word in four forms.
    raw = np.array([1, 1, 1, 1 + np.log(3), 1, 1])
    assert np.isclose(values[places == bucket].sum(), (3 + 1 + np.log(3)) / np.sqrt((raw**2).sum()), atol=1e-6)
    named = dict(zip(quality.STATISTICS, values[-2 * len(quality.STATISTICS) : -len(quality.STATISTICS)]))
    assert np.isclose(named["distinct"], 6 / 8) and np.isclose(named["most common"], 3 / 8) and np.isclose(named["repeats"], 2 / 7)
    assert np.isclose(named["capital tokens"], 1 / 8) and np.isclose(named["marked tokens"], 2 / 8) and np.isclose(named["number tokens"], 1 / 8)
    assert named["repeated lines"] == 0 and bucket in words
    for odd in (None, "", " \n", "\x00", "!!! ???"):
        p, v = quality.features(odd, (), tokens)
        assert np.isfinite(v).all() and len(p) == len(v) >= 2 * len(quality.STATISTICS)


def test_token_memory_may_be_small(monkeypatch):
    text = " ".join(f"w{k % 50}" for k in range(200))
    want = quality.features(text, (), quality.Tokens())
    monkeypatch.setattr(quality, "CACHED_TOKENS", 7)
    tokens = quality.Tokens()
    for _ in range(2):
        assert all((a == b).all() for a, b in zip(quality.features(text, (), tokens), want))


def test_gradient_is_that_of_the_loss():
    model = random_model()
    rows = [(*quality.features(t, (), quality.Tokens()), y) for t, y in (("one two two", 1.0), ("three ONE!!", 0.0))]

    def loss(m):
        margins = [brute_margin(m, p, v) for p, v, _ in rows]
        return np.mean([np.log1p(np.exp(-z if y else z)) for z, (_, _, y) in zip(margins, rows)])

    seen = quality.Model(np.zeros(quality.FEATURES + 1), np.zeros((quality.FEATURES, quality.RANK)))
    moved = quality.Model(model.weights.copy(), model.factors.copy())
    quality.epoch(moved, seen, rows)
    place = int(rows[0][0][0])
    for table, at in (("weights", (place + 1,)), ("factors", (place, 2))):
        step = 1e-5
        ends = []
        for sign in (1, -1):
            other = quality.Model(model.weights.copy(), model.factors.copy())
            getattr(other, table)[at] += sign * step
            ends.append(loss(other))
        slope = (ends[0] - ends[1]) / (2 * step) + quality.SHRINK * getattr(model, table)[at]
        assert np.isclose(getattr(seen, table)[at], slope**2, rtol=1e-3, atol=1e-12)


def test_fit_without_and_with_odd_labels(spark, odd_documents, no_documents):
    none = spark.createDataFrame([(None, 1), (1, None), (99, 1)], "doc_id long, label int")
    model = quality.fit(odd_documents, none, ["source"])
    assert {r.score for r in quality.score(odd_documents, model, ["doc_id"], ["source"]).collect()} == {0.5}
    some = spark.createDataFrame([(k, k % 2) for k in range(1, 15)] * 2 + [(9, 0)], "doc_id long, label int")
    one, two = (quality.fit(odd_documents, some.orderBy(x), ["source"]) for x in ("label", "doc_id"))
    assert (one.weights == two.weights).all() and one.weights.any()
    empty = quality.fit(no_documents, some)
    assert not empty.weights.any()


def test_held_out_quality(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.QUERIES["op12_quality"](spark, sf_dir).collect()}
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    judged = [(got[r.doc_id].score, r.quality) for r in labels if r.quality is not None and r.doc_id in got and got[r.doc_id].held_out]
    good, bad = (np.array([s for s, q in judged if q == k]) for k in (1, 0))
    area = (good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean()
    right = np.mean([(s >= 0.5) == (q == 1) for s, q in judged])
    print(len(judged), area, right)
    assert area > 0.97 and right > 0.95
