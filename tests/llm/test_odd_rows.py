"""Rows that lost data or crashed once: repeated ids with other content, large components, clashing names."""

from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.llm import chunk_dedup, jaccard_join, language_id, suffix_dedup, topk, warc


def test_texts_of_one_id_are_documents_of_their_own(spark):
    rng = np.random.default_rng(1)
    own = ["".join(rng.choice(list("abcdefgh "), 1000)) for _ in range(5)]
    shared = "".join(rng.choice(list("ijklmnop "), 150))
    rows = [(1, own[0]), (1, own[1] + shared + "x" + shared), (2, own[2] + shared), (None, own[3]), (None, shared + own[4]), (3, own[0]), (1, own[0])]
    got = suffix_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = Counter((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in got)
    digest = lambda t: sha256(t.encode()).hexdigest()
    want = Counter()
    # Null comes first, so its copy of the passage stays.
    for doc_id, text, left in (
        (1, own[0], own[0]), (1, own[0], own[0]), (1, rows[1][1], own[1] + "x"), (2, rows[2][1], own[2]),
        (None, own[3], own[3]), (None, rows[4][1], rows[4][1]), (3, own[0], ""),
    ):
        want[doc_id, len(text), len(text) - len(left), digest(left)] += 1
    assert kept == want


def test_repeated_page_ids_with_other_content(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    body = "b" * 120
    rows = [(1, "http://a.example.com/", f"html {k}") for k in range(7)] + [(1, "http://a.example.com/", body), (2, "http://b.example.com/", body)]
    rows += [(None, None, "x"), (None, None, "y"), (3, "http://a.example.com/", body + "c"), (1, "http://a.example.com/", "html 0")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = Counter(map(tuple, warc.look_up(warc.capture_keys(pages), warc.write_archive(pages)).collect()))
    want = Counter()
    for page_id, _, html in rows:
        again = page_id == 2
        want[page_id, len(html), sha256(html.encode()).hexdigest(), "revisit" if again else "response", 1 if again else None] += 1
    assert got == want


def test_large_components_raise_an_error_with_the_row(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = frame([(50, [1.0, 2.0]), (51, [1e30, 0.0])])
    with pytest.raises(Exception, match="row 51"):
        topk.top_k(vectors, vectors["vec_id"] % 50 == 0).collect()
    vectors = frame([(50, [2.0**30, 2.0]), (51, [2.0**30, 0.0])])
    with pytest.raises(Exception, match="query 50"):
        topk.top_k(vectors, vectors["vec_id"] % 50 == 0).collect()
    vectors = frame([(50, [2.0**20, 2.0]), (51, [2.0**21, 0.0])])
    assert [r.score for r in topk.top_k(vectors, vectors["vec_id"] % 50 == 0).collect()] == [2**57]


def test_clashing_names_pass_through(spark, odd_documents):
    names = ["packed", "kept", "n_bytes", "n_removed", "n_spans", "_spans", "spans", "_span_id", "rest", "th", "_gone", "_gone_id",
             "_gone_sha", "_gone_id_", "_share", "h", "place", "ids", "keep_id", "component_id"]
    docs = odd_documents.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
    model = language_id.fit(docs.where("lang IS NOT NULL"))
    for stage in (suffix_dedup.clean, jaccard_join.keep_first, chunk_dedup.keep_last, lambda d: language_id.keep_identified(d, model)):
        done = stage(docs)
        assert done.columns == docs.columns
        plain = stage(odd_documents)
        assert Counter(done.select(*odd_documents.columns).collect()) == Counter(plain.collect())
        assert all(r[5 + k] == k for r in done.collect() for k in range(len(names)))
