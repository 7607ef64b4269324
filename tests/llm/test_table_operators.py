"""Archives, vector search, chat formatting, the queries' SQL, and the pipeline."""

import sys
from collections import Counter
from hashlib import sha256
from pathlib import Path

import duckdb
import numpy as np
import pytest

from reviewloom.llm import chat, files, queries, topk, warc

SF_DIR = "/root/testdata/sf0.001"


def test_archive(spark):
    body = "<p>" + "same " * 40
    rows = [
        (1, "http://www.a.example.com:80/x?q=1", body, "k"), (2, "https://b.example.com/", body, "k"), (3, None, body, "k"),
        (4, "http://a.example.com/y", "short", "k"), (5, "not a url\r\nx", "short", None), (6, "http://c.example.com/z", None, "k"),
        (7, "http://a.example.com/y", "é" * 60, "k"), (None, "http://a.example.com/n", body, "k"), (1, "http://www.a.example.com:80/x?q=1", body, "k"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, key string")
    index = warc.write_archive(pages)
    got = Counter(map(tuple, warc.look_up(warc.capture_keys(pages), index).collect()))
    want = Counter()
    for page_id, _, html, _ in rows:
        data = (html or "").encode()
        first = 1 if html == body and page_id not in (1, None) else None
        want[page_id, len(data), sha256(data).hexdigest(), "revisit" if first else "response", first] += 1
    assert got == want
    missing = spark.createDataFrame([("zz,nowhere)/ 5",), ("!",)], "key string")
    assert warc.look_up(missing, index).collect() == []
    empty = warc.write_archive(pages.limit(0))
    assert empty == [] and warc.look_up(warc.capture_keys(pages), empty).collect() == []


def test_revisits_to_odd_urls(spark):
    odd = ["http://münchen.de/", "http://WWW.MÜNCHEN.de/ä?ö", " http://a.example.com/b", "http://a.example.com/b\tc", "http://a.example.com/b\r\nc: d", "http://a b.example.com/\u00a0", "http://%C3%BC%FF.de/%41%", "x y\n", "http://a.example.com:99999/ü", "http://[::1]:80/ü", ""]
    rows = [(10 * k + n, url if n == 0 else "http://b.example.com/", f"{k} " * 100) for k, url in enumerate(odd) for n in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = Counter(map(tuple, warc.look_up(warc.capture_keys(pages), warc.write_archive(pages)).collect()))
    want = Counter()
    for page_id, _, html in rows:
        first = page_id - page_id % 10
        again = page_id != first
        want[page_id, len(html), sha256(html.encode()).hexdigest(), "revisit" if again else "response", first if again else None] += 1
    assert got == want
    assert warc.url_key(odd[0]) == "de,m%C3%BCnchen)/" and warc.url_key(odd[1]).startswith("de,m%C3%BCnchen)/%C3%A4?")


def test_archive_members_are_standalone_and_blocks_sparse(spark, monkeypatch):
    import gzip

    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").limit(40)
    reader = warc.Reader(warc.write_archive(pages))
    for page in pages.collect():
        path, offset, length = reader.find(warc.capture_key(page.url, page.page_id))
        record = gzip.decompress(files.open_ranges(path).read_at(length, offset))
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert warc.parse(record)[1] == page.html.encode()
    assert warc.url_key("https://www.b.example.com/p?q") == "com,example,b)/p?q"


def brute_top(rows, k):
    out = []
    usable = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for q, a in usable:
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("block", [7, 4096])
def test_top_k(spark, block):
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(x) for x in rng.normal(size=40).astype(np.float32)]) for i in range(220)]
    rows[60] = (60, list(rows[61][1]))  # ties
    rows += [(300, None), (301, [None] * 40), (302, [float("nan")] * 40), (303, [float("inf")] * 40), (None, rows[0][1]), (350, [1.0, 2.0]), (351, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score")
    got = topk.top_k(vectors, vectors["vec_id"] % 50 == 0, 5, block_rows=block).collect()
    assert Counter(map(tuple, got)) == brute_top(rows, 5)
    assert topk.top_k(vectors.limit(0), vectors["vec_id"] % 50 == 0).collect() == []


def test_top_k_is_exact_for_large_components():
    big = np.array([[2**40, 1], [2**40, 2], [2**40, 3]], np.int64)
    found = list(topk.search(np.array([0]), big[:1], np.arange(3), big.T, 2))
    assert found[0][1].tolist() == [2, 1] and [int(x) for x in found[0][2]] == [2**80 + 3, 2**80 + 2]


def test_chat_round_trip(spark):
    tricky = ["\\### Assistant: </turn> ok", "\\h\\b\\t\\n", "####", "##", "<</turn>/turn>", "", None, "a:\n### b", "é😀\n"]
    rows = [(1, k, "assistant" if k % 3 else "user", t, 0) for k, t in enumerate(tricky)]
    rows += [(2, 1, None, "x", 0), (2, 1, "user", "y", 0), (2, None, "od:\nd ### r", "z", 0), (2, 1, "user", "y", 0), (None, 1, "assistant", "w", 0)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    formatted = chat.format_conversations(turns)
    read = formatted.select("conv_id", chat.read_turns(formatted["formatted"]).alias("t"), chat.loss_text(formatted["segments"]).alias("l"))
    got = {r.conv_id: ([(t.role, t.text) for t in r.t], r.l) for r in read.collect()}
    ordered = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    for conv in (1, 2, None):
        want = [(r[2] or "", r[3] or "") for r in ordered if r[0] == conv]
        assert got[conv] == (want, "".join(t for role, t in want if role == "assistant"))
    one = formatted.where("conv_id = 2").first().formatted
    assert one.count("### user:\n") == 1  # neighbours of a role share a header
    assert chat.digests(chat.format_conversations(turns.limit(0))).collect() == []


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(want.columns)
    assert Counter(tuple(r[c] for c in want.columns) for r in got.collect()) == Counter(want.fetchall())


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark, odd_documents, tmp_path):
    sys.path.insert(0, str(Path(__file__).parents[2]))
    import corpus_pipeline

    odd_documents.write.parquet(str(tmp_path / "documents.parquet"))
    rows = odd_documents
    counts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, str(tmp_path))
        assert rows.columns == odd_documents.columns
        counts.append(rows.count())
    # und: 3, 4, 5, 12; copies: 1 and nothing of the repeated row; near: 7 or 6, 10 or 2; passages only shorten.
    assert counts == [12, 11, 9, 9]
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in rows.collect()}


def test_pipeline_against_brute_force(spark, odd_documents, tmp_path):
    sys.path.insert(0, str(Path(__file__).parents[2]))
    import corpus_pipeline
    from tests.llm.test_text_operators import brute_components, library_ids

    odd_documents.write.parquet(str(tmp_path / "documents.parquet"))
    rows = [(r.doc_id, r.text) for r in odd_documents.collect() if any(map(str.isalpha, r.text or ""))]
    last = {text: max((d for d, t in rows if t == text and d is not None), default=None) for _, text in rows}
    rows = [(d, t) for d, t in rows if d == last[t]]
    gone = {d for d, _, least in brute_components(rows) if d is not None and d != least}
    rows = [(d, t) for d, t in rows if d not in gone]
    seen, cut = set(), {}
    for doc_id, text in sorted(dict(rows).items(), key=lambda r: (r[0] is not None, r[0] or 0)):
        data, keep = text.encode(), np.ones(len(text.encode()), bool)
        for k in range(len(data) - 99):
            if data[k : k + 100] in seen:
                keep[k : k + 100] = False
            seen.add(data[k : k + 100])
        cut[doc_id] = bytes(np.frombuffer(data, np.uint8)[keep]).decode("utf-8", "ignore")
    assert any(cut[d] != t for d, t in rows)
    ids = {d: x + [0] for d, x in zip(cut, library_ids(list(cut.values())))}
    got, used = Counter(), Counter()
    for p in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got.update((p.doc_id, p.start + k, int(x)) for k, x in enumerate(np.frombuffer(bytes(p.ids), "<u4")))
        used.update((p.sequence_id, p.offset + k) for k in range(p.length))
    assert got == Counter((d, k, x) for d, _ in rows for k, x in enumerate(ids[d]))
    assert max(used.values()) == 1
