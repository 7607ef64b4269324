"""Corpus operators on documents against brute force, on odd rows and on empty tables."""

import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
import public_tokenizers as tokens

from reviewloom.llm import bpe, chunk_dedup, columns, id_coder, induced, jaccard_join, language_id, packing, suffix_dedup, token_file
from reviewloom.llm.pieces import piece_starts

JSON, RANKS = tokens.path("byte_bpe_50k.json"), tokens.path("byte_bpe_50k.tiktoken")


def library_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(JSON)
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_suffix_order_against_sorting():
    rng = np.random.default_rng(0)
    for turn in range(120):
        text = rng.integers(0, rng.integers(1, 5), rng.integers(1, 70)).astype([np.uint8, np.int64][turn % 2])
        if turn % 4 == 0:
            text = np.tile(text[:9], 5)
        suffixes = [tuple(text[k:].tolist()) for k in range(len(text))]
        for memory in (3, 10**6):  # a tiny memory spills queues and recurses
            order, _ = induced.suffix_order(text, 0, memory)
            assert order.tolist() == sorted(range(len(text)), key=suffixes.__getitem__)
            order, lcps = induced.suffix_order(text, 6, memory)
            heads = [suffixes[k][:6] for k in order]
            assert heads == sorted(heads)
            for a, b, n in zip(heads, heads[1:], lcps[1:]):
                same = [x == y for x, y in zip(a, b)] + [False]
                assert same.index(False) == n


def brute_repeats(rows):
    """Expected (n_bytes, n_removed, n_spans, sha) by doc_id, a row of an id counted once."""
    seen, out = set(), {}
    for doc_id, text in sorted(dict(rows).items(), key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - 99):
            if data[k : k + 100] in seen:
                gone[k : k + 100] = True
            seen.add(data[k : k + 100])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((gone[1:] < gone[:-1]).sum())
        out[doc_id] = (len(data), int(gone.sum()), spans, sha256(kept).hexdigest())
    return out


def test_repeated_passages(odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = suffix_dedup.digests(odd_documents).collect()
    want = brute_repeats(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id
    cleaned = suffix_dedup.clean(odd_documents)
    assert cleaned.columns == odd_documents.columns and cleaned.count() == len(rows)
    assert suffix_dedup.digests(no_documents).collect() == []


def test_shard_limits_do_not_matter(odd_documents, monkeypatch):
    want = sorted(suffix_dedup.digests(odd_documents).collect(), key=str)
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 300)
    monkeypatch.setattr(suffix_dedup, "SEGMENT_WINDOWS", 1000)
    rows = [(r.doc_id, r.text or "") for r in odd_documents.collect()]
    data = [t.encode() for _, t in rows]
    flat = np.frombuffer(b"".join(data), np.uint8)
    offsets = np.cumsum([0] + [len(d) for d in data])
    parts = list(suffix_dedup._parts(offsets))
    assert len(parts) > 10
    covered = Counter()
    for row, stop, a, b in parts:
        inner = np.clip(offsets[row : stop + 1], a, b) - a
        for first, last in zip(*suffix_dedup.contexts(flat[a:b], inner)[3:5]):
            covered.update(range(a + first, a + last + 1))
    every = {k for d, o in zip(data, offsets) for k in range(o, o + len(d) - 99)}
    assert set(covered) == every and max(covered.values()) == 1
    assert len(want) == len(rows)


@pytest.mark.parametrize("bound", [150, 500, 4000])
def test_large_anchors_are_split(spark, bound):
    rng = np.random.default_rng(8)
    line = "a line that stands in every one of the texts, between other words that mostly differ but not always."
    sides = ["".join(rng.choice(list("xyz "), 60)) for _ in range(6)]
    rows = [(k, sides[rng.integers(6)][rng.integers(50) :] + line + sides[rng.integers(6)][: rng.integers(60)]) for k in range(150)]
    rows += [(k, "".join(rng.choice(list("xy"), 60)) + line[:50] + "".join(rng.choice(list("xy"), 60))) for k in range(150, 300)]
    rows += [(7, rows[7][1]), (None, rows[8][1]), (400, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.repeats(suffix_dedup.anchors(docs))
    chosen, done = suffix_dedup.split_large(found, docs, bound)
    held = Counter()
    for r in chosen.collect():
        held[r.h] += (r.place >> 7 & 127) + 100
    assert max(held.values(), default=0) <= bound
    spans = done.unionByName(suffix_dedup.sorted_repeats(suffix_dedup.context_texts(chosen, docs), bound))
    by_id = {}
    for r in spans.collect():
        by_id.setdefault(r.doc_id, []).append((r.start, r.stop))
    for doc_id, (n_bytes, n_removed, n_spans, _) in brute_repeats(rows).items():
        runs = suffix_dedup.merged(*np.array(by_id.get(doc_id, []), np.int64).reshape(-1, 2).T, n_bytes)
        assert (sum(b - a for a, b in runs), len(runs)) == (n_removed, n_spans), doc_id


def brute_components(rows):
    word = re.compile(rb"[^\x20\x09-\x0D]+")
    sets = []
    for _, text in rows:
        w = word.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))
    for _ in rows:
        for a, (x, _) in enumerate(rows):
            for b, (y, _) in enumerate(rows):
                same = len(sets[a] & sets[b])
                if same and x is not None and y is not None and 100 * same >= 75 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    least = {k: min((rows[j][0] for j in range(len(rows)) if label[j] == label[k] and rows[j][0] is not None), default=None) for k in range(len(rows))}
    return Counter((r[0], len(sets[k]), least[k]) for k, r in enumerate(rows))


def test_similarity_join(spark, odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    rng = np.random.default_rng(1)
    base = [f"w{k}" for k in rng.integers(0, 60, 120)]
    for k in range(40):  # a chain of ever more changed copies, linked step by step
        base = list(base)
        base[int(rng.integers(0, 120))] = f"v{k}"
        rows.append((100 + k, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.similar_components(docs).collect()
    assert Counter(map(tuple, got)) == brute_components(rows)
    kept = jaccard_join.keep_first(odd_documents)
    assert kept.columns == odd_documents.columns
    assert {1, 3, 4, 5, 6} <= {r.doc_id for r in kept.collect()} and not {2, 7, 10} & {r.doc_id for r in kept.collect()}
    assert jaccard_join.similar_components(no_documents).collect() == []


def test_every_link_of_the_join(spark, odd_documents, no_documents, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", 3)
    monkeypatch.setattr(jaccard_join, "BLOCKS_AT_ONCE", 2)
    rng = np.random.default_rng(9)
    rows = [(r.doc_id, r.text) for r in odd_documents.where("doc_id <> 9").collect()]
    base = [f"w{k}" for k in range(150)]
    for k in range(60):  # near copies of one text, all in one part after a few neighbours
        words = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 4)):
            words[at] = f"v{rng.integers(4)}"
        rows.append((100 + k, " ".join(words[: 150 - int(rng.integers(0, 45))])))
    rows += [(200, "a b c d e f"), (201, "a b c d e f g"), (202, "a b c d e f g h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    members, found = jaccard_join.similar_links(docs)
    class_of = {r.doc_id: r.class_id for r in members.collect()}
    links_of = {(r.a, r.b): (r.shared, r.total) for r in found.collect()}
    sets = {}
    for doc_id, text in rows:
        w = (text or "").lower().split()
        if w and doc_id is not None:
            sets[doc_id] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    least = {d: min(e for e in sets if sets[e] == sets[d]) for d in sets}
    assert class_of == least
    linked = lambda x, y: 100 * len(x & y) >= 75 * len(x | y)
    want = {(a, b): (len(sets[a] & sets[b]), len(sets[a] | sets[b])) for a in set(least.values()) for b in set(least.values()) if a < b and linked(sets[a], sets[b])}
    assert len(want) > 500 and links_of == want
    counts = {r.doc_id: r.n_links for r in jaccard_join.link_counts(docs).collect()}
    assert counts == {d: sum(linked(sets[d], sets[e]) for e in sets if e != d) for d in sets}
    assert [x.collect() for x in jaccard_join.similar_links(no_documents)] == [[], []]


def test_bounds_of_the_join_hold():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 62, rng.integers(1, 90)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.random()], rng.integers(0, 1 << 62, rng.integers(1, 40)).astype(np.uint64)]))
        differ = len(np.setxor1d(a, b))
        assert jaccard_join.least_difference(jaccard_join.parity_bitmap(a), jaccard_join.parity_bitmap(b)) <= differ
        if jaccard_join.links(a, b):
            assert differ <= jaccard_join.most_difference(len(a), len(b))
            assert set(a[: jaccard_join.prefix_size(np.int64(len(a)))].tolist()) & set(b[: jaccard_join.prefix_size(np.int64(len(b)))].tolist())


def test_folded_bitmaps_bound_differences():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 5, 90, 130, 260, 3000, 3000)]
    sets += [np.union1d(sets[3][7:], sets[0]), np.union1d(sets[5][40:], sets[2])]
    whole = [jaccard_join.parity_bitmap(s) for s in sets]
    small = [jaccard_join.folded(b) for b in whole]
    assert max(map(len, small)) <= jaccard_join.FOLDED_BYTES < max(map(len, whole))
    i, j = (x.ravel() for x in np.indices((len(sets), len(sets))))
    for bitmaps in (whole, small):
        low = jaccard_join.least_differences(bitmaps, i, j)
        for a, b, bound in zip(i.tolist(), j.tolist(), low.tolist()):
            assert bound == jaccard_join.least_difference(bitmaps[a], bitmaps[b])
            assert bound <= len(np.setxor1d(sets[a], sets[b]))


def test_lists_across_batches_stay_whole():
    heads = np.sort(np.random.default_rng(5).integers(0, 9, 60)) << 24
    rows = pa.RecordBatch.from_arrays([pa.array(heads + np.arange(60)), pa.array(np.arange(60))], names=["entry", "leader"])
    for size in (1, 2, 7, 60):
        parts = list(jaccard_join._whole_lists((rows.slice(k, size) for k in range(0, 60, size)), 24))
        assert [x for p in parts for x in p.column(1).to_pylist()] == list(range(60))
        ends = [(p.column(0)[0].as_py() >> 24, p.column(0)[-1].as_py() >> 24) for p in parts if p.num_rows]
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_cleaning_takes_one_worker_a_task_and_drops_half_characters(spark):
    passage = " ".join(f"word{k}" for k in range(30))
    docs = spark.createDataFrame([(1, "\u00e9" + passage, 9), (2, "\u0169" + passage, 9), (3, None, 9)], "doc_id long, text string, n_chars int")
    cleaned = suffix_dedup.clean(docs)
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
    assert sorted(map(tuple, cleaned.collect())) == [(1, "\u00e9" + passage, len(passage) + 1), (2, "", 0), (3, "", 0)]


def test_tasks_return_memory_before_their_workers_wait(monkeypatch):
    events = []
    monkeypatch.setattr(columns, "give_back", lambda: events.append("back"))

    @columns.gives_back
    def run(batches):
        for batch in batches:
            events.append(batch)
            yield batch

    assert list(run(iter([1, 2]))) == [1, 2] and events == ["back", 1, 2, "back"]


@pytest.mark.parametrize("largest", [1, 16, 50_257, 2**32 - 1])
def test_range_coder_round_trip(largest):
    rng = np.random.default_rng(3)
    blocks = [rng.integers(0, largest + 1, n) for n in (1, 2, 300)] + [np.full(500, largest), np.arange(200) % (largest + 1)]
    nibbles = id_coder.nibbles_for(largest)
    read = id_coder.decode_blocks(id_coder.encode_blocks(blocks, nibbles), [len(b) for b in blocks], nibbles)
    assert all((a == b).all() for a, b in zip(blocks, read))
    # A block is coded alone: alone or among others, the bytes are the same.
    assert id_coder.encode_blocks(blocks[2:3], nibbles)[0] == id_coder.encode_blocks(blocks, nibbles)[2]


@pytest.mark.parametrize("largest", [1, 300, 50_257, 2**32 - 1])
def test_shares_are_whole_and_code_ids_in_one_step(largest):
    rng = np.random.default_rng(6)
    ids = np.append(np.minimum(rng.zipf(1.2, 5000), largest), [largest, 0]).astype("<u4")
    shares = id_coder.shares_of(ids)
    again = id_coder.unpack_shares(id_coder.pack_shares(shares))
    assert shares.widths.sum() == 1 << id_coder.SHARE_BITS and shares.widths.min() > 0
    assert (again.ids == shares.ids).all() and (again.widths == shares.widths).all()
    # Ids that the shares do not know are coded too.
    other = rng.integers(0, largest + 1, 700).astype("<u4")
    blocks, nibbles = [*np.array_split(ids, 7), other], id_coder.nibbles_for(largest)
    coded = id_coder.encode_blocks(blocks, nibbles, shares)
    read = id_coder.decode_blocks(coded, [len(b) for b in blocks], nibbles, again)
    assert all((a == b).all() for a, b in zip(blocks, read, strict=True))
    assert id_coder.encode_blocks(blocks[:1], nibbles, shares) == coded[:1]
    alone = id_coder.encode_blocks(blocks[:7], nibbles)
    assert largest < 300 or sum(map(len, coded[:7])) < 0.8 * sum(map(len, alone))


def test_groups_of_a_token_file(tmp_path, monkeypatch):
    monkeypatch.setattr(id_coder, "LANES", 3)
    monkeypatch.setattr(token_file, "BLOCK_IDS", 8)
    rng = np.random.default_rng(7)
    docs = [(k, rng.integers(0, 50, n).astype("<u4")) for k, n in enumerate([5, 0, 200, 1, 24, 24, 7, 0])]
    path = str(tmp_path / "groups.ids")
    writer = token_file.Writer(open(path, "wb"), 2)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    monkeypatch.setattr(token_file.files, "_at", lambda p: (pafs.LocalFileSystem(), p))
    assert [(d, list(ids)) for d, _, ids in token_file.read(path)] == [(d, list(ids)) for d, ids in docs]
    damaged = bytearray(open(path, "rb").read())
    damaged[7 + 12 + 3] ^= 1
    (tmp_path / "damaged.ids").write_bytes(damaged)
    with pytest.raises(ValueError, match="damaged"):
        list(token_file.read(str(tmp_path / "damaged.ids")))


def test_token_files(odd_documents, no_documents, tmp_path):
    manifest = token_file.write_documents(odd_documents, JSON)
    got = sorted(token_file.read_documents(manifest).collect(), key=lambda r: r.start)
    rows = sorted(((r.doc_id, r.text) for r in odd_documents.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for r, (doc_id, text) in zip(got, rows, strict=True):
        ids = np.array(library_ids([text])[0] + [2], "<u4")
        assert (r.doc_id, r.start, bytes(r.ids)) == (doc_id, start, ids.tobytes())
        start += len(ids)
    path = manifest.first().path.removeprefix("file://")
    damaged = bytearray(open(path, "rb").read())
    damaged[30] ^= 1
    (tmp_path / "damaged.ids").write_bytes(damaged)
    with pytest.raises(ValueError, match="damaged"):
        list(token_file.read(str(tmp_path / "damaged.ids")))
    assert token_file.read_documents(token_file.write_documents(no_documents, JSON)).collect() == []


def test_language_identification(spark, odd_documents, no_documents):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    learns = language_id.training_row(table["doc_id"])
    model = language_id.fit(table.where(learns))
    judged = language_id.predict(table.where(~learns), model).collect()
    right = [r.lang == r.lang_pred for r in judged if r.lang]
    assert len(right) > 20 and sum(right) / len(right) > 0.97
    odd = {r.doc_id: r for r in language_id.predict(odd_documents, model).collect()}
    for doc_id in (3, 4, 5, 12):
        assert (odd[doc_id].lang_pred, odd[doc_id].score) == ("und", 0.0)
    assert odd[11].lang_pred == "de" and all(0 <= r.score <= 1 for r in odd.values())
    kept = language_id.keep_identified(odd_documents, model)
    assert kept.columns == odd_documents.columns and kept.count() == 12
    nothing = language_id.fit(no_documents)
    assert {r.lang_pred for r in language_id.predict(odd_documents, nothing).collect()} == {"und"}
    assert language_id.predict(no_documents, model).collect() == []


def test_every_language_is_learned(spark, monkeypatch):
    rng = np.random.default_rng(10)
    words = {f"l{k:03d}": ["".join(rng.choice(list("abcdefghij"), 9)) for _ in range(3)] for k in range(300)}
    rows = [(10 * k + n, " ".join(w), lang) for k, (lang, w) in enumerate(words.items()) for n in range(2)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = spark.createDataFrame([(lang, w[0]) for lang, w in words.items()], "lang string, text string")
    judged = language_id.predict(texts, model).collect()
    assert len(judged) == 300 and all(r.lang == r.lang_pred for r in judged)
    monkeypatch.setattr(language_id, "WORD_ENTRIES", 5)
    monkeypatch.setattr(language_id, "GRAM_ENTRIES", 5)
    rows = [(k, " ".join(f"{a}{b}" for a in "abcde" for b in "fghij") + " seltsam", "big") for k in range(20)]
    rows += [(100, "klein wenig klein wenig", "small"), (101, None, "small"), (102, "x", None)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {"klein", "wenig"} <= set(model.words) and len(model.words) == 7 and model.languages == ["big", "small"]


def test_word_first_then_shorter_grams():
    table = np.arange(12, dtype=np.float32).reshape(6, 2)
    model = language_id.Model(["a", "b"], {"known": 1}, {" unk": 2, "ow": 3, "q": 4}, table)
    assert model.vector("known").tolist() == table[1].tolist()
    assert model.vector("unkow").tolist() == table[2].tolist()  # four characters before two
    assert model.vector("zzow").tolist() == table[3].tolist()
    assert model.vector("zzz").tolist() == table[0].tolist()


def test_packing(odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).collect()]
    ids = {d: np.array(x + [0], "<u4") for (d, _), x in zip(rows, library_ids([t for _, t in rows]))}
    docs = odd_documents.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    pieces = packing.pack_documents(docs, JSON, bucket_tokens=9000).collect()
    covered, sequences = {}, {}
    for p in pieces:
        body = ids[p.doc_id][p.start : p.start + p.length]
        assert bytes(p.ids) == body.tobytes() and p.length == len(body) and p.doc_tokens == len(ids[p.doc_id])
        covered.setdefault(p.doc_id, []).append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts, whole in [(covered[d], len(ids[d])) for d in ids] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == whole if whole is not None else at <= 1024
    assert packing.pack_documents(odd_documents, JSON).count() >= odd_documents.count()
    assert packing.pack_documents(no_documents, JSON).collect() == []


def test_packing_balances_cost_and_wastes_less_than_a_sequence():
    lengths = np.random.default_rng(4).integers(1, 3000, 400)
    used = Counter()
    for _, _, n, sequence, _ in packing.pack(lengths):
        used[sequence] += n
    assert sum(used.values()) == lengths.sum() and max(used.values()) <= 1024
    assert len(used) * 1024 - lengths.sum() < 1024 and packing.padding(np.array(list(used.values()))) < 1024
    assert packing.crc32([1, 2]) == zlib.crc32(np.array([1, 2], "<u4").tobytes())


def test_exact_groups(odd_documents, no_documents):
    rows = [(r.doc_id, r.text or "") for r in odd_documents.collect()]
    for r in chunk_dedup.exact_groups(odd_documents).collect():
        text = next(t for d, t in rows if d == r.doc_id)
        same = [d for d, t in rows if t == text]
        assert (r.group_size, r.keep_id) == (len(same), max((d for d in same if d is not None), default=None))
        assert r.kept == (r.doc_id == r.keep_id) and r.text_sha256 == sha256(text.encode()).hexdigest()
    kept = chunk_dedup.keep_last(odd_documents)
    assert kept.columns == odd_documents.columns and not {1, 3} & {r.doc_id for r in kept.collect()}
    assert chunk_dedup.exact_groups(no_documents).collect() == []


def test_clashing_fingerprints_are_told_apart(spark):
    schema = "doc_id long, text_sha256 string, n_bytes long, chunks array<struct<fp: bigint, digest: binary>>"
    stored = spark.createDataFrame(
        [(1, "a", 1, [(5, b"x")]), (2, "b", 1, [(5, b"y")]), (3, "c", 2, [(5, b"x"), (6, b"z")]), (4, "d", 0, [])], schema
    )
    ids = {r.doc_id: [tuple(x) for x in r.ids] for r in chunk_dedup.identified(stored).collect()}
    assert ids == {1: [(5, 1)], 2: [(5, 2)], 3: [(5, 1), (6, 0)], 4: []}


def test_chunks_depend_on_content_alone():
    rng = np.random.default_rng(5)
    data = rng.integers(0, 256, 60_000).astype(np.uint8)
    alone = chunk_dedup.chunk_ends(chunk_dedup.cut_points(data), 0, len(data))
    shifted = np.concatenate([rng.integers(0, 256, 777).astype(np.uint8), data])
    moved = chunk_dedup.chunk_ends(chunk_dedup.cut_points(shifted), 777, len(shifted))
    assert [e + 777 for e in alone] == moved and len(alone) > 10


def test_byte_pairs(odd_documents, no_documents):
    import regex
    import tiktoken

    ranks = bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = bpe.encode(odd_documents, "doc_id", "text", RANKS)
    rows = [(r.doc_id, r.text or "") for r in odd_documents.collect()]
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == Counter((d, tuple(library.encode_ordinary(t))) for d, t in rows)
    decoded = bpe.decode(encoded, "doc_id", "ids", RANKS)
    assert Counter((r.doc_id, bytes(r.decoded)) for r in decoded.collect()) == Counter((d, t.encode()) for d, t in rows)
    assert bpe.digests(no_documents, "doc_id", "text", RANKS).collect() == []
    rng = np.random.default_rng(6)
    signs = list("ab'stremvld  \n\t1²½é.,!中😀ÀḀ")
    texts = ["".join(rng.choice(signs, rng.integers(0, 40))) for _ in range(3000)]
    data = [t.encode() for t in texts]
    starts = piece_starts(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(d) for d in data])).tolist()
    at, want = 0, []
    for t in texts:
        for found in regex.finditer(tokens.PATTERN, t):
            want.append(at + len(t[: found.start()].encode()))
        at += len(t.encode())
    assert starts == want
    pairs = bpe.byte_pairs(RANKS)
    for piece in (b"a" * 3000, b"ab" * 900, bytes(rng.integers(0, 256, 2000).astype(np.uint8))):
        assert pairs.encode(piece) == library._core_bpe.encode_single_piece(piece)


def test_language_against_brute_force(spark, odd_documents):
    """Predictions and scores from counts made in plain Python."""
    import math

    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    learnt = [r for r in table.where(language_id.training_row(table["doc_id"])).collect() if r.lang and r.text is not None]
    languages = sorted({r.lang for r in learnt})
    words = {lang: Counter() for lang in languages}
    for r in learnt:
        words[r.lang].update(re.findall(r"[^\W\d_]+", r.text.lower()))
    everywhere = sum(words.values(), Counter())
    grams = {size: {lang: Counter() for lang in languages} for size in (4, 3, 2, 1)}

    def cut(word, size):
        padded = f" {word} " if size > 1 else word
        return [padded[k : k + size] for k in range(len(padded) - size + 1)]

    for size, tables in grams.items():
        for lang in languages:
            for word, n in words[lang].items():
                tables[lang].update({g: n * m for g, m in Counter(cut(word, size)).items()})
    known = {w for w, n in everywhere.items() if n > 1}

    def logs(tables, entries, entry):
        out = []
        for lang in languages:
            total = sum(tables[lang][e] for e in entries) + 0.5 * len(entries)
            out.append(math.log((tables[lang][entry] + 0.5) / total))
        return out

    entries_of = {size: set().union(*tables.values()) for size, tables in grams.items()}
    cached = {}

    def vector(word):
        if word in known:
            return logs(words, known, word)
        for size in (4, 3, 2, 1):
            found = [logs(grams[size], entries_of[size], g) for g in cut(word, size) if g in entries_of[size]]
            if found:
                return [sum(c) / len(found) for c in zip(*found)]
        return [0.0] * len(languages)

    texts = ["the anunseenword here", "straße étrangement ñandú", "x", "zzzzqqq 中文", "12", None, "Der das und thatthe"]
    texts += [r.text[:400] for r in learnt[:6]] + [r.text[:400] for r in odd_documents.collect() if r.text]
    judged = language_id.predict(
        spark.createDataFrame(list(enumerate(texts)), "n int, text string"), language_id.fit(table.where(language_id.training_row(table["doc_id"])))
    )
    got = {r.n: r for r in judged.collect()}
    for n, text in enumerate(texts):
        own = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not own:
            assert (got[n].lang_pred, got[n].score) == ("und", 0.0)
            continue
        for word in own:
            if word not in cached:
                cached[word] = vector(word)
        sums = [sum(cached[w][k] for w in own) for k in range(len(languages))]
        best = max(range(len(languages)), key=lambda k: sums[k])
        assert got[n].lang_pred == languages[best]
        assert abs(got[n].score - 1 / sum(math.exp(s - sums[best]) for s in sums)) < 1e-4


def test_lookup_agrees_with_the_model_word_by_word(spark, monkeypatch):
    rng = np.random.default_rng(12)
    pool = ["".join(rng.choice(list("abcéß中"), rng.integers(1, 7))) for _ in range(300)]
    rows = [(k, " ".join(rng.choice(pool[:200], 30)), f"l{k % 5}") for k in range(40)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    lookup = language_id.Lookup(model)
    asked = [*pool, "q", "qa", "é", "𝒳", "𝒳a"]
    want = np.array([model.vector(w) for w in asked])
    assert np.allclose(lookup.vectors(asked), want, atol=1e-5)
    texts = [" ".join(rng.choice(pool, 50)) for _ in range(9)] + [None, "", "7", pool[0]]
    whole = language_id._Judge(lookup).judge(texts)
    monkeypatch.setattr(language_id, "CACHED_WORDS", 60)
    again = language_id._Judge(lookup).judge(texts)
    assert whole[0] == again[0] and np.allclose(whole[1], again[1])


def test_piece_cache_keeps_common_pieces(monkeypatch):
    from reviewloom.llm import pieces

    monkeypatch.setattr(pieces, "CACHED_PIECES", 8)
    asked = Counter()

    def encode(piece):
        asked[piece] += 1
        return [len(piece), 7]

    cache = pieces.PieceCache(encode)
    for k in range(40):
        assert cache[b"common"] == np.array([6, 7], "<u4").tobytes()
        assert cache[b"rare%d" % k] == np.array([len(b"rare%d" % k), 7], "<u4").tobytes()
        assert len(cache) + len(cache.older) <= 9
    assert asked[b"common"] == 1
    # Equal pieces of a batch are looked up once.
    class Looked(dict):
        times = 0

        def __getitem__(self, piece):
            Looked.times += 1
            return np.array([len(piece)], "<u4").tobytes()

    text = b"and so and so and so"
    found = pieces.encode_batch(np.frombuffer(text + text, np.uint8), np.array([0, 0, len(text), 2 * len(text), 2 * len(text)]), Looked())
    assert [x.tolist() for x in found] == [[], [3, 3, 4, 3, 4, 3], [3, 3, 4, 3, 4, 3], []] and Looked.times == 3


def test_profiles_hold_few_rows_at_a_time(spark, monkeypatch):
    """A batch of Spark's size is read in parts, each its own batch of profiles."""
    sizes = []
    batches = [pa.RecordBatch.from_arrays([pa.array(range(1500), pa.int64()), pa.array([f"a b c d e f{k % 700}" for k in range(1500)])], names=["doc_id", "text"])]

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return [b for b in run(iter(batches))]

    for batch in jaccard_join.profiles(Docs()):
        if batch.column("n").null_count == 0:
            sizes.append(batch.num_rows)
    assert sum(sizes) == 1500 and max(sizes) <= 512
