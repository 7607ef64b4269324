"""Removal of repeated passages: every byte that a string of 100 bytes covers which also starts earlier.

1. Anchors. Of each window of 100 bytes the smallest hash of its 24-byte strings is its anchor. Equal windows have
   equal anchors at equal places, so windows meet by anchor; a row stands for all neighbouring windows of one
   anchor (its context).
2. Sorted by anchor, equal contexts are repeats as a whole, whatever their number; only anchors with several
   different contexts go on, with one row a context. Everything else needs no text.
3. An anchor whose contexts exceed a shard is split: its windows are dealt by their place in the context, in ever
   narrower ranges, and by the bytes that all windows of the range cover, so equal windows still meet. Step 2 is
   repeated on the pieces. In the narrowest range those are the whole windows, and nothing is left to sort.
4. The contexts of these are read from the texts and form shards by anchor, each of less than one and a half times
   the bound. A shard is suffix-sorted by induction with common-prefix values (``induced``): suffixes that share 100
   bytes stand side by side, and all but the earliest are repeats.
5. The spans found are joined back to the documents and cut out.

Equality up to step 3 is that of 64-bit hashes of the anchor or the shared bytes and of the context. Texts travel compressed.

A null or empty text has nothing to remove, as has one under 100 bytes. Order is by doc_id (null first), then
start. Repeated rows of one doc_id and text are one document, which never repeats itself at the same place; each
gets the same result. Several texts under one doc_id are documents of their own, in the order of their hashes. Columns other than
doc_id and text pass through. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.columns import gives_back, slices, unused, utf8
from reviewloom.llm.hashes import mix, prefix_hashes, span_hashes
from reviewloom.llm.induced import suffix_order
from reviewloom.plans.ordering import sorted_index
from reviewloom.plans.storage import materialise

WINDOW = 100
GRAM = 24
CHUNK_BYTES = 1 << 17
SEGMENT_WINDOWS = 1 << 22
SHARD_BYTES = 1 << 21
# Anchors above that are split by ranges of so many places of the anchor in the window, one after the other.
RANGES = (32, 8, 1)
CONTEXTS_AT_ONCE = 1 << 13
# So many rows of a batch are Python objects at a time.
ROWS_AT_ONCE = 512
SEPARATOR = 0xFF  # occurs in no UTF-8 text

_PLACE_BITS = 24


def contexts(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """(document row, anchor hash, context hash, first window, last window, anchor) of all contexts.

    Places are counted from the start of ``data``; a context has at most ``window`` - ``gram`` + 1 windows.
    """
    n = len(data) - window + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    sums = prefix_hashes(data)
    at = np.arange(len(data) - gram + 1)
    grams = span_hashes(sums, slice(0, len(at)), slice(gram, None))
    least = (grams >> np.uint64(_PLACE_BITS)) << np.uint64(_PLACE_BITS) | at.astype(np.uint64)
    span, width = window - gram + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:n], least[span - width : span - width + n])
    inside = np.ones(n, bool)
    ends = offsets[1:-1]
    for back in (ends - window + 1).tolist():
        inside[max(back, 0) : back + window - 1] = False
    places = np.flatnonzero(inside)
    if not len(places):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    anchor = (least[places] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    fresh = np.append(True, (anchor[1:] != anchor[:-1]) | (np.diff(places) != 1))
    firsts = np.flatnonzero(fresh)
    first, last = places[firsts], places[np.append(firsts[1:], len(places)) - 1]
    anchor = anchor[firsts]
    row = np.searchsorted(offsets, first, "right") - 1
    context = span_hashes(sums, first, last + window)
    context = mix(context + ((anchor - first) * 1000 + last - first).astype(np.uint64))
    return row, grams[anchor], context, first, last, anchor


def _parts(offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first row, last row + 1, first byte, end) of parts that are hashed together; long texts in segments."""
    row = 0
    while row < len(offsets) - 1:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        a, b = int(offsets[row]), int(offsets[stop])
        while b - a > SEGMENT_WINDOWS + WINDOW - 1:
            yield row, stop, a, a + SEGMENT_WINDOWS + WINDOW - 1
            a += SEGMENT_WINDOWS
        yield row, stop, a, b
        row = stop


def anchors(docs: DataFrame) -> DataFrame:
    """(h, ctx, doc_id, place) of every context; ``place`` is first window, windows - 1 (7 bits), anchor (7 bits)."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for row, stop, a, b in _parts(offsets):
                inner = np.clip(offsets[row : stop + 1], a, b) - a
                local, h, ctx, first, last, anchor = contexts(data[a:b], inner)
                start = first + a - offsets[row:stop][local]
                place = (start << 14) | ((last - first) << 7) | (anchor - first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h.astype(np.uint64).view(np.int64)),
                        pa.array(ctx.astype(np.uint64).view(np.int64)),
                        batch.column(0).take(pa.array(local + row)),
                        pa.array(place),
                    ],
                    names=["h", "ctx", "doc_id", "place"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "h long, ctx long, doc_id long, place long"
    )


_FOUND = "h long, doc_id long, start long, stop long, place long"


def repeats(found: DataFrame) -> DataFrame:
    """Of the anchors' rows, repeats of a whole context (start, stop), and contexts to be sorted (h, place).

    Reads each partition in the order of anchor, context and place, and holds one context back.
    """

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the last row, and the context that waits for the next one of its anchor
        held: tuple | None = None
        held_shares = False
        for batch in batches:
            if not batch.num_rows:
                continue
            h, ctx, place = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 3))
            marks = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
            doc = batch.column(2).fill_null(0).to_numpy(zero_copy_only=False)
            rows = np.stack([h, ctx, doc, place, marks.astype(np.int64)])
            last = rows[:, -1].copy()
            shifted = np.concatenate([(rows[:, :1] + 1 if before is None else before[:, None]), rows[:, :-1]], axis=1)
            same_h = rows[0] == shifted[0]
            same_ctx = same_h & (rows[1] == shifted[1])
            copies = same_ctx & (rows[2:] != shifted[2:]).any(axis=0)
            before = last
            c = rows[:, copies]
            start = c[3] >> 14
            yield _found(None, c, start, start + ((c[3] >> 7) & 127) + WINDOW)
            reps = rows[:, ~same_ctx]
            if held is not None:
                reps = np.concatenate([held[:, None], reps], axis=1)
            if not reps.shape[1]:
                continue
            next_same = np.append(reps[0, 1:] == reps[0, :-1], False)
            shares = next_same.copy()
            shares[1:] |= next_same[:-1]
            shares[0] |= held is not None and held_shares
            held, held_shares = reps[:, -1].copy(), bool(shares[-1])
            out = reps[:, :-1][:, shares[:-1]]
            yield _found(out[0], out, None, None)
        if held is not None and held_shares:
            yield _found(held[:1], held[:, None], None, None)

    ordered = found.repartition("h").sortWithinPartitions("h", "ctx", "doc_id", "place")
    return ordered.mapInArrow(run, _FOUND)


def _found(h, rows: np.ndarray, start, stop) -> pa.RecordBatch:
    n = rows.shape[1]
    nothing = pa.nulls(n, pa.int64())
    doc = pa.array(rows[2], mask=rows[4] == 0)
    if h is None:
        columns = [nothing, doc, pa.array(start), pa.array(stop), nothing]
    else:
        columns = [pa.array(h), doc, nothing, nothing, pa.array(rows[3])]
    return pa.RecordBatch.from_arrays(columns, names=["h", "doc_id", "start", "stop", "place"])


def compressed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``packed``, the compressed bytes, in place of the text (null stays null)."""
    import zstandard

    others = [c for c in docs.columns if c != "text"]

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in (part for whole in batches for part in slices(whole, ROWS_AT_ONCE)):
            packed = [None if x is None else packer.compress(x) for x in batch.column(0).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(packed, pa.binary())], names=[*others, "packed"])

    return docs.select("text", *others).mapInArrow(run, docs.select(*others).schema.add("packed", "binary"))


def context_texts(chosen: DataFrame, docs: DataFrame) -> DataFrame:
    """(h, doc_id, place, bytes) of chosen contexts (h, doc_id, place), read from the texts."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, h, place, body in _read_contexts(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h),
                    pa.array([doc_id] * len(h), pa.int64()),
                    pa.array(place),
                    pa.array(body, pa.binary()),
                ],
                names=["h", "doc_id", "place", "bytes"],
            )

    return _with_texts(chosen, docs).mapInArrow(run, "h long, doc_id long, place long, bytes binary")


def _with_texts(chosen: DataFrame, docs: DataFrame) -> DataFrame:
    by_doc = chosen.groupBy("doc_id").agg(F.collect_list(F.struct("h", "place")).alias("wanted"))
    texts = compressed(docs.select(F.col("doc_id").cast("long").alias("text_id"), "text"))
    joined = by_doc.join(texts, F.col("doc_id").eqNullSafe(F.col("text_id")))
    return joined.select("doc_id", "wanted", "packed")


def _read_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, np.ndarray, np.ndarray, list[bytes]]]:
    """(doc_id, h, place, bytes) of contexts of one text, some at a time."""
    import zstandard

    unpacker = zstandard.ZstdDecompressor()
    for batch in (part for whole in batches for part in slices(whole, ROWS_AT_ONCE)):
        wanted = batch.column(1)
        at = wanted.offsets.to_numpy()
        hs, places = (wanted.values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        for row, packed in enumerate(batch.column(2).to_pylist()):
            text = b"" if packed is None else unpacker.decompress(packed)
            for start in range(int(at[row]), int(at[row + 1]), CONTEXTS_AT_ONCE):
                here = slice(start, min(start + CONTEXTS_AT_ONCE, int(at[row + 1])))
                body = [text[p >> 14 : (p >> 14) + ((p >> 7) & 127) + WINDOW] for p in places[here].tolist()]
                yield batch.column(0)[row].as_py(), hs[here], places[here], body


def pieces(chosen: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(h, ctx, doc_id, place) of pieces of contexts, ``width`` places of the anchor in the window each.

    ``h`` is the hash of the former one, the range of places and the bytes that all windows of the range cover.
    """

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, h, place, body in _read_contexts(batches):
            h, ctx, place = cut_contexts(h, place, body, width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(ctx), pa.array([doc_id] * len(h), pa.int64()), pa.array(place)],
                names=["h", "ctx", "doc_id", "place"],
            )

    return _with_texts(chosen, docs).mapInArrow(run, "h long, ctx long, doc_id long, place long")


def cut_contexts(h: np.ndarray, place: np.ndarray, bodies: list[bytes], width: int):
    """(h, ctx, place) of the pieces of contexts."""
    sizes = np.array([len(b) for b in bodies], np.int64)
    offsets = np.cumsum(sizes) - sizes
    sums = prefix_hashes(np.frombuffer(b"".join(bodies), np.uint8))
    first, more, inner = place >> 14, (place >> 7) & 127, place & 127
    found = []
    for low in range(0, WINDOW - GRAM + 1, width):
        high = min(low + width, WINDOW - GRAM + 1) - 1
        # Windows from ``a`` to ``b`` of the context have their anchor ``high`` to ``low`` bytes behind their start.
        a, b = np.maximum(inner - high, 0), np.minimum(inner - low, more)
        # Of several texts under one doc_id a shorter one may end before.
        here = np.flatnonzero((a <= b) & (sizes >= b + WINDOW))
        a, b, at = a[here], b[here], offsets[here]
        shared = span_hashes(sums, at + inner[here] - low, at + inner[here] - high + WINDOW)
        key = mix(h[here].astype(np.uint64) + mix(shared + np.uint64(low)))
        ctx = span_hashes(sums, at + a, at + b + WINDOW)
        ctx = mix(ctx + ((inner[here] - a) * 1000 + b - a).astype(np.uint64))
        found.append((key.view(np.int64), ctx.view(np.int64), ((first[here] + a) << 14) | ((b - a) << 7) | (inner[here] - a)))
    return tuple(np.concatenate(x) for x in zip(*found))


def split_large(found: DataFrame, docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """Of ``repeats``, contexts to be sorted (h, doc_id, place), at most a shard an anchor, and spans of repeats."""
    done = found.where(F.col("place").isNull()).select("doc_id", "start", "stop")
    chosen = found.where(F.col("place").isNotNull()).select("h", "doc_id", "place")
    kept = None
    size = F.shiftright("place", 7).bitwiseAND(127) + WINDOW
    for width in RANGES:
        large = materialise(chosen.groupBy("h").agg(F.sum(size).alias("size")).where(F.col("size") > shard_bytes).select("h"))
        if large.isEmpty():
            break
        small = chosen.join(large, "h", "left_anti")
        kept = small if kept is None else kept.unionByName(small)
        cut = materialise(repeats(pieces(chosen.join(large, "h", "left_semi"), docs, width)))
        done = done.unionByName(cut.where(F.col("place").isNull()).select("doc_id", "start", "stop"))
        chosen = cut.where(F.col("place").isNotNull()).select("h", "doc_id", "place")
    return chosen if kept is None else kept.unionByName(chosen), done


def shard_repeats(doc: np.ndarray, first: np.ndarray, windows: np.ndarray, bodies: list[bytes]) -> np.ndarray:
    """(context, first, last window) of runs of windows that an earlier one of the shard equals.

    ``doc`` ranks the documents; ``first`` and ``windows`` are the first window and the number of windows.
    """
    sizes = np.array([len(b) for b in bodies], np.int64)
    offsets = np.cumsum(np.append(0, sizes + 1))[:-1]
    text = np.frombuffer(b"".join(b + b"\xff" for b in bodies), np.uint8)
    order, lcps = suffix_order(text, WINDOW)
    owner = np.repeat(np.arange(len(bodies)), sizes + 1)
    inner = np.arange(len(text)) - offsets[owner]
    is_window = inner < np.minimum(windows, sizes - WINDOW + 1)[owner]
    groups = np.empty(len(text), np.int64)
    groups[order] = np.cumsum(lcps < WINDOW)
    at = np.flatnonzero(is_window)
    group, place, rank = groups[at], first[owner[at]] + inner[at], doc[owner[at]]
    sort = np.lexsort((place, rank, group))
    at, group, place, rank = at[sort], group[sort], place[sort], rank[sort]
    head = np.append(True, group[1:] != group[:-1])
    heads = np.flatnonzero(head)[np.cumsum(head) - 1]
    again = at[(place != place[heads]) | (rank != rank[heads])]
    again.sort()
    if not len(again):
        return np.zeros((0, 3), np.int64)
    cut = np.append(True, (np.diff(again) != 1) | (owner[again[1:]] != owner[again[:-1]]))
    starts = np.flatnonzero(cut)
    a, b = again[starts], again[np.append(starts[1:], len(again)) - 1]
    return np.stack([owner[a], inner[a], inner[b]], axis=1)


def sorted_repeats(texts: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, start, stop) of the spans of contexts that an equal string precedes, by suffix sorting."""

    def sort_shard(rows: list[tuple]) -> pa.RecordBatch:
        _, docs, places, bodies = zip(*rows)
        ids = np.array([-(1 << 63) if d is None else d for d in docs], np.int64)
        valid = np.array([d is not None for d in docs])
        rank = np.unique(np.stack([valid.astype(np.int64), ids]), axis=1, return_inverse=True)[1].ravel()
        place = np.array(places, np.int64)
        found = shard_repeats(rank, place >> 14, ((place >> 7) & 127) + 1, list(bodies))
        owner = found[:, 0]
        start = (place >> 14)[owner]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids[owner], mask=~valid[owner]),
                pa.array(start + found[:, 1]),
                pa.array(start + found[:, 2] + WINDOW),
            ],
            names=["doc_id", "start", "stop"],
        )

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held >= shard_bytes // 2 and row[0] != rows[-1][0]:
                    yield sort_shard(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[3])
        if rows:
            yield sort_shard(rows)

    ordered = texts.repartition("h").sortWithinPartitions("h")
    return ordered.mapInArrow(run, "doc_id long, start long, stop long")


def find_spans(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, start, stop), in bytes, of spans to remove; they overlap."""
    chosen, done = split_large(materialise(repeats(anchors(docs))), docs, shard_bytes)
    return done.unionByName(sorted_repeats(context_texts(chosen, docs), shard_bytes))


def merged(starts: np.ndarray, stops: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(np.minimum(stops[order], size))
    cut = np.flatnonzero(starts[1:] > reach[:-1])
    a = starts[np.append(0, cut + 1)] if len(starts) else starts
    b = reach[np.append(cut, len(starts) - 1)] if len(starts) else reach
    return [(x, y) for x, y in zip(a.tolist(), b.tolist()) if x < y]


def _spans_by_text(docs: DataFrame) -> DataFrame:
    """(doc_id, th, spans): ``th`` is null unless some id has several texts, told apart by their hashes."""
    together = F.collect_list(F.struct("start", "stop")).alias("spans")
    hashed = docs.select(F.col("doc_id").cast("long"), _text_hash().alias("th"))
    ends = hashed.groupBy("doc_id").agg(F.min("th").alias("low"), F.max("th").alias("high"))
    if ends.where("low <> high").isEmpty():
        return find_spans(docs).groupBy("doc_id").agg(together).withColumn("th", F.lit(None).cast("long"))
    # Every text gets a number of its own, in the order of ids.
    numbers = materialise(sorted_index(hashed.distinct(), [], [F.col("doc_id").asc_nulls_first(), F.col("th")], "number"))
    told = numbers.select(F.col("doc_id").alias("own_id"), F.col("th").alias("own_th"), "number")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("own_id")) & (_text_hash() == F.col("own_th"))
    renumbered = docs.select("doc_id", "text").join(told, same).select(F.col("number").alias("doc_id"), "text")
    spans = find_spans(materialise(renumbered)).groupBy("doc_id").agg(together)
    return spans.withColumnRenamed("doc_id", "number").join(numbers, "number").select("doc_id", "th", "spans")


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def remove_repeats(docs: DataFrame, as_text: bool = False) -> DataFrame:
    """``docs`` without its text; with kept (binary), n_bytes, n_removed and n_spans instead.

    No other column may have one of these four names. With ``as_text`` kept is a string, without the characters that
    are cut in half.
    """
    others = [c for c in docs.columns if c != "text"]
    whole = docs.select("doc_id", "text", F.struct(*others).alias("rest"))
    spans = _spans_by_text(whole.select("doc_id", "text")).select(
        F.col("doc_id").alias("span_id"), F.col("th").alias("span_th"), "spans"
    )
    texts = compressed(whole.withColumn("th", _text_hash()))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("span_id")) & (
        F.col("span_th").isNull() | (F.col("th") == F.col("span_th"))
    )
    rows = texts.join(spans, same, "left").select("packed", "spans", "rest")

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpacker = zstandard.ZstdDecompressor()
        for batch in (part for whole in batches for part in slices(whole, ROWS_AT_ONCE)):
            spans = batch.column(1)
            at = spans.offsets.to_numpy()
            starts, stops = (spans.values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            out: list[tuple] = []
            for row, packed in enumerate(batch.column(0).to_pylist()):
                text = b"" if packed is None else unpacker.decompress(packed)
                here = slice(int(at[row]), int(at[row + 1]))
                runs = merged(starts[here], stops[here], len(text))
                edges = [0, *(x for run in runs for x in run), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                removed = len(text) - len(kept)
                out.append((kept.decode("utf-8", "ignore") if as_text else kept, len(text), removed, len(runs)))
            kept, n_bytes, n_removed, n_spans = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.column(2).flatten(),
                    pa.array(kept, pa.string() if as_text else pa.binary()),
                    pa.array(n_bytes, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(n_spans, pa.int64()),
                ],
                names=[*others, "kept", "n_bytes", "n_removed", "n_spans"],
            )

    schema = docs.select(*others).schema
    for name, kind in (("kept", "string" if as_text else "binary"), ("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long")):
        schema = schema.add(name, kind)
    return rows.mapInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    return remove_repeats(docs.select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut out of the texts; characters cut in half are dropped.

    Every row stays. ``n_chars``, where present, follows the new text. A null text becomes empty.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    whole = docs.select("doc_id", "text", F.struct(*rest, F.lit(0).alias(unused("_", rest))).alias("rest"))
    done = remove_repeats(whole, as_text=True).withColumnRenamed("kept", "text")

    def shown(name: str) -> Column:
        if name in ("doc_id", "text"):
            return F.col(name)
        if name == "n_chars":
            return F.length("text").cast(docs.schema[name].dataType).alias(name)
        return F.col("rest").getField(name).alias(name)

    return done.select(*map(shown, docs.columns))
