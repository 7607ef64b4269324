"""Similarity join on sets of word 5-grams (Jaccard of at least 0.75), with the components of its links.

Two documents can only link if they share an element among the first quarter of their sets, in any common order of
elements. So sets are indexed by these elements, rare ones first. Two relations between sets save work:

* Equal sets are one class; near-equal sets form families. A set whose least hash of some kind equals a leader's is
  compared with the leader; if they link, it follows the leader in the index. A list of the index holds a family
  once, whatever its size, with the range of its sizes. Lists are sorted by size, and what lies beyond the sizes
  that can reach the threshold is skipped as a block; the position is tested pair by pair (``similar_links`` skips
  blocks by both). A list is one task's.
* Neighbours in a list are compared first. What their links connect is one part; only pairs of families between
  parts follow, so a large group of near copies costs few pairs.
* The answer of a family is derived from its leader's: the symmetric difference of two members lies within that of
  the leaders and the two members' own. Parity bitmaps bound differences from below. Family pairs that cannot hold
  a link are done; leaders that link join their families; only pairs of families between are opened. The bounds
  are first tried within the lists, on folded bitmaps, before any pair is written.

``similar_components`` gives the components only and leaves out pairs that are connected already; ``similar_links``
gives every link.

Every comparison that decides is exact, on the sets of the two whole texts (elements by 64-bit hashes).

Words are runs without ASCII white space, A-Z lower-cased. With fewer than five words the whole sequence is the
only element; without words, or with a null text, the set is empty and links with nothing. Rows of equal sets,
repeated rows too, link with each other. A null doc_id takes no part in links and is its own component (null).
Columns other than doc_id and text are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.columns import gives_back, lists, slices
from reviewloom.llm.components import components
from reviewloom.llm.hashes import mix, prefix_hashes, span_hashes
from reviewloom.llm.suffix_dedup import compressed
from reviewloom.plans.storage import materialise

SHINGLE_WORDS = 5
PERCENT = 75
# Elements met in at least so many different sets of one batch are counted; the most common of them come last in
# the order of elements. The order decides on speed alone.
COMMON_IN_BATCH = 4
COMMON_ELEMENTS = 100_000
PAIRS_AT_ONCE = 1 << 20
# So many next places of a list count as neighbours: a set that links with none must not part a large group.
NEIGHBOURS = 4
# Bitmaps travel to the lists folded to this size at most; a fold bounds differences as well, only less closely.
FOLDED_BYTES = 512
# About so many members of a family travel in one row when families are opened.
BLOCK_MEMBERS = 32
_KEYS = np.array([1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_CHUNK_BYTES = 1 << 17
# So many rows of a batch are Python objects at a time.
ROWS_AT_ONCE = 512


def shingle_sets(texts: list[bytes | None]) -> Iterator[np.ndarray]:
    """The sorted distinct element hashes of each text."""
    row = 0
    while row < len(texts):
        words: list[list[bytes]] = []
        size = 0
        while row < len(texts) and (not words or size < _CHUNK_BYTES):
            words.append((texts[row] or b"").lower().split())
            size += len(texts[row] or b"")
            row += 1
        joined = b" ".join([w for doc in words for w in doc])
        data = np.frombuffer(joined, np.uint8)
        sums = prefix_hashes(data)
        ends = np.append(np.flatnonzero(data == 32), len(data))
        starts = np.append(0, ends[:-1] + 1)
        at = 0
        for doc in words:
            n = len(doc)
            if n:
                k = min(n, SHINGLE_WORDS)
                found = span_hashes(sums, starts[at : at + n - k + 1], ends[at + k - 1 : at + n])
                yield np.unique(found)
            else:
                yield np.zeros(0, np.uint64)
            at += n


def links(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    same = len(np.intersect1d(a, b, assume_unique=True))
    return same > 0 and 100 * same >= percent * (len(a) + len(b) - same)


def prefix_size(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """So many of n elements, first in a common order, meet those of any linked set."""
    return n - (-(-percent * n // 100)) + 1


def parity_bitmap(elements: np.ndarray) -> bytes:
    """Parities of element counts by hash, in at least two bits an element."""
    bits = 1 << max(6, int(2 * len(elements) - 1).bit_length())
    counts = np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound for the symmetric difference of two sets, from their bitmaps."""
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    if len(x) > len(y):
        x, y = y, x
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def folded(bitmap: bytes, most: int = FOLDED_BYTES) -> bytes:
    """The bitmap of the same set in at most ``most`` bytes; both sizes are powers of two."""
    if len(bitmap) <= most:
        return bitmap
    return np.bitwise_xor.reduce(np.frombuffer(bitmap, "<u8").reshape(-1, most // 8), axis=0).tobytes()


def least_differences(bitmaps: list[bytes], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``least_difference`` of many pairs of places in ``bitmaps``."""
    words = np.array([len(b) // 8 for b in bitmaps], np.int64)
    row = np.zeros(len(words), np.int64)
    tables = {}
    for w in np.unique(words).tolist():
        own = np.flatnonzero(words == w)
        row[own] = np.arange(len(own))
        tables[w] = np.frombuffer(b"".join(bitmaps[k] for k in own.tolist()), "<u8").reshape(-1, w)
    low = np.zeros(len(i), np.int64)
    for w, v in np.unique(np.stack([words[i], words[j]], axis=1), axis=0).tolist():
        at = np.flatnonzero((words[i] == w) & (words[j] == v))
        x, y = (
            np.bitwise_xor.reduce(tables[own][row[k[at]]].reshape(len(at), -1, min(w, v)), axis=1)
            for own, k in ((w, i), (v, j))
        )
        low[at] = np.bitwise_count(x ^ y).sum(axis=1)
    return low


def most_difference(n: int, m: int, percent: int = PERCENT) -> int:
    """The largest symmetric difference of linked sets of n and m elements."""
    return (100 - percent) * (n + m) // (100 + percent)


def profiles(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n, digest (of the set), keys (least hashes), bitmap; and rows (h, df) of counts."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every: list[np.ndarray] = []
            seen: set[bytes] = set()
            for part in slices(batch, ROWS_AT_ONCE):
                rows: list[tuple] = []
                for elements in shingle_sets(part.column(1).cast(pa.binary()).to_pylist()):
                    digest = xxhash.xxh3_128_digest(elements.tobytes())
                    keys = [int(mix(elements * k).min().view(np.int64)) for k in _KEYS] if len(elements) else []
                    rows.append((len(elements), digest, keys, parity_bitmap(elements)))
                    if digest not in seen:
                        seen.add(digest)
                        every.append(elements)
                n, digests, keys, bitmaps = zip(*rows)
                yield _profile_batch(part.column(0), n, digests, keys, bitmaps, None, None)
            flat = np.concatenate(every) if every else np.zeros(0, np.uint64)
            every.clear()
            flat.sort()
            starts = np.flatnonzero(np.append(True, flat[1:] != flat[:-1])) if len(flat) else np.zeros(0, np.int64)
            counts = np.diff(np.append(starts, len(flat)))
            common = counts >= COMMON_IN_BATCH
            if common.any():
                h, df = flat[starts[common]].view(np.int64), counts[common]
                yield _profile_batch(pa.nulls(len(h), pa.int64()), None, None, None, None, h, df)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, digest binary, keys array<long>, bitmap binary, h long, df long"
    )


def _profile_batch(doc_ids, n, digests, keys, bitmaps, h, df) -> pa.RecordBatch:
    size = len(doc_ids)
    kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64())
    columns = [pa.nulls(size, t) if c is None else pa.array(c, t) for c, t in zip((n, digests, keys, bitmaps, h, df), kinds)]
    return pa.RecordBatch.from_arrays(
        [doc_ids, *columns], names=["doc_id", "n", "digest", "keys", "bitmap", "h", "df"]
    )


def family_candidates(reps: DataFrame) -> DataFrame:
    """(a, b): each set with a leader that shares one of its keys and may link with it.

    The leader of a key is the set whose keys most others share, so it stands in the middle of its neighbours. Of
    up to three leaders the one with the least bound on the difference is taken.
    """
    keyed = reps.select("rep", F.posexplode("keys").alias("kind", "key"))
    shared = keyed.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialise(keyed.join(shared, ["kind", "key"]))
    central = shared.groupBy("rep").agg(F.sum("n").alias("weight"))
    leaders = shared.join(central, "rep").groupBy("kind", "key").agg(
        F.max_by("rep", F.struct("weight", -F.col("rep"))).alias("leader")
    )
    pairs = shared.join(leaders, ["kind", "key"]).where("rep <> leader").select(
        F.col("leader").alias("a"), F.col("rep").alias("b")
    )
    bounded = _bounded(pairs.distinct(), reps).where("low <= most")
    return bounded.groupBy("b").agg(F.min_by("a", F.struct("low", "a")).alias("a")).select("a", "b")


def _bounded(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs with low, a lower bound of the sets' difference, and most, what linked sets may differ by."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, ROWS_AT_ONCE)):
            x, y = batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist()
            n, m = batch.column(len(names) + 2).to_pylist(), batch.column(len(names) + 3).to_pylist()
            low = [least_difference(a, b) for a, b in zip(x, y)]
            most = [most_difference(a, b) for a, b in zip(n, m)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(low, pa.int64()), pa.array(most, pa.int64())],
                names=[*names, "low", "most"],
            )

    names = pairs.columns
    sides = [
        reps.select(F.col("rep").alias(c), F.col("bitmap").alias(f"bitmap_{c}"), F.col("n").alias(f"n_{c}")) for c in "ab"
    ]
    rows = pairs.join(sides[0], "a").join(sides[1], "b").select(*names, "bitmap_a", "bitmap_b", "n_a", "n_b")
    return rows.mapInArrow(run, pairs.schema.add("low", "long").add("most", "long"))


def compare(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b, differ, linked) of pairs of doc ids, from their whole texts."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpacker = zstandard.ZstdDecompressor()
        for batch in (part for whole in batches for part in slices(whole, ROWS_AT_ONCE)):
            sets: dict[int, np.ndarray] = {}
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            packed = dict(zip(a, batch.column(2).to_pylist())) | dict(zip(b, batch.column(3).to_pylist()))
            differ, linked = [], []
            for x, y in zip(a, b):
                for key in (x, y):
                    if key not in sets:
                        sets[key] = next(shingle_sets([unpacker.decompress(packed[key])]))
                same = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                union = len(sets[x]) + len(sets[y]) - same
                differ.append(union - same)
                linked.append(same > 0 and 100 * same >= PERCENT * union)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(differ, pa.int64()), pa.array(linked, pa.bool_())],
                names=["a", "b", "differ", "linked"],
            )

    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    texts = compressed(docs.select(F.col("doc_id").cast("long").alias("id"), "text")).where("packed IS NOT NULL")
    texts = materialise(wanted.join(texts, "id").dropDuplicates(["id"]))
    sides = [texts.select(F.col("id").alias(c), F.col("packed").alias(f"packed_{c}")) for c in "ab"]
    rows = pairs.select("a", "b").join(sides[0], "a").join(sides[1], "b")
    return materialise(
        rows.select("a", "b", "packed_a", "packed_b").mapInArrow(run, "a long, b long, differ long, linked boolean")
    )


def prefixes(docs: DataFrame, common: list[tuple[int, int]]) -> DataFrame:
    """(doc_id, n, elements): of every set the elements that index it, in order, as packed hashes.

    ``common`` are (element, count); they come after all others, the rarer first.
    """
    known = np.array(sorted((h & ((1 << 64) - 1), df) for h, df in common), np.uint64).reshape(-1, 2)
    shared = docs.sparkSession.sparkContext.broadcast((known[:, 0].copy(), known[:, 1].copy()))

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, counts = shared.value
        for batch in (part for whole in batches for part in slices(whole, ROWS_AT_ONCE)):
            n, bodies = [], []
            for elements in shingle_sets(batch.column(1).cast(pa.binary()).to_pylist()):
                size = int(prefix_size(np.int64(len(elements)))) if len(elements) else 0
                place = np.minimum(np.searchsorted(often, elements), max(len(often) - 1, 0))
                late = often[place] == elements if len(often) else np.zeros(len(elements), bool)
                chosen = elements[~late][:size]
                if len(chosen) < size:
                    rest = np.flatnonzero(late)
                    rest = rest[np.argsort(counts[place[rest]], kind="stable")]
                    chosen = np.concatenate([chosen, elements[rest][: size - len(chosen)]])
                n.append(len(elements))
                bodies.append(chosen.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(bodies, pa.binary())], names=["doc_id", "n", "elements"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, elements binary")


# An entry of the index in one number: 40 bits of the element, 16 of the set's size, 8 of the place in the set.
_LARGE = (1 << 16) - 1


def index_entries(indexed: DataFrame) -> DataFrame:
    """(entry, leader, part) for each indexing element of each set (leader, n, elements, part)."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).to_numpy(zero_copy_only=False)
            rows = [np.frombuffer(x, np.uint64) for x in batch.column(2).to_pylist()]
            sizes = np.array([len(x) for x in rows], np.int64)
            if not sizes.sum():
                continue
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            many = np.repeat(n, sizes)
            part = (place * 1024 // many).clip(max=255).astype(np.uint64)
            entry = (np.concatenate(rows) >> np.uint64(24)) << np.uint64(24)
            entry |= (many.clip(max=_LARGE).astype(np.uint64) << np.uint64(8)) | part
            row = pa.array(np.repeat(np.arange(len(n)), sizes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(entry.view(np.int64)), batch.column(0).take(row), batch.column(3).take(row)],
                names=["entry", "leader", "part"],
            )

    return indexed.select("leader", "n", "elements", "part").mapInArrow(run, "entry long, leader long, part long")


def list_members(entries: np.ndarray, leaders: np.ndarray, parts: np.ndarray) -> list[np.ndarray]:
    """element, leader, part, low, high, place of lists that hold several parts, by element, low and leader.

    One row for a leader in a list: the range of its sizes and the earliest place. Entries are sorted.
    """
    element = entries.astype(np.uint64) >> np.uint64(24)
    n = (entries >> 8) & _LARGE
    place = entries & 255
    order = np.lexsort((leaders, element))
    element, leaders, parts, n, place = (x[order] for x in (element, leaders, parts, n, place))
    starts = np.flatnonzero(np.append(True, (element[1:] != element[:-1]) | (leaders[1:] != leaders[:-1])))
    low, high = np.minimum.reduceat(n, starts), np.maximum.reduceat(n, starts)
    high = np.where(high == _LARGE, 1 << 40, high)
    place = np.minimum.reduceat(place, starts)
    element, leaders, parts = element[starts], leaders[starts], parts[starts]
    # A list within one part brings nothing.
    heads = np.flatnonzero(np.append(True, element[1:] != element[:-1]))
    mixed = np.minimum.reduceat(parts, heads) != np.maximum.reduceat(parts, heads)
    mixed = np.repeat(mixed, np.diff(np.append(heads, len(element))))
    members = [x[mixed] for x in (element.view(np.int64), leaders, parts, low, high, place)]
    order = np.lexsort((members[1], members[3], members[0]))
    return [x[order] for x in members]


def close_places(
    element: np.ndarray, parts: np.ndarray, low: np.ndarray, high: np.ndarray, place: np.ndarray,
    nearest: bool = False, percent: int = PERCENT,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of members of one list, of different parts, that sizes and places let link.

    With ``nearest`` only neighbours in a list.
    """
    # At most so many elements of a set are left from its place in the list on.
    rest = high - place * low // 1024
    active = np.arange(len(element))
    step = 1
    while len(active):
        active = active[active + step < len(element)]
        other = active + step
        # The others come by size: once one is too large, so are those behind it.
        near = (element[active] == element[other]) & (percent * low[other] <= 100 * high[active])
        active, other = active[near], other[near]
        need = -(-percent * (low[active] + low[other]) // (100 + percent))
        close = (np.minimum(rest[active], rest[other]) >= need) & (parts[active] != parts[other])
        if close.any():
            yield active[close], other[close]
        if nearest and step == NEIGHBOURS:
            break
        step += 1


def distinct_pairs(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)


def _joined(found: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def _whole_lists(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that end with a list; the first column without its last ``bits`` names the list."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        head = batch.column(0).to_numpy(zero_copy_only=False) >> bits
        cut = int(np.flatnonzero(head != head[-1])[-1]) + 1 if head[0] != head[-1] else 0
        # The list held back may have ended before this batch.
        if kept and (cut or (kept[-1].column(0)[-1].as_py() >> bits) != head[-1]):
            yield from pa.Table.from_batches([*kept, batch.slice(0, cut)]).combine_chunks().to_batches()
            kept = []
        elif cut:
            yield batch.slice(0, cut)
        kept.append(batch.slice(cut))
    if kept:
        yield from pa.Table.from_batches(kept).combine_chunks().to_batches()


def _pair_batches(found: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Partners by leader, distinct among up to PAIRS_AT_ONCE pairs."""
    held: list[np.ndarray] = []
    for pairs in found:
        held.append(pairs)
        if sum(map(len, held)) >= PAIRS_AT_ONCE:
            held = [_joined(held)]
            if len(held[0]) >= PAIRS_AT_ONCE // 2:
                yield _pair_batch(held.pop())
    if held:
        yield _pair_batch(_joined(held))


def _exploded(met: DataFrame) -> DataFrame:
    # Near sets meet in many lists, hence in many tasks: partners travel as one list a leader and task.
    lists_of = met.groupBy("a").agg(F.collect_list("others").alias("lists"))
    return lists_of.select("a", F.explode(F.array_distinct(F.flatten("lists"))).alias("b"))


def neighbour_pairs(entries: DataFrame) -> DataFrame:
    """(a, b) of leaders of different parts that are neighbours in a list and that their sizes let link."""

    @gives_back
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in _whole_lists(batches, 24):
            element, leaders, *rest = list_members(*(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            yield _joined([distinct_pairs(leaders[i], leaders[j]) for i, j in close_places(element, *rest, nearest=True)])

    return _exploded(_by_list(entries).mapInArrow(lambda batches: _pair_batches(pairs(batches)), "a long, others array<long>"))


def _by_list(entries: DataFrame) -> DataFrame:
    return entries.repartition(F.shiftright("entry", 24)).sortWithinPartitions("entry")


def meeting_members(entries: DataFrame) -> DataFrame:
    """(element, leader, part, low, high, place) of the members of lists that are close to one of another part."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["element", "leader", "part", "low", "high", "place"]
        for batch in _whole_lists(batches, 24):
            members = list_members(*(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            meets = np.zeros(len(members[0]), bool)
            for i, j in close_places(members[0], *members[2:]):
                meets[i] = meets[j] = True
            yield pa.RecordBatch.from_arrays([pa.array(x[meets].astype(np.int64)) for x in members], names=names)

    return _by_list(entries).mapInArrow(run, "element long, leader long, part long, low long, high long, place long")


def _folded_bitmaps(rows: DataFrame) -> DataFrame:
    """``rows`` (a key, bitmap, more columns) with the bitmaps folded."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bitmaps = pa.array([folded(b) for b in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), bitmaps, *batch.columns[2:]], names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def family_pairs(members: DataFrame, families: DataFrame) -> DataFrame:
    """(a, b) of leaders of different parts whose families may hold a link by sizes, places and bitmaps.

    ``families`` are (leader, bitmap, spread, largest). A link of two members needs a difference of their leaders
    within what the largest members may differ by and both spreads.
    """

    @gives_back
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in _whole_lists(batches, 0):
            element, low, leaders, parts, high, place, spread, largest = (
                c.to_numpy(zero_copy_only=False) for c in batch.columns[:8]
            )
            bitmaps = batch.column(8).to_pylist()
            found = []
            for i, j in close_places(element, parts, low, high, place):
                widest = (largest[i] + largest[j]) * (100 - PERCENT) // (100 + PERCENT) + spread[i] + spread[j]
                may = least_differences(bitmaps, i, j) <= widest
                found.append(distinct_pairs(leaders[i[may]], leaders[j[may]]))
            yield _joined(found)

    small = families.select("leader", "bitmap", F.col("spread").cast("long"), F.col("largest").cast("long"))
    rows = members.join(_folded_bitmaps(small), "leader").select("element", "low", "leader", "part", "high", "place", "spread", "largest", "bitmap")
    ordered = rows.repartition("element").sortWithinPartitions("element", "low", "leader")
    return _exploded(ordered.mapInArrow(lambda batches: _pair_batches(pairs(batches)), "a long, others array<long>"))


def _pair_batch(pairs: np.ndarray) -> pa.RecordBatch:
    starts = np.flatnonzero(np.append(True, pairs[1:, 0] != pairs[:-1, 0])) if len(pairs) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(pairs)))
    return pa.RecordBatch.from_arrays(
        [pa.array(pairs[starts, 0]), lists(pairs[:, 1], sizes, pa.int64())], names=["a", "others"]
    )


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, list[tuple[int, int]]]:
    """Profiles of all rows, classes of equal sets (rep, digest, n, keys, bitmap), and the common elements."""
    found = materialise(profiles(docs))
    rows = found.where(F.col("n").isNotNull()).drop("h", "df")
    common = (
        found.where(F.col("h").isNotNull())
        .groupBy("h")
        .agg(F.sum("df").alias("df"))
        .orderBy(F.desc("df"), "h")
        .limit(COMMON_ELEMENTS)
        .collect()
    )
    classes = (
        rows.where("n > 0 AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("bitmap").alias("bitmap"))
    )
    return rows, materialise(classes), [(r["h"], r["df"]) for r in common]


def similar_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    rows, reps, common = _classes(docs)
    followers = compare(family_candidates(reps), docs).where("linked")
    sets = reps.select("rep", "n").join(followers.select(F.col("b").alias("rep"), "a", "differ"), "rep", "left")
    sets = materialise(
        sets.select("rep", "n", F.coalesce("a", "rep").alias("leader"), F.coalesce("differ", F.lit(0)).alias("differ"))
    )
    indexed = materialise(
        prefixes(docs, common).join(
            sets.select(F.col("rep").alias("doc_id"), "leader"), "doc_id"
        )
    )
    # Neighbours in the lists first: they connect a large group of near copies with few pairs. What is connected
    # by then is one part, and only pairs between parts follow.
    beside = neighbour_pairs(index_entries(indexed.withColumn("part", F.col("leader"))))
    beside = materialise(_bounded(beside, reps).where("low <= most").select("a", "b"))
    beside = compare(beside, docs)
    known = materialise(followers.select("a", "b").unionByName(beside.where("linked").select("a", "b")))
    parts = components(known).select(F.col("id").alias("doc_id"), "component")
    parted = indexed.join(parts, "doc_id", "left").withColumn("part", F.coalesce("component", "leader"))
    families = sets.groupBy("leader").agg(F.max("differ").alias("spread"), F.max("n").alias("largest"))
    families = materialise(families.join(reps.select(F.col("rep").alias("leader"), "bitmap"), "leader"))
    members = materialise(meeting_members(index_entries(parted)))
    pairs = materialise(family_pairs(members, families))
    near = _open_pairs(pairs, families, reps)
    judged = near.where("low <= most").join(beside.select("a", "b"), ["a", "b"], "left_anti").select("a", "b")
    judged = compare(materialise(judged), docs)
    known = known.unionByName(judged.where("linked").select("a", "b"))
    more = _members_links(near, known, sets, reps, docs)
    edges = known if more is None else known.unionByName(more)
    groups = components(edges)
    of_class = reps.select("digest", "rep").join(groups.withColumnRenamed("id", "rep"), "rep", "left")
    of_class = of_class.select("digest", F.coalesce("component", "rep").alias("found"))
    own = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return rows.join(of_class, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(own, F.col("found")).otherwise(F.col("doc_id")).alias("component_id")
    )


def _open_pairs(pairs: DataFrame, families: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs of leaders that their bitmaps and their families' spread do not rule out.

    Columns: a, b, low and most (of the leaders), spread (of both families), widest (what members may differ by).
    """
    bounded = _bounded(pairs, reps)
    for c in "ab":
        side = families.select(F.col("leader").alias(c), F.col("spread").alias(f"spread_{c}"), F.col("largest").alias(f"largest_{c}"))
        bounded = bounded.join(side, c)
    widest = F.floor((F.col("largest_a") + F.col("largest_b")) * (100 - PERCENT) / (100 + PERCENT))
    spread = F.col("spread_a") + F.col("spread_b")
    return materialise(
        bounded.select("a", "b", "low", "most", spread.alias("spread"), widest.alias("widest")).where("low - spread <= widest")
    )


def _members_links(near: DataFrame, known: DataFrame, sets: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame | None:
    """Links between members of families that are near but not yet connected; None if there are no such families."""
    unsure = near.where("spread > 0")
    if unsure.isEmpty():
        return None
    groups = components(known)
    apart = unsure.select("a", "b")
    for c in "ab":
        apart = apart.join(groups.select(F.col("id").alias(c), F.col("component").alias(f"in_{c}")), c, "left")
    apart = materialise(
        apart.where(F.coalesce("in_a", "a") != F.coalesce("in_b", "b")).select(F.col("a").alias("la"), F.col("b").alias("lb"))
    )
    if apart.isEmpty():
        return None
    opened = materialise(member_pairs(apart, sets, reps).distinct())
    judged = compare(materialise(_bounded(opened, reps).where("low <= most").select("a", "b")), docs)
    return judged.where("linked").select("a", "b")


def member_pairs(apart: DataFrame, sets: DataFrame, reps: DataFrame) -> DataFrame:
    """(a, b) of the members of two families (la, lb) that sizes and folded bitmaps let link.

    Members travel in blocks, so a large family beside many others costs a row a block and not one a pair.
    """

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                i, j = (k.ravel() for k in np.indices((len(x), len(y))))
                j = j + len(x)
                ids, n = (np.array([m[k] for m in x + y], np.int64) for k in ("rep", "n"))
                low = least_differences([m["bitmap"] for m in x + y], i, j)
                may = (low <= (100 - PERCENT) * (n[i] + n[j]) // (100 + PERCENT)) & (ids[i] != ids[j])
                found.append(distinct_pairs(ids[i[may]], ids[j[may]]))
            pairs = _joined(found)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    wanted = apart.select(F.col("la").alias("leader")).unionByName(apart.select(F.col("lb").alias("leader"))).distinct()
    members = sets.select("rep", "leader").join(wanted, "leader", "left_semi")
    sizes = members.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS).alias("blocks"))
    members = members.join(sizes, "leader").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
    members = members.join(_folded_bitmaps(reps.select("rep", "bitmap", "n")), "rep")
    blocks = materialise(
        members.groupBy("leader", "block").agg(F.collect_list(F.struct("rep", "n", "bitmap")).alias("members"))
    )
    sides = [blocks.select(F.col("leader").alias(f"l{c}"), F.col("members").alias(f"members_{c}")) for c in "ab"]
    rows = apart.join(sides[0], "la").join(sides[1], "lb").select("members_a", "members_b")
    return rows.mapInArrow(run, "a long, b long")


def similar_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every link: members (doc_id, class_id) of the classes of equal sets, and links between different classes.

    Links are (a, b, shared, total): class ids, a < b, with the sizes of the intersection and of the union. Members
    of one class link with each other. Rows without an element or a doc_id are in no class. Lists are cut into
    blocks by size and place, pairs of blocks are dealt to tasks, and those that cannot hold a link are skipped.
    """
    rows, reps, common = _classes(docs)
    own = rows.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "digest")
    members = own.join(reps.select("digest", F.col("rep").alias("class_id")), "digest").select("doc_id", "class_id")
    # Rows of other texts under the id of a representative do not speak for its class.
    indexed = prefixes(docs, common).join(reps.select(F.col("rep").alias("doc_id"), "n"), ["doc_id", "n"])
    indexed = indexed.select(F.col("doc_id").alias("leader"), "n", "elements", F.lit(0).cast("long").alias("part"))
    met = materialise(block_pairs(list_blocks(index_entries(indexed))))
    near = materialise(_bounded(met, reps).where("low <= most").select("a", "b"))
    links_of = compare(near, docs).where("linked")
    for c in "ab":
        links_of = links_of.join(reps.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}")), c)
    shared = ((F.col("n_a") + F.col("n_b") - F.col("differ")) / 2).cast("long")
    return members, links_of.select("a", "b", shared.alias("shared"), (shared + F.col("differ")).alias("total"))


def link_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, n_links) of every row in a class: the rows that it links with, other than itself."""
    members, links_of = similar_links(docs)
    members = materialise(members)
    sizes = members.groupBy("class_id").agg(F.count(F.lit(1)).alias("size"))
    both = links_of.select("a", "b").unionByName(links_of.select(F.col("b").alias("a"), F.col("a").alias("b")))
    beside = both.join(sizes.withColumnRenamed("class_id", "b"), "b").groupBy("a").agg(F.sum("size").alias("others"))
    counts = sizes.join(beside.withColumnRenamed("a", "class_id"), "class_id", "left")
    counts = counts.select("class_id", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return members.join(counts, "class_id").select("doc_id", "n_links")


# Linked sets are of one band of sizes or of two neighbouring ones: the ratio of a band is above 100 / PERCENT.
_BAND = 1.34
# So many members of a list are in a block, about, and so many blocks of a list are compared by one task.
LIST_BLOCK, BLOCKS_AT_ONCE = 32, 64


def list_blocks(entries: DataFrame) -> DataFrame:
    """(element, band, near, block, low, high, rest, members) of lists with more than one member.

    Members are (rep, low, high, rest): the bounds of the size, and how many elements are left from the place on.
    """
    n, place = F.shiftright("entry", 8).bitwiseAND(_LARGE), F.col("entry").bitwiseAND(255)
    rows = entries.select(
        F.shiftright("entry", 24).alias("element"), F.col("leader").alias("rep"), n.alias("low"), place.alias("place")
    ).distinct()
    rows = rows.withColumn("high", F.when(F.col("low") == _LARGE, F.lit(1 << 40)).otherwise(F.col("low")))
    rows = rows.withColumn("rest", F.col("high") - F.floor(F.col("place") * F.col("low") / 1024))
    rows = rows.withColumn("band", F.floor(F.log("low") / float(np.log(_BAND)))).withColumn("near", F.shiftright("place", 4))
    rows = materialise(rows.select("element", "band", "near", "rep", "low", "high", "rest"))
    cells = rows.groupBy("element", "band", "near").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.select("element", "band", "near", F.ceil(F.col("n") / LIST_BLOCK).alias("blocks"))
    several = rows.groupBy("element").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("element")
    rows = rows.join(cells.join(several, "element"), ["element", "band", "near"])
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
    return materialise(
        rows.groupBy("element", "band", "near", "block").agg(
            F.min("low").alias("low"), F.max("high").alias("high"), F.max("rest").alias("rest"),
            F.collect_list(F.struct("rep", "low", "high", "rest")).alias("members"),
        )
    )


def block_pairs(blocks: DataFrame) -> DataFrame:
    """(a, b), distinct, of members of one list that sizes and places let link; see ``list_blocks``."""

    @gives_back
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            sides = [batch.column(k) for k in (0, 1)]
            starts = [c.offsets.to_numpy().astype(np.int64) for c in sides]
            fields = [[c.values.field(k).to_numpy(zero_copy_only=False) for k in range(4)] for c in sides]
            sizes = [np.diff(s) for s in starts]
            ends = np.cumsum(sizes[0] * sizes[1])
            row = 0
            while row < len(ends):
                # Some rows at a time, of bounded pairs.
                done = ends[row - 1] if row else 0
                stop = max(row + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, "right")))
                many = sizes[0][row:stop] * sizes[1][row:stop]
                of = np.repeat(np.arange(row, stop), many)
                k = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
                i, j = starts[0][of] + k // sizes[1][of], starts[1][of] + k % sizes[1][of]
                (a, low_a, high_a, rest_a), (b, low_b, high_b, rest_b) = ([x[at] for x in f] for f, at in zip(fields, (i, j)))
                need = -(-PERCENT * (low_a + low_b) // (100 + PERCENT))
                may = (a != b) & (PERCENT * np.maximum(low_a, low_b) <= 100 * np.minimum(high_a, high_b))
                may &= np.minimum(rest_a, rest_b) >= need
                yield distinct_pairs(a[may], b[may])
                row = stop

    per_list = blocks.groupBy("element").agg(F.ceil(F.count(F.lit(1)) / BLOCKS_AT_ONCE).alias("deals"))
    dealt = blocks.join(per_list, "element")
    left, right = (dealt.select("element", "deals", *(F.col(c).alias(f"{c}_{s}") for c in blocks.columns[1:])) for s in "xy")
    left = left.withColumn("deal", F.pmod(F.xxhash64("band_x", "near_x", "block_x"), "deals")).drop("deals")
    left = left.withColumn("band_y", F.explode(F.array("band_x", F.col("band_x") + 1)))
    right = right.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1))).drop("deals")
    once = (F.col("band_x") < F.col("band_y")) | (F.struct("near_x", "block_x") <= F.struct("near_y", "block_y").cast("struct<near_x:bigint,block_x:bigint>"))
    close = PERCENT * F.greatest("low_x", "low_y") <= 100 * F.least("high_x", "high_y")
    reach = (100 + PERCENT) * F.least("rest_x", "rest_y") >= PERCENT * (F.col("low_x") + F.col("low_y"))
    met = left.join(right, ["element", "band_y", "deal"]).where(once & close & reach).select("members_x", "members_y")
    return _exploded(met.mapInArrow(lambda batches: _pair_batches(pairs(batches)), "a long, others array<long>"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each component: that with the smallest doc_id; null ids stay."""
    found = similar_components(docs.select("doc_id", "text"))
    return docs.join(found.where("doc_id <> component_id").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


