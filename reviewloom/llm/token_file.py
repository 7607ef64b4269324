"""Token ids of documents in binary files, coded by an adaptive range coder.

A file holds the documents of one range of ids in ascending order::

    magic "RLID2\\n", nibbles per id (1 byte)
    groups of at most LANES blocks of at most BLOCK_IDS ids each, across documents; first the group's shares:
        0 (u32), payload bytes (u32), CRC-32 of the payload (u32), payload
    then its blocks:
        ids (u32), payload bytes (u32), CRC-32 of the payload (u32), payload
    index, zlib: documents' tokens (i64 each) after their ids (i64 each) and marks of missing ids (1 byte each)
    index bytes (u32), CRC-32 of the index (u32), ids in the file (u64), magic

Each block of a group is coded from the same start and checked by itself, so a damaged block is found and the others
stay readable with the group's shares (how often each id occurs in it). Files are named by the task that wrote them and known by the manifest (one row a file); the place of
a document among all ids follows from the manifest's sums.

A null or empty text is the end id alone. Rows of equal ids are ordered by text; a null id comes first. Other
columns are ignored. An empty table gives an empty manifest.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm import files, id_coder
from reviewloom.llm.columns import utf8
from reviewloom.llm.pieces import encode_batch, library_ids
from reviewloom.plans.storage import materialise, scratch_path

MAGIC = b"RLID2\n"
BLOCK_IDS = 1024
_BLOCK, _TAIL = struct.Struct("<III"), struct.Struct("<IIQ6s")


class Writer:
    """Writes one file; documents are added in order."""

    def __init__(self, out, nibbles: int):
        self.out, self.nibbles = out, nibbles
        self.doc_ids: list[int | None] = []
        self.sizes: list[int] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        out.write(MAGIC + bytes([nibbles]))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()).bit_length() > 4 * self.nibbles:
            raise ValueError("an id is larger than the file allows")
        self.doc_ids.append(doc_id)
        self.sizes.append(len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= BLOCK_IDS * id_coder.LANES:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, "<u4")
        whole = len(ids) if last else len(ids) - len(ids) % BLOCK_IDS
        blocks = [ids[a : min(a + BLOCK_IDS, whole)] for a in range(0, whole, BLOCK_IDS)]
        for k in range(0, len(blocks), id_coder.LANES):
            part = blocks[k : k + id_coder.LANES]
            shares = id_coder.shares_of(np.concatenate(part))
            self._put(0, id_coder.pack_shares(shares))
            for block, payload in zip(part, id_coder.encode_blocks(part, self.nibbles, shares)):
                self._put(len(block), payload)
        self.waiting = [ids[whole:]]
        self.n_waiting = len(ids) - whole

    def _put(self, n: int, payload: bytes) -> None:
        self.out.write(_BLOCK.pack(n, len(payload), zlib.crc32(payload)) + payload)

    def close(self) -> None:
        self._flush(last=True)
        missing = np.array([x is None for x in self.doc_ids], np.uint8)
        names = np.array([x or 0 for x in self.doc_ids], "<i8")
        index = zlib.compress(names.tobytes() + np.array(self.sizes, "<i8").tobytes() + missing.tobytes(), 1)
        self.out.write(index + _TAIL.pack(len(index), zlib.crc32(index), self.n_ids, MAGIC))
        self.out.close()


def read(path: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(document, ids before it in the file, its ids) in the file's order. Damage raises ValueError."""
    with files.open_ranges(path) as source:
        size = source.size()
        head = source.read_at(len(MAGIC) + 1, 0)
        length, crc, n_ids, magic = _TAIL.unpack(source.read_at(_TAIL.size, size - _TAIL.size))
        if head[: len(MAGIC)] != MAGIC or magic != MAGIC:
            raise ValueError(f"not a token file: {path}")
        packed = source.read_at(length, size - _TAIL.size - length)
        if zlib.crc32(packed) != crc:
            raise ValueError(f"damaged index in {path}")
        index = zlib.decompress(packed)
        n = len(index) // 17
        names = np.frombuffer(index, "<i8", n)
        sizes = np.frombuffer(index, "<i8", n, 8 * n)
        missing = np.frombuffer(index, np.uint8, n, 16 * n)
        end = size - _TAIL.size - length
        source.seek(len(head))
        doc = at = 0
        waiting: list[np.ndarray] = []
        ready = 0
        while doc < n:
            while ready < sizes[doc]:
                found = _blocks(source, head[-1], end, path)
                waiting.append(found)
                ready += len(found)
            ids = np.concatenate(waiting) if waiting else np.zeros(0, "<u4")
            used = 0
            while doc < n and used + sizes[doc] <= len(ids):
                yield None if missing[doc] else int(names[doc]), at, ids[used : used + sizes[doc]]
                used += int(sizes[doc])
                at += int(sizes[doc])
                doc += 1
            waiting, ready = [ids[used:]], len(ids) - used
        if at != n_ids:
            raise ValueError(f"{at} of {n_ids} ids in {path}")


def _blocks(source, nibbles: int, end: int, path: str) -> np.ndarray:
    """The ids of the next group."""
    payloads: list[bytes] = []
    sizes: list[int] = []
    shares = None
    while source.tell() < end:
        at = source.tell()
        n, length, crc = _BLOCK.unpack(source.read(_BLOCK.size))
        if not n and shares is not None:
            source.seek(at)
            break
        payload = source.read(length)
        if zlib.crc32(payload) != crc or (n and shares is None):
            raise ValueError(f"damaged block before byte {source.tell()} of {path}")
        if n:
            payloads.append(payload)
            sizes.append(n)
        else:
            shares = id_coder.unpack_shares(payload)
    if not sizes:
        raise ValueError(f"too few blocks in {path}")
    return np.concatenate(id_coder.decode_blocks(payloads, sizes, nibbles, shares))


def write_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Writes the ids of all texts, each with the end id, and returns the manifest.

    Columns: path, place (of the file among all), n_docs, n_ids, start (ids in the files before).
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        path = files.new_name(folder, part, ".ids")
        cache = library_ids(tokenizer_path)
        writer = None
        end = np.array([end_id], "<u4")
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode_batch(*utf8(batch.column(1)), cache)):
                writer = writer or Writer(files.create(path), nibbles)
                writer.add(doc_id, np.concatenate([ids, end]))
        if writer:
            writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([part]), pa.array([len(writer.sizes)]), pa.array([writer.n_ids])],
                names=["path", "place", "n_docs", "n_ids"],
            )

    nibbles = id_coder.nibbles_for(max(_largest_id(tokenizer_path), end_id))
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = materialise(ordered.mapInArrow(run, "path string, place long, n_docs long, n_ids long"))
    # One row a file: the sums before each are those of a short list.
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _largest_id(tokenizer_path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True) - 1


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document of the files; ids as little-endian unsigned 32-bit bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows: list[tuple] = []
                for doc_id, at, ids in read(path):
                    rows.append((doc_id, base + at, ids.astype("<u4").tobytes()))
                    if len(rows) == 2048:
                        yield _as_batch(rows)
                        rows = []
                if rows:
                    yield _as_batch(rows)

    # A file a task: a row of the manifest is small, what it stands for is not, so rows are not merged by size.
    spread = manifest.select("path", "start")
    spread = spread.repartition(max(1, manifest.count()))
    return spread.mapInArrow(run, "doc_id long, start long, ids binary")


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    doc_id, start, ids = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_id, pa.int64()), pa.array(start, pa.int64()), pa.array(ids, pa.binary())],
        names=["doc_id", "start", "ids"],
    )
