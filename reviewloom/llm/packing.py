"""Packing documents into training sequences of equal attention cost, with next to no padding.

A document is its ids and an end id. Every full sequence length of a document is a sequence of its own.
The rests of a bucket of documents are dealt in descending length, each to the sequence of the lowest
estimated cost (linear in the tokens plus quadratic within each piece) that has token capacity left. A rest
that does not fit fills that sequence, and what is left of it goes on to the next. A bucket uses as few
sequences as its tokens allow, so it has less than one sequence of padding.

A bucket is a part of one input partition, so nothing is shuffled and memory is bounded by the bucket.
Nulls and empty texts are the end id alone. Repeated rows are packed each for itself. Equal lengths go by
input order, equal costs to the earlier sequence. An empty table gives no piece.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from reviewloom.llm.columns import gives_back, utf8
from reviewloom.llm.pieces import encode_batch, library_ids

SEQUENCE_TOKENS = 1024
BUCKET_TOKENS = 1 << 23
LINEAR_COST, QUADRATIC_COST = 1.0, 1.0 / 512

Piece = tuple[int, int, int, int, int]


def pack(lengths: np.ndarray, size: int = SEQUENCE_TOKENS) -> list[Piece]:
    """Pieces (document, start, length, sequence, offset) of one bucket, sequences from 0."""
    pieces: list[Piece] = []
    sequence = 0
    for doc in np.flatnonzero(lengths >= size).tolist():
        for start in range(0, int(lengths[doc]) - size + 1, size):
            pieces.append((doc, start, size, sequence, 0))
            sequence += 1
    rests = lengths % size
    order = np.argsort(-rests, kind="stable")
    order = order[: np.count_nonzero(rests)].tolist()
    open_sequences = [(0.0, sequence + k, 0) for k in range(-(-int(rests.sum()) // size))]
    for doc in order:
        left = int(rests[doc])
        while left:
            cost, target, used = open_sequences[0]
            n = min(left, size - used)
            pieces.append((doc, int(lengths[doc]) - left, n, target, used))
            left -= n
            if used + n == size:
                heapq.heappop(open_sequences)
            else:
                cost += LINEAR_COST * n + QUADRATIC_COST * n * n
                heapq.heapreplace(open_sequences, (cost, target, used + n))
    return pieces


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 0,
    size: int = SEQUENCE_TOKENS,
    bucket_tokens: int = BUCKET_TOKENS,
) -> DataFrame:
    """Pieces of all documents with their ids.

    Columns: doc_id, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens, sequence_id,
    offset. ``sequence_id`` holds the partition in its upper bits.
    """

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = library_ids(tokenizer_path)
        end = np.array([end_id], "<u4")
        first = TaskContext.get().partitionId() << 36
        ids: list[np.ndarray] = []
        names: list[pa.Array] = []
        waiting = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal first, waiting
            lengths = np.array([len(x) for x in ids], np.int64)
            pieces = pack(lengths, size)
            doc, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces))
            every = pa.concat_arrays(names)
            for a in range(0, len(pieces), 4096):
                part = slice(a, a + 4096)
                bodies = [
                    ids[d][s : s + n].tobytes()
                    for d, s, n in zip(doc[part].tolist(), start[part].tolist(), length[part].tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        every.take(pa.array(doc[part])),
                        pa.array(start[part]),
                        pa.array(length[part]),
                        pa.array(bodies, pa.binary()),
                        pa.array(lengths[doc[part]]),
                        pa.array(sequence[part] + first),
                        pa.array(offset[part]),
                    ],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )
            first += int(sequence.max()) + 1
            ids.clear()
            names.clear()
            waiting = 0

        for batch in batches:
            at = 0
            for row, found in enumerate(encode_batch(*utf8(batch.column(1)), cache)):
                ids.append(np.concatenate([found, end]))
                waiting += len(found) + 1
                if waiting >= bucket_tokens:
                    names.append(batch.column(0)[at : row + 1])
                    at = row + 1
                    yield from close()
            if at < batch.num_rows:
                names.append(batch.column(0)[at:])
        if ids:
            yield from close()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )


def with_crc32(pieces: DataFrame) -> DataFrame:
    """``ids`` replaced by ids_crc32, the unsigned CRC-32 of its bytes."""
    from pyspark.sql import functions as F

    return pieces.select(
        *(F.crc32("ids").alias("ids_crc32") if c == "ids" else F.col(c) for c in pieces.columns)
    )


def padding(lengths: np.ndarray, size: int = SEQUENCE_TOKENS) -> int:
    """Padding of sequences: up to ``size``, none at a power of two."""
    lengths = np.asarray(lengths, np.int64)
    power = (lengths & (lengths - 1)) == 0
    return int(np.where(power, 0, size - lengths).sum())


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
