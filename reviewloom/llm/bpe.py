"""Byte-level BPE encoding and decoding, exact and in linear time.

A piece is matched against all tokens at once by an Aho-Corasick automaton (bytes mapped to Latin-1). From
the longest match at each place the encoder goes on, and takes back when two neighbours would not survive the
merges: whether two tokens may stand side by side is found by undoing their merges across the border, and is
remembered. Every place is given up at most once, so the work is linear in the piece.

Nulls are empty texts (no ids). Empty tables give empty tables; repeated rows are encoded each for itself;
other columns are ignored. A text is never cut, however long.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.columns import lists, utf8
from reviewloom.llm.pieces import PieceCache, encode_batch

REMEMBERED_PAIRS = 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class BytePairs:
    """The merges of one rank table. Ranks must be dense, and every single byte must have one."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"bytes without a rank: {missing[:5]}")
        self.sizes = [len(token) for token in self.tokens]
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.shorter = [self._shorter(token) for token in self.tokens]
        self.halves: list[tuple[int, int]] = []
        self.merged: dict[tuple[int, int], int] = {}
        self.allowed: dict[tuple[int, int], bool] = {}
        for rank, token in enumerate(self.tokens):
            self.halves.append(self._last_merge(rank, token))
        self.allowed.clear()

    def _shorter(self, token: bytes) -> int:
        """The longest token that is a proper prefix, or -1."""
        for size in range(len(token) - 1, 0, -1):
            if (found := self.ranks.get(token[:size])) is not None:
                return found
        return -1

    def _last_merge(self, rank: int, token: bytes) -> tuple[int, int]:
        """The two tokens whose merge makes this one; a token that no merge makes is its own half."""
        left = self.shorter[rank]
        while left >= 0:
            right = self.ranks.get(token[len(self.tokens[left]) :], rank)
            if left < rank and right < rank and self._side_by_side(left, right):
                self.merged[left, right] = rank
                return left, right
            left = self.shorter[left]
        return rank, rank

    def _side_by_side(self, left: int, right: int) -> bool:
        """True if the merges leave the border between two tokens alone.

        The later of the two tokens is taken apart step by step; a merge across the border that comes before
        the step just undone would have happened first.
        """
        undone = len(self.tokens) + 1
        while True:
            if self.merged.get((left, right), undone) < undone:
                return False
            for side in ("left", "right") if left > right else ("right", "left"):
                if side == "left":
                    undone, inner = left, self.halves[left][1]
                    if inner != left:
                        left = inner
                        break
                else:
                    undone, inner = right + 1, self.halves[right][0]
                    if inner != right:
                        right = inner
                        break
            else:
                return True

    def fits(self, left: int, right: int) -> bool:
        known = self.allowed.get((left, right))
        if known is None:
            if len(self.allowed) >= REMEMBERED_PAIRS:
                self.allowed.clear()
            known = self.allowed[left, right] = self._side_by_side(left, right)
        return known

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece, as merging in rank order gives them."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        sizes, shorter, allowed, size = self.sizes, self.shorter, self.allowed, len(piece)
        longest = [0] * (size + 1)
        for end, rank in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - sizes[rank]] = rank
        given_up = bytearray(size + 1)
        ids: list[int] = []
        at = 0
        token, last = longest[0], -1
        while at < size:
            end = at + sizes[token]
            if not given_up[end]:
                fits = last < 0 or allowed.get((last, token))
                if fits is None:
                    fits = self.fits(last, token)
                if fits:
                    ids.append(token)
                    at, last, token = end, token, longest[end]
                    continue
            if shorter[token] >= 0:
                token = shorter[token]
                continue
            given_up[at] = 1
            token = ids.pop()
            at -= sizes[token]
            last = ids[-1] if ids else -1
        return ids


@lru_cache(4)
def byte_pairs(path: str) -> BytePairs:
    return BytePairs(read_ranks(path))


@lru_cache(4)
def _cache(path: str) -> PieceCache:
    return PieceCache(byte_pairs(path).encode)


class Spelling:
    """Turns many ids into one run of bytes at once: a table row for each id."""

    def __init__(self, words: list[bytes]):
        self.sizes = np.array([len(w) for w in words] or [0], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(words), np.uint8)

    def spell(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[ids] - (ends - sizes), sizes)
        shift += np.arange(ends[-1])
        return self.letters[shift].tobytes()


@lru_cache(4)
def token_bytes(path: str) -> Spelling:
    return Spelling(byte_pairs(path).tokens)


def encode(texts: DataFrame, id_col: str, text_col: str, ranks_path: str) -> DataFrame:
    """(``id_col``, ids array<int>) of every row, whole texts, by the ranks in ``ranks_path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache(ranks_path)
        for batch in batches:
            found = encode_batch(*utf8(batch.column(1)), cache)
            flat = np.concatenate(found).astype(np.int32) if found else np.zeros(0, np.int32)
            ids = lists(flat, np.array([len(x) for x in found], np.int64), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_col, "ids"])

    kind = texts.schema[id_col].dataType.simpleString()
    return texts.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(encoded: DataFrame, id_col: str, ids_col: str, ranks_path: str) -> DataFrame:
    """(``id_col``, decoded binary) of every row; bytes, since ids may end inside a character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = token_bytes(ranks_path)
        for batch in batches:
            column = batch.column(1)
            flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            decoded = [spelling.spell(flat[a:b]) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(decoded, pa.binary())], names=[id_col, "decoded"]
            )

    kind = encoded.schema[id_col].dataType.simpleString()
    ids = F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids")
    return encoded.select(id_col, ids).mapInArrow(run, f"`{id_col}` {kind}, decoded binary")


def digests(texts: DataFrame, id_col: str, text_col: str, ranks_path: str) -> DataFrame:
    """Per row: ``id_col``, n_tokens, ids_sha256, decoded_sha256, from the ids of ``encode`` alone."""
    from hashlib import sha256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = token_bytes(ranks_path)
        decimal = Spelling([b"%d " % rank for rank in range(len(spelling.sizes))])
        for batch in batches:
            column = batch.column(1)
            flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            rows = [flat[a:b] for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in rows], pa.int64()),
                    pa.array([sha256(decimal.spell(x)[:-1]).hexdigest() for x in rows], pa.string()),
                    pa.array([sha256(spelling.spell(x)).hexdigest() for x in rows], pa.string()),
                ],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = texts.schema[id_col].dataType.simpleString()
    return encode(texts, id_col, text_col, ranks_path).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
