"""Splitting text into the pieces that byte-level BPE merges within, and their ids by word.

The pieces are those of the pattern of the public byte-level vocabularies: contractions, letters, digits or
other signs with at most one blank before them, and runs of white space. The split is computed for a whole
Arrow batch at once from the classes of its characters.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa

LETTER, DIGIT, SPACE, OTHER = 0, 1, 2, 3
CONTRACTIONS = (b"'s", b"'t", b"'re", b"'ve", b"'m", b"'ll", b"'d")
CACHED_PIECES = 200_000
# Documents are split together up to so many bytes.
CHUNK_BYTES = 1 << 20


@lru_cache(1)
def _classes() -> np.ndarray:
    """The class of every code point."""
    import regex

    points = [*range(0xD800), *range(0xE000, 0x110000)]
    every = "".join(map(chr, points))
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
        for found in regex.finditer(pattern, every):
            table[points[found.start()] : points[found.end() - 1] + 1] = kind
    table[0xD800:0xE000] = OTHER
    return table


def _code_points(data: np.ndarray, lead: np.ndarray) -> np.ndarray:
    first = data[lead].astype(np.uint32)
    points = first.copy()
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    for size, low, mark in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        here = np.flatnonzero((first >= low) & (first < (0xE0, 0xF0, 0x100)[size - 2]))
        value = first[here] & np.uint32(mark)
        for k in range(1, size):
            value = (value << np.uint32(6)) | (padded[lead[here] + k] & np.uint32(0x3F))
        points[here] = np.minimum(value, 0x10FFFF)
    return points


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which the pieces of all documents start, ascending."""
    if not len(data):
        return np.zeros(0, np.int64)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    points = _code_points(data, lead)
    kind = _classes()[points]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    first = first[lead]
    before = np.empty_like(kind)
    before[0], before[1:] = 255, kind[:-1]
    before[first] = 255
    last = np.empty_like(first)
    last[-1], last[:-1] = True, first[1:]
    after_blank = np.zeros(len(kind), bool)
    after_blank[1:] = points[:-1] == 32
    after_blank &= ~first
    space = kind == SPACE
    start = (kind != before) & (space | ~after_blank)
    # The last of a run of white space leads the next piece if it is a blank, else it stands alone.
    ends = space & ~last
    ends[:-1] &= kind[1:] != SPACE
    start |= ends
    quotes = np.flatnonzero((points == 39) & start)
    if len(quotes):
        end = np.append(lead, len(data))
        following = np.searchsorted(offsets, lead[quotes], "right")
        for q, stop in zip(quotes.tolist(), offsets[following].tolist()):
            head = data[end[q] : min(end[q] + 3, stop)].tobytes()
            for word in CONTRACTIONS:
                if head.startswith(word):
                    start[q + 1 : q + len(word)] = False
                    if q + len(word) < len(start):
                        start[q + len(word)] = True
                    break
    return lead[start]


def encode_batch(data: np.ndarray, offsets: np.ndarray, ids_of) -> list[np.ndarray]:
    """The ids of every document; ``ids_of[piece]`` gives the ids of one piece as bytes of <u4."""
    found: list[np.ndarray] = []
    row = 0
    while row < len(offsets) - 1:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        part = offsets[row : stop + 1]
        found += _encode(data[part[0] : part[-1]], part - part[0], ids_of)
        row = stop
    return found


def _encode(data: np.ndarray, offsets: np.ndarray, ids_of) -> list[np.ndarray]:
    starts = piece_starts(data, offsets)
    if not len(starts):
        return [np.zeros(0, "<u4")] * (len(offsets) - 1)
    # Arrow numbers equal pieces, so that each is looked up once and the ids are gathered by number.
    bounds = np.append(starts, len(data)).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    coded = pieces.dictionary_encode()
    number = coded.indices.to_numpy()
    parts = list(map(ids_of.__getitem__, coded.dictionary.to_pylist()))
    known = np.frombuffer(b"".join(parts), "<u4")
    sizes = np.fromiter(map(len, parts), np.int32, len(parts)) // 4
    firsts = np.cumsum(sizes, dtype=np.int32) - sizes
    many = sizes[number]
    ends = np.append(0, np.cumsum(many))
    place = np.repeat(firsts[number] - ends[:-1], many)
    place += np.arange(len(place))
    ids = known[place]
    cuts = ends[np.searchsorted(starts, offsets)].tolist()
    return [ids[a:b] for a, b in zip(cuts, cuts[1:])]


class PieceCache(dict):
    """Ids by piece; ``encode`` is asked for a piece that is not there.

    When half full the pieces become the older half, in place of the one before; a piece found there is kept again,
    so common pieces stay.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= CACHED_PIECES // 2:
            self.older = dict(self)
            self.clear()
        ids = self.older.pop(piece, None)
        if ids is None:
            found = self.encode(piece)
            ids = struct.pack(f"<{len(found)}I", *found)
        self[piece] = ids
        return ids


@lru_cache(4)
def library_ids(path: str) -> PieceCache:
    """Ids by the tokenizers library, without special tokens, asked piece by piece."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {b: b for b in shown} | {b: 256 + k for k, b in enumerate(sorted({*range(256)} - {*shown}))}
    model = tokenizer.model

    def encode(piece: bytes) -> list[int]:
        return [token.id for token in model.tokenize(piece.decode("latin-1").translate(signs))]

    return PieceCache(encode)
