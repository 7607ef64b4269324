"""An adaptive range coder for blocks of token ids, driven by predictions of order 0 to 2.

Order 2 and order 1 predict one id each: the one that last proved right after the last two ids, and after the
last id, with a confidence. Whether one of them is right is a symbol whose odds are mixed from two adaptive
models, one that sees both confidences and one that sees the recent outcomes. If neither is right, order 0
takes over: the id's share (``Shares``) among all ids of the blocks that are coded together, in one step. Ids
without a share follow an escape as plain bits.

All blocks start from the same state and are coded side by side, one numpy lane a block, so each block can be
read alone with the shares. The range has 64 bits and leaves in 16-bit words without carries.
"""

from __future__ import annotations

import zlib

import numpy as np

PROB_BITS = 14
ONE = 1 << PROB_BITS
# The share of ONE that a symbol is drawn towards when another one comes; above the loss by rounding.
LEAST_SHARE = 40
RATE = 4
TABLE_BITS = 9
SHARE_BITS = 16
# Ids from here on, and all beyond the most common, have no share of their own.
MOST_SHARED_ID, MOST_SHARES = 1 << 22, 1 << 15
CONFIDENCE = 7
LANES = 8192

_U16, _U48 = np.uint64(16), np.uint64(48)
_LOW32 = np.uint64((1 << 32) - 1)
_LEAST = np.uint64(1 << 32)
_STEP = np.uint64(PROB_BITS)
_SHARES = np.uint64(SHARE_BITS)

Lanes = slice | np.ndarray


def _targets(symbols: int) -> np.ndarray:
    """The frequencies (cumulative, up to and with each symbol) that coding a symbol draws a row towards."""
    share = np.full((symbols, symbols), LEAST_SHARE)
    np.fill_diagonal(share, ONE - LEAST_SHARE * (symbols - 1))
    return share.cumsum(axis=1).astype(np.int16)


def _even(nodes: int) -> np.ndarray:
    row = (np.arange(1, 5) * (ONE // 4)).astype(np.int16)
    return np.tile(row, (nodes, 1))


_TARGETS = _targets(4)


def _learned(odds: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    change = _TARGETS.take(symbol, 0)
    change -= odds
    change >>= RATE
    change += odds
    return change


def _store(table: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """table[rows] = values, moving a row as one item."""
    whole = np.dtype((np.void, table.shape[1] * 2))
    table.view(whole)[:, 0][rows] = values.view(whole)[:, 0]


class Shares:
    """Order 0: what part of 1 << SHARE_BITS each id takes; the last part is that of all ids without one."""

    def __init__(self, ids: np.ndarray, widths: np.ndarray):
        self.ids, self.widths = ids.astype(np.int64), widths.astype(np.int64)
        if len(widths) != len(ids) + 1 or self.widths.sum() != 1 << SHARE_BITS:
            raise ValueError("the shares are not whole")
        self.starts = np.cumsum(self.widths) - self.widths
        self.place_of = np.full(int(self.ids.max(initial=-1)) + 2, len(ids), np.int32)
        self.place_of[self.ids] = np.arange(len(ids), dtype=np.int32)
        self.at = np.repeat(np.arange(len(widths), dtype=np.int32), self.widths)

    def places(self, ids: np.ndarray) -> np.ndarray:
        return self.place_of.take(np.minimum(ids, len(self.place_of) - 1))


NO_SHARES = Shares(np.zeros(0, np.int64), np.array([1 << SHARE_BITS]))


def shares_of(ids: np.ndarray) -> Shares:
    """Shares by the number of times that ids occur, at least twice."""
    counts = np.bincount(ids[ids < MOST_SHARED_ID])
    kept = np.flatnonzero(counts > 1)
    if len(kept) > MOST_SHARES:
        kept = np.sort(kept[np.argsort(-counts[kept], kind="stable")[:MOST_SHARES]])
    if not len(kept):
        return NO_SHARES
    many = np.append(counts[kept], len(ids) - counts[kept].sum())
    widths = 1 + many * ((1 << SHARE_BITS) - len(many)) // len(ids)
    widths[many.argmax()] += (1 << SHARE_BITS) - widths.sum()
    return Shares(kept, widths)


def pack_shares(shares: Shares) -> bytes:
    if not len(shares.ids):
        return b""
    gaps = np.diff(shares.ids, prepend=0)
    return zlib.compress(gaps.astype("<u4").tobytes() + shares.widths.astype("<u4").tobytes(), 1)


def unpack_shares(packed: bytes) -> Shares:
    if not packed:
        return NO_SHARES
    numbers = np.frombuffer(zlib.decompress(packed), "<u4").astype(np.int64)
    return Shares(np.cumsum(numbers[: len(numbers) // 2]), numbers[len(numbers) // 2 :])


class _Coder:
    """Ranges of many lanes; subclasses send symbols out or read them."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, (1 << 64) - 1, np.uint64)

    def _narrow(self, lane: Lanes, odds: np.ndarray, symbol: np.ndarray, step: np.ndarray) -> None:
        at = np.arange(0, odds.size, odds.shape[1])
        at += symbol
        flat = odds.ravel()
        # The last entry of a row is ONE, so the row before gives the zero below the first symbol.
        first = (flat.take(at - 1) & (ONE - 1)).astype(np.uint64)
        width = flat.take(at).astype(np.uint64)
        width -= first
        self._cut(lane, first, width, step)

    def _cut(self, lane: Lanes, first: np.ndarray, width: np.ndarray, step: np.ndarray) -> None:
        """Goes on with ``width`` steps of the range from the step ``first``; both are overwritten."""
        width *= step
        first *= step
        first += self.low[lane]
        small = np.flatnonzero(width < _LEAST)
        while len(small):
            low, span = first[small], width[small]
            straddles = ((low ^ (low + span - np.uint64(1))) >> _U48) != 0
            if straddles.any():
                span = np.where(straddles, _LEAST - (low & _LOW32), span)
            self._shift(small if isinstance(lane, slice) else lane[small], low)
            span = span << _U16
            first[small], width[small] = low << _U16, span
            small = small[span < _LEAST]
        self.low[lane], self.range[lane] = first, width


class _Writer(_Coder):
    def __init__(self, lanes: int, size: int):
        super().__init__(lanes)
        self.words = np.zeros((lanes, 2 * size + 16), np.uint16)
        self.used = np.zeros(lanes, np.int64)

    def _shift(self, lane: np.ndarray, low: np.ndarray) -> None:
        used = self.used[lane]
        if used.max() + 8 >= self.words.shape[1]:
            self.words = np.concatenate([self.words, np.zeros_like(self.words)], axis=1)
        self.words[lane, used] = (low >> _U48).astype(np.uint16)
        self.used[lane] = used + 1

    def symbol(self, lane: Lanes, odds: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Codes ``symbol`` of each lane by the cumulative frequencies ``odds`` (lanes by symbols)."""
        self._narrow(lane, odds, symbol, self.range[lane] >> _STEP)
        return symbol

    def part(self, lane: np.ndarray, starts: np.ndarray, widths: np.ndarray, _, symbol: np.ndarray) -> np.ndarray:
        """Codes ``symbol``, whose part of 1 << SHARE_BITS starts and is as wide as the tables say."""
        first, width = starts.take(symbol).astype(np.uint64), widths.take(symbol).astype(np.uint64)
        self._cut(lane, first, width, self.range[lane] >> _SHARES)
        return symbol

    def plain(self, lane: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Codes SHARE_BITS bits of the same odds."""
        self._cut(lane, symbol.astype(np.uint64), np.ones(len(lane), np.uint64), self.range[lane] >> _SHARES)
        return symbol

    def finish(self) -> list[bytes]:
        every = np.arange(len(self.low))
        for _ in range(4):
            self._shift(every, self.low)
            self.low <<= _U16
        return [w[:n].astype("<u2").tobytes() for w, n in zip(self.words, self.used)]


class _Reader(_Coder):
    def __init__(self, payloads: list[bytes]):
        super().__init__(len(payloads))
        sizes = np.array([len(p) // 2 for p in payloads])
        self.words = np.zeros((len(payloads), int(sizes.max()) + 4), np.uint16)
        for row, payload in zip(self.words, payloads):
            row[: len(payload) // 2] = np.frombuffer(payload, "<u2")
        self.code = np.zeros(len(payloads), np.uint64)
        self.used = np.zeros(len(payloads), np.int64)
        every = np.arange(len(payloads))
        for _ in range(4):
            self._shift(every, self.low)

    def _shift(self, lane: np.ndarray, low: np.ndarray) -> None:
        used = self.used[lane]
        self.code[lane] = (self.code[lane] << _U16) | self.words[lane, np.minimum(used, self.words.shape[1] - 1)]
        self.used[lane] = used + 1

    def symbol(self, lane: Lanes, odds: np.ndarray, _) -> np.ndarray:
        step = self.range[lane] >> _STEP
        place = np.minimum((self.code[lane] - self.low[lane]) // step, np.uint64(ONE - 1)).astype(np.int16)
        below = (odds <= place[:, None]).view(np.uint32)
        symbol = ((below[:, 0] * np.uint32(0x01010101)) >> np.uint32(24)).astype(np.int64)
        self._narrow(lane, odds, symbol, step)
        return symbol

    def _place(self, lane: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        step = self.range[lane] >> _SHARES
        place = np.minimum((self.code[lane] - self.low[lane]) // step, np.uint64((1 << SHARE_BITS) - 1))
        return place.astype(np.int64), step

    def part(self, lane: np.ndarray, starts: np.ndarray, widths: np.ndarray, at: np.ndarray, _) -> np.ndarray:
        place, step = self._place(lane)
        symbol = at.take(place)
        self._cut(lane, starts.take(symbol).astype(np.uint64), widths.take(symbol).astype(np.uint64), step)
        return symbol

    def plain(self, lane: np.ndarray, _) -> np.ndarray:
        place, step = self._place(lane)
        self._cut(lane, place.astype(np.uint64), np.ones(len(lane), np.uint64), step)
        return place


class _Model:
    def __init__(self, lanes: int, nibbles: int, shares: Shares):
        self.nibbles, self.shares = nibbles, shares
        self.last = np.zeros((2, lanes), np.int64)
        # By slot: the id that proved right, times 8, plus the confidence in it.
        self.guess = [np.zeros(lanes << TABLE_BITS, np.int32 if nibbles < 7 else np.int64) for _ in range(2)]
        self.by_sure = _even(lanes * (CONFIDENCE + 1) ** 2)
        self.by_past = _even(lanes * 32)
        self.past = np.zeros(lanes, np.int64)
        number = np.arange(lanes)
        self.slots, self.sures, self.pasts = number << TABLE_BITS, number << 6, number << 5

    def code(self, coder: _Coder, lanes: int, ids: np.ndarray | None) -> np.ndarray:
        """Codes or reads one id of each of the first ``lanes`` lanes, and learns it."""
        here = slice(0, lanes)
        one = self.last[0][here]
        mask = (1 << TABLE_BITS) - 1
        slots = [((self.last[1][here] * 0x2F0B + one) * 0x9E3779B1) >> 15, (one * 0x9E3779B1) >> 13]
        entry = []
        for k in range(2):
            slots[k] &= mask
            slots[k] += self.slots[here]
            entry.append(self.guess[k].take(slots[k]))
        guess, sure = [x >> 3 for x in entry], [x & CONFIDENCE for x in entry]
        by_sure = self.sures[here] + (sure[0] << 3) + sure[1]
        by_past = self.pasts[here] + (self.past[here] << 1) + (guess[0] == guess[1])
        odds = (self.by_sure.take(by_sure, 0), self.by_past.take(by_past, 0))
        mixed = (odds[0] >> 1) + (odds[1] >> 1)
        hit = None
        if ids is not None:
            hit = 2 - (ids == guess[1])
            hit *= ids != guess[0]
        hit = coder.symbol(here, mixed, hit)
        _store(self.by_sure, by_sure, _learned(odds[0], hit))
        _store(self.by_past, by_past, _learned(odds[1], hit))
        self.past[here] = ((self.past[here] << 2) | hit) & 15
        found = np.where(hit == 0, guess[0], guess[1])
        missed = np.flatnonzero(hit == 2)
        if len(missed):
            found[missed] = self._plain(coder, missed, None if ids is None else ids[missed])
        for k in range(2):
            right = guess[k] == found
            kept = (sure[k] >= 2) | right
            confidence = np.where(right, np.minimum(sure[k] + 1, CONFIDENCE), np.maximum(sure[k] >> 1, 1))
            self.guess[k][slots[k]] = (np.where(kept, guess[k], found) << 3) + confidence
        self.last[1][here] = one
        self.last[0][here] = found
        return found

    def _plain(self, coder: _Coder, lane: np.ndarray, ids: np.ndarray | None) -> np.ndarray:
        own = self.shares
        place = coder.part(lane, own.starts, own.widths, own.at, None if ids is None else own.places(ids))
        escaped = np.flatnonzero(place == len(own.ids))
        if not len(escaped):
            return own.ids.take(place)
        found = np.append(own.ids, 0).take(place)
        rest = np.zeros(len(escaped), np.int64)
        for low in range(SHARE_BITS * ((4 * self.nibbles - 1) // SHARE_BITS), -1, -SHARE_BITS):
            bits = None if ids is None else (ids[escaped] >> low) & ((1 << SHARE_BITS) - 1)
            rest = (rest << SHARE_BITS) | coder.plain(lane[escaped], bits)
        found[escaped] = rest
        return found


def nibbles_for(largest_id: int) -> int:
    return max(1, -(-int(largest_id).bit_length() // 4))


def encode_blocks(blocks: list[np.ndarray], nibbles: int, shares: Shares = NO_SHARES) -> list[bytes]:
    """The coded form of each block; ids need at most ``nibbles`` times four bits, and any may lack a share."""
    if not blocks:
        return []
    order, sizes, active = _by_size([len(b) for b in blocks])
    table = np.zeros((len(active), len(blocks)), np.uint32)
    for column, k in enumerate(order):
        table[: sizes[column], column] = blocks[k]
    coder, model = _Writer(len(blocks), len(active)), _Model(len(blocks), nibbles, shares)
    for ids, lanes in zip(table, active):
        model.code(coder, lanes, ids[:lanes].astype(np.int64))
    coded: list[bytes] = [b""] * len(blocks)
    for k, payload in zip(order, coder.finish()):
        coded[k] = payload
    return coded


def decode_blocks(payloads: list[bytes], sizes: list[int], nibbles: int, shares: Shares = NO_SHARES) -> list[np.ndarray]:
    """The blocks of ``encode_blocks``, by the same shares."""
    if not payloads:
        return []
    order, ordered, active = _by_size(sizes)
    table = np.zeros((len(active), len(payloads)), np.uint32)
    coder, model = _Reader([payloads[k] for k in order]), _Model(len(payloads), nibbles, shares)
    for row, lanes in zip(table, active):
        row[:lanes] = model.code(coder, lanes, None)
    blocks: list[np.ndarray] = [np.zeros(0, "<u4")] * len(payloads)
    for column, k in enumerate(order):
        blocks[k] = table[: ordered[column], column].astype("<u4")
    return blocks


def _by_size(sizes: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Lanes in descending size, their sizes, and at each step how many have an id left."""
    order = sorted(range(len(sizes)), key=lambda k: -sizes[k])
    ordered = [sizes[k] for k in order]
    many = np.array(ordered)
    return order, ordered, [int(x) for x in np.searchsorted(-many, -np.arange(many[0]), "left")]
