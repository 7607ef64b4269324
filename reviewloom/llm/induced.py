"""Suffix sorting by recursive induction, with common-prefix values, of texts that fit into memory.

Suffixes that start a rise after a fall (the seeds) are sorted first: the pieces between seeds are sorted by
induction from an arbitrary order, named by rank, and the shorter text of names is sorted by recursion (in memory
once it is small). From the sorted seeds all other suffixes follow: going through the sorted ones, each hands the
suffix that starts one place before it to the queue of its first character. Queues are emptied in the order of
characters, so they are a monotone priority queue; they carry positions and common-prefix lengths and go to a
local file when they grow beyond ``memory`` entries. The common prefix of two neighbours in a queue is one more
than the least common prefix met between those that handed them over. The text, the order and the common prefixes
are arrays in memory, so callers bound the text.
"""

from __future__ import annotations

import tempfile

import numpy as np

MEMORY_ENTRIES = 16_000_000


class Queues:
    """First-in first-out queues by character, of positions and common-prefix lengths, partly on disk."""

    def __init__(self, memory: int):
        self.memory, self.held = memory, 0
        self.parts: dict[int, list] = {}
        self.file = None

    def push(self, key: int, positions: np.ndarray, lcps: np.ndarray) -> None:
        self.parts.setdefault(key, []).append((positions, lcps))
        self.held += len(positions)
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        for parts in self.parts.values():
            for k, part in enumerate(parts):
                if isinstance(part[0], np.ndarray):
                    at = self.file.seek(0, 2)
                    self.file.write(part[0].tobytes() + part[1].tobytes())
                    parts[k] = (at, len(part[0]))
        self.held = 0

    def pop(self, key: int) -> tuple[np.ndarray, np.ndarray] | None:
        """All that has come to this queue since the last time, or None."""
        parts = self.parts.pop(key, None)
        if not parts:
            return None
        found = []
        for part in parts:
            if isinstance(part[0], np.ndarray):
                self.held -= len(part[0])
                found.append(part)
            else:
                at, n = part
                self.file.seek(at)
                raw = self.file.read(10 * n)
                found.append((np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.int16, n, 8 * n)))
        if len(found) == 1:
            return found[0]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def close(self) -> None:
        if self.file:
            self.file.close()


class _Scan:
    """One pass over sorted suffixes that hands their predecessors on."""

    def __init__(self, text: np.ndarray, rises: np.ndarray, wanted: bool, keys: int, cap: int, memory: int):
        self.text, self.rises, self.wanted, self.cap = text, rises, wanted, cap
        self.queues = Queues(memory)
        # The least common prefix met since the last hand-over to a queue; none yet: nothing shared.
        self.since = np.zeros(keys, np.int16)

    def hand_over(self, positions: np.ndarray, lcps: np.ndarray) -> None:
        before = positions - 1
        at = np.flatnonzero((before >= 0) & (self.rises[before] == self.wanted))
        if not len(at):
            if self.cap:
                np.minimum(self.since, lcps.min(), out=self.since)
            return
        before = before[at]
        keys = self.text[before]
        order = np.argsort(keys, kind="stable")
        keys, sources = keys[order], at[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        ends = np.append(starts[1:], len(keys))
        found = np.zeros(len(keys), np.int16)
        if self.cap:
            least = _RangeMin(lcps)
            left = np.append(0, sources[:-1] + 1)
            left[starts] = 0
            found = least(left, sources)
            firsts = keys[starts].astype(np.int64)
            found[starts] = np.minimum(found[starts], self.since[firsts])
            found = np.where(found >= self.cap, self.cap, found + 1).astype(np.int16)
            new = starts[self.since[firsts] < 0]
            found[new] = 0
            np.minimum(self.since, lcps.min(), out=self.since, where=self.since >= 0)
            tail = np.append(np.minimum.accumulate(lcps[::-1])[::-1], np.int16(self.cap))
            self.since[firsts] = tail[sources[ends - 1] + 1]
        before = before[order]
        for a, b in zip(starts.tolist(), ends.tolist()):
            self.queues.push(int(keys[a]), before[a:b], found[a:b])


class _RangeMin:
    """Least value of closed ranges of an array."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        width = 1
        while 2 * width <= len(values):
            row = self.levels[-1]
            self.levels.append(np.minimum(row[:-width], row[width:]))
            width *= 2

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        level = np.frexp((right - left + 1).astype(np.float64))[1] - 1
        out = np.empty(len(left), self.levels[0].dtype)
        for k in np.unique(level).tolist():
            here = np.flatnonzero(level == k)
            row = self.levels[k]
            out[here] = np.minimum(row[left[here]], row[right[here] + 1 - (1 << k)])
        return out


def _rising(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it; the last is not."""
    n = len(text)
    rises = np.zeros(n, bool)
    if n > 1:
        change = np.flatnonzero(text[1:] != text[:-1])
        # A run of one character behaves as its end does.
        runs = np.diff(np.append(np.append(-1, change), n - 1))
        up = np.append(text[change] < text[change + 1], False)
        rises = np.repeat(up, runs)
    return rises


def _run(text: np.ndarray, at: int, cap: int) -> int:
    part = text[at : at + cap]
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


def _induce(
    text: np.ndarray, rises: np.ndarray, seeds: np.ndarray, seed_lcps: np.ndarray, cap: int, memory: int
) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order, and the common prefix with the one before, from seeds in order."""
    present = np.unique(text)
    keys = int(present[-1]) + 1
    nothing = (np.zeros(0, np.int64), np.zeros(0, np.int16))
    seed_keys = text[seeds]
    falling: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    scan = _Scan(text, rises, False, keys, cap, memory)
    scan.since[:] = -1
    scan.queues.push(int(text[-1]), np.array([len(text) - 1]), np.zeros(1, np.int16))
    scan.since[text[-1]] = 0
    place = np.searchsorted(seed_keys, present)
    stop = np.searchsorted(seed_keys, present, "right")
    for key, a, b in zip(present.tolist(), place.tolist(), stop.tolist()):
        waves = []
        while (wave := scan.queues.pop(key)) is not None:
            waves.append(wave)
            scan.hand_over(*wave)
        falling[key] = _join(waves)
        if b > a:
            lcps = seed_lcps[a:b].copy()
            if cap:
                lcps[0] = _border(text, falling[key][0][-1:], seeds[a], cap)
            scan.hand_over(seeds[a:b], lcps)
    scan.queues.close()
    scan = _Scan(text, rises, True, keys, cap, memory)
    scan.since[:] = -1
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for key in present[::-1].tolist():
        waves = []
        while (wave := scan.queues.pop(key)) is not None:
            waves.append(wave)
            scan.hand_over(*wave)
        down, down_lcps = _join(waves)
        up, up_lcps = falling.pop(key, nothing)
        border = _border(text, up[-1:], down[-1], cap) if cap and len(down) else 0
        if len(down):
            # Ascending: each with the one below it, the lowest with the highest falling suffix.
            parts.append((down[::-1], np.append(np.int16(border), down_lcps[:0:-1])))
        if len(up):
            parts.append((up, up_lcps))
            backwards = np.append(np.int16(border), up_lcps[:0:-1])
            scan.hand_over(up[::-1], backwards)
    scan.queues.close()
    return _join(parts[::-1])


def _join(parts: list) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int16)
    if len(parts) == 1:
        return parts[0]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _border(text: np.ndarray, falling: np.ndarray, rising: int, cap: int) -> int:
    """Common prefix of a falling and a rising suffix of one first character: the shorter run of it."""
    if not len(falling):
        return 0
    return min(_run(text, int(falling[0]), cap), _run(text, int(rising), cap))


def common_prefixes(text: np.ndarray, left: np.ndarray, right: np.ndarray, cap: int) -> np.ndarray:
    """Length of the common prefix of pairs of suffixes, at most ``cap``."""
    found = np.zeros(len(left), np.int16)
    active = np.arange(len(left))
    padded = np.append(text, np.zeros(8, text.dtype))
    if text.dtype == np.uint8:
        rows = np.lib.stride_tricks.sliding_window_view(padded, 8)
    n = len(text)
    for at in range(0, cap, 8):
        a, b = left[active] + at, right[active] + at
        room = np.minimum(np.minimum(n - a, n - b), min(8, cap - at)).clip(0)
        a, b = np.minimum(a, n), np.minimum(b, n)
        if text.dtype == np.uint8:
            differ = rows[a].view("<u8")[:, 0] ^ rows[b].view("<u8")[:, 0]
            low = differ & (~differ + np.uint64(1))
            same = np.where(differ == 0, 8, (np.frexp(low.astype(np.float64))[1] - 1) // 8)
        else:
            step = np.arange(8)
            equal = padded[a[:, None] + step] == padded[b[:, None] + step]
            same = np.logical_and.accumulate(equal, axis=1).sum(axis=1)
        same = np.minimum(same, room)
        found[active] += same.astype(np.int16)
        active = active[same == 8]
        if not len(active):
            break
    return found


def _named(text: np.ndarray, seeds: np.ndarray, order: np.ndarray) -> np.ndarray:
    """A name by rank for the piece from each seed (in order) to the next seed; equal pieces, equal names."""
    end = np.append(seeds[1:], len(text) - 1)
    sizes = np.zeros(len(text), np.int64)
    sizes[seeds] = end - seeds + 1
    left, right = order[:-1], order[1:]
    equal = sizes[left] == sizes[right]
    active = np.flatnonzero(equal)
    step = 0
    while len(active):
        same = text[left[active] + step] == text[right[active] + step]
        equal[active[~same]] = False
        step += 1
        active = active[same]
        active = active[sizes[left[active]] > step]
    names = np.cumsum(np.append(0, ~equal))
    by_place = np.zeros(len(text), np.int64)
    by_place[order] = names
    return by_place[seeds]


def _doubling(names: np.ndarray, depth: int | None) -> np.ndarray:
    """Order of the suffixes of a text in memory, by at least ``depth`` characters."""
    rank = names.astype(np.int64)
    n, width = len(rank), 1
    while True:
        after = np.full(n, 0, np.int64)
        after[: n - width] = rank[width:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.append(False, ordered[1:] != ordered[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        width *= 2
        if fresh.sum() == n - 1 or width >= n or (depth is not None and width >= depth):
            return order


def suffix_order(text: np.ndarray, cap: int, memory: int = MEMORY_ENTRIES) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``text`` (non-negative integers) in order, and common prefixes with the one before.

    Both are right up to ``cap`` characters: longer common prefixes count as ``cap``, and suffixes that share so
    many are in any order. With ``cap`` 0 the order is complete and no common prefixes are kept.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int16)
    rises = _rising(text)
    seeds = np.flatnonzero(rises[1:] & ~rises[:-1]) + 1
    order = seeds
    if len(seeds):
        by_key = seeds[np.argsort(text[seeds], kind="stable")]
        sorted_once, _ = _induce(text, rises, by_key, np.zeros(len(seeds), np.int16), 0, memory)
        is_seed = np.zeros(n, bool)
        is_seed[seeds] = True
        order = sorted_once[is_seed[sorted_once]]
        names = _named(text, seeds, order)
        if len(seeds) <= memory:
            order = seeds[_doubling(names, cap // 2 + 2 if cap else None)]
        else:
            order = seeds[suffix_order(names, 0, memory)[0]]
    lcps = np.zeros(len(order), np.int16)
    if cap and len(order) > 1:
        lcps[1:] = common_prefixes(text, order[:-1], order[1:], cap)
    return _induce(text, rises, order, lcps, cap, memory)
