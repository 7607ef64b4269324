"""64-bit hashes of spans of bytes, for whole arrays at once."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values so that every bit depends on every other (in place)."""
    for _ in range(2):
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            inverse = pow(_BASE, -1, 1 << 64)
            for name, base in (("up", _BASE), ("down", inverse)):
                row = np.full(n, base, np.uint64)
                row[0] = 1
                setattr(self, name, np.multiply.accumulate(row))
        return self.up, self.down


_powers = _Powers()
_BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64)


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """n + 1 running sums from which ``span_hashes`` takes the hash of any span."""
    up, _ = _powers.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray | slice, stop: np.ndarray | slice) -> np.ndarray:
    """Equal spans have equal hashes, wherever they stand."""
    _, down = _powers.get(len(sums))
    return mix((sums[stop] - sums[start]) * down[start])
