"""numpy kernels that several operators of this subpackage share.

They work on the UTF-8 bytes of one text.  Words are the maximal runs of
bytes other than space, tab, newline, vertical tab, form feed and carriage
return (``[^\\x20\\x09-\\x0D]+``); ``bytes.split()`` uses the same six.
Hashes are polynomials modulo 2**64 with a fixed odd base, mixed afterwards.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n; grown by doubling and kept."""
    if n > len(_powers.get("up", ())):
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            out = np.ones(size, dtype=np.uint64)
            step, filled = base, 1
            while filled < size:
                out[filled : 2 * filled] = out[:filled] * np.uint64(step)
                step, filled = step * step & _MASK, 2 * filled
            _powers[name] = out
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (two multiply-xorshift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """C with C[j] - C[i] = sum of (data[t] + 1) * BASE**-t over i <= t < j."""
    _, down = powers(len(data))
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down, out=out[1:])
    return out


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Mixed hash of each substring of ``width`` bytes, by its start."""
    if len(data) < width:
        return np.zeros(0, dtype=np.uint64)
    sums = prefix_sums(data)
    up, _ = powers(len(data))
    return mix((sums[width:] - sums[:-width]) * up[: len(data) - width + 1])


def as_bytes(text: bytes, lower: bool = False) -> np.ndarray:
    data = np.frombuffer(text, dtype=np.uint8)
    return _LOWER[data] if lower else data


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words."""
    if not len(data):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def word_hashes(data: np.ndarray) -> np.ndarray:
    starts, ends = word_bounds(data)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sums = prefix_sums(data)
    up, _ = powers(len(data))
    return mix((sums[ends] - sums[starts]) * up[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased (A-Z) word shingles.

    With fewer words than ``width``, the whole sequence is one shingle; a text
    without words has none.
    """
    words = word_hashes(as_bytes(text, lower=True))
    if not len(words):
        return words
    take = min(width, len(words))
    count = len(words) - take + 1
    acc = np.full(count, np.uint64(take), dtype=np.uint64)
    for j in range(take):
        acc = mix(acc * np.uint64(0x2545F4914F6CDD1D) + words[j : j + count])
    acc.sort()
    return acc[np.concatenate(([True], acc[1:] != acc[:-1]))]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, in three passes."""
    n = len(x)
    if n < width:
        return x[:0]
    top = np.iinfo(x.dtype).max
    blocks = -(-n // width)
    padded = np.full(blocks * width, top, dtype=x.dtype)
    padded[:n] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])
