"""Words and their hashes for a group of texts at once, in arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_LONG = 64  # longer words are hashed one by one
GROUP_BYTES = 1 << 20


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes with all bits depending on all others."""
    h = (h ^ (h >> np.uint64(32))) * _ODD[3]
    h = (h ^ (h >> np.uint64(29))) * _ODD[1]
    return h ^ (h >> np.uint64(32))


def groups(raw: list[bytes], budget: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``budget`` bytes, a longer one alone."""
    lo, size = 0, 0
    for i, t in enumerate(raw):
        if i > lo and size + len(t) > budget:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(raw):
        yield lo, len(raw)


def lanes(buffer: bytes) -> np.ndarray:
    """Eight bytes from every place of the buffer as a number; beyond its end come zeros."""
    return np.ndarray((len(buffer),), "<u8", buffer + b"\0" * 8, strides=(1,))


def words_of(raw: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts with a blank behind each, the words' starts and ends in it, and each text's first word (and the end)."""
    buffer = b" ".join(raw) + b" "
    solid = ~_BLANK[np.frombuffer(buffer, np.uint8)]
    edge = np.flatnonzero(np.diff(solid, prepend=False))
    starts, ends = edge[0::2], edge[1::2]
    begins = np.cumsum([0, *[len(r) + 1 for r in raw]])
    return buffer, starts, ends, np.searchsorted(starts, begins)


def hashes_of(buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every range of bytes."""
    import xxhash

    view, length = lanes(buffer), ends - starts
    h = length.astype(np.uint64) * _ODD[2]
    here = np.flatnonzero(length <= _LONG)
    at = 0
    while len(here):
        left = np.minimum(length[here] - at, 8)
        word = view[starts[here] + at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - left).astype(np.uint64) * np.uint64(8)))
        x = (h[here] ^ word) * _ODD[0]
        h[here] = x ^ (x >> np.uint64(31))
        at += 8
        here = here[length[here] > at]
    for i in np.flatnonzero(length > _LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(buffer[starts[i]:ends[i]], 7)
    return mixed(h)


def runs(h: np.ndarray, k: int, factor: int) -> np.ndarray:
    """A hash of every ``k`` consecutive hashes, by doubling; shorter than ``h`` by k - 1, empty if there are fewer."""
    if len(h) < k:
        return h[:0]
    out, have, part, size = None, 0, h, 1
    p = factor | 1
    while True:
        if k & size:
            # ``out`` covers the last ``have`` of the k, ``part`` the ``size`` before them.
            if out is None:
                out = part
            else:
                n = min(len(part), len(out) - size)
                out = part[:n] * np.uint64(pow(p, have, 1 << 64)) + out[size:size + n]
            have += size
        size *= 2
        if size > k:
            return out[:len(h) - k + 1]
        half = size // 2
        part = part[:len(part) - half] * np.uint64(pow(p, half, 1 << 64)) + part[half:]
