"""Content-defined anchors: which places of a text have to be compared.

Of the hashes of all k-byte strings inside a window of ``length`` bytes the
smallest (the first, among equals) is the window's anchor. It depends on the
window's bytes alone, so equal windows have equal anchors, and neighbouring
windows mostly share theirs. Windows in a row with one anchor make a stretch;
the stretches of a text hold each of its windows exactly once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: bytes of the strings that are hashed
K = 32
#: window starts that are handled at once; at most 2 ** 24
CHUNK = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, k: int = K) -> np.ndarray:
    """Mixed 64-bit hashes of all k-byte strings (k a power of two)."""
    h = data.astype(np.uint64) + np.uint64(1)
    power, size = 0x100000001B3, 1
    with np.errstate(over="ignore"):
        while size < k:
            h = h[:-size] * np.uint64(power) + h[size:]
            power, size = power * power % (1 << 64), size * 2
        h ^= h >> np.uint64(31)
        h *= np.uint64(_MULTIPLIER)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def stretches(data: np.ndarray, begin: np.ndarray, length: int, k: int = K) -> tuple[np.ndarray, ...]:
    """Stretches of the windows of the texts that follow each other in
    ``data`` and begin at ``begin`` (ascending, the end of data last).

    Returns (text number, first window start in data, last window start,
    place of the anchor in data, hash of the anchor).
    """
    ends = begin[1:]
    parts = []
    for at in range(0, len(data), CHUNK):
        piece = data[at:at + CHUNK + length - 1]
        if len(piece) < length:
            break
        h = gram_hashes(piece, k)
        low = sliding_min((h >> np.uint64(24) << np.uint64(24)) | np.arange(len(h), dtype=np.uint64), length - k + 1)
        place = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
        start = np.arange(len(place))
        text = np.searchsorted(ends, start + at, side="right")
        ok = start + at + length <= ends[text]
        place, start, text = place[ok], start[ok], text[ok]
        if not len(start):
            continue
        new = np.concatenate(([True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])))
        first = np.nonzero(new)[0]
        last = np.concatenate((first[1:], [len(start)])) - 1
        parts.append((text[first], start[first] + at, start[last] + at, place[first] + at, h[place[first]]))
    if not parts:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def string_hashes(data: bytes, start: np.ndarray, end: np.ndarray, seed: int) -> Iterator[int]:
    from itertools import repeat

    from xxhash import xxh3_64_intdigest
    return map(xxh3_64_intdigest, map(memoryview(data).__getitem__, map(slice, start.tolist(), end.tolist())), repeat(seed))
