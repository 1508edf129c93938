"""Word shingles of whole texts as sets of 64-bit hashes, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Words per shingle.
WORDS = 5
#: Bytes of text hashed at once; a longer text is hashed alone.
SLICE_BYTES = 512 << 10

_rng = np.random.Generator(np.random.PCG64(20240607))
#: White space between words: U+0020 and U+0009 to U+000D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: A random number per byte, the same for A-Z and a-z.
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_PLACE = _rng.integers(1, 2**63, WORDS, dtype=np.uint64) | np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which each bit depends on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(name: str, base: int, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        full = np.full(max(n, SLICE_BYTES + 4096), base, np.uint64)
        full[0] = 1
        _powers[name] = np.cumprod(full, dtype=np.uint64)
    return _powers[name][:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for each text where its words begin (one more at the end)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACE[data]
    word = ~space
    before = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(word & before)
    ends = np.flatnonzero(space & ~np.concatenate([[True], space[:-1]]))
    total = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * _power("up", _BASE, len(data)), dtype=np.uint64)])
    hashes = (total[ends] - total[starts]) * _power("down", _INVERSE, len(data))[starts]
    hashes = mixed(hashes + (ends - starts).astype(np.uint64))
    text_starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return hashes, np.searchsorted(starts, text_starts)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than a shingle
    make one shingle, no words an empty set."""
    hashes, at = word_hashes(texts)
    full = np.zeros(max(0, len(hashes) - WORDS + 1), np.uint64)
    for j in range(WORDS):
        full += hashes[j : j + len(full)] * _PLACE[j]
    full = mixed(full)
    sets = []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= WORDS:
            sets.append(np.unique(full[a : b - WORDS + 1]))
        elif b > a:
            short = (hashes[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            sets.append(mixed(np.array([short], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def slices(sizes: list[int]) -> Iterator[slice]:
    """Ranges of rows with about SLICE_BYTES of text, one row at least."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > SLICE_BYTES:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))
