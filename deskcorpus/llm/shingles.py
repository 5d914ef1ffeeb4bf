"""Word shingles of whole texts as sets of 64-bit numbers, and their minwise signatures."""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa

from deskcorpus.llm.common import text_bytes, word_bounds, worker_cache

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
FOLD = np.uint64(0xD6E8FEB86659FD93)
SEGMENT = 1 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.ones(256, np.bool_)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every bit of the result depends on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _table(name: str, factor: np.uint64, n: int) -> np.ndarray:
    known = worker_cache("powers")
    if len(known.get(name, ())) < n:
        steps = np.full(max(n, SEGMENT), factor, np.uint64)
        steps[0] = 1
        known[name] = np.cumprod(steps)
    return known[name][:n]


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number per word, from running sums of bytes times powers of a base; the
    bytes are gone through in segments of whole words."""
    out = np.zeros(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        begin = int(starts[k])
        stop = max(int(np.searchsorted(ends, begin + SEGMENT, "right")), k + 1)
        n = int(ends[stop - 1]) - begin
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw[begin : begin + n].astype(np.uint64) + np.uint64(1)) * _table("up", BASE, n), out=sums[1:])
        s, e = starts[k:stop] - begin, ends[k:stop] - begin
        out[k:stop] = (sums[e] - sums[s]) * _table("down", INVERSE, n)[s] + (e - s).astype(np.uint64)
        k = stop
    return mix(out)


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all texts in one array, and each text's bounds in it.
    A text of fewer words than ``width`` has its whole sequence as one shingle, a text
    without words none."""
    raw, offsets = text_bytes(texts)
    raw = LOWER[raw]
    starts, ends, before = word_bounds(raw, offsets, IS_WORD)
    words = word_hashes(raw, starts, ends)
    rolling = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for k in range(width):
        rolling = rolling * FOLD + words[k : k + len(rolling)]
    rolling = mix(rolling)
    sets = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
        if b - a >= width:
            sets.append(np.unique(rolling[a : b - width + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for w in words[a:b]:
                whole = np.uint64((int(whole) * int(FOLD) + int(w)) & (2**64 - 1))
            sets.append(mix(np.array([whole], np.uint64)))
        else:
            sets.append(words[:0])
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else words[:0]), bounds


def signatures(values: np.ndarray, bounds: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Minwise signatures, ``size`` 32-bit numbers for every non-empty set."""
    draw = np.random.Generator(np.random.PCG64(seed))
    keys = draw.integers(0, 1 << 63, size, dtype=np.uint64)
    factors = draw.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    full = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(full), size), np.uint32)
    if len(full):
        at = bounds[full]
        for k in range(size):
            hashed = ((values ^ keys[k]) * factors[k]) >> np.uint64(32)
            out[:, k] = np.minimum.reduceat(hashed, at)
    return out


def set_name(values: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return hashlib.blake2b(np.ascontiguousarray(values), digest_size=16).digest()


def least_agreement(size: int, similarity: float, loss: float) -> int:
    """The largest number of agreeing places, of ``size``, that a pair of at least this
    similarity falls short of with no more than the chance ``loss``."""
    below = 0.0
    for k in range(size + 1):
        below += comb(size, k) * similarity**k * (1 - similarity) ** (size - k)
        if below > loss:
            return k
    return size
