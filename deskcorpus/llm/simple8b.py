"""Simple-8b: whole numbers packed into 64-bit words.

The top four bits of a word select how many values follow in its other 60 bits and how
wide they are. Values are coded in blocks of BLOCK, each starting on a word of its own
with an offset kept beside, so blocks decode alone and many at a time. Selector 0 is the
escape: its word holds the place, among the block's escaped values, of one value of 60
bits or more, which is stored whole."""

from __future__ import annotations

import numpy as np

BLOCK = 256
# fixed values of the code: selector, values in a word, bits of each
SELECTORS = (
    (1, 120, 0),
    (2, 60, 1),
    (3, 30, 2),
    (4, 20, 3),
    (5, 15, 4),
    (6, 12, 5),
    (7, 10, 6),
    (8, 8, 7),
    (9, 7, 8),
    (10, 6, 10),
    (11, 5, 12),
    (12, 4, 15),
    (13, 3, 20),
    (14, 2, 30),
    (15, 1, 60),
)
COUNT = np.ones(16, np.int64)
BITS = np.zeros(16, np.uint64)
for _s, _n, _b in SELECTORS:
    COUNT[_s], BITS[_s] = _n, _b


STEP = 1024 * BLOCK


class Packer:
    """Codes values as they come; between calls it holds words, and less than a block of
    values."""

    def __init__(self):
        self.n = 0
        self.rest = np.zeros(0, np.uint64)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, values: np.ndarray) -> None:
        self.n += len(values)
        if len(self.rest):
            take = min(BLOCK - len(self.rest), len(values))
            self.rest = np.concatenate([self.rest, values[:take].astype(np.uint64)])
            values = values[take:]
            if len(self.rest) < BLOCK:
                return
            self.parts.append(_encode(self.rest))
        full = len(values) - len(values) % BLOCK
        self.parts += [_encode(values[i : min(i + STEP, full)].astype(np.uint64)) for i in range(0, full, STEP)]
        self.rest = values[full:].astype(np.uint64)

    def finish(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(words, first word of each block, escaped values, first escape of each block)."""
        self.parts.append(_encode(self.rest))
        words, starts, odd, odd_starts = ([p[k] for p in self.parts] for k in range(4))
        return np.concatenate(words), _joined(starts), np.concatenate(odd), _joined(odd_starts)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The code of an array, as of :meth:`Packer.finish`."""
    packer = Packer()
    packer.add(np.asarray(values, np.uint64))
    return packer.finish()


def _joined(offsets: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.concatenate([np.diff(o) for o in offsets]))]).astype(np.int64)


def _encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every place and selector, a running count of values too wide for it tells whether
    the next values all fit; then all blocks advance together, a word at a time."""
    n = len(values)
    blocks = -(-n // BLOCK)
    ends = np.minimum(np.arange(1, blocks + 1) * BLOCK, n)
    left = np.repeat(ends, np.diff(ends, prepend=0)).astype(np.int32) - np.arange(n, dtype=np.int32)
    best = np.zeros(n, np.int8)
    wide = np.zeros(n + 1, np.int32)
    for selector, count, bits in reversed(SELECTORS):  # a better one replaces those before
        np.cumsum(values >= np.uint64(1 << bits), out=wide[1:], dtype=np.int32)
        if wide[-1] == 0:
            best[:] = selector
            continue
        fits = np.zeros(n, np.bool_)
        full = max(n - count + 1, 0)
        fits[:full] = wide[count:] == wide[:full] if full else False
        short = np.flatnonzero(left < count)  # the block ends before the word is full
        fits[short] = wide[short + left[short]] == wide[short]
        best[fits] = selector
    place = np.arange(blocks) * BLOCK
    live = np.arange(blocks)
    rounds_word, rounds_block = [], []
    escapes: list[np.ndarray] = []
    escape_blocks: list[np.ndarray] = []
    used = np.zeros(blocks, np.int64)
    while len(live):
        here = place[live]
        chosen = best[here].astype(np.int64)
        word = chosen.astype(np.uint64) << np.uint64(60)
        for selector in np.unique(chosen):
            these = np.flatnonzero(chosen == selector)
            if selector == 0:
                word[these] = used[live[these]].astype(np.uint64)
                escapes.append(values[here[these]])
                escape_blocks.append(live[these])
                used[live[these]] += 1
                continue
            count, bits = int(COUNT[selector]), BITS[selector]
            if bits == 0:
                continue
            packed = np.zeros(len(these), np.uint64)
            for k in range(count):
                source = here[these] + k
                inside = source < ends[live[these]]
                value = np.where(inside, values[np.minimum(source, n - 1)], np.uint64(0))
                packed |= value << (np.uint64(k) * bits)
            word[these] |= packed
        rounds_word.append(word)
        rounds_block.append(live)
        place[live] = np.minimum(here + COUNT[chosen], ends[live])
        live = live[place[live] < ends[live]]
    if not blocks:
        none = np.zeros(0, np.uint64)
        return none, np.zeros(1, np.int64), none, np.zeros(1, np.int64)
    owner = np.concatenate(rounds_block)
    words = np.concatenate(rounds_word)[np.argsort(owner, kind="stable")]
    starts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=blocks))])
    odd = np.concatenate(escapes) if escapes else np.zeros(0, np.uint64)
    odd_owner = np.concatenate(escape_blocks) if escapes else np.zeros(0, np.int64)
    odd = odd[np.argsort(odd_owner, kind="stable")]
    odd_starts = np.concatenate([[0], np.cumsum(np.bincount(odd_owner, minlength=blocks))])
    return words, starts, odd, odd_starts


def decode(
    words: np.ndarray, starts: np.ndarray, odd: np.ndarray, odd_starts: np.ndarray, n: int
) -> np.ndarray:
    """The ``n`` values of consecutive blocks; all but the last block are full."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNT[selector]
    before = np.concatenate([[0], np.cumsum(counts)])
    block = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    # a word's first value: those before it in its block, after the full blocks before
    first = block * BLOCK + before[:-1] - before[starts[block]]
    limit = np.minimum((block + 1) * BLOCK, n)
    payload = words & np.uint64((1 << 60) - 1)
    for s in np.unique(selector):
        these = np.flatnonzero(selector == s)
        if s == 0:
            out[first[these]] = odd[odd_starts[block[these]] + payload[these].astype(np.int64)]
            continue
        count, bits = int(COUNT[s]), BITS[s]
        if bits == 0:
            continue
        mask = np.uint64((1 << int(bits)) - 1)
        for k in range(count):
            target = first[these] + k
            inside = target < limit[these]
            out[target[inside]] = (payload[these][inside] >> (np.uint64(k) * bits)) & mask
    return out
