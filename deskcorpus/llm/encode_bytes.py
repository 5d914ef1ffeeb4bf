"""Token ids of whole texts with a byte-level BPE tokenizer, by their distinct units.

The tokenizer's split pattern always starts a new piece at a space that is followed by
something other than white space, whatever stands before; between ASCII letters, digits
and punctuation (but not after an apostrophe, which may open a contraction); and on both
sides of a line break that stands alone. So a text is cut there into units, most of them a
space and a word; every distinct unit goes through the tokenizers library once per chunk of
texts, or once per worker while the cache has room, and texts are put together by array
gathers. Next to bytes outside ASCII there are no cuts but those before a space."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from deskcorpus.llm.common import text_bytes, worker_cache

CACHE_UNITS = 400_000
GROUP = 512
END_ID = 2

# classes of bytes: 0 may be white space or begin it, 1 other bytes outside ASCII
LETTER, DIGIT, MARK = 2, 3, 4
_KIND = np.ones(256, np.uint8)
_KIND[[*range(0x21), 0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = 0
_KIND[0x21:0x7F] = [LETTER if chr(b).isalpha() else DIGIT if chr(b).isdigit() else MARK for b in range(0x21, 0x7F)]
_PLAIN = "^ [A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+$"  # a space and letters


def unit_bounds(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where units begin in joined texts, and the end of the last one."""
    cut = np.zeros(len(raw) + 1, np.bool_)
    if len(raw) > 1:
        kind = _KIND[raw]
        left, right = kind[:-1], kind[1:]
        cut[1:-1] = (left != right) & (left >= LETTER) & (right >= LETTER) & (raw[:-1] != 0x27)
        cut[:-2] |= (raw[:-1] == 0x20) & (right != 0)
        lone = np.flatnonzero((raw[1:-1] == 0x0A) & (left[:-1] >= LETTER) & (right[1:] >= LETTER)) + 1
        cut[lone] = cut[lone + 1] = True
    cut[ends] = True  # a text begins a unit, whatever it begins with
    return np.flatnonzero(cut)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class UnitEncoder:
    """For byte-level tokenizers whose split pattern takes a space with what follows it."""

    def __init__(self, path: str):
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True  # their strings in a text are ordinary text
        # a space and letters is one piece; for such units the costly pattern has nothing to find
        self.letters = Tokenizer(self.model.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(" "), "merged_with_next"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.model.get_vocab()
        self.wide = len(vocabulary) > 1 << 16
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes of each token
        self.size[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.known = pa.array([], pa.string())
        self.pool = np.zeros(1 << 18, np.uint32)
        self.ends = np.zeros(1 << 14, np.int64)

    def _append(self, at: int, flat: np.ndarray, sizes: np.ndarray) -> int:
        """Put entries after the first ``at``; returns how many there are then."""
        upto = self.ends[at] + np.cumsum(sizes)
        if at + len(sizes) + 1 > len(self.ends):
            self.ends = np.resize(self.ends, 2 * (at + len(sizes) + 1))
        if len(upto) and upto[-1] > len(self.pool):
            self.pool = np.resize(self.pool, 2 * int(upto[-1]))
        self.pool[self.ends[at] : self.ends[at] + len(flat)] = flat
        self.ends[at + 1 : at + 1 + len(sizes)] = upto
        return at + len(sizes)

    def _joined(self, model, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units that begin with a space, many to a call, told apart by their bytes."""
        strings = units.to_pylist()
        groups = ["".join(strings[i : i + GROUP]) for i in range(0, len(strings), GROUP)]
        found = model.encode_batch_fast(groups, add_special_tokens=False)
        flat = np.concatenate([np.array(e.ids, np.uint32) for e in found]) if found else np.zeros(0, np.uint32)
        upto = np.cumsum(self.size[flat])
        ends = np.cumsum(pc.binary_length(units).to_numpy(zero_copy_only=False).astype(np.int64))
        last = np.searchsorted(upto, ends)
        if len(ends) and (last[-1] >= len(upto) or (upto[last] != ends).any()):
            raise ValueError("this tokenizer does not keep a space with the word after it")
        return flat, np.diff(last, prepend=-1)

    def _alone(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode_batch_fast(units.to_pylist(), add_special_tokens=False)
        flat = [np.array(e.ids, np.uint32) for e in found]
        sizes = np.fromiter(map(len, flat), np.int64, len(flat))
        return np.concatenate([np.zeros(0, np.uint32), *flat]), sizes

    def _places(self, units: pa.Array) -> np.ndarray:
        """Entry of every distinct unit."""
        found = pc.index_in(units, self.known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(found < 0)
        fresh = units.take(pa.array(new))
        inner = pc.starts_with(fresh, " ").to_numpy(zero_copy_only=False)
        plain = pc.match_substring_regex(fresh, _PLAIN).to_numpy(zero_copy_only=False)
        at, kept = len(self.known), []
        for code, which in (
            (lambda u: self._joined(self.letters, u), plain),
            (lambda u: self._joined(self.model, u), inner & ~plain),
            (self._alone, ~inner),
        ):
            chosen = fresh.filter(pa.array(which))
            if not len(chosen):
                continue
            flat, sizes = code(chosen)
            found[new[which]] = at + np.arange(len(chosen))
            at = self._append(at, flat, sizes)
            kept.append(chosen)
        if kept and len(self.known) < CACHE_UNITS:  # the units met first are the common ones
            self.known = pa.concat_arrays([self.known, *kept])
        return found

    def ids(self, texts: pa.Array, end: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, each text's followed by ``end``, and each text's bounds."""
        raw, ends = text_bytes(texts)
        if not len(raw):
            return np.full(len(texts), end, np.uint32), np.arange(len(texts) + 1)
        bounds = unit_bounds(raw, ends)
        units = pa.Array.from_buffers(
            pa.string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))]
        )
        coded = units.dictionary_encode()
        places = self._places(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        first = self.ends[places]
        sizes = self.ends[places + 1] - first
        before = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.pool[np.repeat(first - before[:-1], sizes) + np.arange(before[-1])]
        upto = before[np.searchsorted(bounds, ends)]
        return np.insert(flat, upto[1:], end), upto + np.arange(len(upto))


def encoder(path: str) -> UnitEncoder:
    """The worker's encoder for a tokenizer file; it lives as long as the worker."""
    known = worker_cache("unit_encoders")
    if path not in known:
        known[path] = UnitEncoder(path)
    return known[path]
