"""Token ids of whole texts with a public tokenizer, at the speed of its distinct words.

``word_bpe`` tokenizers drop white space and never merge across it, and they lower-case.
So a text's ids are its words' ids in a row: every distinct word goes through the
tokenizers library once per worker, and texts are put together by array gathers.
The words met first are kept in a bounded cache; others are learnt anew by each chunk of
texts. That changes nothing but the speed."""

from __future__ import annotations

from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from deskcorpus.llm.common import worker_cache

CACHE_WORDS = 250_000
GROUP = 256
WORD_END = "</w>"
STOPS = ".,;:!?#%&$*|)"  # after a letter, these always start another piece
END_ID = 1


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _only_letters(word: str) -> bool:
    """Whether the tokenizer sees letters alone: its normal form takes some letters apart
    into a letter and a mark, at which it splits."""
    return word.isalpha() and (word := normalize("NFC", word)).isalpha() and word.lower().isalpha()


class WordEncoder:
    """For tokenizers that treat white-space separated words on their own."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.model = Tokenizer.from_file(path)
        self.ascii_letters, self.any_letters = (Tokenizer(self.model.model) for _ in range(2))
        # for letters alone the costly patterns of the full tokenizer find nothing to do
        spaces = pre_tokenizers.WhitespaceSplit()
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.ascii_letters.normalizer = normalizers.Lowercase()
        self.ascii_letters.pre_tokenizer = spaces
        self.any_letters.normalizer = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.any_letters.pre_tokenizer = pre_tokenizers.Sequence([spaces, as_bytes])
        vocabulary = self.model.get_vocab()
        self.wide = len(vocabulary) > 1 << 16
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, np.bool_)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.tokens = vocabulary
        self.known = pa.array([], pa.string())
        self.pool = np.zeros(1 << 20, np.uint32)
        self.ends = np.zeros(1 << 16, np.int64)

    def _letters(self, model, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters alone, each of which is one piece to the tokenizer, so
        that its last id is the one that ends a word."""
        groups = [" ".join(words[i : i + GROUP]) for i in range(0, len(words), GROUP)]
        found = model.encode_batch_fast(groups, add_special_tokens=False)
        flat = np.concatenate([np.array(e.ids, np.uint32) for e in found]) if found else np.zeros(0, np.uint32)
        upto = np.flatnonzero(self.ends_word[flat]) + 1
        if len(upto) != len(words):
            raise ValueError("this tokenizer does not keep words apart")
        return flat, np.diff(upto, prepend=0)

    def _any(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.model.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for x in ids for i in x], np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))

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

    def _gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = self.ends[places]
        sizes = self.ends[places + 1] - first
        before = np.cumsum(sizes) - sizes
        return self.pool[np.repeat(first - before, sizes) + np.arange(sizes.sum())], sizes

    def _places(self, words: pa.Array) -> np.ndarray:
        """Entry of every distinct word. Words that end in stops after an ASCII letter are
        two parts, between which the tokenizer always splits; parts are what is kept."""
        body = pc.utf8_rtrim(words, STOPS)
        cut = pc.and_(pc.less(pc.binary_length(body), pc.binary_length(words)), pc.match_substring_regex(body, "[A-Za-z]$"))
        two = np.flatnonzero(cut.to_numpy(zero_copy_only=False))
        bodies = pc.if_else(cut, body, words)
        pairs = zip(*(x.take(pa.array(two)).to_numpy(zero_copy_only=False) for x in (words, body)))
        parts = pa.concat_arrays([bodies, pa.array([w[len(m) :] for w, m in pairs], pa.string())]).dictionary_encode()
        names = parts.dictionary
        found = pc.index_in(names, self.known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(found < 0)
        plain = names.take(pa.array(new))
        ascii_ = pc.and_(pc.ascii_is_alpha(plain), pc.string_is_ascii(plain)).to_numpy(zero_copy_only=False)
        other = plain.filter(pa.array(~ascii_)).to_numpy(zero_copy_only=False)
        letters = np.fromiter(map(_only_letters, other), np.bool_, len(other))
        others = new[~ascii_]
        at = len(self.known)
        kept = []
        for model, which in (
            (self.ascii_letters, new[ascii_]),
            (self.any_letters, others[letters]),
            (None, others[~letters]),
        ):
            chosen = names.take(pa.array(which))
            strings = chosen.to_numpy(zero_copy_only=False).tolist()
            flat, sizes = self._letters(model, strings) if model else self._any(strings)
            found[which] = at + np.arange(len(which))
            at = self._append(at, flat, sizes)
            kept.append(chosen)
        places = found[parts.indices.to_numpy(zero_copy_only=False)]
        if len(two):
            both = np.stack([places[two], places[len(words) :]], 1).ravel()
            flat, sizes = self._gather(both)
            places[two] = at + np.arange(len(two))
            self._append(at, flat, sizes.reshape(-1, 2).sum(1))
        if len(self.known) < CACHE_WORDS:  # the words met first are the common ones
            self.known = pa.concat_arrays([self.known, *kept])
        return places[: len(words)]

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Entry of every word of the texts, and the words before each text."""
        special = pc.match_substring(texts, "<|")
        lowered = pc.ascii_lower(texts)  # as the tokenizer does, but not inside special tokens
        if pc.any(special).as_py():
            lowered = pc.if_else(special, texts, lowered)
        lists = pc.ascii_split_whitespace(lowered)
        coded = lists.flatten().dictionary_encode()
        places = self._places(coded.dictionary)
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
        return places[coded.indices.to_numpy(zero_copy_only=False)], bounds.astype(np.int64)

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        places, bounds = self.words(texts)
        total = np.concatenate([[0], np.cumsum(self.ends[places + 1] - self.ends[places])])
        return total[bounds[1:]] - total[bounds[:-1]]

    def ids(self, texts: pa.Array, end: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, each text's followed by ``end``, and each text's bounds."""
        places, bounds = self.words(texts)
        flat, sizes = self._gather(places)
        bounds = np.concatenate([[0], np.cumsum(sizes)])[bounds]
        if end is not None:
            flat = np.insert(flat, bounds[1:], end)
            bounds = bounds + np.arange(len(bounds))
        return flat, bounds


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file; it lives as long as the worker."""
    known = worker_cache("encoders")
    if path not in known:
        known[path] = WordEncoder(path)
    return known[path]
