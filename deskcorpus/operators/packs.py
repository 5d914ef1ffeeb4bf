"""Windows of words in packs: a row of a table holds thousands of windows of n words, as
numbers of the words that stand beside them, for one share of the work.

A pack's ``words`` are those it needs, in order, the first one PAD; ``rows`` are its windows, one
column of word numbers per place, and ``keys`` tell who asks. All three are compressed Arrow
streams. Words are compared as they are written, never by hashes, which only choose the share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SCHEMA = "share int, n int, asked boolean, words binary, rows binary, keys binary"
PAD = ""  # stands before the first word of a text; words are never empty
BETWEEN = "\n"  # no word has white space
LARGEST = 1 << 62
MIX, MIX32 = np.uint64(0x9E3779B97F4A7C15), np.uint32(0x9E3779B1)


class Codes:
    """A number for each row of ids, in the order of the rows and equal for equal rows. Where
    the numbers would grow beyond ``largest``, they are replaced by their ranks."""

    def __init__(self, ids: Sequence[np.ndarray], size: int, largest: int = LARGEST):
        self.size, self.ranked = size, []
        code, width = ids[0].astype(np.int64), size
        for column in ids[1:]:
            known = None
            if width > largest // size:
                known = np.unique(code)
                code, width = np.searchsorted(known, code), len(known)
            self.ranked.append(known)
            code *= size
            code += column
            width *= size
        self.code = code

    def of(self, ids: Sequence[np.ndarray]) -> np.ndarray:
        """The numbers of other rows, -1 for those with an id below 0 or a rank that is not there."""
        code, bad = ids[0].astype(np.int64), ids[0] < 0
        for column, known in zip(ids[1:], self.ranked, strict=True):
            if known is not None:
                code, here = _find(known, code)
                bad |= ~here
            code = code * self.size + column
            bad |= column < 0
        return np.where(bad, -1, code)


def _find(known: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each is in a sorted array, and whether it is there."""
    if not len(known):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return at, known[at] == asked


def _starts(code: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin."""
    return np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)


def _encode(parts: Sequence[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    """PAD and the different words of all parts in order, and the number of each."""
    coded = pa.concat_arrays([pa.array([PAD], pa.large_string()), *parts]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    number = np.empty(len(order), np.int32)
    number[order.to_numpy()] = np.arange(len(order), dtype=np.int32)
    return coded.dictionary.take(order), number[coded.indices.to_numpy()[1:]]


def _unify(parts: Sequence) -> tuple[pa.Array, list[np.ndarray]]:
    """Words of all parts and the ids of all as numbers of these."""
    found, numbers = _encode([p.words for p in parts])
    ends = np.cumsum([0, *(len(p.words) for p in parts)])
    own = [numbers[lo:hi] for lo, hi in zip(ends, ends[1:])]
    return found, [np.concatenate([n[p.ids[i]] for n, p in zip(own, parts, strict=True)]) for i in range(len(parts[0].ids))]


@dataclass
class Windows:
    """Different windows, in order, and how often each was counted; a window that was only
    seen at the start of a text counts 0."""

    words: pa.Array
    ids: list[np.ndarray]
    count: np.ndarray

    def __len__(self) -> int:
        return len(self.count)

    @staticmethod
    def joined(parts: list[Windows], order: int) -> Windows:
        """All windows of some parts, which are let go."""
        none = Windows(pa.array([PAD], pa.large_string()), [np.zeros(0, np.int32)] * order, np.zeros(0, np.int64))
        found, ids = _unify(parts or [none])
        count = np.concatenate([p.count for p in parts or [none]])
        parts.clear()
        return Windows(found, ids, count)._distinct()

    def _distinct(self) -> Windows:
        code = Codes(self.ids, len(self.words)).code
        by = np.argsort(code)
        starts = _starts(code[by])
        del code
        some = by[starts]
        count = self.count[by]
        del by
        count = np.add.reduceat(count, starts, dtype=np.int64) if len(starts) else count
        return Windows(self.words, [c[some] for c in self.ids], _narrow(count, np.int32))

    def ends(self) -> Windows:
        """The windows without their first word: each counts the different words before it."""
        return Windows(self.words, self.ids[1:], self.ids[0] != 0)._distinct()

    def where(self, some: np.ndarray) -> Windows:
        return Windows(self.words, [c[some] for c in self.ids], self.count[some])

    def columns(self) -> dict[str, np.ndarray]:
        return {"count": _narrow(self.count)}


@dataclass
class Asked:
    """Windows to be answered: ``who`` is the place of the asker in ``keys`` and never falls,
    ``times`` is how often it asks, and p = a + b * (p by this order)."""

    words: pa.Array
    ids: list[np.ndarray]
    keys: pa.Array
    who: np.ndarray
    a: np.ndarray
    b: np.ndarray
    times: np.ndarray

    def __len__(self) -> int:
        return len(self.who)

    @staticmethod
    def joined(parts: Sequence[Asked]) -> Asked:
        found, ids = _unify(parts)
        ends = np.cumsum([0, *(len(p.keys) for p in parts)])
        who = np.concatenate([p.who.astype(np.int64) + at for p, at in zip(parts, ends)])
        rest = (np.concatenate([getattr(p, c) for p in parts]) for c in ("a", "b", "times"))
        return Asked(found, ids, pa.concat_arrays([p.keys for p in parts]), who, *rest)

    def ends(self, a: np.ndarray, b: np.ndarray) -> Asked:
        return Asked(self.words, self.ids[1:], self.keys, self.who, a, b, self.times)

    def where(self, some: np.ndarray) -> Asked:
        rest = (c[some] for c in (self.who, self.a, self.b, self.times))
        return Asked(self.words, [c[some] for c in self.ids], self.keys, *rest)

    def columns(self) -> dict[str, np.ndarray]:
        return {"a": self.a, "b": self.b, "times": _narrow(self.times)}


class Table:
    """All windows of a share, to look up what is asked."""

    def __init__(self, windows: Windows):
        self.windows, size = windows, len(windows.words)
        self.rows = Codes(windows.ids, size)
        self.contexts = Codes(windows.ids[:-1] or [np.zeros(len(windows), np.int64)], size)
        starts = _starts(self.contexts.code)
        self.known, self.contexts.code = self.contexts.code[starts], None
        sums = [windows.count, windows.count > 0]
        self.total, self.kinds = (np.add.reduceat(c, starts, dtype=np.int64) if len(starts) else c for c in sums)

    def find(self, asked: Asked) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How often each window was counted, and all windows of its context and their kinds."""
        numbers = pc.fill_null(pc.index_in(asked.words, value_set=self.windows.words), -1).to_numpy(zero_copy_only=False)
        ids = [numbers[c] for c in asked.ids]
        count = _values(*_find(self.rows.code, self.rows.of(ids)), self.windows.count)
        at, here = _find(self.known, self.contexts.of(ids[:-1] or [np.zeros(len(asked), np.int64)]))
        return count, _values(at, here, self.total), _values(at, here, self.kinds)


def _values(at: np.ndarray, here: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.where(here, values[at], 0) if len(values) else np.zeros(len(at), np.int64)


@dataclass
class Texts:
    """Some texts: the words of all, one after the other, and whose they are."""

    words: pa.Array
    ids: np.ndarray
    lengths: np.ndarray
    keys: pa.Array | None

    def windows(self, order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """The longest window of each place, the text it is in and how many words follow there."""
        who = np.repeat(np.arange(len(self.lengths), dtype=np.int32), self.lengths)
        starts = np.cumsum(self.lengths) - self.lengths
        place = np.arange(len(self.ids), dtype=np.int32) - starts.astype(np.int32)[who]

        def before(k: int) -> np.ndarray:
            found = np.zeros(len(self.ids), np.int32)
            found[k:] = self.ids[: len(found) - min(k, len(found))]
            found[place < k] = 0
            return found

        return [*map(before, range(order - 1, 0, -1)), self.ids], who, self.lengths.astype(np.int32)[who] - 1 - place


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Texts]:
    """Texts with about ``size`` words together, from rows of words and, if asked, keys."""
    pending, held = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(0)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(ends):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + size - held, side="right")))
            pending.append(batch.slice(at, to - at))
            held, at = held + int(ends[to - 1] - done), to
            if held >= size or at < len(ends):
                yield _texts(pending)
                held = 0
    if held:
        yield _texts(pending)


def _texts(batches: list[pa.RecordBatch]) -> Texts:
    """The texts of all batches, which are let go."""
    found, ids = _encode([b.column(0).flatten().cast(pa.large_string()) for b in batches])
    lengths = [pc.fill_null(pc.list_value_length(b.column(0)), 0).to_numpy(zero_copy_only=False) for b in batches]
    keys = pa.concat_arrays([b.column(1) for b in batches]) if batches[0].num_columns > 1 else None
    batches.clear()
    return Texts(found, ids, np.concatenate(lengths).astype(np.int64), keys)


def counted(texts: Texts, order: int) -> Windows:
    """The different windows of all places, those with words before them missing counting 0."""
    ids, _, _ = texts.windows(order)
    whole = ids[0] != 0
    return Windows(texts.words, ids, whole)._distinct()


def asking(texts: Texts, order: int, last: bool) -> Asked:
    """Each text asks for the different windows of its places, or for its ``last`` one."""
    ids, who, left = texts.windows(order)
    if last:
        ids, who = [c[left == 0] for c in ids], who[left == 0]
    code = Codes([who, *ids], max(len(texts.words), len(texts.keys))).code
    by = np.argsort(code)
    starts = _starts(code[by])
    some = by[starts]
    times = np.diff(np.r_[starts, len(by)])
    zero = np.zeros(len(some))
    return Asked(texts.words, [c[some] for c in ids], texts.keys, who[some], zero, zero + 1, times)


def _narrow(values: np.ndarray, least: type = np.uint8) -> np.ndarray:
    top = int(values.max(initial=0))
    kinds = (k for k in (np.uint8, np.uint16, np.int32, np.int64) if np.iinfo(k).bits >= np.iinfo(least).bits)
    return values.astype(next(k for k in kinds if top <= np.iinfo(k).max))


def _stream(columns: dict[str, np.ndarray | pa.Array]) -> bytes:
    batch = pa.RecordBatch.from_pydict(columns)
    sink, how = pa.BufferOutputStream(), pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
    with pa.ipc.new_stream(sink, batch.schema, options=how) as to:
        to.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _read(value: pa.Scalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(value.as_buffer()).read_next_batch()


class _Used:
    """Numbers for the few of many that are used, and for those wanted in any case."""

    def __init__(self, size: int):
        self.flags, self.place = np.zeros(size, bool), np.zeros(size, np.int32)

    def renumber(self, ids: list[np.ndarray], *wanted: int) -> tuple[np.ndarray, list[np.ndarray]]:
        for c in (*ids, *wanted):
            self.flags[c] = True
        used = np.flatnonzero(self.flags)
        self.flags[used] = False
        self.place[used] = np.arange(len(used))
        kind = np.uint16 if len(used) <= 1 << 16 else np.int32
        return used, [self.place[c].astype(kind) for c in ids]


def marks(found: pa.Array) -> np.ndarray:
    """A number of each word, to choose a share by: its length and its first and last eight bytes."""
    _, offsets, data = found.buffers()
    ends = np.frombuffer(offsets, np.int64)[found.offset : found.offset + len(found) + 1]
    size = np.diff(ends).astype(np.uint64)
    text = np.zeros(8 + (data.size if data else 0) + 8, np.uint8)
    text[8:-8] = np.frombuffer(data, np.uint8) if data else 0
    eight = np.ndarray(len(text) - 7, "<u8", text, strides=(1,))  # the bytes from each place on
    unused = np.uint64(8) * (np.uint64(8) - np.minimum(size, np.uint64(8)))
    some = size > 0
    unused = np.where(some, unused, np.uint64(0))
    first, last = eight[ends[:-1] + 8] << unused, eight[ends[1:]] >> unused
    mixed = ((first * MIX) ^ (first >> np.uint64(29)) ^ last) * MIX + size
    return np.where(some, mixed >> np.uint64(32), np.uint64(0)).astype(np.uint32)


def dealt(rows: Windows | Asked, by: Iterable[np.ndarray], shares: int) -> pa.RecordBatch:
    """Rows of SCHEMA: a pack for each share that the numbers ``by`` choose. Steps are written
    for the column that never falls, the first one of windows and ``who`` of what is asked."""
    mixed = np.zeros(len(rows), np.uint32)
    for numbers in by:
        mixed ^= numbers
        mixed *= MIX32
        mixed ^= mixed >> np.uint32(15)
    share = (mixed % np.uint32(shares)).astype(np.uint16 if shares <= 1 << 16 else np.uint32)
    del mixed
    order = np.argsort(share, kind="stable")
    sizes = np.bincount(share, minlength=shares)
    ends = np.cumsum(sizes)
    asked, steps = (True, "who") if isinstance(rows, Asked) else (False, "w0")
    columns, some_words = rows.columns(), _Used(len(rows.words))
    some_keys = _Used(len(rows.keys)) if asked else None
    found: dict[str, list] = {"share": [], "words": [], "rows": [], "keys": []}
    for one in np.flatnonzero(sizes).tolist():
        at = order[ends[one] - sizes[one] : ends[one]]
        used, ids = some_words.renumber([c[at] for c in rows.ids], 0)
        own = {f"w{i}": c for i, c in enumerate(ids)} | {name: c[at] for name, c in columns.items()}
        keys = None
        if asked:
            askers, (own["who"],) = some_keys.renumber([rows.who[at]])
            keys = _stream({"key": rows.keys.take(pa.array(askers))})
        own[steps] = _narrow(np.diff(own[steps].astype(np.int64), prepend=0))
        text = pa.ListArray.from_arrays([0, len(used)], rows.words.take(pa.array(used)))
        found["words"].append(_stream({"words": pc.binary_join(text, pa.scalar(BETWEEN, pa.large_string()))}))
        for name, value in {"share": one, "rows": _stream(own), "keys": keys}.items():
            found[name].append(value)
    size = len(found["share"])
    of = {"share": pa.array(found["share"], pa.int32()), "n": pa.array([len(rows.ids)] * size, pa.int32())}
    of["asked"] = pa.array([asked] * size, pa.bool_())
    return pa.RecordBatch.from_pydict(of | {c: pa.array(found[c], pa.binary()) for c in ("words", "rows", "keys")})


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[Windows | Asked]:
    for batch in batches:
        _, n, asked, text, rows, keys = batch.columns
        for i in range(batch.num_rows):
            own, steps = _read(rows[i]), "who" if asked[i].as_py() else "w0"
            of = {name: own.column(name).to_numpy(zero_copy_only=False) for name in own.schema.names}
            of[steps] = np.cumsum(of[steps], dtype=np.int64).astype(np.int32)
            ids = [of[f"w{k}"] for k in range(n[i].as_py())]
            found = pc.split_pattern(_read(text[i]).column(0), BETWEEN).flatten()
            if asked[i].as_py():
                yield Asked(found, ids, _read(keys[i]).column(0), of["who"], of["a"], of["b"], of["times"].astype(np.int64))
            else:
                yield Windows(found, ids, of["count"])


def by_key(rows: pa.Table) -> list[pa.RecordBatch]:
    """Sums of the other columns by the first one, if Arrow can group that."""
    key, *others = rows.column_names
    try:
        sums = rows.group_by(key, use_threads=False).aggregate([(c, "sum") for c in others])
    except pa.ArrowNotImplementedError:
        return rows.to_batches()
    return sums.select([key, *(f"{c}_sum" for c in others)]).rename_columns([key, *others]).to_batches()
