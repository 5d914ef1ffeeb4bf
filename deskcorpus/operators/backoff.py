"""An interpolated n-gram model of any order with continuation counts, as a loss source.

The highest order counts how often a word follows its context; every lower order counts
after how many different words context and word were seen, so that a word met in one
place alone is not taken for a common one. From each count a discount is taken and handed to
the next lower order, in proportion to the number of different words after the context:

    p(w | h) = max(n(h, w) - d, 0) / n(h) + d * kinds(h) / n(h) * p(w | h without its first word)

A context that was never seen leaves the word to the lower order; below order 1 all words of
the training vocabulary and one unknown word are alike.

Windows travel in packs, see ``packs``. A share of the work has all windows with the same last
word of the context, or the same last two where that word is common. So a task counts its
windows in all orders, answers what is asked of them and passes on what the order of single
words needs; only pairs that begin with a common word are counted in between."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from deskcorpus.functions.tokens import words
from deskcorpus.operators import packs
from deskcorpus.operators.packs import Asked, Table, Windows
from deskcorpus.stages import materialize

DISCOUNT = 0.75
SHARE_BYTES = 10 << 20  # text whose windows are one share
COMMON = 1.0  # shares that a common word's windows would fill
SHARES_TO_ONE = 8  # shares of longer windows for one of single words, which are few
LEAST_BYTES = 1 << 20
LOOK_BYTES = 8 << 20  # text that is looked at to find common words
CHUNK = 3 << 19  # words that are packed at a time
LOOKUPS = 1 << 19  # windows that are looked up at a time
HOLD = 1 << 21  # windows and words that are held before equal ones are joined


@dataclass(frozen=True)
class Deal:
    """How windows are dealt to ``shares``, and single words to fewer of them. Words whose
    windows would fill more than COMMON shares are ``common``, fewer than shares / COMMON.
    Which ones these are, and how many shares, changes no result."""

    shares: int
    common: tuple[str, ...]

    @staticmethod
    def of(texts: DataFrame, text: str) -> Deal:
        """Shares of about SHARE_BYTES, or more of them up to the session's number of shuffle
        partitions while they have LEAST_BYTES. Common words are told by some of the texts."""
        total = texts.agg(F.sum(F.octet_length(F.col(f"`{text}`")).cast("long"))).first()[0] or 0
        usual = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        shares = max(1, -(-total // SHARE_BYTES), min(usual, -(-total // LEAST_BYTES)))
        if shares == 1:
            return Deal(1, ())
        some = texts.sample(min(1.0, LOOK_BYTES / total), 0)
        counts = some.select(F.explode(_words(text)).alias("word")).rollup("word").count()
        top = counts.orderBy(F.desc("count")).limit(int(shares / COMMON) + 1).collect()
        least = sum(r["count"] for r in top if r.word is None) / shares * COMMON
        return Deal(shares, tuple(sorted(r.word for r in top if r.word is not None and r["count"] > least)))

    def shares_of(self, n: int) -> int:
        return self.shares if n > 1 else min(self.shares, max(SHARES_TO_ONE, self.shares // SHARES_TO_ONE))

    def is_common(self, found: pa.Array) -> np.ndarray:
        return pc.is_in(found, value_set=pa.array(self.common, found.type)).to_numpy(zero_copy_only=False)

    def __call__(self, rows: Windows | Asked) -> pa.RecordBatch:
        """Packs of windows of any order. Contexts that are missing have many words and are
        never asked for; what is asked of a common word alone may go anywhere."""
        marks, common, n = packs.marks(rows.words), self.is_common(rows.words), len(rows.ids)

        def by() -> Iterator[np.ndarray]:
            if n == 1:
                apart = np.arange(len(rows), dtype=np.uint32) if isinstance(rows, Asked) else np.uint32(0)
                yield marks[rows.ids[0]] + np.where(common[rows.ids[0]], apart, np.uint32(0))
                return
            last = rows.ids[-2]
            yield marks[last]
            yield np.where((last == 0) | common[last] if n == 2 else last == 0, marks[rows.ids[-1]], np.uint32(0))
            if n > 2:
                yield np.where(common[last], marks[rows.ids[-3]], np.uint32(0))

        return packs.dealt(rows, by(), self.shares_of(n))


@dataclass(frozen=True)
class BackoffModel:
    """``windows`` has the longest window of each place of the training texts in packs, as
    ``deal`` deals them; ``vocabulary`` is the number of different words."""

    order: int
    discount: float
    windows: DataFrame
    deal: Deal

    @cached_property
    def vocabulary(self) -> int:
        return _sums(_single(self.windows, self), 1, self)[packs.PAD][0]


def _words(text: str) -> Column:
    return words(F.lower(F.col(f"`{text}`"))).alias("words")


def _packed(df: DataFrame, text: Column, order: int, deal: Deal, key: Column | None = None, last: bool = False) -> DataFrame:
    """Packs of the longest windows of all places of texts, which are arrays of words. Those
    of texts with a ``key`` are asked for, if wanted the ``last`` one of each text only."""
    chunk, asked = CHUNK, key is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = (packs.asking(t, order, last) if asked else packs.counted(t, order) for t in packs.chunks(batches, chunk))
        yield from map(deal, packed)

    return df.select(text, *([key] if asked else [])).mapInArrow(run, packs.SCHEMA)


def train_backoff(
    train: DataFrame, text: str, order: int = 3, discount: float = DISCOUNT, deal: Deal | None = None, lasting: bool = True
) -> BackoffModel:
    """Count a model. Null and empty texts have no words. One pass over the texts packs the
    longest window of each place, equal ones joined. All shorter windows are ends of these,
    those at the start of a text being filled up in front; so every lower order is counted
    from the windows of the one above. A ``lasting`` model keeps its packs, any other reads
    the texts whenever it is used."""
    if order < 1 or not 0 < discount < 1:
        raise ValueError("the order is at least 1 and the discount between 0 and 1")
    deal = deal or Deal.of(train, text)
    windows = _packed(train, _words(text), order, deal)
    return BackoffModel(order, discount, materialize(windows) if lasting else windows, deal)


def _by_share(rows: DataFrame, n: int, model: BackoffModel) -> DataFrame:
    """A task per share of windows of order n, what is counted before what is asked."""
    return rows.repartitionById(model.deal.shares_of(n), F.col("share")).sortWithinPartitions("asked")


def _joined(rows: Iterator[Windows], order: int, hold: int) -> Windows:
    """All windows of a share, equal ones joined whenever twice as many have come together."""
    held, size, room = [], 0, hold
    for some in rows:
        held.append(some)
        size += len(some) + len(some.words)
        if size >= room:
            held = [Windows.joined(held, order)]
            size = len(held[0]) + len(held[0].words)
            room = max(hold, 2 * size)
    return Windows.joined(held, order)


def _together(first: Asked, rows: Iterator[Asked], chunk: int) -> Iterator[Asked]:
    """What is asked, about ``chunk`` windows at a time, so that it need not fit in memory."""
    held = [first]
    for some in rows:
        if sum(map(len, held)) + len(some) > chunk:
            yield Asked.joined(held)
            held = []
        held.append(some)
    yield Asked.joined(held)


def _share(batches: Iterator[pa.RecordBatch], order: int, hold: int, chunk: int) -> tuple[Windows, Iterator[Asked]]:
    """The windows of a share and what is asked of it."""
    rows, first = packs.opened(batches), []

    def windows() -> Iterator[Windows]:
        for some in rows:
            if isinstance(some, Asked):
                first.append(some)
                return
            yield some

    joined = _joined(windows(), order, hold)
    return joined, _together(first[0], rows, chunk) if first else iter(())


def _answered(asked: Asked, d: float, count: np.ndarray, total: np.ndarray, kinds: np.ndarray) -> Asked:
    """The ends of what is asked, with the part of this order in p = a + b * (p by the order below)."""
    part = asked.b / np.maximum(total, 1)
    a = asked.a + np.where(total > 0, part * np.maximum(count - d, 0.0), 0.0)
    return asked.ends(a, np.where(total > 0, part * d * kinds, asked.b))


def _single(rows: DataFrame, model: BackoffModel) -> DataFrame:
    """From packs of the longest windows to those of single words."""
    if model.order == 1:
        return materialize(rows)
    d, deal, order, hold, chunk = model.discount, model.deal, model.order, HOLD, LOOKUPS

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All orders of a share but for pairs that begin with a common word."""
        windows, asked = _share(batches, order, hold, chunk)
        tables = []
        while len(windows.ids) > 2:
            tables.append(Table(windows))
            windows = windows.ends()
        common = deal.is_common(windows.words)[windows.ids[0]]
        pairs = Table(windows.where(~common))
        for some in asked:
            for table in tables:
                some = _answered(some, d, *table.find(some))
            apart = deal.is_common(some.words)[some.ids[0]]
            here = some.where(~apart)
            yield deal(_answered(here, d, *pairs.find(here)))
            yield deal(some.where(apart))
        yield deal(pairs.windows.ends())
        yield deal(windows.where(common))

    found = materialize(_by_share(rows, order, model).mapInArrow(own, packs.SCHEMA))
    if not deal.common:
        return found
    sums = _sums(found, 2, model)

    def common_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, asked = _share(batches, 2, hold, chunk)
        table = Table(windows)
        for some in asked:
            of = [sums.get(w, (0, 0, 0)) for w in some.words.to_pylist()]
            total, kinds = (np.array([s[i] for s in of])[some.ids[0]] for i in (1, 2))
            yield deal(_answered(some, d, table.find(some)[0], total, kinds))
        yield deal(windows.ends())

    rest = _by_share(found.where("n = 2"), 2, model).mapInArrow(common_pairs, packs.SCHEMA)
    return found.where("n = 1").unionByName(materialize(rest))


def _sums(rows: DataFrame, n: int, model: BackoffModel) -> dict[str, tuple[int, int, int]]:
    """For each of the few contexts of order n, 2 or 1, how many different words were seen
    after it, how often any was counted and how many were. That of order 1 is PAD; in order 1
    each common word also has its own count in place of all."""
    deal, hold = model.deal, HOLD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _joined(packs.opened(batches), n, hold)
        size = len(windows.words)
        context = windows.ids[0] if n == 2 else np.zeros(len(windows), np.int32)
        seen, kinds = (np.bincount(context[c], minlength=size) for c in (slice(None), windows.count > 0))
        total = np.bincount(context, windows.count, size).astype(np.int64)
        if n == 1:
            common = deal.is_common(windows.words)[windows.ids[0]]
            total[windows.ids[0][common]] = windows.count[common]
        at = pa.array(np.flatnonzero((seen > 0) | (total > 0)))
        sums = [pa.array(c).cast(pa.int64()).take(at) for c in (seen, total, kinds)]
        yield pa.RecordBatch.from_arrays([windows.words.take(at).cast(pa.string()), *sums], ["word", "seen", "total", "kinds"])

    found = _by_share(rows.where(f"n = {n} and not asked"), n, model).mapInArrow(run, "word string, seen long, total long, kinds long")
    sums = found.groupBy("word").agg(F.sum("seen"), F.sum("total"), F.sum("kinds")).collect()
    return {packs.PAD: (0, 0, 0)} | {word: tuple(of) for word, *of in sums}


def _answers(single: DataFrame, model: BackoffModel, key: DataType, summed: bool) -> DataFrame:
    """(key, p) of each window that is asked or, ``summed``, (key, loss, times): its part of
    the loss of its key."""
    sums = _sums(single, 1, model)
    different, total, kinds = sums[packs.PAD]
    d, deal, hold, chunk, unknown = model.discount, model.deal, HOLD, LOOKUPS, 1.0 / (different + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, asked = _share(batches, 1, hold, chunk)
        table = Table(windows)
        for some in asked:
            count = table.find(some)[0]
            common = deal.is_common(some.words)
            often = np.zeros(len(common), np.int64)
            often[common] = [sums.get(w, (0, 0, 0))[1] for w in some.words.filter(pa.array(common)).to_pylist()]
            count = np.where(common[some.ids[0]], often[some.ids[0]], count)
            lower = np.maximum(count - d, 0.0) / total + d * kinds / total * unknown if total else unknown
            p = some.a + some.b * lower
            if not summed:
                yield pa.RecordBatch.from_arrays([some.keys.take(pa.array(some.who)), pa.array(p)], ["key", "p"])
                continue
            times = np.bincount(some.who, some.times, len(some.keys)).astype(np.int64)
            loss = np.bincount(some.who, some.times * -np.log(p), len(some.keys))
            yield from packs.by_key(pa.table([some.keys, loss, times], ["key", "loss", "times"]))

    schema = StructType().add("key", key).add("loss" if summed else "p", "double")
    return _by_share(single, 1, model).mapInArrow(run, schema.add("times", "long") if summed else schema)


def backoff_probabilities(asked: DataFrame, model: BackoffModel) -> DataFrame:
    """``asked``, distinct rows with n up to the model's order, context and word, and their
    probability ``p``."""
    key = F.struct(*[F.col(f"`{c}`") for c in asked.columns]).alias("key")
    before = F.filter(F.split("context", " "), lambda w: w != "")
    one = lambda w: F.when(w.rlike(r"\s"), packs.PAD).otherwise(w)  # noqa: E731  # a word that no text has
    text = F.transform(F.concat(before, F.array("word")), one).alias("words")
    rows = asked.dropna(subset=["n", "context", "word"])
    windows = _packed(rows, text, model.order, model.deal, key, last=True)
    single = _single(model.windows.unionByName(windows), model)
    return _answers(single, model, rows.select(key).schema["key"].dataType, summed=False).select("key.*", "p")


def backoff_losses(
    train: DataFrame, test: DataFrame, key: str, text: str, order: int = 3, discount: float = DISCOUNT
) -> DataFrame:
    """(key, loss): mean negative log likelihood of all words of each test text (M03), the
    first ones after as many words as there are. Texts without words have no loss; an empty
    training table makes every word an unknown one. Rows that share a key are one text.

    What the test texts ask travels along with the training windows, once for each text and
    different window."""
    deal = Deal.of(train.select(f"`{text}`").unionAll(test.select(f"`{text}`")), text)
    model = train_backoff(train, text, order, discount, deal, lasting=False)
    asked = _packed(test, _words(text), order, deal, F.col(f"`{key}`").alias("key"))
    single = _single(model.windows.unionByName(asked), model)
    parts = _answers(single, model, test.schema[key].dataType, summed=True).groupBy(F.col("key").alias(key))
    return parts.agg((F.sum("loss") / F.sum("times")).alias("loss"))
