"""Ranked lexical search over a length-stratified index.

A document's normaliser m depends on its length alone. Documents are dealt to shards in order
of length, and each shard's documents to segments; in a segment, those with equal m are a
stratum. A posting list is divided by stratum and, within it, into groups of documents with
one term frequency, the highest first. A group's impact is computed once for all its
documents, and the first groups of an item's terms bound every score in a stratum.

Search goes through the segments with the bounds first: the strata with the best ones are
scored, and then those others whose bound reaches the lowest score still in the list of the
best. Each task keeps the best documents of every item; these lists are merged in two steps.
Weights are floor(1000 ln((2N + 2) / (2 df + 1))), all else is integer arithmetic; sums stay
below 2**53, so that doubles add them exactly."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskcorpus.llm.common import partitions, slices_as_binary, text_bytes, text_chunks, text_of, tidy, word_bounds
from deskcorpus.stages import materialize, scratch_dir

TOP = 50
SEGMENT_BYTES = 1 << 21
SHARD_BYTES = 1 << 25
BLOCK_ITEMS = 2000
BLOCK_BYTES = 1 << 24
MERGE_WAYS = 64

# ASCII letters and digits, and all bytes outside ASCII, are part of terms.
IS_TERM = np.zeros(256, np.bool_)
IS_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 0x20


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in a row, A-Z lower-cased, and the terms before each text."""
    raw, ends = text_bytes(texts)
    starts, stops, before = word_bounds(raw, ends, IS_TERM)
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    kept = np.ascontiguousarray(LOWERED[raw[IS_TERM[raw]]])
    return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]), before


def term_totals(texts: pa.Array) -> np.ndarray:
    raw, ends = text_bytes(texts)
    return np.diff(word_bounds(raw, ends, IS_TERM)[2])


# --- building the index --------------------------------------------------------------


def _level(n: np.ndarray) -> np.ndarray:
    """A scale of lengths that never falls: exact up to 1023, then 64 steps to a doubling."""
    fine = np.floor(64 * np.log2(np.maximum(n, 1024) / 1024)).astype(np.int64)
    return np.where(n < 1024, n, 1024 + fine)


def _lengths(docs: DataFrame) -> DataFrame:
    """(level, n_docs, n_terms, n_bytes) of all documents: a row per level of length, of
    which there are a few thousand at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, size=SEGMENT_BYTES):
                texts = chunk.column("text")
                n = term_totals(texts)
                level, at = np.unique(_level(n), return_inverse=True)
                sizes = np.diff(text_bytes(texts)[1])
                sums = [np.bincount(at, x, len(level)).astype(np.int64) for x in (np.ones(len(n)), n, sizes)]
                yield pa.RecordBatch.from_arrays([pa.array(level), *map(pa.array, sums)], names=["level", "n_docs", "n_terms", "n_bytes"])

    found = docs.select(text_of("text").alias("text")).mapInArrow(
        tidy(count), "level long, n_docs long, n_terms long, n_bytes long"
    )
    return found.groupBy("level").agg(*[F.sum(c).alias(c) for c in ("n_docs", "n_terms", "n_bytes")])


def normalisers(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents with n terms: 100 - 50 + (50 n N) div L."""
    if not n_terms:
        return np.full(len(n), 50, np.int64)
    some, at = np.unique(n, return_inverse=True)
    return np.array([50 + 50 * x * n_docs // n_terms for x in some.tolist()], np.int64)[at]


def _narrow(values: np.ndarray) -> pa.Scalar:
    """Whole numbers as bytes of the narrowest kind, which the first byte tells."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return bytes([kind.itemsize]) + np.ascontiguousarray(values.astype(kind)).tobytes()


def _wide(cell: pa.Scalar) -> np.ndarray:
    raw = np.frombuffer(cell.as_buffer(), np.uint8)
    return raw[1:].view(f"<u{raw[0]}").astype(np.int64)


ARRAYS = ("term_df", "term_groups", "group_stratum", "group_tf", "group_end", "post_doc", "stratum_m", "stratum_end")
INDEX = "doc_ids array<long>, terms array<string>, " + ", ".join(f"{a} binary" for a in ARRAYS)


def segment(doc_ids: pa.Array, texts: pa.Array, m: np.ndarray) -> pa.RecordBatch:
    """One row of the index for documents in order of m."""
    words, before = terms_of(texts)
    coded = words.dictionary_encode()
    n_docs = len(texts)
    owner = np.repeat(np.arange(n_docs), np.diff(before))
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    pair, tf = np.unique(code * n_docs + owner, return_counts=True) if len(code) else (code, code)
    term, doc = np.divmod(pair, max(n_docs, 1))
    opens = np.concatenate([[True], np.diff(m) > 0])[:n_docs]
    stratum = np.cumsum(opens) - 1
    stratum_end = np.append(np.flatnonzero(opens)[1:], n_docs)
    # term, stratum, falling tf, document
    order = np.lexsort((doc, -tf, stratum[doc], term))
    term, doc, tf = term[order], doc[order], tf[order]
    at = stratum[doc]
    new = np.ones(len(term), np.bool_)
    new[1:] = (np.diff(term) != 0) | (np.diff(at) != 0) | (np.diff(tf) != 0)
    first = np.flatnonzero(new)
    n_terms = len(coded.dictionary)
    arrays = {
        "term_df": np.bincount(term, minlength=n_terms),
        "term_groups": np.cumsum(np.bincount(term[first], minlength=n_terms)),
        "group_stratum": at[first],
        "group_tf": tf[first],
        "group_end": np.append(first[1:], len(term)) if len(term) else first,
        "post_doc": doc,
        "stratum_m": m[opens],
        "stratum_end": stratum_end,
    }
    lists = [
        pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values) for values in (doc_ids, coded.dictionary)
    ]
    cells = [pa.array([_narrow(arrays[a])], pa.binary()) for a in ARRAYS]
    return pa.RecordBatch.from_arrays([*lists, *cells], names=["doc_ids", "terms", *ARRAYS])


class Index:
    """An index written as a table, a row per segment, with its corpus totals: ``n_docs``
    with at least one term, ``n_terms`` of all."""

    def __init__(self, segments: DataFrame, n_docs: int, n_terms: int):
        self.segments, self.n_docs, self.n_terms = segments, n_docs, n_terms


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Index:
    """Index every row of ``docs``. Null and empty texts have no terms and are never found;
    repeated rows are documents of their own. Lengths that many documents share spread over
    shards by row number. A very long text is a segment of its own."""
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("doc_id"), text_of(text).alias("text")
    )
    levels = sorted(_lengths(rows).collect(), key=lambda r: r["level"])  # a few thousand at most
    n_docs = sum(r["n_docs"] for r in levels if r["level"])
    n_terms = sum(r["n_terms"] for r in levels)
    scale = np.array([r["level"] for r in levels], np.int64)
    size = np.array([r["n_bytes"] + r["n_docs"] for r in levels], np.float64)
    begin = np.cumsum(size) - size
    shards = max(partitions(spark), math.ceil(size.sum() / SHARD_BYTES))
    step = max(size.sum(), 1.0) / shards

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, size=SEGMENT_BYTES):
                n = term_totals(chunk.column("text"))
                at = np.searchsorted(scale, _level(n))
                spread = chunk.column("row").to_numpy() * 0.6180339887498949 % 1.0
                shard = np.minimum((begin[at] + spread * size[at]) / step, shards - 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), pa.array(n), chunk.column("doc_id"), chunk.column("text")],
                    names=["shard", "n", "doc_id", "text"],
                )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, size=SEGMENT_BYTES):
                m = normalisers(chunk.column("n").to_numpy(), n_docs, n_terms)
                yield segment(chunk.column("doc_id"), chunk.column("text"), m)

    dealt = rows.mapInArrow(tidy(deal), "shard int, n long, doc_id long, text string").where("n > 0")
    segments = (
        dealt.repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("n", "doc_id")
        .select("n", "doc_id", "text")
        .mapInArrow(tidy(build), INDEX)
    )
    return Index(materialize(segments), n_docs, n_terms)


# --- search --------------------------------------------------------------------------


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


class Block:
    """Items searched together: ids, their terms, and each item's terms as places in the
    sorted list of all."""

    def __init__(self, items: list[tuple[int | None, set[str]]]):
        self.ids = [i for i, _ in items]
        names = sorted(set().union(*(t for _, t in items))) if items else []
        place = {t: k for k, t in enumerate(names)}
        self.terms = names
        self.of_item = [np.array(sorted(place[t] for t in terms), np.int64) for _, terms in items]


def item_blocks(items: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[Block]:
    """The items in blocks of a bounded number and size, in order of their ids. Rows with the
    same id, the null one included, are one item with the terms of all its texts."""
    rows = items.select(F.col(key).cast("long").alias("item_id"), text_of(text).alias("text")).orderBy("item_id")
    held: list[tuple[int | None, set[str]]] = []
    size = 0
    for r in rows.toLocalIterator():
        terms = set(terms_of(pa.array([r["text"]], pa.string()))[0].to_pylist())
        if held and held[-1][0] == r["item_id"]:
            held[-1][1].update(terms)
        else:
            if len(held) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
                yield Block(held)
                held, size = [], 0
            held.append((r["item_id"], terms))
        size += len(r["text"])
    if held:
        yield Block(held)


def term_weights(index: Index, terms: list[str]) -> np.ndarray:
    """Weight of each term; those that no document holds get the weight of df = 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(terms, pa.string())
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                at = pc.index_in(wanted, batch.column("terms")[i].values)
                found = pc.is_valid(at).to_numpy(zero_copy_only=False)
                total[found] += _wide(batch.column("term_df")[i])[at.drop_null().to_numpy()]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    df = np.zeros(len(terms), np.int64)
    if terms:
        counted = index.segments.select("terms", "term_df").mapInArrow(tidy(count), "term long, df long")
        for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():  # terms of a block
            df[r["term"]] = r["df"]
    return np.array([math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


class Best:
    """The best documents of an item so far, by falling score and ascending id, null first."""

    def __init__(self, top: int):
        self.top = top
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)
        self.known = np.zeros(0, np.bool_)

    def floor(self) -> int:
        """A score below this cannot enter."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, doc: np.ndarray, known: np.ndarray) -> None:
        score, doc, known = (np.concatenate(x) for x in ((self.score, score), (self.doc, doc), (self.known, known)))
        order = np.lexsort((doc, known, -score))[: self.top]
        self.score, self.doc, self.known = score[order], doc[order], known[order]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


def search_segment(row: dict, block_terms: pa.Array, of_item: list[np.ndarray], weights: np.ndarray, best: list[Best], top: int) -> None:
    """Enter the documents of one segment into the items' lists."""
    arrays = {a: _wide(row[a]) for a in ARRAYS if a != "term_df"}
    ids = row["doc_ids"].values
    known = pc.is_valid(ids).to_numpy(zero_copy_only=False)
    ids = ids.fill_null(0).to_numpy()
    place = pc.index_in(block_terms, row["terms"].values).fill_null(-1).to_numpy().astype(np.int64)
    here = np.flatnonzero((place >= 0) & (weights > 0))
    if not len(here):
        return
    group_ends = arrays["term_groups"]
    lasts = group_ends[place[here]]
    firsts = np.where(place[here] > 0, group_ends[place[here] - 1], 0)
    groups = _ranges(firsts, lasts - firsts)  # all groups of the block's terms, term by term
    owner = np.repeat(np.arange(len(here)), lasts - firsts)
    stratum = arrays["group_stratum"][groups]
    gain = weights[here][owner] * impacts(arrays["group_tf"][groups], arrays["stratum_m"][stratum])
    post_end = arrays["group_end"]
    posts = post_end[groups]
    posts_from = np.where(groups > 0, post_end[groups - 1], 0)
    leads = np.ones(len(groups), np.bool_)  # the highest tf of a term in a stratum
    leads[1:] = (np.diff(owner) != 0) | (np.diff(stratum) != 0)
    at = np.concatenate([[0], np.cumsum(lasts - firsts)])
    slot = np.full(len(weights), -1, np.int64)
    slot[here] = np.arange(len(here))
    stratum_docs = np.diff(arrays["stratum_end"], prepend=0)
    n_strata, n_docs = len(stratum_docs), len(ids)

    for item, terms in enumerate(of_item):
        mine = slot[terms]
        mine = mine[mine >= 0]
        if not len(mine):
            continue
        chosen = _ranges(at[mine], at[mine + 1] - at[mine])
        lead = chosen[leads[chosen]]
        bound = np.bincount(stratum[lead], gain[lead], n_strata)
        list_ = best[item]
        open_ = bound >= list_.floor()
        if not open_.any():
            continue
        order = np.flatnonzero(open_)
        order = order[np.argsort(-bound[order], kind="stable")]
        ahead = int(np.searchsorted(np.cumsum(stratum_docs[order]), top)) + 1
        for part in (order[:ahead], order[ahead:]):
            part = part[bound[part] >= list_.floor()]
            if not len(part):
                continue
            wanted = np.zeros(n_strata, np.bool_)
            wanted[part] = True
            visited = chosen[wanted[stratum[chosen]]]
            sizes = posts[visited] - posts_from[visited]
            docs = arrays["post_doc"][_ranges(posts_from[visited], sizes)]
            score = np.bincount(docs, np.repeat(gain[visited], sizes), n_docs).astype(np.int64)
            good = np.flatnonzero(score >= list_.floor())
            if len(good) > 4 * top:  # keep ties with the last that could enter
                cut = np.partition(score[good], len(good) - top)[len(good) - top]
                good = good[score[good] >= cut]
            list_.add(score[good], ids[good], known[good])


RANKED = "item long, doc_id long, score long"


def search_block(index: Index, block: Block, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score) of the best documents of every item of a block."""
    weights = term_weights(index, block.terms)
    names, of_item = block.terms, block.of_item

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(names, pa.string())
        best = [Best(top) for _ in of_item]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                search_segment(row, wanted, of_item, weights, best, top)
        for a in range(0, len(best), 256):
            some = best[a : a + 256]
            item = np.repeat(np.arange(a, a + len(some)), [len(b.score) for b in some])
            known = np.concatenate([b.known for b in some])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(item),
                    pa.array(np.concatenate([b.doc for b in some]), pa.int64(), mask=~known),
                    pa.array(np.concatenate([b.score for b in some])),
                ],
                names=["item", "doc_id", "score"],
            )

    columns = ["doc_ids", "terms", *[a for a in ARRAYS if a != "term_df"]]
    found = index.segments.select(*columns).mapInArrow(tidy(search), RANKED)
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    some = Window.partitionBy("item", "way").orderBy(*order)
    found = found.withColumn("way", F.spark_partition_id() % MERGE_WAYS)
    found = found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    whole = Window.partitionBy("item").orderBy(*order)
    ranked = found.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)
    spark = index.segments.sparkSession
    ids = spark.createDataFrame(list(enumerate(block.ids)), "item long, item_id long")
    return ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")  # a block's items


def search(index: Index, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` best documents of every item, by falling score, equal scores by ascending
    doc_id; documents with score 0 are not found, so an item without terms has no rows.
    Items are searched block by block, each a pass over the index."""
    spark: SparkSession = items.sparkSession
    path = scratch_dir(spark)
    schema = "item_id long, rank int, doc_id long, score long"
    spark.createDataFrame([], schema).write.parquet(path)
    for block in item_blocks(items):
        search_block(index, block, top).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def search_table(docs: DataFrame, items: DataFrame) -> DataFrame:
    """All documents indexed, all items searched; see :func:`build_index` and
    :func:`search`. Without documents or items there are no rows."""
    return search(build_index(docs), items)
