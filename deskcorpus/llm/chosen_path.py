"""Near duplicates by a chosen-path set similarity join.

Equal shingle sets form a class, and classes are what is joined. In each of a few
independent trees a node branches on some places of the minwise signature, chosen by the
node among those that its tree has for its level; a class goes to the child named by its
minwise token there. Classes of similarity s share a branch with chance s, so with two
branches a node a similar pair meets in some leaf of a tree with a high chance, and the
trees together reach the target recall. A node of few classes is not branched: its pairs are
compared exhaustively by signature, and what may be a link is confirmed on the full sets.

Only components are asked for, so classes known to be connected need not be compared. First
every class is tested with a best partner in each small node, and with a few pivots in each
large one; the links found give labels. Large nodes that still have several labels are
branched, level by level. What is crowded at the depth limit is joined by prefixes: of
shingles in order of their frequency, two similar sets have one in common among the rarest
fifth of each, so classes that share a frequent passage alone part there, and no link is
lost. Should a prefix node still be too large, as for texts that are all but similar enough,
its classes are dealt to groups and every two groups are a small node: nothing is left out.
Last, all small nodes of all levels are compared at once, between labels only."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskcorpus.llm.common import binary, hot_lookup, partitions, text_bytes, text_chunks, text_of, tidy
from deskcorpus.llm.components import components
from deskcorpus.llm.shingles import least_agreement, mix, set_name, shingle_sets, signatures
from deskcorpus.stages import materialize

MARKS = 256  # places of the signature that pairs are compared by, 8 bits each
BRANCHES = 2
PLACES = 4  # minwise tokens that a tree has for each level
PICKS = list(combinations(range(PLACES), BRANCHES))
MAX_DEPTH = 3
NODE_LIMIT = 2048  # classes that a task compares exhaustively
PIVOTS = 8
TARGET_RECALL = 0.9999
LOSS = 1e-6  # chance that the signatures hide a link
PAIRS_AT_ONCE = 100_000
FEW_PAIRS = 3000  # so many are confirmed one by one
BROADCAST_ROWS = 500_000  # of 8 bytes
RARITY_CELLS = 1 << 18  # counters that order shingles by frequency
HOT_SETS = 0.01  # a class in a larger share of the pairs has its set broadcast: under 100
SEED = 20


def tree_recall(similarity: float, depth: int = MAX_DEPTH) -> float:
    """Chance that a pair of this similarity shares a node of the given depth of a tree.

    Of a level's places a random number agrees. Each node that the pair shares picks
    BRANCHES of them, and the pair goes on by those of its picks that agree; fresh places on
    every level make the levels independent."""
    chance = {1: 1.0}  # number of shared nodes
    for _ in range(depth):
        after: dict[int, float] = {}
        for agreeing in range(PLACES + 1):
            p = comb(PLACES, agreeing) * similarity**agreeing * (1 - similarity) ** (PLACES - agreeing)
            picked = [
                comb(agreeing, k) * comb(PLACES - agreeing, BRANCHES - k) / comb(PLACES, BRANCHES) for k in range(BRANCHES + 1)
            ]
            for nodes, q in chance.items():
                spread = [1.0]
                for _ in range(nodes):
                    spread = [
                        sum(spread[i] * picked[n - i] for i in range(len(spread)) if 0 <= n - i <= BRANCHES)
                        for n in range(len(spread) + BRANCHES)
                    ]
                for n, r in enumerate(spread):
                    after[n] = after.get(n, 0.0) + p * q * r
        chance = {n: q for n, q in after.items() if n}
    return sum(chance.values())


def trees_for(recall: float, similarity: float) -> int:
    trees, lost = 1, 1 - tree_recall(similarity)
    while lost**trees > 1 - recall:
        trees += 1
    return trees


def n_tokens(trees: int) -> int:
    """Minwise tokens of a class, 32 bits each: every tree and level has its own."""
    return trees * MAX_DEPTH * PLACES


def sketch(docs: DataFrame, width: int, trees: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, class, tokens, marks) of every row; empty sets have no class."""
    n = n_tokens(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch):
                values, bounds = shingle_sets(chunk.column("text"), width)
                names = [set_name(values[a:b]) if b > a else None for a, b in zip(bounds[:-1], bounds[1:])]
                made = signatures(values, bounds, n + MARKS, SEED)
                parts = (made[:, :n], made[:, n:].astype(np.uint8))
                cells = [iter([row.tobytes() for row in np.ascontiguousarray(p)]) for p in parts]
                tokens, marks = ([None if n is None else next(c) for n in names] for c in cells)
                yield pa.RecordBatch.from_arrays(
                    [
                        chunk.column("doc_id"),
                        pa.array(np.diff(bounds), pa.int64()),
                        *map(binary, (names, tokens, marks)),
                    ],
                    names=["doc_id", "n_shingles", "class", "tokens", "marks"],
                )

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), text_of(f"`{text}`").alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, n_shingles long, class binary, tokens binary, marks binary")


def _token(place: Column) -> Column:
    return F.substring("tokens", 4 * place + 1, F.lit(4))


def first_nodes(classes: DataFrame, trees: int) -> DataFrame:
    """(node, class, tree) below the roots."""
    ways = F.explode(F.sequence(F.lit(0), F.lit(trees * BRANCHES - 1))).alias("_way")
    each = classes.select("class", "tokens", ways)
    tree, branch = F.expr(f"_way div {BRANCHES}").cast("int"), F.col("_way") % BRANCHES
    place = (tree * (MAX_DEPTH * PLACES) + branch).cast("int")  # a root picks the first places
    return each.select(F.xxhash64("_way", _token(place)).alias("node"), "class", tree.alias("tree"))


def children(members: DataFrame, depth: int) -> DataFrame:
    """(node, class, tree) of the children of members, which have the tokens, at ``depth``."""
    picks = F.array(*[F.array(*map(F.lit, p)) for p in PICKS])
    pick = F.get(picks, F.pmod(F.xxhash64("node"), F.lit(len(PICKS))).cast("int"))
    ways = members.select("class", "tokens", "node", "tree", F.explode(pick).alias("_place"))
    place = (F.col("tree") * (MAX_DEPTH * PLACES) + F.lit(depth * PLACES) + F.col("_place")).cast("int")
    return ways.select(F.xxhash64("node", "_place", _token(place)).alias("node"), "class", "tree")


def rarity(sets: DataFrame) -> np.ndarray:
    """How many of the sets have a shingle of each cell; the cells are RARITY_CELLS."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(RARITY_CELLS, np.int64)
        for batch in batches:
            values = text_bytes(batch.column("shingles"))[0].view(np.uint64)
            total += np.bincount((values % np.uint64(RARITY_CELLS)).astype(np.int64), minlength=RARITY_CELLS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])

    cells = sets.select("shingles").mapInArrow(tidy(count), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(RARITY_CELLS, np.int64)
    for r in cells.collect():
        out[r["cell"]] = r["n"]
    return out


def prefix_nodes(sets: DataFrame, percent: int) -> DataFrame:
    """(node, class, tree) of classes by the shingles of their prefixes: from a set of n, in
    one order of all shingles, the first n - ceil(percent n / 100) + 1. Two sets that are
    similar enough have one of these in common, whatever the order; rare ones first keep
    the nodes small."""
    frequent = rarity(sets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = text_bytes(batch.column("shingles"))
            values = raw.view(np.uint64)
            sizes = np.diff(ends) // 8
            owner = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((values, frequent[(values % np.uint64(RARITY_CELLS)).astype(np.int64)], owner))
            keep = sizes - -(-percent * sizes // 100) + 1
            rank = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            chosen = order[rank < keep[owner]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(mix(values[chosen]).view(np.int64)), batch.column("class").take(pa.array(owner[chosen]))],
                names=["node", "class"],
            )

    return sets.select("class", "shingles").mapInArrow(tidy(run), "node long, class binary").withColumn("tree", F.lit(-1))


def group_nodes(members: DataFrame) -> DataFrame:
    """Nodes of too many classes as small ones: their classes are dealt to groups of about
    half the limit, and two classes meet in the node of their groups."""
    groups = F.ceil(F.col("size") / (NODE_LIMIT / 2)).cast("int")
    own = F.pmod(F.xxhash64("class"), groups).cast("int").alias("_own")
    each = members.select("node", "class", "tree", own, F.explode(F.sequence(F.lit(0), groups - 1)).alias("_other"))
    node = F.xxhash64("node", F.least("_own", "_other"), F.greatest("_own", "_other"))
    return each.select(node.alias("node"), "class", "tree")


def crowded(members: DataFrame, total: int, distinct: bool = False) -> DataFrame:
    """Members of nodes with at least two classes, with ``size``, the classes of their node,
    written; with ``distinct``, only one of nodes that have the same classes. ``total`` is
    about the number of members; nodes with many of them are spread."""
    held = F.struct(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("class")).alias("a"), F.bit_xor(F.xxhash64("class", F.lit(SEED))).alias("b"))
    counts = members.groupBy("node").agg(held.alias("_held")).where("_held.n > 1")
    if distinct:
        counts = counts.groupBy("_held").agg(F.min("node").alias("node"))
    counts = counts.select("node", F.col("_held.n").alias("_n"), F.col("_held.n").alias("size"))
    return materialize(hot_lookup(members, counts, ["node"], "_n", total).where("size is not null"))


PAIR = "a binary, b binary"
_PAIR = pa.schema([pa.field("a", pa.binary()), pa.field("b", pa.binary())])


def _agreeing(marks: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray, least: int, percent: int):
    """Agreeing places of the pairs i, j, and which may be links by them and by size."""
    same = np.zeros(len(i), np.int64)
    for k in range(0, len(i), PAIRS_AT_ONCE):
        part = slice(k, k + PAIRS_AT_ONCE)
        same[part] = (marks[i[part]] == marks[j[part]]).sum(1)
    low, high = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
    return same, (same >= least) & (100 * low >= percent * high)


def _columns(table: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy(zero_copy_only=False) for n in names]


def _marks(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, MARKS)


def _pair_batch(names: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    a, b = names[i], names[j]
    flip = np.array([x > y for x, y in zip(a, b)], np.bool_) if len(a) else np.zeros(0, np.bool_)
    a, b = np.where(flip, b, a), np.where(flip, a, b)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], schema=_PAIR)


def _whole_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by node, cut anew between nodes."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = (table if rest is None else pa.concat_tables([rest, table])).combine_chunks()
        node = table.column("node").to_numpy()
        cut = int(np.searchsorted(node == node[-1], True))
        rest = table.slice(cut)
        if cut:
            yield table.slice(0, cut).combine_chunks().to_batches()[0]
    if rest is not None:
        yield rest.combine_chunks().to_batches()[0]


def _similar(batch: pa.RecordBatch, least: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows i, j of the batch, i before j in the same node but of another label, that may
    be links, and in how many places they agree; a bounded number of pairs at a time."""
    node, labels, sizes = _columns(batch, "node", "label", "n_shingles")
    _, labels = np.unique(labels, return_inverse=True)
    marks = _marks(batch.column("marks"))
    starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    begin = np.repeat(starts, np.diff(np.append(starts, len(node))))
    earlier = np.arange(len(node)) - begin  # each class against those before it
    upto = np.cumsum(earlier)
    at = 0
    while at < len(node):
        base = upto[at - 1] if at else 0
        stop = max(int(np.searchsorted(upto, base + PAIRS_AT_ONCE, "right")), at + 1)
        n = earlier[at:stop]
        j = np.repeat(np.arange(at, stop), n)
        i = begin[j] + np.arange(len(j)) - np.repeat(np.cumsum(n) - n, n)
        same, good = _agreeing(marks, sizes, i, j, least, percent)
        good &= labels[i] != labels[j]
        yield i[good], j[good], same[good]
        at = stop


def _by_node(members: DataFrame, *more: str) -> DataFrame:
    return (
        members.select("node", "class", "label", "n_shingles", "marks", *more)
        .repartition(partitions(members.sparkSession), "node")
        .sortWithinPartitions("node", "class")
    )


def best_pairs(members: DataFrame, least: int, percent: int) -> DataFrame:
    """For each class of a small node, the most similar of those before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_nodes(batches):
            (names,) = _columns(batch, "class")
            for i, j, same in _similar(batch, least, percent):
                order = np.lexsort((i, -same, j))
                i, j = i[order], j[order]
                first = np.concatenate([[True], j[1:] != j[:-1]])[: len(j)]
                yield _pair_batch(names, i[first], j[first])

    return _by_node(members).mapInArrow(tidy(run), PAIR)


def contested(members: DataFrame, least: int, percent: int) -> DataFrame:
    """(node, class) of the classes that may link to another label in a small node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_nodes(batches):
            found = np.zeros(batch.num_rows, np.bool_)
            for i, j, _ in _similar(batch, least, percent):
                found[i] = found[j] = True
            yield batch.select(["node", "class"]).filter(pa.array(found))

    return _by_node(members).mapInArrow(tidy(run), "node long, class binary")


def confirmed_links(members: DataFrame, least: int, percent: int) -> DataFrame:
    """Links between labels in small nodes, confirmed where the node is, on the full sets
    that ``members`` brings along. Only what connects components is kept, so a node gives
    fewer links than it has classes, however many of its pairs are similar; pairs that turn
    out not to be links cost no more than the ones that are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_nodes(batches):
            node, names, labels = _columns(batch, "node", "class", "label")
            known: dict[tuple, int] = {}
            root = np.array([known.setdefault(k, n) for n, k in enumerate(zip(node.tolist(), labels))], np.int64)
            raw, ends = text_bytes(batch.column("shingles"))
            starts = np.concatenate([[True], node[1:] != node[:-1]])
            exact = _Overlaps(raw.view(np.uint64), ends // 8, np.flatnonzero(starts), percent)
            left, right = [], []
            for i, j, _ in _similar(batch, least, percent):
                open_ = root[i] != root[j]
                i, j = i[open_], j[open_]
                good = exact.linked(i, j)
                a, b = _forest(root, i[good], j[good])
                left.append(a)
                right.append(b)
            nothing = np.zeros(0, np.int64)
            yield _pair_batch(names, np.concatenate([nothing, *left]), np.concatenate([nothing, *right]))

    return _by_node(members, "shingles").mapInArrow(tidy(run), PAIR)


def _forest(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those links i, j that connect components; ``root`` names each row's and is updated."""
    left, right = [], []
    while len(i):
        a, b = root[i], root[j]
        open_ = a != b
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        low, high = np.minimum(a, b), np.maximum(a, b)
        order = np.lexsort((low, high))
        first = order[np.concatenate([[True], high[order][1:] != high[order][:-1]])[: len(order)]]
        # every larger name takes the smallest one that a link offers it
        step = np.arange(len(root))
        step[high[first]] = low[first]
        while (step != step[step]).any():
            step = step[step]
        left.append(i[first])
        right.append(j[first])
        root[:] = step[root]
    nothing = np.zeros(0, np.int64)
    return np.concatenate([nothing, *left]), np.concatenate([nothing, *right])


class _Overlaps:
    """Exact overlaps of sets, given as sorted numbers one after the other; the rows between
    two of ``starts`` are a node.

    A few pairs are intersected one by one. For many, the columns of a node's incidence
    matrix that are equal, such as the shingles of a template that all pages share, are one
    column with a weight, those of one set alone are left out, and blocks of the rest are
    multiplied: their products are whole numbers, exact in single precision up to sets of
    16 million."""

    COLUMNS = 2048

    def __init__(self, values: np.ndarray, ends: np.ndarray, starts: np.ndarray, percent: int):
        self.values, self.ends, self.percent = values, ends, percent
        self.starts = np.append(starts, len(ends) - 1)
        self.sizes = np.diff(ends)
        self.known: tuple[int, np.ndarray] | None = None

    def linked(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        common = np.zeros(len(i), np.int64)
        node = np.searchsorted(self.starts, i, "right") - 1
        for n in np.unique(node).tolist():
            at = np.flatnonzero(node == n)
            if len(at) <= FEW_PAIRS and (self.known is None or self.known[0] != n):
                common[at] = [self._one(x, y) for x, y in zip(i[at].tolist(), j[at].tolist())]
            else:
                begin = self.starts[n]
                common[at] = self._matrix(n)[i[at] - begin, j[at] - begin].astype(np.int64)
        return 100 * common >= self.percent * (self.sizes[i] + self.sizes[j] - common)

    def _one(self, x: int, y: int) -> int:
        a, b = (self.values[self.ends[k] : self.ends[k + 1]] for k in (x, y))
        both = np.sort(np.concatenate([a, b]), kind="stable")
        return int((both[1:] == both[:-1]).sum())

    def _matrix(self, n: int) -> np.ndarray:
        """Overlaps of all pairs of a node."""
        if self.known is None or self.known[0] != n:
            first, last = self.starts[n], self.starts[n + 1]
            sizes = self.sizes[first:last]
            owner = np.repeat(np.arange(last - first), sizes)
            _, code, uses = np.unique(self.values[self.ends[first] : self.ends[last]], return_inverse=True, return_counts=True)
            several = uses[code] > 1
            owner, code = owner[several], code[several]
            # columns with the same rows, told by two sums of random numbers
            draw = np.random.Generator(np.random.PCG64(SEED)).integers(0, 1 << 63, (2, last - first), dtype=np.uint64)
            sums = np.zeros((2, len(uses)), np.uint64)
            for k in range(2):
                np.add.at(sums[k], code, draw[k][owner])
            used = np.flatnonzero(uses > 1)
            pairs = np.ascontiguousarray(sums[:, used].T).view([("a", np.uint64), ("b", np.uint64)]).ravel()
            _, lead, group, weight = np.unique(pairs, return_index=True, return_inverse=True, return_counts=True)
            column = np.full(len(uses), -1, np.int64)
            column[used[lead]] = np.arange(len(lead))
            keep = column[code] >= 0
            owner, column = owner[keep], column[code[keep]]
            order = np.argsort(column, kind="stable")
            owner, column = owner[order], column[order]
            kind = np.float32 if sizes.max() < 1 << 24 else np.float64
            total = np.zeros((last - first, last - first), kind)
            for c in range(0, len(lead), self.COLUMNS):
                some = slice(*np.searchsorted(column, [c, c + self.COLUMNS]))
                block = np.zeros((last - first, min(self.COLUMNS, len(lead) - c)), kind)
                block[owner[some], column[some] - c] = 1
                total += (block * weight[c : c + self.COLUMNS].astype(kind)) @ block.T
            self.known = (n, total)
        return self.known[1]


def _linked(x, y, percent: int) -> bool:
    """Whether two sets, given as sorted 64-bit numbers, are similar enough."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = np.sort(np.concatenate([x, y]), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def compare_pivots(members: DataFrame, pivots: DataFrame, total: int, least: int, percent: int) -> DataFrame:
    """Candidate pairs of the members of large nodes, each with its most similar pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names, labels, sizes = _columns(batch, "class", "label", "n_shingles")
            marks = _marks(batch.column("marks"))
            lists = batch.column("pivots")
            flat = lists.flatten()
            parts = [flat.field(k) for k in range(4)]
            counts = np.diff(lists.offsets.to_numpy())
            i = np.repeat(np.arange(len(names)), counts)
            p_names, p_labels, p_sizes = (parts[k].to_numpy(zero_copy_only=False) for k in (0, 1, 2))
            j = len(names) + np.arange(len(i))
            everyone = np.concatenate([names, p_names])
            _, all_labels = np.unique(np.concatenate([labels, p_labels]), return_inverse=True)
            same, good = _agreeing(
                np.concatenate([marks, _marks(parts[3])]), np.concatenate([sizes, p_sizes]), i, j, least, percent
            )
            good &= all_labels[i] != all_labels[j]
            i, j, same = i[good], j[good], same[good]
            order = np.lexsort((j, -same, i))
            i, j = i[order], j[order]
            first = np.concatenate([[True], i[1:] != i[:-1]])[: len(i)]
            yield _pair_batch(everyone, i[first], j[first])

    weighed = pivots.select("node", "pivots", "n")
    found = hot_lookup(members, weighed, ["node"], "n", total)
    return found.where("pivots is not null").mapInArrow(tidy(run), PAIR)


def choose_pivots(members: DataFrame) -> DataFrame:
    """(node, n, pivots) of large nodes: up to PIVOTS of their classes."""
    one = F.struct("class", "label", "n_shingles", "marks")
    slot = F.pmod(F.xxhash64("class"), F.lit(PIVOTS)).alias("slot")
    chosen = members.groupBy("node", slot).agg(F.min(one).alias("p"), F.max("size").alias("n"))
    return chosen.groupBy("node").agg(F.collect_list("p").alias("pivots"), F.max("n").alias("n"))


def fetch_sets(docs: DataFrame, wanted: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """(class, shingles, n) of the classes in ``wanted`` (class, doc_id, n), from the texts of
    one document each. The list of documents is broadcast if it is short."""
    ids = materialize(wanted.select(F.xxhash64("doc_id").alias("_pick")).distinct())
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    rows = docs.select(
        F.xxhash64(F.col(f"`{key}`").cast("long")).alias("_pick"), text_of(f"`{text}`").alias("text")
    ).join(ids, "_pick", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch):
                values, bounds = shingle_sets(chunk.column("text"), width)
                parts = [values[a:b] for a, b in zip(bounds[:-1], bounds[1:]) if b > a]
                yield pa.RecordBatch.from_arrays(
                    [binary([set_name(p) for p in parts]), binary([p.tobytes() for p in parts])],
                    names=["class", "shingles"],
                )

    sets = rows.select("text").mapInArrow(tidy(run), "class binary, shingles binary")
    once = sets.groupBy("class").agg(F.first("shingles").alias("shingles"))
    return once.join(wanted.select("class", "n"), "class")


def confirm(pairs: DataFrame, sets: DataFrame, total: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough. A class in many pairs, such as a pivot,
    has its set broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("x"), batch.column("y"))
            good = [_linked(x.as_buffer(), y.as_buffer(), percent) for x, y in pairs]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    for side, name in (("a", "x"), ("b", "y")):
        table = sets.select(F.col("class").alias(side), F.col("shingles").alias(name), F.col("n").alias("_n"))
        pairs = hot_lookup(pairs, table, [side], "_n", total, HOT_SETS)
    return pairs.mapInArrow(tidy(run), PAIR)


def similar_classes(
    docs: DataFrame, classes: DataFrame, width: int, percent: int, recall: float = TARGET_RECALL, key: str = "doc_id", text: str = "text"
) -> DataFrame | None:
    """(class, root) of the classes that have links, or None where there are none."""
    least = least_agreement(MARKS, percent / 100, LOSS)
    trees = trees_for(recall, percent / 100)
    marked = classes.select("class", "n_shingles", "marks")
    n_classes = classes.count()

    def sets_of(wanted: DataFrame) -> DataFrame:
        named = materialize(wanted.join(classes.select("class", "doc_id"), "class"))
        return materialize(fetch_sets(docs, named, width, key, text))

    def tested(pairs: DataFrame) -> DataFrame:
        """Links among candidate pairs."""
        pairs = materialize(pairs.distinct())
        ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("n"))
        return materialize(confirm(pairs, sets_of(ends), pairs.count(), percent))

    def merged(links: DataFrame, labels: DataFrame | None) -> DataFrame | None:
        if labels is not None:
            links = links.unionByName(labels.select(F.col("class").alias("a"), F.col("root").alias("b")))
        return None if links.isEmpty() else components(links).withColumnRenamed("node", "class")

    def labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
        if labels is None:
            return members.withColumn("label", F.col("class"))
        joined = members.join(labels, "class", "left")  # a class is in a bounded number of nodes
        return joined.withColumn("label", F.coalesce("root", "class")).drop("root")

    def mixed(members: DataFrame) -> DataFrame:
        """Members of nodes with several labels."""
        nodes = members.groupBy("node").agg(F.min("label").alias("l1"), F.max("label").alias("l2"), F.max("size").alias("_n"))
        nodes = nodes.select("node", "_n", (F.col("l1") != F.col("l2")).alias("_mixed")).where("_mixed")
        found = hot_lookup(members, nodes, ["node"], "_n", n_classes * trees * BRANCHES)
        return found.where("_mixed").drop("_mixed")

    # a best partner for every class, and pivots where nodes are large
    start = crowded(first_nodes(classes, trees), n_classes * trees * BRANCHES)
    sizes = start.agg(F.count(F.lit(1)), F.count_if(F.col("size") > NODE_LIMIT)).first()
    if not sizes[0]:
        return None
    own = start.withColumn("label", F.col("class")).join(marked, "class")
    pairs = best_pairs(own.where(F.col("size") <= NODE_LIMIT), least, percent)
    if sizes[1]:
        large = materialize(own.where(F.col("size") > NODE_LIMIT))
        pivots = materialize(choose_pivots(large))
        pairs = pairs.unionByName(compare_pivots(large, pivots, sizes[1], least, percent))
    labels = merged(tested(pairs), None)

    # branching: the small nodes of every level wait, the large ones go on
    small = [start.where(F.col("size") <= NODE_LIMIT)]
    level = materialize(mixed(labelled(start.where(F.col("size") > NODE_LIMIT), labels))) if sizes[1] else None
    for depth in range(1, MAX_DEPTH + 1):
        n = level.count() if level is not None else 0
        if not n:
            level = None
            break
        if depth < MAX_DEPTH:
            kids = children(level.join(classes.select("class", "tokens"), "class"), depth)
            n *= BRANCHES
        else:
            kids = prefix_nodes(sets_of(level.groupBy("class").agg(F.count(F.lit(1)).alias("n"))), percent)
        kids = crowded(kids, n, distinct=depth == MAX_DEPTH)
        small.append(kids.where(F.col("size") <= NODE_LIMIT))
        level = materialize(mixed(labelled(kids.where(F.col("size") > NODE_LIMIT), labels)))
    if level is not None and (n := level.count()):
        small.append(crowded(group_nodes(level), n))

    # all small nodes of all levels, between labels only
    several = materialize(mixed(labelled(reduce(DataFrame.unionByName, small), labels)).join(marked, "class"))
    open_rows = materialize(contested(several, least, percent))
    if not open_rows.isEmpty():
        sets = sets_of(open_rows.groupBy("class").agg(F.count(F.lit(1)).alias("n"))).drop("n")
        rows = several.join(open_rows, ["node", "class"], "left_semi").join(sets, "class")
        links = materialize(confirmed_links(rows, least, percent))
        if not links.isEmpty():
            labels = merged(links, labels)
    return labels


def component_table(
    docs: DataFrame, rows: DataFrame, width: int, percent: int, recall: float, key: str, text: str
) -> DataFrame:
    """(class, component_id, _n, _found) of the classes of several documents or with
    links; ``_n`` is the number of a class's documents."""
    filled = rows.where("class is not null")
    classes = materialize(
        filled.groupBy("class").agg(
            F.min("doc_id").alias("doc_id"),
            F.count(F.lit(1)).alias("n_docs"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("tokens").alias("tokens"),
            F.first("marks").alias("marks"),
        )
    )
    labels = similar_classes(docs, classes, width, percent, recall, key, text)
    ids = classes.select("class", "doc_id", "n_docs")
    if labels is None:
        named = ids.select("class", F.col("doc_id").alias("component_id"), F.col("n_docs").alias("_n")).where("_n > 1")
    else:
        linked = ids.join(labels, "class", "left")
        linked = linked.withColumn("root", F.coalesce("root", "class"))
        least = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("_members"))
        several = least.where("_members > 1").withColumn("_n", F.col("_members"))
        joined = hot_lookup(linked, several, ["root"], "_n", classes.count())
        named = joined.select(
            "class",
            F.when(F.col("_members").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
            F.col("n_docs").alias("_n"),
            F.coalesce("_members", F.lit(1)).alias("_members"),
        ).where("_n > 1 or _members > 1")
    return named.select("class", "component_id", "_n", F.lit(True).alias("_found"))


def _named(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """``rows`` (with doc_id and class) and their ``component_id``."""
    answer = hot_lookup(rows, lookup, ["class"], "_n", rows.count())
    component = F.when(F.col("_found"), F.col("component_id")).otherwise(F.col("doc_id"))
    return answer.withColumn("component_id", component).drop("_found")


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, recall: float = TARGET_RECALL, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Words are parted by white space and compared after lower-casing A-Z; a document's set
    has its distinct runs of ``width`` words, or its only, shorter one. Documents link
    when 100 * intersection >= percent * union. ``component_id`` is the smallest identifier
    reachable by links. Null texts and texts without words have an empty set and are linked
    with nothing. Rows that repeat an identifier are each judged; a null identifier counts
    as larger than any other, so it names only components of nulls alone."""
    rows = materialize(sketch(docs, width, trees_for(recall, percent / 100), key, text))
    answer = _named(rows, component_table(docs, rows, width, percent, recall, key, text))
    return answer.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def keep_one(
    docs: DataFrame, width: int = 5, percent: int = 80, recall: float = TARGET_RECALL, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One document of each component, that with the smallest identifier, with the columns
    of ``docs``. Rows that share an identifier stay if one of them is to stay."""
    answer = near_duplicates(docs, width, percent, recall, key, text)
    stays = answer.groupBy(F.col("doc_id").alias("_chosen_path_gone")).agg(F.bool_or("kept").alias("_chosen_path_kept"))
    gone = materialize(stays.where("not _chosen_path_kept").select("_chosen_path_gone"))
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return docs.join(gone, F.col(f"`{key}`").eqNullSafe(F.col("_chosen_path_gone")), "left_anti")
