"""Mixing overlapping sources to target weights by a min-cost flow.

A document may belong to several sources. Documents are aggregated by their membership
pattern; the capacity of a pattern is its words, once per repetition allowed, and a further
repetition costs more than the one before. The flow sends words of patterns to the quotas
of their sources, as many as it can and at the least cost. Since only a pattern's own
repetition has a price, that is a maximum flow with the first repetitions, augmented with
the second, and so on. What a pattern sends then picks its documents in a seeded order:
whole passes over all, and one partial pass that ends inside a document, which a mix of
documents takes whole or not at all."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskcorpus.llm.common import HOT_SHARE, WORD, hot_lookup, text_of
from deskcorpus.operators.running import prefix_sums
from deskcorpus.stages import materialize

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
MAX_PATTERNS = 100_000  # that the driver takes; of more, only what a flow is needed for
ROUNDS = 30  # of proportional shares, at most
ROUND_GAIN = 0.001  # rounds that bring less than this share more are the last ones
CELL_DIGITS = 3  # hex digits of the order that each of two levels of cells takes
SEED = 20


def cycle_weights(sources: Sequence[str | None], weights: Sequence[int] = WEIGHTS) -> dict[str | None, int]:
    """Weights in turn for the sources by code point, null last."""
    ordered = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: weights[i % len(weights)] for i, s in enumerate(ordered)}


def capped_targets(
    sizes: Mapping[str | None, int], weights: Mapping[str | None, float], repeats: int = MAX_REPEATS
) -> dict[str | None, float]:
    """Shares of all words by weight; a share above ``repeats`` times the source's size
    stops there, and the excess is shared by weight among the others until none is above."""
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in sizes if s not in capped]
        weight = sum(weights[s] for s in free)
        level = (total - sum(repeats * sizes[s] for s in capped)) / weight if weight else 0.0
        over = {s for s in free if weights[s] * level > repeats * sizes[s]}
        if not over:
            return {s: float(repeats * sizes[s]) if s in capped else weights[s] * level for s in sizes}
        capped |= over


class Flow:
    """Maximum flow by shortest augmenting phases; capacities can be raised later on."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.left: list[int] = []

    def edge(self, a: int, b: int, capacity: int) -> int:
        for x, y, c in ((a, b, capacity), (b, a, 0)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.left.append(c)
        return len(self.to) - 2

    def _levels(self, start: int) -> list[int]:
        level = [-1] * len(self.out)
        level[start], queue = 0, deque([start])
        while queue:
            x = queue.popleft()
            for e in self.out[x]:
                if self.left[e] and level[self.to[e]] < 0:
                    level[self.to[e]] = level[x] + 1
                    queue.append(self.to[e])
        return level

    def augment(self, start: int, end: int) -> None:
        while (level := self._levels(start))[end] >= 0:
            tried = [0] * len(self.out)
            path: list[int] = []
            x = start
            while True:
                if x == end:
                    amount = min(self.left[e] for e in path)
                    for e in path:
                        self.left[e] -= amount
                        self.left[e ^ 1] += amount
                    path, x = [], start
                    continue
                while tried[x] < len(self.out[x]):
                    e = self.out[x][tried[x]]
                    if self.left[e] and level[self.to[e]] == level[x] + 1:
                        break
                    tried[x] += 1
                else:
                    if not path:
                        break
                    e = path.pop()
                    x = self.to[e ^ 1]
                    tried[x] += 1
                    continue
                path.append(e)
                x = self.to[e]


def route(
    patterns: Mapping[tuple, int], quotas: Mapping[str | None, int], repeats: int = MAX_REPEATS
) -> dict[tuple, dict[str | None, int]]:
    """Words that each pattern (a tuple of sources) sends to each of its sources."""
    names, sources = list(patterns), list(quotas)
    place = {s: 1 + len(names) + i for i, s in enumerate(sources)}
    flow, end = Flow(2 + len(names) + len(sources)), 1 + len(names) + len(sources)
    supply = [flow.edge(0, 1 + i, 0) for i in range(len(names))]
    links = {
        (p, s): flow.edge(1 + i, place[s], repeats * patterns[p]) for i, p in enumerate(names) for s in p if s in place
    }
    for s in sources:
        flow.edge(place[s], end, quotas[s])
    for _ in range(repeats):  # a repetition of any pattern costs more than all before
        for e, p in zip(supply, names):
            flow.left[e] += patterns[p]
        flow.augment(0, end)
    sent: dict[tuple, dict[str | None, int]] = {p: {} for p in names}
    for (p, s), e in links.items():
        sent[p][s] = flow.left[e ^ 1]
    return sent


def seeded_order(key: Column, text: Column, seed: int) -> Column:
    """A pseudo-random place of a document that depends on its key and text alone."""
    parts = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.md5(text.cast("binary")))
    return F.md5(parts.cast("binary"))


def measured(docs: DataFrame, sources: Column, key: str, text: str, seed: int) -> DataFrame:
    """(doc_id, pattern, size, place) of every row; ``pattern`` is a sorted array."""
    body = text_of(f"`{text}`")
    pattern = F.array_sort(F.array_distinct(sources))
    return docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        pattern.alias("pattern"),
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"),
        seeded_order(F.col(f"`{key}`"), body, seed).alias("place"),
    )


def mix(
    docs: DataFrame,
    sources: Column | None = None,
    weigh: Callable[[Sequence[str | None]], Mapping[str | None, float]] | DataFrame = cycle_weights,
    repeats: int = MAX_REPEATS,
    key: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, pattern, place, size, taken, sent, stats) of every row of ``docs``.

    ``sources`` is an array of the sources of a document, by default its column
    ``source`` alone. ``size`` counts words parted by white space (null text: none),
    ``taken`` the words that the mix takes of the document, repetitions counted, at most
    ``repeats`` times its size. ``stats`` has for each source of the pattern its size and
    target. A null source is a source; rows of no source at all are not taken. Identical
    rows are taken each on its own. Up to MAX_PATTERNS patterns are collected. Of more,
    only those linked by documents of several sources are, and more than MAX_PATTERNS of
    these are routed in Spark by rounds of proportional shares (:func:`_shares_by_rounds`).
    ``weigh`` maps the list of sources to weights; for more than MAX_PATTERNS sources a
    caller's weights come as a table (source, w) instead."""
    spark = docs.sparkSession
    sources = F.array("source") if sources is None else sources
    rows = materialize(measured(docs, sources, key, text, seed))
    found = rows.groupBy("pattern").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        return _mix_many(rows, weigh, repeats)
    patterns = {tuple(r.pattern or ()): r["size"] for r in found}
    sizes: dict[str | None, int] = {}
    for pattern, size in patterns.items():
        for s in pattern:
            sizes[s] = sizes.get(s, 0) + size
    weights = {r.source: r.w for r in weigh.collect()} if isinstance(weigh, DataFrame) else weigh(list(sizes))
    goal = capped_targets(sizes, weights, repeats)
    total, wanted = sum(patterns.values()), sum(goal.values())
    if wanted > total:  # sources that overlap are larger together than all documents
        goal = {s: t * total / wanted for s, t in goal.items()}
    return _take(rows, _shares(spark, patterns, sizes, goal, repeats))


SHARES = "pattern array<string>, passes long, rest long, stats array<struct<source: string, source_size: long, target: double>>"


def _shares(
    spark: SparkSession, patterns: Mapping[tuple, int], sizes: Mapping[str | None, int], goal: Mapping[str | None, float], repeats: int
) -> DataFrame:
    """(pattern, passes, rest, stats) of patterns, by the flow."""
    sent = route(patterns, {s: int(t) for s, t in goal.items()}, repeats)
    table = []
    for p, size in patterns.items():
        words = sum(sent[p].values())
        passes, rest = divmod(words, size) if size else (0, 0)
        stats = [(s, sizes[s], goal[s]) for s in p]
        table.append((list(p), passes, rest, stats))
    return spark.createDataFrame(table, SHARES)


def _mix_many(rows: DataFrame, weigh: Callable, repeats: int) -> DataFrame:
    """The mix of more patterns than the driver takes. A source that no document shares
    with another is sent what its target and its own words allow; the others, with all
    their patterns, make up flows of their own, so these alone go to the driver."""
    groups = materialize(rows.groupBy("pattern").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")))
    member = F.explode("pattern").alias("source")
    sources = groups.select(member, "size", (F.size("pattern") > 1).alias("linked")).groupBy("source")
    sources = sources.agg(F.sum("size").alias("source_size"), F.max("linked").alias("linked"))
    sources = materialize(_targets(materialize(_weighed(sources, weigh)), groups, repeats))
    own = sources.where("not linked").withColumn("_sent", F.least(F.floor("target"), F.lit(repeats) * F.col("source_size")))
    own = own.select(
        F.array("source").alias("pattern"),
        F.when(F.col("source_size") > 0, F.expr("_sent div source_size")).otherwise(0).cast("long").alias("passes"),
        F.when(F.col("source_size") > 0, F.expr("_sent % source_size")).otherwise(0).cast("long").alias("rest"),
        F.array(F.struct("source", "source_size", "target")).alias("stats"),
    )
    linked = sources.where("linked").withColumnRenamed("source", "_s")
    flows = groups.select("pattern", "size", F.explode_outer("pattern").alias("source")).join(linked, _same("source", "_s"), "left")
    flows = flows.where("linked or size(pattern) = 0").groupBy("pattern").agg(
        F.first("size").alias("size"), F.collect_list(F.struct("source", "source_size", "target")).alias("stats")
    )
    found = flows.limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        driven = _shares_by_rounds(materialize(flows), repeats)
    else:
        of_sources = {x.source: x for r in found if r.pattern for x in r.stats}
        driven = _shares(
            rows.sparkSession,
            {tuple(r.pattern): r["size"] for r in found},
            {s: x.source_size for s, x in of_sources.items()},
            {s: x.target for s, x in of_sources.items()},
            repeats,
        )
    shares = materialize(own.unionByName(driven))
    # patterns of many rows are gone through by cells, the others each in a task
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = groups.where(F.col("n") > HOT_SHARE * total).select(F.col("pattern").alias("_hot"))  # fewer than 1/HOT_SHARE
    hot = F.broadcast(materialize(hot))
    few = _take(rows, shares.join(hot, _same("pattern", "_hot"), "left_semi"))
    rest = rows.join(hot, _same("pattern", "_hot"), "left_anti").withColumnRenamed("pattern", "_p")
    rest = rest.join(shares, F.col("_p") == F.col("pattern")).drop("_p")
    order = Window.partitionBy("pattern").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("rest") - F.coalesce(F.sum("size").over(order), F.lit(0))
    taken = F.col("passes") * F.col("size") + F.greatest(F.least("size", left), F.lit(0))
    return few.unionByName(rest.withColumn("taken", taken).select(few.columns))


def _shares_by_rounds(flows: DataFrame, repeats: int) -> DataFrame:
    """(pattern, passes, rest, stats) of more patterns than a driver takes, from (pattern,
    size, stats). A pattern parts its words among its sources in proportion to their
    priorities; a priority rises by as much as its source falls short of its quota, and falls by
    as much as it gets too much. The shares come near a maximum flow; what a source still gets too much
    is scaled down to its quota. The patterns' capacity is tried with one repetition first, and
    with one more as long as that brings the sources clearly nearer to their quotas.

    A round is a lookup of the priorities, with hot sources spread, and two aggregations."""
    flows = flows.withColumn("_id", F.to_json("pattern"))  # tells null sources, which hashes skip
    member = F.explode("stats").alias("s")
    edges = flows.where("size > 0 and size(pattern) > 0").select("_id", "size", member)
    # a null source takes part in lookups under a flag
    edges = materialize(
        edges.select("_id", "size", F.col("s.source").isNull().alias("_null"), F.coalesce("s.source", F.lit("")).alias("_s"), "s.target")
    )
    key = ["_null", "_s"]
    n_edges = edges.count()
    sources = materialize(
        edges.groupBy(*key).agg(F.floor(F.first("target")).cast("double").alias("quota"), F.count(F.lit(1)).alias("_n"))
    )
    wanted = sources.agg(F.coalesce(F.sum("quota"), F.lit(0.0))).first()[0]

    def parted(priority: DataFrame, times: int) -> DataFrame:
        """Edges with their words ``x`` at these priorities."""
        named = hot_lookup(edges, priority.select(*key, "priority", "_n"), key, "_n", n_edges)
        whole = named.groupBy("_id").agg(F.sum("priority").alias("_whole"))  # a pattern has few sources
        return named.join(whole, "_id").withColumn("x", F.lit(float(times)) * F.col("size") * F.col("priority") / F.col("_whole"))

    best, reached = None, -1.0
    for times in range(1, repeats + 1):
        priority, last = sources.withColumn("priority", F.lit(1.0)), -1.0
        for _ in range(ROUNDS):
            loads = parted(priority, times).groupBy(*key).agg(F.sum("x").alias("load"))
            placed = materialize(priority.join(loads, key))
            got = placed.agg(F.sum(F.least("load", "quota"))).first()[0] or 0.0
            if got <= last * (1 + ROUND_GAIN) or got >= (1 - ROUND_GAIN) * wanted:
                break
            last = got
            # priorities are at least 1e-100, so that no pattern is left without any
            change = F.greatest(F.least(F.col("quota") / F.col("load"), F.lit(4.0)), F.lit(0.25))
            priority = placed.withColumn("priority", F.greatest(F.col("priority") * change, F.lit(1e-100))).drop("load")
        if best is None or got > reached * (1 + ROUND_GAIN):
            scale = F.when(F.col("load") > F.col("quota"), F.col("quota") / F.col("load")).otherwise(1.0)
            scales = placed.select(*key, scale.alias("scale"), "_n")
            scaled = hot_lookup(parted(placed, times), scales, key, "_n", n_edges)
            best = materialize(scaled.groupBy("_id").agg(F.floor(F.sum(F.col("x") * F.col("scale"))).alias("_sent")))
            reached = got
        if reached >= (1 - ROUND_GAIN) * wanted:
            break
    sent = F.least(F.coalesce("_sent", F.lit(0)), F.lit(repeats) * F.col("size"))
    shared = flows.join(best, "_id", "left").withColumn("_sent", sent)
    part = lambda e: F.when(F.col("size") > 0, F.expr(e)).otherwise(0).cast("long")
    return shared.select("pattern", part("_sent div size").alias("passes"), part("_sent % size").alias("rest"), "stats")


def _weighed(sources: DataFrame, weigh: Callable | DataFrame) -> DataFrame:
    """Sources with their weight ``w``; the default weights go by rank, which needs no list."""
    if isinstance(weigh, DataFrame):
        table = weigh.select(F.col("source").alias("_s"), F.col("w").cast("double").alias("w"))
        return sources.join(table, _same("source", "_s")).drop("_s")
    if weigh is cycle_weights:
        ranked = sources.withColumns({"_null": F.col("source").isNull(), "_one": F.lit(1)})
        ranked = prefix_sums(ranked, ["_null", "source"], "_one", "_rank")
        turns = F.array(*map(F.lit, WEIGHTS))
        return ranked.withColumn("w", F.get(turns, F.col("_rank") % len(WEIGHTS)).cast("double")).drop("_null", "_one", "_rank")
    names = [r.source for r in sources.select("source").limit(MAX_PATTERNS + 1).collect()]
    if len(names) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} sources: give their weights as a table (source, w)")
    weights = sources.sparkSession.createDataFrame([(s, float(w)) for s, w in weigh(names).items()], "_s string, w double")
    return sources.join(weights, _same("source", "_s")).drop("_s")


def _targets(sources: DataFrame, groups: DataFrame, repeats: int) -> DataFrame:
    """Sources with their target, as ``capped_targets`` finds them, by a pass over the
    sources for each round: the level only rises, so it tells which sources are capped."""
    most = F.lit(repeats) * F.col("source_size")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    words = groups.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    level = 0.0
    while True:
        over = F.col("w") * F.lit(level) > most
        r = sources.agg(F.sum(F.when(over, most)).alias("capped"), F.sum(F.when(~over, F.col("w"))).alias("free")).first()
        risen = (total - (r.capped or 0)) / r.free if r.free else 0.0
        if risen <= level:
            break
        level = risen
    target = F.when(F.col("w") * F.lit(level) > most, most.cast("double")).otherwise(F.col("w") * F.lit(level))
    if total > words:  # sources that overlap are larger together than all documents
        target = target * F.lit(words) / F.lit(total)
    return sources.withColumn("target", target)


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _take(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """Each row's words. A pattern's partial pass ends at the row where the sizes, in
    seeded order, reach ``rest``: cells of the order are summed, then the cells within the
    one that holds the end, and only the rows of that one are gone through in order."""
    shares = F.broadcast(shares)  # at most MAX_PATTERNS rows, or the hot ones of more
    cell = lambda k: F.substring("place", 1 + k * CELL_DIGITS, CELL_DIGITS)
    joined = rows.withColumnRenamed("pattern", "_p").join(shares, _same("_p", "pattern")).drop("_p")
    upto = Window.partitionBy("pattern").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)

    def holder(cells: DataFrame, name: str, base: Column) -> DataFrame:
        sums = cells.withColumn("_end", base + F.sum("n").over(upto))
        hit = sums.where("_end >= rest and _end - n < rest")
        return hit.select("pattern", F.col("cell").alias(name), (F.col("_end") - F.col("n")).alias(f"{name}_before"))

    partial = joined.where("rest > 0")
    first = holder(
        partial.groupBy("pattern", "rest", cell(0).alias("cell")).agg(F.sum("size").alias("n")), "c0", F.lit(0)
    )
    first = F.broadcast(materialize(first))  # a row per pattern
    inner = partial.join(first.withColumnRenamed("pattern", "_p"), _same("pattern", "_p")).where(cell(0) == F.col("c0"))
    second = holder(
        inner.groupBy("pattern", "rest", "c0_before", cell(1).alias("cell")).agg(F.sum("size").alias("n")),
        "c1",
        F.col("c0_before"),
    )
    cuts = materialize(first.join(second, ["pattern"]).withColumn("cut", F.concat("c0", "c1")))
    cuts = F.broadcast(cuts.select(F.col("pattern").alias("_p"), "cut", F.col("c1_before").alias("begin")))
    placed = joined.join(cuts, _same("pattern", "_p"), "left").withColumn("_cell", F.substring("place", 1, 2 * CELL_DIGITS))
    whole = F.col("passes") * F.col("size")
    outside = placed.where("cut is null or _cell != cut").withColumn(
        "taken", whole + F.when(F.col("_cell") < F.col("cut"), F.col("size")).otherwise(0)
    )
    order = Window.partitionBy("pattern").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("rest") - F.col("begin") - F.coalesce(F.sum("size").over(order), F.lit(0))
    inside = placed.where("_cell = cut").withColumn("taken", whole + F.greatest(F.least("size", left), F.lit(0)))
    return outside.unionByName(inside).select("doc_id", "pattern", "place", "size", "taken", "stats")


def mix_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, source_size, target, taken) for documents of one source each."""
    return mix(docs, key=key, text=text).select(
        "doc_id",
        "size",
        F.col("stats")[0]["source_size"].alias("source_size"),
        F.col("stats")[0]["target"].alias("target"),
        "taken",
    )


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, **how) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each repetition taken. Texts
    are never cut: a document in which a source's share ends is taken once more or not,
    whichever comes nearer to the share, so each source is off by half a document at most.
    Rows that are equal in key and text stand for each other; which one's other columns are
    repeated is open. Texts without words are not taken."""
    takes = mix(docs, key=key, text=text, seed=seed, **how).where("taken > 0")
    takes = takes.groupBy("place").agg(F.sum("taken").alias("_taken"), F.first("size").alias("_size"))
    times = takes.select("place", F.expr("cast((2 * _taken + _size) div (2 * _size) as int)").alias("_times"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    placed = docs.select(row.alias("row"), seeded_order(F.col(f"`{key}`"), text_of(f"`{text}`"), seed).alias("place"))
    one = placed.groupBy("place").agg(F.first("row").alias("row")).join(materialize(times.where("_times > 0")), "place")
    return one.select(F.explode(F.array_repeat("row", F.col("_times"))).alias("row")).select("row.*")
