"""Order statistics without a global sort.

Splits, samples and quantiles all need "the value at rank r". A sort of the table
would find it, but so does this: count rows per bucket of an order-preserving
bucketing, look up which bucket holds the rank, and order only that bucket. The
rows that are to be kept are never moved; they are compared with the cut value.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_DIGITS = 4
BUCKETS = 16**HASH_DIGITS


def hash_order(key: str | Column, seed: int) -> Column:
    """Seeded pseudo-random order of a row key, the same on every engine."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def _bucket(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("int")


def _keyed(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Narrow (key, digest, bucket) view; only the key column is scanned."""
    return (
        df.select(F.col(key).alias("key"))
        .withColumn("digest", hash_order("key", seed))
        .withColumn("bucket", _bucket(F.col("digest")))
    )


def _bucket_ends(keyed: DataFrame) -> DataFrame:
    """Rows per bucket with their running total: at most BUCKETS rows, so the
    unpartitioned window and a broadcast of it are bounded."""
    running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return (
        keyed.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("size"))
        .withColumn("end", F.sum("size").over(running))
        .withColumn("total", F.sum("size").over(Window.partitionBy()))
    )


def hash_cuts(
    df: DataFrame, key: str, seed: int, ranks: Callable[[Column], Sequence[Column]]
) -> Column:
    """Cut points of the seeded order as one scalar subquery.

    ``ranks`` maps the row count to the wanted ranks. The subquery is a struct
    with fields ``cut0, cut1, ...``, each the (digest, key) of the row at that rank,
    null for rank 0; ranks past the end mean the last row. Equal keys are counted
    as one weighted entry, so copies cannot pile up in a task; they also stay on
    the same side of a cut."""
    keyed = _keyed(df, key, seed)
    ends = _bucket_ends(keyed)
    wanted = ranks(F.col("total"))
    targets = (
        ends.select(
            "bucket",
            "size",
            "end",
            F.posexplode(
                F.array(*[F.least(r.cast("bigint"), F.col("total")) for r in wanted])
            ).alias("cut", "rank"),
        )
        .where("rank <= end and rank > end - size")
        .select("bucket", "cut", (F.expr("rank - (end - size)")).alias("local"))
    )
    upto = (
        Window.partitionBy("cut")
        .orderBy("digest", "key")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    found = (
        keyed.join(F.broadcast(targets), "bucket")  # at most one row per cut
        .groupBy("cut", "local", "digest", "key")
        .agg(F.count(F.lit(1)).alias("weight"))
        .withColumn("upto", F.sum("weight").over(upto))
        .where("upto >= local and upto - weight < local")
    )
    at = F.struct("digest", "key")
    cuts = [
        F.max(F.when(F.col("cut") == i, at)).alias(f"cut{i}") for i in range(len(wanted))
    ]
    return found.agg(F.struct(*cuts).alias("cuts")).scalar()


def within_cut(key: str, seed: int, cut: Column) -> Column:
    """True for rows at or before a cut of :func:`hash_cuts`."""
    here = F.struct(hash_order(key, seed).alias("digest"), F.col(key).alias("key"))
    return F.coalesce(here <= cut, F.lit(False))


def with_rank(df: DataFrame, key: str, seed: int, name: str = "rank") -> DataFrame:
    """Add the 0-based position of every row in the seeded order. ``key`` must be
    unique. Buckets are uniform by construction and each is sorted on its own."""
    keyed = df.withColumn("digest", hash_order(key, seed)).withColumn(
        "bucket", _bucket(F.col("digest"))
    )
    ends = _bucket_ends(_keyed(df, key, seed))
    starts = ends.select("bucket", (F.col("end") - F.col("size")).alias("start"))
    inside = Window.partitionBy("bucket").orderBy("digest", key)
    return (
        keyed.join(F.broadcast(starts), "bucket")  # at most BUCKETS rows
        .withColumn(name, F.col("start") + F.row_number().over(inside) - 1)
        .drop("digest", "bucket", "start")
    )


# --- quantiles ---------------------------------------------------------------

CELLS = 4096


def _even(x: Column) -> Column:
    return x


def _by_size(x: Column) -> Column:
    """A scale that never falls with x and grows evenly with the magnitude of numbers on
    either side of zero; infinities have an end of it to themselves."""
    magnitude = F.least(F.ln(F.greatest(F.abs(x), F.lit(5e-324))) + 746, F.lit(1500.0))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.signum(x) * magnitude)


# values of any magnitude are told apart first, then those within a factor of two
REFINEMENTS = (_by_size, _even, _even)


def exact_quantiles(
    counts: DataFrame, bounds: DataFrame, probabilities: Sequence[float]
) -> DataFrame:
    """Linear-interpolation quantiles per group.

    ``counts`` holds (name, value, weight) with one row per distinct value;
    ``bounds`` holds (name, low, high, total) and maybe more, one row per name; it
    comes back with a column ``q{percent}`` per probability. Each refinement splits
    the interval around a wanted rank into CELLS cells, even on some scale, and keeps the
    one that contains it; only what is left of the interval is ordered."""
    places = F.array(*[F.lit(float(p)) for p in probabilities])
    targets = (
        bounds.where("total > 0")
        .select("name", "low", "high", "total", F.explode(places).alias("prob"))
        .withColumn("place", F.expr("(total - 1) * prob"))
        .select(
            "name",
            "prob",
            "low",
            "high",
            F.explode(
                F.array_distinct(F.array(F.floor("place") + 1, F.ceil("place") + 1))
            ).alias("rank"),
        )
        .withColumn("local", F.col("rank"))
    )
    identity = ["name", "prob", "rank"]
    for scale in REFINEMENTS:
        targets = _refine(counts, targets, identity, scale)
    upto = (
        Window.partitionBy(*identity)
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    picked = (
        _inside(counts, targets)
        .withColumn("upto", F.sum("weight").over(upto))
        .where("upto >= local and upto - weight < local")
    )
    ends = []
    for i, p in enumerate(probabilities):
        here = F.when(F.col("prob") == float(p), F.col("value"))
        ends += [F.min(here).alias(f"below{i}"), F.max(here).alias(f"above{i}")]
    found = picked.groupBy("name").agg(*ends)
    quantiles = []
    for i, p in enumerate(probabilities):
        place = (F.col("total") - 1) * F.lit(float(p))
        low, high = F.col(f"below{i}"), F.col(f"above{i}")
        value = low + (high - low) * (place - F.floor(place))
        quantiles.append(value.alias(f"q{round(p * 100)}"))
    # one row per column on both sides
    return bounds.join(F.broadcast(found), "name", "left").select(*bounds.columns, *quantiles)


def _inside(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """Distinct values inside a target's interval. ``targets`` has two rows per
    column and probability, so it is always small enough to broadcast."""
    t = F.broadcast(targets).alias("t")
    c = counts.alias("c")
    on = (F.col("c.name") == F.col("t.name")) & F.col("c.value").between(
        F.col("t.low"), F.col("t.high")
    )
    return c.join(t, on).select("t.*", "c.value", "c.weight")


def _refine(
    counts: DataFrame, targets: DataFrame, identity: list[str], scale: Callable[[Column], Column]
) -> DataFrame:
    value, low, high = (scale(F.col(c)) for c in ("value", "low", "high"))
    share = F.nanvl(F.try_divide(value - low, high - low), F.lit(0.0))
    cell = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * CELLS), F.lit(CELLS - 1))
    upto = (
        Window.partitionBy(*identity)
        .orderBy("cell")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        _inside(counts, targets)
        .groupBy(*identity, "local", cell.alias("cell"))
        .agg(
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.sum("weight").alias("size"),
        )
        .withColumn("upto", F.sum("size").over(upto))
        .where("upto >= local and upto - size < local")
        .select(
            *identity, "low", "high", F.expr("local - (upto - size)").alias("local")
        )
    )


# --- quantiles by radix narrowing ------------------------------------------------

DIGIT_BITS = 16
DIGITS = 64 // DIGIT_BITS
TOP_BIT = -(1 << 63)


def ordered_image(value: Column) -> Column:
    """A double as a 64-bit integer that orders like it: the bits of the number, with all but
    the sign flipped below zero. Both zeros have one image, null has none."""
    number = F.coalesce(value, F.lit(0.0)) + F.lit(0.0)
    bits = F.call_function("reflect", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), number).cast("bigint")
    flipped = lambda b: b.bitwiseXOR(F.shiftright(b, 63).bitwiseAND(F.lit((1 << 63) - 1)))
    # a function over an array of one element names the bits, which are costly to find
    return F.when(value.isNotNull(), F.get(F.transform(F.array(bits), flipped), F.lit(0)))


def _digit(value: Column, place: int) -> Column:
    """Digit ``place`` of the image, the highest being 0, in the order of the values."""
    unsigned = ordered_image(value).bitwiseXOR(F.lit(TOP_BIT))
    return F.shiftrightunsigned(unsigned, 64 - DIGIT_BITS * (place + 1)).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))


def radix_counts(values: DataFrame, spans: DataFrame, place: int) -> DataFrame:
    """Per name, span of values and digit: how many values, the smallest and the largest.
    Values are only counted, on the map side first, so that a task sends a row per counter
    at most, and none of the values. ``spans`` (name, low, high) is broadcast: it has a row
    per rank that is sought."""
    v, s = values.alias("v"), F.broadcast(spans).alias("s")
    inside = (F.col("v.name") == F.col("s.name")) & F.col("v.value").between(F.col("s.low"), F.col("s.high"))
    return (
        v.join(s, inside)
        .groupBy("s.name", "s.low", _digit(F.col("v.value"), place).alias("digit"))
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.min("v.value").alias("first"),
            F.max("v.value").alias("last"),
        )
    )


def radix_quantiles(
    values: DataFrame, bounds: DataFrame, probabilities: Sequence[float]
) -> DataFrame:
    """Linear-interpolation quantiles per group, like :func:`exact_quantiles`, from the values
    themselves: ``values`` holds (name, value) rows without missing ones, ``bounds`` (name,
    low, high, total) and maybe more, one row per name.

    Each round counts the values around every wanted rank by their next 16 bits and goes
    on with the span of one count. Four rounds tell any two doubles apart, so nothing is
    ever ordered or shuffled but counters; columns of few distinct values need fewer.
    Driver and broadcasts hold two ranks per name and probability."""
    spark = values.sparkSession
    known = [r.asDict() for r in bounds.select("name", "low", "high", "total").collect()]
    sought = {}
    for row in known:
        for p in probabilities if row["total"] else ():
            place = (row["total"] - 1) * float(p)
            for rank in (math.floor(place) + 1, math.ceil(place) + 1):
                sought[row["name"], rank] = {"low": row["low"], "high": row["high"], "local": rank}
    for place in range(DIGITS):
        wide = {key: s for key, s in sought.items() if s["low"] != s["high"]}
        if not wide:
            break
        targets = spark.createDataFrame(
            [(name, rank, s["low"], s["high"], s["local"]) for (name, rank), s in wide.items()],
            "name string, rank long, low double, high double, local long",
        )
        counts = radix_counts(values, targets.select("name", "low", "high").distinct(), place)
        upto = (
            Window.partitionBy("name", "low")
            .orderBy("digit")
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        cells = counts.withColumn("upto", F.sum("size").over(upto))
        found = (
            cells.join(F.broadcast(targets), ["name", "low"])  # a row per rank sought
            .where("upto >= local and upto - size < local")
            .select("name", "rank", "first", "last", F.expr("local - (upto - size)").alias("local"))
        )
        for r in found.collect():
            sought[r["name"], r["rank"]] = {"low": r["first"], "high": r["last"], "local": r["local"]}
    rows = []
    for row in known:
        ends = []
        for p in probabilities:
            place = (row["total"] - 1) * float(p)
            if not row["total"]:
                ends += [None]
                continue
            low, high = (sought[row["name"], math.floor(place) + 1]["low"], sought[row["name"], math.ceil(place) + 1]["low"])
            share = place - math.floor(place)
            ends += [low + (high - low) * share if share and low != high else low]
        rows.append((row["name"], *ends))
    names = [f"q{round(p * 100)}" for p in probabilities]
    found = spark.createDataFrame(rows, ", ".join(["name string", *[f"{n} double" for n in names]]))
    return bounds.join(F.broadcast(found), "name", "left").select(*bounds.columns, *names)  # a row per name
