"""Exact duplicates by a tree-merge of sorted digest runs.

A text's digest is the SHA-256 of its normalised form, with its length and a second hash
to verify that equal digests mean equal texts. Every partition first sorts its digests and
collapses equal ones to the identifier to keep and a count: a run. Runs are then merged
in rounds. In a round, groups of partitions exchange parts of their runs, a part for each
value of the next few bits of the digest, and each merges the parts it receives, again
keeping the best identifier and the sum of the counts. After the last round a partition
has one run, with all of its range of digests. A run has one row per digest, so a text
with any number of copies never fills a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskcorpus.llm.common import HOT_SHARE, ascii_lower, hot_lookup, partitions, text_of, tidy
from deskcorpus.stages import evaluate_once, materialize

BROADCAST_ROWS = 500_000  # identifiers of 8 bytes and what becomes of them
FAN_BITS = 3  # a merge takes runs of up to 2**FAN_BITS partitions
IDENTITY = ["digest", "n_bytes", "check"]
RUN = "digest binary, n_bytes long, check long, keep_id long, group_size long"


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", normalise=ascii_lower) -> DataFrame:
    """(doc_id, digest, n_bytes, check) of every row."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), normalise(text_of(text)).alias("t"))
    return rows.select(
        "doc_id",
        F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("digest"),
        F.octet_length("t").cast("long").alias("n_bytes"),
        F.xxhash64("t").alias("check"),
    )


def rounds(n_partitions: int, fan_bits: int = FAN_BITS) -> tuple[int, list[tuple[int, int]]]:
    """The number of runs, a power of two no less than the partitions, and for every round
    the lowest bit of the partition number that it settles, and how many bits."""
    bits = max(n_partitions - 1, 1).bit_length()
    return 1 << bits, [(low, min(fan_bits, bits - low)) for low in range(0, bits, fan_bits)]


def _collapse():
    """Merge adjacent rows of the same digest in sorted batches; the first row of a digest
    has the identifier to keep, and the last digest waits for the next batch."""

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.table(dict(zip(batch.schema.names, batch.columns)))
            if rest is not None:
                table = pa.concat_tables([rest, table])
            table = table.combine_chunks()
            raw = [table.column(c).chunk(0) for c in IDENTITY]
            digest = np.array(raw[0].to_numpy(zero_copy_only=False), dtype="S32")
            other = [c.to_numpy(zero_copy_only=False) for c in raw[1:]]
            # S32 drops trailing zero bytes, which equality does not see either
            new = np.ones(len(digest), np.bool_)
            new[1:] = digest[1:] != digest[:-1]
            for c in other:
                new[1:] |= c[1:] != c[:-1]
            first = np.flatnonzero(new)
            counts = np.add.reduceat(table.column("group_size").to_numpy(), first)
            merged = table.take(pa.array(first)).set_column(
                table.schema.get_field_index("group_size"), "group_size", pa.array(counts, pa.int64())
            )
            rest = merged.slice(merged.num_rows - 1)
            yield from merged.slice(0, merged.num_rows - 1).combine_chunks().to_batches()
        if rest is not None:
            yield from rest.combine_chunks().to_batches()

    return collapse


def merge_runs(rows: DataFrame, largest: bool = True, fan_bits: int = FAN_BITS) -> DataFrame:
    """(digest, n_bytes, check, keep_id, group_size), one row per text. ``keep_id`` is the
    largest or the smallest identifier; null only if all are null."""
    better = F.desc_nulls_last if largest else F.asc_nulls_last
    order = [*IDENTITY, better("keep_id")]
    runs, steps = rounds(partitions(rows.sparkSession), fan_bits)

    def merged(df: DataFrame) -> DataFrame:
        return df.sortWithinPartitions(*order).mapInArrow(tidy(_collapse()), RUN)

    state = merged(rows.select(*IDENTITY, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")))
    place = F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(runs))
    for low, n in steps:
        mask = ((1 << n) - 1) << low
        here = F.pmod(F.spark_partition_id(), F.lit(runs))
        to = here.bitwiseAND(F.lit(~mask & (runs - 1))).bitwiseOR(place.cast("int").bitwiseAND(F.lit(mask)))
        state = merged(state.withColumn("_to", to).repartitionById(runs, F.col("_to")).drop("_to"))
    return state


def dedup_table(docs: DataFrame, largest: bool = True, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row.

    Texts are equal when the same after lower-casing A-Z; null counts as empty. Rows that
    repeat an identifier and a text are all kept or dropped together, and counted each.
    Null identifiers lose against others; a group of nulls alone keeps them."""
    rows = materialize(digests(docs, key, text))  # read by the merge and by the answer
    groups = materialize(merge_runs(rows, largest))
    return _answers(rows, groups)


def _answers(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Only texts with copies have to be looked up: a text of its own keeps its row."""
    repeated = groups.where("group_size > 1").withColumn("_n", F.col("group_size"))
    found = hot_lookup(rows, repeated, IDENTITY, "_n", rows.count())
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, largest: bool = True, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every group of equal texts, with the columns of ``docs``. Of rows that
    repeat the identifier to keep, the one with the smallest text as written stays.

    Digests alone tell which identifiers have only rows that go, so whole rows are not
    shuffled for them while these identifiers are few enough to be broadcast, and once if
    they are more. Rows of identifiers that have rows of both kinds, or several rows to
    choose from, are looked up by their digests."""
    rows = materialize(digests(docs, key, text))
    groups = materialize(
        merge_runs(rows, largest)
        .where("group_size > 1")
        .withColumn("_n", F.col("group_size"))
    )
    total = rows.count()
    copies = F.col("group_size").isNotNull()
    best = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    on = ["_none", "_id"]
    place = lambda c: (c.isNull().alias("_none"), F.coalesce(c, F.lit(0)).alias("_id"))
    ids = (
        hot_lookup(rows, groups, IDENTITY, "_n", total)
        .groupBy(*place(F.col("doc_id")))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count_if(copies & ~best).alias("go"),
            F.count_if(copies & best).alias("rivals"),
        )
    )
    verdict = F.when(F.col("go") == F.col("_n"), "go").when((F.col("go") > 0) | (F.col("rivals") > 1), "look")
    frequent = F.col("_n") > HOT_SHARE * max(total, 1)
    marked = materialize(ids.select(*on, "_n", verdict.alias("_verdict")).where(F.col("_verdict").isNotNull() | frequent))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    named = docs.select(whole, *place(F.col(f"`{key}`").cast("long")), F.xxhash64(F.col(f"`{text}`")).alias("_spread"))
    if marked.count() <= BROADCAST_ROWS:
        told = named.join(F.broadcast(marked.drop("_n")), on, "left")
    else:
        told = hot_lookup(named, marked, on, "_n", total)
    stay = told.where("_verdict is null").select("row.*")
    if marked.where("_verdict = 'look'").isEmpty():
        return stay
    return stay.unionByName(_looked_up(told.where("_verdict = 'look'").select("row.*"), groups, total, key, text))


def _looked_up(docs: DataFrame, groups: DataFrame, total: int, key: str, text: str) -> DataFrame:
    """The rows of ``docs`` that stay, found by the digest of each."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    normal = ascii_lower(text_of(f"`{text}`"))
    rows = evaluate_once(
        docs.select(whole, F.col(f"`{key}`").cast("long").alias("doc_id"), normal.alias("t")),
        {"digest": F.unhex(F.sha2(F.col("t").cast("binary"), 256))},
    ).select(
        "row", "doc_id", "digest", F.octet_length("t").cast("long").alias("n_bytes"), F.xxhash64("t").alias("check")
    )
    found = hot_lookup(rows, groups, IDENTITY, "_n", total)
    alone = found.where("group_size is null").select("row")
    chosen = (
        found.where("group_size is not null and doc_id <=> keep_id")
        .groupBy(*IDENTITY)
        .agg(F.min_by("row", text_of(f"row.`{text}`")).alias("row"))
        .select("row")
    )
    return alone.unionByName(chosen).select("row.*")
