"""Connected components of a table of links, without any node's links in one place."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from deskcorpus.llm.common import hot_lookup, tidy
from deskcorpus.stages import materialize


FEW_EDGES = 20_000  # so many links, of 32 bytes, are joined up in one task
HUB_EDGES = 200_000  # the links of one node, of so many, are any one task's work


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the smallest node reachable.

    Large and small star steps by turns: every node hands its larger, then its smaller
    neighbours to the smallest one it knows, until all links are stars around the roots.
    While all links are few enough for any one task, a step is a window over each node's
    links. More links are aggregated, combined on the map side, and look up the answers, the
    links of a hub, which a root becomes after the first steps, spread over tasks. Each step's
    links are written, which cuts the lineage. Up to FEW_EDGES links, less than a megabyte, are
    not worth a shuffle: one task joins them up. The answer is the same by every way."""
    edges = materialize(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    )
    n_edges, state = edges.count(), None
    if n_edges <= FEW_EDGES:
        return _joined_up(edges)

    def least_of(rows: DataFrame, total: int) -> DataFrame:
        """The rows with ``m``, the least neighbour of their node."""
        if total <= HUB_EDGES:
            return rows.withColumn("m", F.min("v").over(Window.partitionBy("u")))
        found = rows.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n"))
        return hot_lookup(rows, found, ["u"], "_n", total)

    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = least_of(both, 2 * n_edges).withColumn("m", F.least("u", "m"))
        large = least.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = least_of(large, n_edges).select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        )
        edges = materialize(small.select("col.u", "col.v").where("u != v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        n_edges, state = now[0], now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _joined_up(edges: DataFrame) -> DataFrame:
    """(node, root) of links that fit in one task, by union of trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def find(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for batch in batches:
            kind = batch.schema.field(0).type
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parent.setdefault(u, u)
                parent.setdefault(v, v)
                a, b = find(u), find(v)
                parent[max(a, b)] = min(a, b)
        if parent:
            nodes = list(parent)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([find(x) for x in nodes], kind)], names=["node", "root"])

    schema = StructType([StructField("node", edges.schema["u"].dataType), StructField("root", edges.schema["u"].dataType)])
    return edges.select("u", "v").coalesce(1).mapInArrow(tidy(run), schema)
