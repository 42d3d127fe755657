"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import attach
from .stage import frugal, written


class Forest:
    """Union-find that keeps the smallest member as root."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while (y := up.get(top, top)) != top:
            top = y
        while (y := up.get(x, x)) != top:
            up[x] = top
            x = y
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.up[b] = a
        self.up.setdefault(a, a)
        return True


def _local(batches):
    """Edges of each batch as stars around the smallest node; a batch is bounded, so is the memory."""
    for batch in batches:
        forest = Forest()
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if a is not None and b is not None:
                forest.join(a, b)
        nodes = [x for x in forest.up if forest.root(x) != x]
        yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array([forest.root(x) for x in nodes], pa.int64())], names=["u", "v"])


#: Edges that one task may connect alone (its memory is some tens of megabytes).
SMALL = 200_000


def _whole(batches):
    """(node, component) of all edges."""
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
    nodes = list(forest.up)
    yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array([forest.root(x) for x in nodes], pa.int64())], names=["node", "component"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a bigint, b bigint); component is the smallest node reachable.

    Self-loops and repeated edges do no harm; nulls are ignored; no edges give no rows.
    SMALL edges at most, after those inside a batch are stars, are connected by one task.  More take rounds:
    each is one join and two aggregations on narrow rows and is written to the
    shared folder; hot centres go through map-side minima and a broadcast of
    those with a thousandth of all edges, which are few.
    """
    spark = edges.sparkSession
    a, b = edges.columns[:2]
    now = written(edges.select(F.col(a).cast("bigint").alias("u"), F.col(b).cast("bigint").alias("v")).mapInArrow(frugal(_local), "u long, v long"), "edges")
    state, edges_now = None, now.count()
    if edges_now <= SMALL:
        return now.coalesce(1).mapInArrow(frugal(_whole), "node long, component long")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = attach(both.where("v > u"), least, "u", "n", 2 * edges_now).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("w")), F.struct(F.col("v").alias("u"), F.col("m").alias("w")))).alias("e")).select("e.u", F.col("e.w").alias("v")).where("u <> v").distinct()
        now = written(small, "small")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state, edges_now = tuple(seen), seen[0]
    roots = now.groupBy("v").agg(F.lit(1)).select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
