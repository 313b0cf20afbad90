"""Connected components of a distributed edge table by alternating stars.

Every round links each node's larger neighbours, then its smaller ones, to the
smallest of them.  Before the first round, the edges of each partition are turned
into stars where they are, in chunks of bounded size.  Minima are aggregated map-side
first, so a hub costs no task its whole degree; edges stay distributed and are cut
from lineage by staged tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from custlens.llm.common import drop_staged, importable, stage, trim


#: Edges of a chunk that one task holds.
CHUNK = 100_000


def stars(edges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Edges (u, v), v the smallest node that ``edges`` join u to, for all other nodes."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while parent.get(x, x) != top:
            parent[x], x = top, parent.get(x, x)
        return top

    for u, v in edges:
        a, b = root(u), root(v)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(u, root(u)) for u in parent if root(u) != u]


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int]] = []

    def flush():
        rows = stars(held)
        held.clear()
        u, v = zip(*rows, strict=True) if rows else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    for batch in batches:
        held.extend(zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True))
        if len(held) >= CHUNK:
            yield flush()
            trim()
    if held:
        yield flush()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v), u > v, after a large or small star."""
    if large:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    linked = both.join(least, "u")
    if large:
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"),
                                                           F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge, from edges (u, v): the
    component is the smallest node.  Loops and repeated edges don't matter."""
    spark = edges.sparkSession
    importable(spark)
    edges = edges.select("u", "v").where(F.col("u") != F.col("v")).mapInArrow(
        _local_stars, "u long, v long").distinct()
    path, before = None, None
    while True:
        # Count and checksum come with the write, not from a job of their own.
        seen = Observation()
        counted = edges.observe(seen, F.count(F.lit(1)).alias("n"),
                                F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"))
        done, path = path, stage(counted, "edges")
        if done:
            drop_staged(spark, done)
        now, edges = seen.get, spark.read.parquet(path)
        # At rest every edge joins a node to its component's smallest node.
        if now == before or not now["n"]:
            break
        before = now
        edges = _star(_star(edges, True), False).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
