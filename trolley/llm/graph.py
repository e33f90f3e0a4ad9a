"""Connected components by alternating large-star and small-star rounds of Spark joins.

A node's neighbours are never collected: each round is a partial minimum per node and a join
back, which adaptive planning splits where one node has very many links. Rounds grow with the
logarithm of the longest chain; each ends in a stored table. As soon as the links left are at most
``FEW_LINKS`` (counted), one task joins them up; the answer is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trolley.llm.common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (u, v) with u > v. Large star: hang every larger neighbour on the smallest one.
    Small star: hang the node and its smaller neighbours on the smallest one."""
    if large:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        moved = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    else:
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        joined = links.join(least, "u")
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.filter("u != v").distinct()


FEW_LINKS = 200_000  # some 50 MB in the one task that joins them up


def joined_up(links: DataFrame) -> DataFrame:
    """(node, component) of a bounded number of links (u, v), in one task."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while up.setdefault(x, x) != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                up[max(a, b)] = min(a, b)
        if up:
            yield pa.record_batch([pa.array(list(up)), pa.array([root(x) for x in list(up)])], ["node", "component"])

    return links.select("u", "v").coalesce(1).mapInArrow(work, "node long, component long")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected links (a, b); component is the smallest
    node reachable. Links of a node to itself are ignored; no links give an empty table."""
    current = stored(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    shape = None
    while current.count() > FEW_LINKS:
        current = stored(_star(_star(current, True), False), "stars")
        found = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == shape:
            break
        shape = tuple(found)
    else:
        return joined_up(current)
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
