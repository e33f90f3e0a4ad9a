"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

Vectors are put on a sphere (scaled by the largest norm, one more component), where the largest
inner product with a query is the nearest point. Equal vectors are one node of the graph, known by
their smallest id, so copies cost nothing and answers are expanded at the end.

1. Start: every node goes to the cells of its ``CELLS`` nearest pivots, cells are split by hash into
   blocks of bounded size, and each block is compared inside.
2. NN-descent: in each round every node u introduces its neighbours (and a bounded number of nodes
   that have u as a neighbour) to each other; a pair is proposed where it beats the worst neighbour
   one of them has, and only if one of the two is new in u's list. Rounds are Spark joins and end
   when few neighbours change.
3. Search: a query begins at its own node and its best pivots; its pool of best nodes is extended by the neighbours of all members not yet
   expanded, until a round brings nothing into the pool. All queries go through a round together.
   The pool is then scored in double precision on the original vectors.

Scale: every list is bounded by its parameter; top lists are taken with a limit below the shuffle, so
a node in everybody's list is no hot group. Pivots are a bounded sample (``PIVOTS``), the only thing
collected; every vector is indexed. Rounds end in stored tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from trolley.llm.common import stored, table, text_bytes

DEGREE, REVERSE, POOL, TOP, ENTRIES = 24, 12, 96, 20, 8
PIVOTS, CELL, CELLS, BLOCK = 4096, 96, 16, 2048  # at most, nodes a pivot stands for, cells of a node, nodes a block holds at most on average
ASKED_ROWS = 100_000    # query points broadcast at most, some 15 MB at 64 components; more are joined
ROUNDS, ENOUGH = 6, 0.02


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector): rows that take part. Left out: null ids; null, empty or zero vectors; null or
    non-finite components; vectors of another length than most; repeats of an id (the first vector in
    the order of components stays)."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), v.alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.col("count").desc(), "n").limit(1).collect()
    dimension = sizes[0]["n"] if sizes else 0
    return rows.filter(F.size("vector") == dimension).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((vec_id, node) per row, (node, vector) per different vector); node is the smallest id."""
    nodes = stored(rows.groupBy("vector").agg(F.min("vec_id").alias("node")).select("node", "vector"), "nodes")
    return stored(rows.join(nodes, "vector").select("vec_id", "node"), "members"), nodes


def on_sphere(nodes: DataFrame) -> DataFrame:
    """(node, point): unit vectors with one more component, as half-precision bytes."""
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    largest = nodes.agg(F.max(norm)).first()[0] or 1.0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1) / np.sqrt(largest)
                x = np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1, keepdims=True)))]).astype(np.float16)
                yield pa.record_batch([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["node", "point"])

    return stored(nodes.select("node", "vector").mapInArrow(work, "node long, point binary"), "points")


def _points(column: pa.Array) -> np.ndarray:
    """Float32 rows of a column of half-precision points."""
    if not len(column):
        return np.zeros((0, 0), np.float32)
    return np.frombuffer(text_bytes(column)[0], np.float16).reshape(len(column), -1).astype(np.float32)


def nearest(rows: DataFrame, owner: str, k: int) -> DataFrame:
    """Each owner's ``k`` best rows by falling similarity, then smaller node."""
    place = F.row_number().over(W.partitionBy(owner).orderBy(F.col("sim").desc(), "node"))
    return rows.withColumn("place", place).filter(F.col("place") <= k).drop("place")


def pivots_of(points: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, points) of the pivots, drawn by hash."""
    drawn = points.orderBy(F.xxhash64("node"), "node").limit(max(1, min(PIVOTS, n // CELL))).toArrow().combine_chunks()
    return drawn["node"].to_numpy(), _points(drawn["point"].chunk(0) if drawn.num_rows else pa.array([], pa.binary()))


def start_graph(points: DataFrame, pivots: np.ndarray, degree: int) -> DataFrame:
    """(owner, node, sim) from the comparison inside blocks."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                sims = _points(part.column(1)) @ pivots.T
                near = np.argsort(-sims, 1, kind="stable")[:, :CELLS].astype(np.int32)
                rows = np.repeat(np.arange(part.num_rows), near.shape[1])
                yield pa.record_batch([pa.array(near.ravel()), part.column(0).take(pa.array(rows)), part.column(1).take(pa.array(rows))], ["cell", "node", "point"])

    dealt = stored(points.mapInArrow(cells, "cell int, node long, point binary"), "cells")
    parts = dealt.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))  # a row per pivot
    blocks = (dealt.join(F.broadcast(parts), "cell").groupBy("cell", F.pmod(F.xxhash64("node", "cell"), "parts").alias("part"))
              .agg(F.collect_list(F.struct("node", "point")).alias("members")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                members = batch.column(0).slice(i, 1).flatten()
                ids, x = members.field(0).to_numpy(), _points(members.field(1))
                sims = x @ x.T
                np.fill_diagonal(sims, -np.inf)
                k = min(degree, len(ids) - 1)
                if k > 0:
                    best = np.argpartition(-sims, k - 1, 1)[:, :k]
                    yield pa.record_batch([pa.array(np.repeat(ids, k)), pa.array(ids[best].ravel()), pa.array(np.take_along_axis(sims, best, 1).ravel())], ["owner", "node", "sim"])

    found = blocks.select("members").mapInArrow(compare, "owner long, node long, sim float")
    return nearest(found.groupBy("owner", "node").agg(F.max("sim").alias("sim")), "owner", degree)


def reverse(graph: DataFrame, k: int, salt: int, *more: str) -> DataFrame:
    """Up to ``k`` owners that have a node in their list, drawn by hash."""
    turned = graph.select(F.col("node").alias("owner"), F.col("owner").alias("node"), *more)
    place = F.row_number().over(W.partitionBy("owner").orderBy(F.xxhash64("node", F.lit(salt)), "node"))
    return turned.withColumn("place", place).filter(F.col("place") <= k).drop("place")


def descend(points: DataFrame, graph: DataFrame, degree: int, salt: int) -> DataFrame:
    """One round: (owner, node, sim, new)."""
    known = graph.select("owner", "node", "new")
    lists = known.unionByName(reverse(known, REVERSE, salt, "new")).groupBy("owner", "node").agg(F.max("new").alias("new"))
    worst = graph.groupBy("owner").agg(F.min("sim").alias("worst"), F.count(F.lit(1)).alias("n"))
    met = (points.join(worst.withColumnRenamed("owner", "node"), "node", "left")
           .select("node", "point", F.when(F.col("n") >= degree, F.col("worst")).otherwise(F.lit(-2.0)).cast("float").alias("worst")))
    meetings = lists.join(met, "node").groupBy("owner").agg(F.collect_list(F.struct("node", "point", "worst", "new")).alias("members"))

    def introduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                members = batch.column(0).slice(i, 1).flatten()
                ids, x = members.field(0).to_numpy(), _points(members.field(1))
                bar, new = members.field(2).to_numpy(), members.field(3).to_numpy(zero_copy_only=False)
                sims = x @ x.T
                good = (sims > bar[:, None]) & (new[:, None] | new[None, :])
                np.fill_diagonal(good, False)
                a, b = np.nonzero(good)
                out.append((ids[a], ids[b], sims[a, b]))
            if out:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], ["owner", "node", "sim"])

    proposed = meetings.select("members").mapInArrow(introduce, "owner long, node long, sim float").withColumn("new", F.lit(True))
    both = graph.select("owner", "node", "sim", F.lit(False).alias("new")).unionByName(proposed)
    return nearest(both.groupBy("owner", "node").agg(F.max("sim").alias("sim"), F.min("new").alias("new")), "owner", degree)


def build(points: DataFrame, pivots: np.ndarray, degree: int = DEGREE) -> DataFrame:
    """The neighbour graph (owner, node, sim)."""
    n = points.count()
    graph = stored(start_graph(points, pivots, degree).withColumn("new", F.lit(True)), "graph")
    for i in range(ROUNDS):
        graph = stored(descend(points, graph, degree, i), "graph")
        if graph.filter("new").count() <= ENOUGH * degree * n:
            break
    return graph.select("owner", "node", "sim")


def search(points: DataFrame, graph: DataFrame, queries: DataFrame, pivots: tuple[np.ndarray, np.ndarray], pool: int = POOL) -> DataFrame:
    """(query, node, sim): the pool of every query node after greedy search from itself and from its
    ``ENTRIES`` best pivots, by inner product: the query's added component counts as zero."""
    edges = stored(graph.select("owner", "node").unionByName(reverse(graph, REVERSE, ROUNDS)).distinct(), "edges")
    asked = stored(queries.join(points, queries["query"] == points["node"]).select("query", F.col("point").alias("asked")), "queries")
    nodes, places = pivots
    places = places.copy()
    places[:, -1:] = 0

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                sims = _points(part.column(1)) @ places.T
                best = np.argsort(-sims, 1, kind="stable")[:, :ENTRIES]
                queries_ = np.repeat(part.column(0).to_numpy(), best.shape[1])
                other = nodes[best.ravel()] != queries_
                yield pa.record_batch([pa.array(queries_[other]), pa.array(nodes[best.ravel()][other]), pa.array(np.take_along_axis(sims, best, 1).ravel()[other])], ["query", "node", "sim"])

    nearby = F.broadcast(asked) if asked.count() <= ASKED_ROWS else asked
    own = asked.select("query", F.col("query").alias("node"), F.lit(2.0).cast("float").alias("sim"))
    held = stored(own.unionByName(asked.mapInArrow(enter, "query long, node long, sim float")).withColumn("done", F.lit(False)), "pool")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 5000):
                part = batch.slice(at, 5000)
                sims = np.einsum("ij,ij->i", _points(part.column(2))[:, :-1], _points(part.column(3))[:, :-1])
                yield pa.record_batch([part.column(0), part.column(1), pa.array(sims)], ["query", "node", "sim"])

    while True:
        frontier = held.filter("not done").select("query", F.col("node").alias("owner"))
        if frontier.isEmpty():
            return held.select("query", "node", "sim")
        met = frontier.join(edges, "owner").select("query", "node").distinct().join(held.select("query", "node"), ["query", "node"], "left_anti")
        scored = met.join(points, "node").join(nearby, "query").select("query", "node", "point", "asked").mapInArrow(compare, "query long, node long, sim float")
        both = held.withColumn("done", F.lit(True)).unionByName(scored.withColumn("done", F.lit(False)))
        held = stored(nearest(both, "query", pool), "pool")


def nearest_neighbours(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 20, top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id is divisible by ``every``, against all rows
    but the query's own: the ``top`` largest inner products found, ties to the smaller id. Vectors that
    cannot take part (``usable``) are neither queries nor answers; an empty table gives an empty result."""
    members, nodes = classes(stored(usable(vectors, key, vector), "vectors"))
    points = on_sphere(nodes)
    pivots = pivots_of(points, nodes.count())
    graph = build(points, pivots[1])
    asking = members.filter(F.pmod("vec_id", F.lit(every)) == 0).withColumnRenamed("vec_id", "query_id")
    queries = stored(asking.select(F.col("node").alias("query")).distinct(), "asking")
    # The query's own node leads its pool: its other members are candidates.
    found = nearest(search(points, graph, queries, pivots), "query", 2 * top + 1)
    sides = (found.join(nodes, "node").withColumnRenamed("vector", "x")
             .join(nodes.select(F.col("node").alias("query"), F.col("vector").alias("q")), "query"))
    product = F.aggregate(F.zip_with("x", "q", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    scored = nearest(sides.select("query", "node", product.alias("sim")), "query", top + 1)
    # Of equal vectors only the smallest ids can be among the best.
    first = F.row_number().over(W.partitionBy("node").orderBy("vec_id"))
    leading = members.withColumn("place", first).filter(F.col("place") <= top + 1).drop("place")
    answers = scored.join(leading, "node").groupBy("query").agg(F.collect_list(F.struct((-F.col("sim")).alias("minus"), "vec_id")).alias("all"))
    # At most (top + 1) squared answers for a query vector; each asking row drops itself.
    own = F.slice(F.filter(F.array_sort("all"), lambda a: a["vec_id"] != F.col("query_id")), 1, top)
    return (asking.join(answers, asking["node"] == answers["query"]).select("query_id", F.posexplode(own).alias("at", "a"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("a.vec_id").alias("vec_id"), (-F.col("a.minus")).alias("score")))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))
