"""Conversation prefix trie by truncation peeling.

Every distinct sequence of first d turns is a node. The trie is never walked from its root: the level
of the longest sequences comes first, and each round merges the conversations that end at this depth
with the nodes that survive from the depth below, aggregates them, strips the last turn and regroups.
One pass over the levels finds the nodes and all their sums.

* A sequence of turns is known by two running XORs of 64-bit words, one word per (depth, SHA-256 of
  role and text). XOR needs no order, so a very long conversation is cut into blocks of turns, and
  stripping a turn is another XOR.
* From a depth on at which all members of a node are the same conversation, the rest is one chain whose
  numbers are known at once: it is written without peeling. Rounds are therefore bounded by the
  deepest prefix that *different* conversations share (plus ``STRIDE``), not by the longest one.
* The ids of the conversations that end in a node are hashed from a range-partitioned order: tasks write
  runs of up to ``RUN`` ids, and the runs of a node are hashed in order as a stream.

Scale: each round shuffles node rows only, pre-aggregated, so a first turn, or a whole conversation,
that a third of the table shares is one row per task. Parents with very many children are joined by a
broadcast of at most ``HOT_PARENTS`` rows (children sum up to the number of nodes, which bounds the list),
others by shuffling. Every level is written to the shared folder, so a lost executor repeats one level.

Rows: null conv_ids take no part; a null role or text counts as empty; turns are ordered by turn (null
first), equal ones by role and text; repeated rows are turns of their own. Of further columns none is
read. An empty table has no node. Two different prefixes of one depth get the same words with chance 2^-128.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from trolley.llm.common import stored, table
from trolley.operators.ordering import position_in_key

STRIDE, BLOCK, RUN = 8, 512, 8192
HOT_PARENTS, HOT_LEAST = 10_000, 1_000  # rows of the broadcast list; children a shuffled key may always have
FAMILY, MOST_HEAD = 5, 9  # rebuilt conversations: family size, bound of the shared head
KEY = ["k1", "k2"]
NODE = ["depth", *KEY, "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "p1", "p2"]


def placed(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, content words c1 c2, bytes of the text): turns numbered from 1."""
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    numbered = position_in_key(turns, ["conv_id"], "turn", [F.asc("role"), F.asc("text")], newest_first=False, name="place")
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    words = [F.conv(F.substring("_d", at, 15), 16, 10).cast("long").alias(n) for n, at in (("c1", 1), ("c2", 16))]
    return numbered.withColumn("_d", digest).select("conv_id", "place", *words, F.octet_length("text").cast("long").alias("bytes"))


def as_written(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns with depth, conversations) of the conversations as they are."""
    return own.withColumnRenamed("place", "depth"), own.select("conv_id").distinct()


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns with depth, conversations): the first h turns of the family's first conversation, then the
    conversation's own turns after its first h."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_HEAD
    sizes = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    firsts = sizes.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), h.alias("h"))
    convs = stored(convs.join(firsts, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("head")), "conversations")
    shared = own.filter((F.col("conv_id") % FAMILY == 0) & (F.col("place") < MOST_HEAD)).withColumnRenamed("conv_id", "base")
    heads = shared.join(convs, "base").filter(F.col("place") <= F.col("h")).select("conv_id", F.col("place").alias("depth"), "c1", "c2", "bytes")
    rest = own.join(convs, "conv_id").filter(F.col("place") > F.col("h"))
    rest = rest.select("conv_id", (F.col("place") - F.col("h") + F.col("head")).alias("depth"), "c1", "c2", "bytes")
    return heads.unionByName(rest), convs.select("conv_id")


def prefixes(turns: DataFrame) -> DataFrame:
    """Each turn with its own words w1 w2, the words k1 k2 of the prefix it ends, its bytes and those up
    to it. Running values are taken inside blocks of turns, then block by block."""
    words = turns.select("conv_id", "depth", F.xxhash64("c1", "c2", "depth").alias("w1"), F.xxhash64("c2", "depth", "c1", F.lit(1)).alias("w2"),
                         "bytes", F.floor((F.col("depth") - 1) / BLOCK).alias("block"))
    sums = [F.bit_xor("w1").alias("k1"), F.bit_xor("w2").alias("k2"), F.sum("bytes").alias("total")]
    inside = W.partitionBy("conv_id", "block").orderBy("depth")
    run = words.select("*", F.bit_xor("w1").over(inside).alias("k1"), F.bit_xor("w2").over(inside).alias("k2"), F.sum("bytes").over(inside).alias("total"))
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    earlier = words.groupBy("conv_id", "block").agg(*sums).select(
        "conv_id", "block", F.bit_xor("k1").over(before).alias("e1"), F.bit_xor("k2").over(before).alias("e2"), F.sum("total").over(before).alias("et"))
    joined = run.join(earlier.filter("block > 0"), ["conv_id", "block"], "left")
    none = F.lit(0).cast("long")
    return joined.select("conv_id", "depth", "w1", "w2", F.col("k1").bitwiseXOR(F.coalesce("e1", none)).alias("k1"),
                         F.col("k2").bitwiseXOR(F.coalesce("e2", none)).alias("k2"), "bytes", (F.col("total") + F.coalesce("et", none)).alias("total"))


def _parent() -> list[Column]:
    return [F.col(f"k{i}").bitwiseXOR(F.col(f"w{i}")).alias(f"p{i}") for i in (1, 2)]


def tails(turns: DataFrame, whole: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes of the chains in which all members are one conversation, their starts with k1 k2 of the whole).

    Looked for at every ``STRIDE``-th depth; the start is the first of these at which all members are equal.
    """
    marks = turns.filter(F.col("depth") % STRIDE == 0).join(whole.select("conv_id", F.struct(*KEY).alias("all")), "conv_id")
    same = (marks.groupBy("depth", *KEY).agg(F.min("all").alias("all"), F.max("all").alias("other"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
            .filter("all = other"))
    starts = same.groupBy("all").agg(F.min("depth").alias("start"), F.min("n").alias("n"), F.min("conv_id").alias("conv_id"))
    starts = stored(starts.join(whole.select("conv_id", "length", F.col("total").alias("bytes_all")), "conv_id").select(
        "conv_id", "start", "n", "length", "bytes_all", "all.k1", "all.k2"), "tails")
    chain = turns.join(starts.drop(*KEY), "conv_id").filter("depth >= start")
    nodes = chain.select("depth", *KEY, "conv_id", F.col("n").alias("n_convs"), (F.col("depth") < F.col("length")).cast("long").alias("n_children"),
                         F.lit(1).cast("long").alias("n_leaves"), ((F.col("n") - 1) * (F.col("bytes_all") - F.col("total") + F.col("bytes"))).alias("saved_tokens"),
                         *_parent(), (F.col("depth") == F.col("start")).alias("top"))
    return stored(nodes, "tail-nodes"), starts


def ends(whole: DataFrame, run: int = RUN) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the nodes at which conversations end."""
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, now, ids, out = ["depth", "k1", "k2", "first", "ids"], None, [], []
        for batch in batches:
            for *key, conv in zip(*[c.to_pylist() for c in batch.columns]):
                if key != now or len(ids) >= run:
                    if ids:
                        out.append((*now, ids[0], ",".join(map(str, ids))))
                    now, ids = key, []
                ids.append(conv)
            if len(out) >= 1000:
                yield pa.record_batch([pa.array(c) for c in zip(*out)], names)
                out = []
        if ids:
            out.append((*now, ids[0], ",".join(map(str, ids))))
        if out:
            yield pa.record_batch([pa.array(c) for c in zip(*out)], names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, now, state, out = ["depth", "k1", "k2", "ends_sha256"], None, None, []
        for batch in batches:
            for *key, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if key == now:
                    state.update(b"," + ids.encode())
                    continue
                if now:
                    out.append((*now, state.hexdigest()))
                now, state = key, hashlib.sha256(ids.encode())
            if len(out) >= 1000:
                yield pa.record_batch([pa.array(c) for c in zip(*out)], names)
                out = []
        if now:
            out.append((*now, state.hexdigest()))
            yield pa.record_batch([pa.array(c) for c in zip(*out)], names)

    key = ["depth", *KEY]
    listed = whole.select(F.col("length").alias("depth"), *KEY, "conv_id")
    cut = listed.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id").mapInArrow(runs, "depth long, k1 long, k2 long, first long, ids string")
    return cut.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(digests, "depth long, k1 long, k2 long, ends_sha256 string")


def peeled(turns: DataFrame, whole: DataFrame) -> DataFrame:
    """All nodes, level by level from the deepest; columns NODE."""
    chain, starts = tails(turns, whole)
    ended = stored(whole.join(starts.select(*KEY, F.lit(1).alias("_t")), KEY, "left").filter("_t IS NULL").select("conv_id", "length", *KEY), "ended")
    deepest = max(ended.agg(F.max("length")).first()[0] or 0, (starts.agg(F.max("start")).first()[0] or 0) - 1)
    none, levels, above = F.lit(0).cast("long"), [chain.select(*NODE)], None
    for depth in range(deepest, -1, -1):
        survivors = chain.filter((F.col("depth") == depth + 1) & F.col("top")).select(*NODE)
        if above is not None:
            survivors = survivors.unionByName(above)
        stripped = survivors.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "conv_id", "n_convs", F.lit(1).cast("long").alias("child"), "n_leaves", "saved_tokens")
        new = ended.filter(F.col("length") == depth).select(*KEY, "conv_id", F.lit(1).cast("long").alias("n_convs"), none.alias("child"), none.alias("n_leaves"), none.alias("saved_tokens"))
        merged = stripped.unionByName(new).groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("child").alias("n_children"),
            F.greatest(F.sum("n_leaves"), F.lit(1).cast("long")).alias("n_leaves"), F.sum("saved_tokens").alias("below"))
        if depth:
            last = turns.filter(F.col("depth") == depth).select("conv_id", "w1", "w2", "bytes")
            merged = merged.join(last, "conv_id").withColumn("saved_tokens", F.col("below") + (F.col("n_convs") - 1) * F.col("bytes"))
            merged = merged.select(F.lit(depth).cast("long").alias("depth"), "*", *_parent())
        else:
            merged = merged.select(none.alias("depth"), "*", F.col("below").alias("saved_tokens"), none.alias("p1"), none.alias("p2"))
        above = stored(merged.select(*NODE), f"level-{depth}")
        levels.append(above)
    return reduce(DataFrame.unionByName, levels)


def with_parents(nodes: DataFrame) -> DataFrame:
    """Adds parent_conv_id. A parent with more than nodes / HOT_PARENTS children is one of at most
    HOT_PARENTS, as children sum up to less than the nodes."""
    most = nodes.count() // HOT_PARENTS + HOT_LEAST
    parents = nodes.filter("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                                                    F.col("conv_id").alias("parent_conv_id"), "n_children")
    key = ["depth", "p1", "p2"]
    hot = parents.filter(F.col("n_children") > most).select(*key, F.col("parent_conv_id").alias("hot_parent"))
    found = nodes.join(F.broadcast(hot), key, "left")
    known = found.filter("hot_parent IS NOT NULL").withColumnRenamed("hot_parent", "parent_conv_id")
    rest = found.filter("hot_parent IS NULL").drop("hot_parent").join(parents.filter(F.col("n_children") <= most).drop("n_children"), key, "left")
    return known.unionByName(rest)


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, and the words k1 k2 of its turns.

    ``turns`` holds (conv_id, depth from 1 without gaps, c1, c2, bytes); ``convs`` all conv_ids, turnless ones too.
    """
    run, whole = summed(turns, convs)
    nodes = with_parents(stored(peeled(run, whole), "nodes"))
    empty = hashlib.sha256(b"").hexdigest()
    return nodes.join(ends(whole), ["depth", *KEY], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"), *KEY)


def summed(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns with the words and bytes of their prefixes, conversations with those of the whole), stored."""
    run = stored(prefixes(turns).sortWithinPartitions("depth"), "prefixes")
    last = run.groupBy("conv_id").agg(F.max("depth").alias("length"), F.max_by(F.struct(*KEY, "total"), "depth").alias("_l")).select("conv_id", "length", "_l.*")
    none = F.lit(0).cast("long")
    return run, stored(convs.join(last, "conv_id", "left").select("conv_id", *[F.coalesce(c, none).alias(c) for c in ("length", *KEY, "total")]), "whole")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    return prefix_trie(*as_written(stored(placed(conversations), "turns")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(stored(placed(table(spark, sf_dir, "conversations")), "turns"))).drop(*KEY)


# crc32 of the decimal id: a fold over its bytes, each followed by eight shifts.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
 lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"""

SQL = f"""WITH own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place FROM conversations WHERE conv_id IS NOT NULL),
 convs AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC} % 9 AS h FROM (SELECT DISTINCT conv_id FROM own)),
 sized AS (SELECT c.*, least(h, coalesce(n, 0)) AS head FROM convs c LEFT JOIN (SELECT conv_id AS base, count(*) AS n FROM own GROUP BY conv_id) USING (base)),
 turns AS (SELECT s.conv_id, o.place AS depth, role, text FROM sized s JOIN own o ON o.conv_id = s.base AND o.place <= s.h
  UNION ALL SELECT s.conv_id, o.place - s.h + s.head, role, text FROM sized s JOIN own o ON o.conv_id = s.conv_id AND o.place > s.h),
 pref AS (SELECT conv_id, depth, strlen(text) AS bytes, string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
 marked AS (SELECT *, lag(path) OVER (PARTITION BY conv_id ORDER BY depth) AS up, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM pref),
 nodes AS (SELECT depth, path, any_value(up) AS up, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs,
  coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '') AS ends FROM marked GROUP BY depth, path),
 kids AS (SELECT up AS path, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
 full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (depth, path)),
 sums AS (SELECT p.depth, p.path, sum((d.n_convs - 1) * d.bytes) AS saved, count(*) FILTER (WHERE d.n_children = 0) AS leaves
  FROM full_nodes d JOIN pref p ON p.conv_id = d.conv_id AND p.depth <= d.depth GROUP BY ALL)
 SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
 FROM full_nodes n JOIN sums USING (depth, path) LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.path = n.up"""
