"""Chat formatting as packed prefix trees.

Conversations that begin with the same turns share them: a node is a turn together with all turns
before it. Different conversations are sorted by their path of turn digests, which is the depth-first
order of the forest, and written to packs in that order, so a shared turn is emitted once in a pack.
A pack holds up to ``chars`` characters; a tree that is larger goes on in the next pack, where the
path to the next turn is written again (attention needs it there).

Each node has its place in the pack, the position id of its first character (its ancestors' length),
the intervals of its ancestors to attend to, and the interval under the loss mask (assistant texts).

Template: ``### role: text</turn>`` and a line end per turn. ``\\``, ``#`` and ``<`` inside texts and
roles become ``\\\\``, ``\\h`` and ``\\l`` (in roles also ``:`` and the line end, ``\\c`` and ``\\n``), so
control strings occur nowhere else and every text comes back unchanged.

Scale: turns are gathered per conversation, one record each. Copies collapse to one row per task
before the shuffle. The depth-first order is a range partition of one row per different
conversation by its whole path, so a first turn that a third of all conversations share is spread
like any other; no tree is collected.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from trolley.llm.common import stored, table

PACK_CHARS = 65_536
LEARNED = "assistant"

_OUT = {"\\": "\\\\", "#": "\\h", "<": "\\l"}
_BACK = {"\\": "\\", "h": "#", "l": "<", "c": ":", "n": "\n"}
_TEXT, _ROLE, _ESCAPED = re.compile(r"[\\#<]"), re.compile(r"[\\#<:\n]"), re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ([^:]*): ([^<]*)</turn>\n")


def escape_text(text: str) -> str:
    return _TEXT.sub(lambda m: _OUT[m[0]], text)


def escape_role(role: str) -> str:
    return _ROLE.sub(lambda m: _OUT.get(m[0]) or ("\\c" if m[0] == ":" else "\\n"), role)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m[1]], text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """(formatted turn, start and end of the text in it)."""
    head, body = f"### {escape_role(role)}: ", escape_text(text)
    return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError("not a formatted conversation")
        out.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return out


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, path, leaf, turns) per conversation: rows in the order of turn, role and text; null
    roles and texts are empty; path holds a digest per turn, leaf is the last one."""
    gathered = rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(F.struct(
        "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))).alias("turns"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = []
            for turns in batch.column(1).to_pylist():
                path, last = [], b""
                for t in turns:
                    role, text = t["role"].encode(), t["text"].encode()
                    last = hashlib.blake2b(b"%s%d:%s%s" % (last, len(role), role, text), digest_size=16).digest()
                    path.append(last)
                paths.append(path)
            yield pa.record_batch([batch.column(0), pa.array([b"".join(p) for p in paths], pa.binary()), pa.array([p[-1] for p in paths], pa.binary()), batch.column(1)],
                                  ["conv_id", "path", "leaf", "turns"])

    slim = gathered.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    return slim.mapInArrow(work, "conv_id long, path binary, leaf binary, turns array<struct<role:string,text:string>>")


PACK = ("pack_id long, text string, "
        "nodes array<struct<start:long,length:long,parent:int,position:long,loss_start:long,loss_end:long,attends:array<struct<start:long,end:long>>>>, "
        "leaves array<struct<leaf:binary,node:int>>")


class Pack:
    """Nodes in depth-first order with their places in one text."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.nodes: list[dict] = []
        self.leaves: list[dict] = []
        self.chars = 0
        self.open: list[tuple[bytes, int]] = []  # (digest, node) of the path written last

    def shared(self, path: list[bytes]) -> int:
        n = 0
        while n < min(len(path), len(self.open)) and self.open[n][0] == path[n]:
            n += 1
        return n

    def add(self, path: list[bytes], turns: list[tuple[str, str, int, int]]) -> None:
        common = self.shared(path)
        del self.open[common:]
        for digest, (role, text, start, end) in zip(path[common:], turns[common:]):
            parent = self.open[-1][1] if self.open else -1
            above = self.nodes[parent] if self.open else None
            attends: list[dict] = []
            if above:
                attends = [dict(a) for a in above["attends"]]
                if attends and attends[-1]["end"] == above["start"]:
                    attends[-1]["end"] += above["length"]
                else:
                    attends.append({"start": above["start"], "end": above["start"] + above["length"]})
            learned = role == LEARNED
            self.nodes.append({"start": self.chars, "length": len(text), "parent": parent, "position": above["position"] + above["length"] if above else 0,
                               "loss_start": self.chars + start if learned else -1, "loss_end": self.chars + end if learned else -1, "attends": attends})
            self.open.append((digest, len(self.nodes) - 1))
            self.parts.append(text)
            self.chars += len(text)
        self.leaves.append({"leaf": path[-1], "node": self.open[-1][1]})


def packs(talks: DataFrame, chars: int = PACK_CHARS) -> DataFrame:
    """The packed trees of the different conversations of ``conversations``."""
    different = stored(talks.select("path", "leaf", "turns").dropDuplicates(["leaf"]), "talks")
    kind = talks.sparkSession.createDataFrame([], PACK).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, number, pack = to_arrow_schema(kind), TaskContext.get().partitionId() << 33, Pack()

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"pack_id": number, "text": "".join(pack.parts), "nodes": pack.nodes, "leaves": pack.leaves}], schema)

        for batch in batches:
            for i in range(batch.num_rows):
                path, turns = (batch.column(c)[i].as_py() for c in (0, 1))
                path = [path[k:k + 16] for k in range(0, len(path), 16)]
                written = [(t["role"], *format_turn(t["role"], t["text"])) for t in turns]
                if pack.leaves and pack.chars + sum(len(w[1]) for w in written[pack.shared(path):]) > chars:
                    yield row()
                    number, pack = number + 1, Pack()
                pack.add(path, written)
        if pack.leaves:
            yield row()

    return different.select("path", "turns").repartitionByRange("path").sortWithinPartitions("path").mapInArrow(work, kind)


def read_back(packed: DataFrame) -> DataFrame:
    """Per different conversation, from the packs alone: leaf, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, nodes, leaves in zip(*(batch.column(c).to_pylist() for c in range(3))):
                for leaf in leaves:
                    node = nodes[leaf["node"]]
                    whole = "".join(text[a["start"]:a["end"]] for a in node["attends"]) + text[node["start"]:node["start"] + node["length"]]
                    turns, learned, at = parse(whole), [], leaf["node"]
                    while at >= 0:
                        if nodes[at]["loss_start"] >= 0:
                            learned.append(unescape(text[nodes[at]["loss_start"]:nodes[at]["loss_end"]]))
                        at = nodes[at]["parent"]
                    loss = "".join(reversed(learned))
                    out.append((leaf["leaf"], len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                                len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole)))
            if out:
                kinds = [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return packed.select("text", "nodes", "leaves").mapInArrow(work, "leaf binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([Row(conv_id=-7, turn=i, role=r, text=said) for i, r in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(extra)
    talks = stored(conversations(rows), "conversations")
    return (talks.select("conv_id", "leaf").join(read_back(packs(talks)), "leaf")
            .select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"))
