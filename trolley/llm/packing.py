"""Best-fit-decreasing packing of tokenised documents into fixed windows.

A document is its token ids and one end id. Ids beyond full windows are cut off in front: each
full window is a sequence of its own. The rests are packed in decreasing length; a segment tree
indexed by remaining capacity finds the tightest open window that still has room.

Scale: one pass and no shuffle. Every input partition packs its own documents, in pools bounded by
the bytes of the rests they hold, so memory does not grow and no key can be hot. Padding comes only
from windows left open at the end of a pool. Sequence numbers carry the partition, and the order
inside a pool is fixed by length, id and start, so a task that is run again gives its rows again.

Tokenisation: the tokenizer never joins characters over white space, so distinct white-space
delimited chunks are encoded once per task and looked up after that. The table of chunks is bounded
by bytes: when one half is full, the older half goes, long chunks are never kept, and at the end of a
task the table goes, for the worker lives on through tasks that do not need it. A new chunk is
cut into words by the tokenizer's own pattern. Texts with control strings of the tokenizer or
characters outside the common Latin ranges go through the tokenizer whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from trolley.llm.common import empty_text, give_back, slices, table, worker_cache

WINDOW, END_ID = 2048, 1
TABLE_BYTES = 192 << 20   # chunks remembered per task, with what Python needs for them
LONG_CHUNK = 200         # characters; longer chunks are encoded each time
POOL_BYTES = 24 << 20   # ids of rests packed together
_PLAIN = re.compile("[\\t\\n\\r -~ -įı-ſ‐-‧‰-⁞€]*")
# Bytes that byte-level vocabularies write as characters from 256 on, in order.
_BYTE_SIGNS = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree of counts."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.stacks: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, number: int) -> None:
        self.stacks[room].append(number)
        node = self.size + room
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(window, its room) with the smallest room of at least ``need``, removed from the tree."""
        count, node = self.count, self.size + need
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):  # up until a right sibling has windows
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:  # down to its leftmost leaf
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.size
        number = self.stacks[room].pop()
        while node:
            count[node] -= 1
            node >>= 1
        return number, room


def best_fit(lengths: list[int], window: int) -> tuple[list[tuple[int, int]], int]:
    """((window number, offset) per piece, windows used); lengths must not increase."""
    open_, out, used = OpenWindows(window), [], 0
    for n in lengths:
        found = open_.take(n)
        number, room = found or (used, window)
        used += found is None
        out.append((number, window - room))
        if room > n:
            open_.add(room - n, number)
    return out, used


class Remembered(dict):
    """Ids by chunk, made where they are missing; looked up first in the table that was full before."""

    def __init__(self, encode: Callable[[str], bytes], older: dict[str, bytes]):
        super().__init__()
        self.encode, self.older, self.held = encode, older, 0

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.encode(chunk)
        if len(chunk) <= LONG_CHUNK:
            self[chunk] = ids
            self.held += 200 + len(chunk)
        return ids


class ChunkEncoder:
    """Token ids of texts as little-endian unsigned 32-bit values."""

    def __init__(self, path: str, table_bytes: int = TABLE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or "(?!)")
        self.model, self.pattern = self.tokenizer.model, None
        with open(path, encoding="utf-8") as f:
            split, *rest = (json.load(f).get("pre_tokenizer") or {}).get("pretokenizers") or [None]
        # Words are cut here where the file says: matches of a pattern, written as bytes.
        if rest and split["type"] == "Split" and split["invert"] and split["behavior"] == "Removed" and "Regex" in split["pattern"] \
                and [(r["type"], r["add_prefix_space"], r["use_regex"]) for r in rest] == [("ByteLevel", False, False)]:
            self.pattern = regex.compile(split["pattern"]["Regex"])
        self.half = table_bytes // 2
        self.forget()

    def forget(self) -> None:
        self.known = Remembered(self.chunk, {})

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def chunk(self, chunk: str) -> bytes:
        """Ids of a chunk of a plain text, in lower case."""
        if self.pattern is None:
            return self.whole(chunk)
        tokens, cut = self.model.tokenize, [chunk] if chunk.isalpha() else self.pattern.findall(chunk)
        return array("I", [t.id for w in cut
                           for t in tokens(w if w.isascii() else w.encode().decode("latin-1").translate(_BYTE_SIGNS))]).tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            if not _PLAIN.fullmatch(text) or self.special.search(text):
                yield self.whole(text)
                continue
            yield b"".join(map(self.known.__getitem__, text.lower().split()))
            if self.known.held > self.half:
                self.known.older = {}
                self.known = Remembered(self.chunk, self.known)


PIECE = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(docs: DataFrame, vocabulary: str | None = None, text: str = "text", key: str = "doc_id", window: int = WINDOW,
         end_id: int = END_ID, pool_bytes: int = POOL_BYTES) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    Null text counts as empty: such a document is its end id alone. Repeated rows are packed as
    often as they occur; a null id stays null. An empty table gives an empty result.
    """
    vocabulary = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    tail = np.uint32(end_id).tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_cache(f"chunks:{vocabulary}", lambda: ChunkEncoder(vocabulary))
        base, used, pool, held = TaskContext.get().partitionId() << 33, 0, [], 0

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64()] * 6 + [pa.binary()]
            columns = zip(*rows) if rows else [[]] * 7
            return pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds)], [c.split()[0] for c in PIECE.split(", ")])

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal used, pool, held
            pool.sort(key=lambda p: (-len(p[3]), p[0] is not None, p[0] or 0, p[1]))
            places, windows = best_fit([len(p[3]) // 4 for p in pool], window)
            for at in range(0, len(pool), 1000):
                yield batch([(doc, start, len(ids) // 4, total, base + used + number, offset, ids)
                             for (doc, start, total, ids), (number, offset) in zip(pool[at:at + 1000], places[at:at + 1000])])
            used, pool, held = used + windows, [], 0

        for piece in slices(batches, "text", 1000, 1 << 20):
            full = []
            for doc, ids in zip(piece.column(0).to_pylist(), encoder.encode(piece.column(1).to_pylist())):
                ids += tail
                total = len(ids) // 4
                whole = total - total % window
                for start in range(0, whole, window):
                    full.append((doc, start, window, total, base + used, 0, ids[4 * start:4 * (start + window)]))
                    used += 1
                if whole < total:
                    pool.append((doc, whole, total, ids[4 * whole:]))
                    held += 4 * (total - whole)
            if full:
                yield batch(full)
            if held > pool_bytes:
                yield from packed()
        if pool:
            yield from packed()
        encoder.forget()
        give_back()

    return docs.select(F.col(key).cast("long").alias("doc_id"), empty_text(text).alias("text")).mapInArrow(work, PIECE)


def sequences(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """(sequence_id, length, padding, ids): the pieces of each window joined in order. A group holds
    at most ``window`` pieces. A window filled to a power of two needs no padding."""
    joined = (pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("length"))
              .select("sequence_id", "length", F.aggregate("p", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids")))
    power = F.col("length").bitwiseAND(F.col("length") - 1) == 0
    return joined.select("sequence_id", "length", F.when(power, F.lit(0)).otherwise(F.lit(window) - F.col("length")).alias("padding"), "ids")


def digests(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(pack(table(spark, sf_dir, "documents")))
