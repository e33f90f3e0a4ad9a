"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of byte strings. Every adjacent pair whose join has a merge rank sits
in the bucket of that rank, by position. A bitmap of two levels marks the buckets in use, so the
next rank is two find-first-set steps, whatever the number of pairs; entries whose pair has changed
since are skipped when they come up. Many pre-tokens, with walls between them, go through one queue
together, so a bucket is found once for all their pairs of its rank. Merging costs O(log n) per pair,
so a pre-token of millions of letters is no special case.

Pre-tokens repeat, so ids are remembered per worker, in tables of bounded size, by chunk (what
stands between single spaces or line ends, where the pattern always cuts) and by pre-token. Texts where white space meets white space are cut by the pattern as a whole.

Scale: two passes of Arrow batches without a shuffle; documents do not depend on each other.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from trolley.llm.common import empty_text, slices, table, worker_cache

REMEMBERED = 1_000_000  # chunks and pre-tokens per worker
TOGETHER = 1 << 17      # bytes of pre-tokens merged in one queue; eight times as many characters are encoded together
_WALL = 0xFFFFF         # stands between pre-tokens and joins with nothing


class RankQueue:
    """Positions by merge rank; the next ones are the lowest rank's, from the left.

    Two levels of bitmaps: ``top`` has a bit per word of ``low``, whose bits are the ranks in use.
    """

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> 8) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def fill(self, rank: int, positions: list[int]) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket += positions
            return
        self.buckets[rank] = positions
        i = rank >> 8
        if not self.low[i]:
            self.top |= 1 << i
        self.low[i] |= 1 << (rank & 255)

    def take(self) -> tuple[int, list[int]]:
        """The lowest rank and all its positions from the left, which leave the queue."""
        word_at = (self.top & -self.top).bit_length() - 1
        word = self.low[word_at]
        bit = word & -word
        self.low[word_at] = word ^ bit
        if word == bit:
            self.top ^= 1 << word_at
        rank = word_at << 8 | bit.bit_length() - 1
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket


class Pairs(dict):
    """(left id << 20 | right id) -> id of their join, or -1; filled as pairs are met."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.bytes_of = ranks, {i: b for b, i in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.double = np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)], np.int32)

    def __missing__(self, pair: int) -> int:
        left, right = pair >> 20, pair & 0xFFFFF
        found = self[pair] = -1 if _WALL in (left, right) else self.ranks.get(self.bytes_of[left] + self.bytes_of[right], -1)
        return found


def merge(piece: bytes, pairs: Pairs, queue: RankQueue) -> list[int]:
    """Ids of one pre-token."""
    return np.frombuffer(merge_all([piece], pairs, queue)[0], np.uint32).tolist()


def merge_all(pieces: list[bytes], pairs: Pairs, queue: RankQueue) -> list[bytes]:
    """Ids of each pre-token (a merged token's id is its rank), as little-endian unsigned 32-bit values."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    number = np.repeat(np.arange(len(pieces)), sizes)
    place = np.arange(len(data)) + number + 1  # a wall before each pre-token and after the last
    total = len(data) + len(pieces) + 1
    first, second = np.full(total, _WALL, np.int32), np.full(total, -1, np.int32)
    first[place] = pairs.single[data]
    joined = pairs.double[data[:-1].astype(np.int32) << 8 | data[1:]]
    second[place[:-1]] = np.where(number[1:] == number[:-1], joined, -1)
    live = np.flatnonzero(second >= 0)
    live = live[np.argsort(second[live], kind="stable")]
    ranks, starts = np.unique(second[live], return_index=True)
    for rank, positions in zip(ranks.tolist(), np.split(live, starts[1:])):
        queue.fill(rank, positions.tolist())
    part, rank_of = first.tolist(), second.tolist()  # rank_of: of the pair that begins here
    after, before = list(range(1, total + 1)), list(range(-1, total - 1))
    get, fill = queue.buckets.get, queue.fill
    while queue.top:
        own, bucket = queue.take()
        waiting = iter(bucket)
        for i in waiting:
            if rank_of[i] != own:
                continue  # stale
            j = after[i]
            part[i], part[j], rank_of[j] = own, -1, -1
            k = after[i] = after[j]
            before[k] = i
            right = rank_of[i] = pairs[own << 20 | part[k]]
            if right >= 0:
                found = get(right)
                if found is None:
                    fill(right, [i])
                else:
                    found.append(i)
            h = before[i]
            left = rank_of[h] = pairs[part[h] << 20 | own]
            if left >= 0:
                found = get(left)
                if found is None:
                    fill(left, [h])
                else:
                    found.append(h)
            if -1 < right < own or -1 < left < own:  # a lower rank has come up: it goes first
                rest = list(waiting)
                if rest:
                    fill(own, rest)
    ids = np.array(part, np.int64)
    held = (ids >= 0) & (ids != _WALL)
    ends = 4 * np.cumsum(np.bincount(number[held[place]], minlength=len(pieces)))
    out, ends = ids[held].astype("<u4").tobytes(), ends.tolist()
    return [out[s:e] for s, e in zip([0, *ends], ends)]


class Codec:
    """Encoder and decoder of one vocabulary file of (base64 bytes, rank) lines."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN, remembered: int = REMEMBERED):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pairs = Pairs(self.ranks)
        self.bytes_of = self.pairs.bytes_of
        self.queue = RankQueue(max(self.bytes_of) + 1)
        self.tabulate()
        # \s of this module also holds the separators U+001C to U+001F, which are not white space in Unicode.
        self.pattern = regex.compile(pattern.replace("\\s", "\\p{White_Space}").replace("\\S", "\\P{White_Space}"))
        self.known: dict[str, bytes] = {}  # by pre-token; one that begins with a space, without it
        self.plain: dict[str, bytes] = {}  # by pre-token that does not
        self.remembered = remembered

    def tabulate(self) -> None:
        """All tokens' bytes in one array, for decoding: a token's are ``sizes`` bytes from ``starts`` on."""
        self.sizes = np.zeros(max(self.bytes_of) + 1, np.int64)
        self.sizes[list(self.bytes_of)] = [len(b) for b in self.bytes_of.values()]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes_at = np.frombuffer(b"".join(b for _, b in sorted(self.bytes_of.items())), np.uint8)

    def cut(self, text: str) -> list[tuple[dict[str, bytes], str, str]]:
        """(table, name there, pre-token) of each match of the pattern."""
        return [(self.known, piece[1:], piece) if piece[0] == " " and len(piece) > 1 and not piece[1].isspace() else (self.plain, piece, piece)
                for piece in self.pattern.findall(text)]

    def learn(self, cuts: Iterator[list[tuple[dict[str, bytes], str, str]]], words: Iterator[str]) -> None:
        """Enter the ids of all pre-tokens that are not known yet; a word is one behind a space."""
        spaced, plain = {w: (" " + w).encode() for w in words}, {}
        for cut in cuts:
            for table_, name, piece in cut:
                if name not in table_:
                    (spaced if table_ is self.known else plain)[name] = piece.encode()
        for table_, new in ((self.known, spaced), (self.plain, plain)):
            names, pieces, held = [], [], 0
            for name, piece in new.items():
                rank = self.pairs.ranks.get(piece)
                if rank is not None:
                    table_[name] = rank.to_bytes(4, "little")
                    continue
                names.append(name)
                pieces.append(piece)
                held += len(piece)
                if held > TOGETHER:
                    table_.update(zip(names, merge_all(pieces, self.pairs, self.queue)))
                    names, pieces, held = [], [], 0
            if pieces:
                table_.update(zip(names, merge_all(pieces, self.pairs, self.queue)))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit values."""
        known = self.known
        for table_ in (known, self.plain, self.pairs):
            if len(table_) > self.remembered:
                table_.clear()
        plans, chunks, new_words = [], {}, set()  # new chunks that are cut further, and that are one pre-token
        for text in texts:
            parts = text.replace("\n", " \n").split(" ")
            if "" in parts or "\n" in parts:
                plans.append((self.cut(text), [], [], []))
                continue
            head = parts.pop(0)
            ids = list(map(known.get, parts))
            gaps = [i for i, found in enumerate(ids) if found is None] if None in ids else []
            new = {parts[i] for i in gaps}.difference(new_words, chunks)
            # Other white space beside a space would go on over the cut.
            if head[-1:].isspace() or any(c[-1].isspace() or c.lstrip("\n")[:1].isspace() for c in new):
                plans.append((self.cut(text), [], [], []))
                continue
            plans.append((self.cut(head), parts, ids, gaps))
            for c in new:
                if c.isalpha():
                    new_words.add(c)
                else:
                    chunks[c] = self.cut(c if c[0] == "\n" else " " + c)
        self.learn([*(p[0] for p in plans), *chunks.values()], new_words)
        for chunk, cut in chunks.items():
            if chunk not in known:
                known[chunk] = b"".join([table_[name] for table_, name, _ in cut])
        out = []
        for cut, parts, ids, gaps in plans:
            for i in gaps:
                ids[i] = known[parts[i]]
            out.append(b"".join([*[table_[name] for table_, name, _ in cut], *ids]))
        # Long ones without any break are remembered for these texts only.
        for cut in (*(p[0] for p in plans), *chunks.values()):
            for table_, name, _ in cut:
                if len(name) > 200:
                    table_.pop(name, None)
        for c in (*chunks, *new_words):
            if len(c) > 200:
                known.pop(c, None)
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_batch(self, texts: list[str]) -> Iterator[bytes]:
        """As ``encode_all``, a bounded number of characters at a time."""
        group, held = [], 0
        for text in texts:
            group.append(text)
            held += len(text)
            if held > 8 * TOGETHER:
                yield from self.encode_all(group)
                group, held = [], 0
        if group:
            yield from self.encode_all(group)

    def decode(self, ids: bytes) -> bytes:
        return self.decode_all([ids])[0]

    def decode_all(self, all_ids: list[bytes]) -> list[bytes]:
        """The bytes of each list of ids; many ids at a time are looked up in one table of all tokens' bytes."""
        out, at = [], 0
        while at < len(all_ids):
            to, held = at, 0
            while to < len(all_ids) and (to == at or held + len(all_ids[to]) <= TOGETHER):
                held += len(all_ids[to])
                to += 1
            ids = np.frombuffer(b"".join(all_ids[at:to]), np.uint32)
            sizes = self.sizes[ids]
            stops = np.append(0, np.cumsum(sizes))
            found = self.bytes_at[np.repeat(self.starts[ids] - stops[:-1], sizes) + np.arange(stops[-1])].tobytes()
            ends = stops[np.cumsum([0, *(len(i) // 4 for i in all_ids[at:to])])].tolist()
            out += [found[s:e] for s, e in zip(ends, ends[1:])]
            at = to
        return out


def encode(docs: DataFrame, vocabulary: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit values. Null text counts as empty and has
    no ids; repeated rows are encoded as often as they occur."""
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_cache(f"codec:{vocabulary}", lambda: Codec(vocabulary))
        for rows in slices(batches, "text", 2000, 8 << 20):
            yield pa.record_batch([rows.column(0), pa.array(list(codec.encode_batch(rows.column(1).to_pylist())), pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), empty_text(text).alias("text")).mapInArrow(work, "doc_id long, ids binary")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): the bytes that the ids stand for; null ids stand for none."""
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_cache(f"codec:{vocabulary}", lambda: Codec(vocabulary))
        for rows in slices(batches, "ids", 2000, 16 << 20):
            yield pa.record_batch([*rows.columns[:2], pa.array(codec.decode_all(rows.column(1).to_pylist()), pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids")).mapInArrow(work, "doc_id long, ids binary, decoded binary")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = decode(encode(table(spark, sf_dir, "documents")))
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
