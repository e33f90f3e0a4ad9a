"""Secret scan: fixed patterns, and a linear-chain conditional random field for what they miss.

Three patterns give the base spans. A CRF over the tokens of a text (``crf``: shape, neighbouring words,
separators, file features) is trained to tag the secrets that the patterns find in a sample, and Viterbi
decoding then marks secrets anywhere, also where no pattern matches. In training, long tokens of letters
and digits outside base spans count as unknown, not as clean (the likelihood sums over their tags), for the
patterns do not know every secret. A tagged span that overlaps no base
span is added as kind ``crf``; base spans always stay.

Scale: the CRF is trained on windows of at most ``WIDTH`` tokens, ``PER_TEXT`` a text, from at most
``PER_CLASS`` texts with base spans and as many without (those with the smallest hash of id and text),
so the fit is one bounded task. Scanning is one pass of Arrow batches over all texts, no shuffle. A long
text is tagged in chunks of tokens, exactly as in one go.

Rows: null text counts as empty and has no span; repeated ids and rows each get their row; of further
columns none is read; where no text of the table has a base span the CRF adds none; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from trolley.llm import crf
from trolley.llm.common import empty_text, slices, stored, table, text_bytes

# The patterns, and how long what they find must be.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "crf")

PER_CLASS, PER_TEXT, WIDTH = 2_000, 3, 64  # texts a class; windows a text; tokens a window
_HINTS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

Span = tuple[int, int, int, int]  # start, kind, end, start of the secret itself; in bytes


def _texts_with(data: bytes, words: tuple[bytes, ...], ends: np.ndarray) -> list[int]:
    """Numbers of the texts that hold one of the words."""
    found = set()
    for word in words:
        at = data.find(word)
        while at >= 0:
            doc = int(np.searchsorted(ends, at, "right")) - 1
            if at + len(word) <= ends[doc + 1]:
                found.add(doc)
                at = data.find(word, int(ends[doc + 1]))
            else:
                at = data.find(word, at + 1)
    return sorted(found)


def base_spans(data: np.ndarray, ends: np.ndarray) -> dict[int, list[Span]]:
    """Text number -> its base spans by start, then kind; positions are bytes of the text."""
    raw, out = data.tobytes(), {}
    for kind, pattern, docs in ((0, ASSIGN, _texts_with(raw.translate(_LOWER), _HINTS, ends)), (1, ACCESS, _texts_with(raw, (b"AKIA",), ends))):
        for doc in docs:
            for m in pattern.finditer(raw[ends[doc]:ends[doc + 1]]):
                inner = 2 if kind == 0 else 0
                if m.end(inner) - m.start(inner) >= LEAST[KINDS[kind]]:
                    out.setdefault(doc, []).append((m.start(), kind, m.end(), m.start(inner)))
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = crf.HEX[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    before = np.concatenate([[False], inside[:-1]])
    starts, stops = np.flatnonzero(inside & (~before | edge)), np.flatnonzero(before & (~inside | edge))
    long = np.flatnonzero(stops - starts >= LEAST["hex"])
    for start, stop in zip(starts[long].tolist(), stops[long].tolist()):
        doc = int(np.searchsorted(ends, start, "right")) - 1
        at = start - int(ends[doc])
        out.setdefault(doc, []).append((at, 2, stop - int(ends[doc]), at))
    return {doc: sorted(spans) for doc, spans in out.items()}


def gold_tags(tokens: crf.Tokens, ends: np.ndarray, spans: dict[int, list[Span]]) -> np.ndarray:
    """B and I on the tokens that base spans' secrets touch; other random-looking tokens are UNKNOWN."""
    tags = np.zeros(len(tokens), np.uint8)
    for doc, found in spans.items():
        for _, _, stop, inner in found:
            first = int(np.searchsorted(tokens.stops, ends[doc] + inner, "right"))
            last = int(np.searchsorted(tokens.starts, ends[doc] + stop, "left"))
            if last > first and not tags[first:last].any():
                tags[first], tags[first + 1:last] = crf.B, crf.I
    tags[tokens.random_looking() & (tags == crf.O)] = crf.UNKNOWN
    return tags


@dataclass(frozen=True)
class Model:
    weights: np.ndarray | None  # None: nothing to learn from, no span is added
    moves: np.ndarray

    def spans(self, data: np.ndarray, ends: np.ndarray) -> dict[int, list[Span]]:
        """Text number -> tagged spans."""
        if self.weights is None or not len(data):
            return {}
        tokens, out = crf.Tokens(data, ends), {}
        tags = crf.decode(tokens, self.weights, self.moves)
        begins = np.flatnonzero(tags == crf.B)
        goes_on = np.append(tags[1:] == crf.I, False)
        stops = np.flatnonzero((tags != crf.O) & ~goes_on)
        for b, e in zip(begins.tolist(), stops.tolist()):
            doc = int(tokens.doc[b])
            start = int(tokens.starts[b] - ends[doc])
            out.setdefault(doc, []).append((start, 3, int(tokens.stops[e] - ends[doc]), start))
        return out


def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training windows of the sampled texts: around base spans, and one at a place drawn by hash."""
    for piece in slices(batches, "text", 500, 4 << 20):
        data, ends = text_bytes(piece.column(0))
        tokens = crf.Tokens(data, ends)
        tags = gold_tags(tokens, ends, base_spans(data, ends))
        firsts, out = np.searchsorted(tokens.doc, np.arange(len(ends))), []
        for doc, key in enumerate(piece.column(1).to_pylist()):
            lo, hi = int(firsts[doc]), int(firsts[doc + 1])
            if lo == hi:
                continue
            begins = lo + np.flatnonzero(tags[lo:hi] == crf.B)
            begins = begins[np.linspace(0, len(begins) - 1, min(len(begins), PER_TEXT - 1)).astype(int)] if len(begins) else begins
            places = [*(int(b) - (key + int(b) - lo) % (WIDTH // 2) for b in begins), lo + key % (hi - lo)]
            for k, at in enumerate(places):
                at = max(lo, at)
                while at > lo and tags[at] == crf.I:
                    at -= 1
                stop = min(at + WIDTH, hi)
                out.append((key, k, stop - at, tokens.features(at, stop).tobytes(), tags[at:stop].tobytes()))
        if out:
            yield pa.record_batch([pa.array(c) for c in zip(*out)], ["key", "k", "size", "features", "tags"])


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id", per_class: int = PER_CLASS) -> Model:
    """Train on the base spans of a bounded sample of texts."""
    hinted = F.col("text").rlike(r"(?i)(passw|secret|token|api_?key).{0,24}[:=]|AKIA[A-Z0-9]{12}|[0-9a-f]{32}")
    rows = docs.select(empty_text(text).alias("text"), F.col(key).alias("id")).filter("text <> ''")
    rows = rows.select(F.abs(F.xxhash64("id", "text") % 1_000_003).alias("key"), F.xxhash64("text", "id").alias("tie"), hinted.alias("hinted"), "text")
    heads = stored(rows.groupBy("key", "tie").agg(F.max("hinted").alias("hinted")), "secret-keys")
    chosen = [heads.filter(c).orderBy("key", "tie").limit(per_class) for c in ("hinted", "NOT hinted")]
    chosen = stored(chosen[0].unionByName(chosen[1]), "secret-sample")  # at most 2 * per_class rows
    sampled = rows.drop("hinted").join(F.broadcast(chosen.drop("hinted")), ["key", "tie"]).select("text", "key", "tie")
    once = sampled.dropDuplicates(["key", "tie"]).select("text", "key")
    found = stored(once.mapInArrow(windows, "key long, k long, size long, features binary, tags binary"), "windows")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = sorted((r for b in batches for r in zip(*[c.to_pylist() for c in b.columns])), key=lambda r: (r[0], r[1], r[3]))
        sizes = np.array([r[2] for r in cut], np.int64)
        features, tags = np.zeros((len(cut), WIDTH, len(crf.SIZES)), np.int32), np.zeros((len(cut), WIDTH), np.uint8)
        for i, (_, _, size, f, t) in enumerate(cut):
            features[i, :size] = np.frombuffer(f, np.int32).reshape(size, -1)
            tags[i, :size] = np.frombuffer(t, np.uint8)
        if (tags == crf.B).any():
            weights, moves = crf.trained(features, tags, sizes)
            yield pa.record_batch([pa.array([weights.tobytes()]), pa.array([moves.tobytes()])], ["weights", "moves"])

    best = found.coalesce(1).mapInArrow(train, "weights binary, moves binary").first()
    if best is None:
        return Model(None, np.zeros((3, 3)))
    return Model(np.frombuffer(bytes(best["weights"]), np.float32).reshape(-1, 3), np.frombuffer(bytes(best["moves"]), np.float64).reshape(3, 3))


SCANNED = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def listed(spans: list[Span], points: np.ndarray) -> str:
    return ",".join(f"{KINDS[kind]}:{points[start]}:{points[stop]}" for start, kind, stop, _ in spans)


def scan(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans in code points."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for piece in slices(batches, "text", 2000, 4 << 20):
            data, ends = text_bytes(piece.column(1))
            base, extra = base_spans(data, ends), model.spans(data, ends)
            n = piece.num_rows
            counts, digests, spans = np.zeros((3, n), np.int64), [nothing] * n, [""] * n
            for doc in base.keys() | extra.keys():
                known = base.get(doc, [])
                points = np.concatenate([[0], np.cumsum((data[ends[doc]:ends[doc + 1]] & 0xC0) != 0x80)])
                new = [s for s in extra.get(doc, []) if not any(s[0] < k[2] and k[0] < s[2] for k in known)]
                for s in known:
                    counts[s[1], doc] += 1
                digests[doc] = hashlib.sha256(listed(known, points).encode()).hexdigest()
                spans[doc] = listed(sorted(known + new), points)
            yield pa.record_batch([piece.column(0), *[pa.array(c) for c in counts], pa.array(digests), pa.array(spans)],
                                  ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), empty_text(text).alias("text")).mapInArrow(work, SCANNED)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, fit(docs))
