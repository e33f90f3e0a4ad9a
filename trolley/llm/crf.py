"""Tokens, features and arithmetic of the secret tagger: a linear-chain conditional random field.

Texts are bytes. A token is a run of letters, digits, bytes of other characters and ``_+/-``, with dots
inside. Each token has ``len(SIZES)`` features, numbers into one table of weights: its shape, the words
around it, the separators around it and its file's make-up. Tags are O, B (a secret begins), I (it goes on).
"""

from __future__ import annotations

import numpy as np

O, B, I, UNKNOWN = 0, 1, 2, 3
FORBIDDEN = -1e9
LONG = 16  # bytes from which a token of letters and digits may be a secret that no pattern names
LENGTHS = np.array([2, 3, 5, 8, 12, 16, 20, 32, 40, 64], np.int64)

# Feature kinds and how many values each has.
SIZES = {"shape": 64 * 11, "made": 128, "switches": 8 * 11, "digits": 22, "prefix": 4096, "before": 8192, "after": 8192, "before2": 8192,
         "before_gap": 8192, "gap_before": 32, "gap_after": 32, "file_length": 32, "file_mix": 64}
STARTS = dict(zip(SIZES, np.cumsum([0, *SIZES.values()])))
TABLE = sum(SIZES.values())

_ORD = np.arange(256)
_LOWER, _UPPER, _DIGIT = (_ORD >= 97) & (_ORD <= 122), (_ORD >= 65) & (_ORD <= 90), (_ORD >= 48) & (_ORD <= 57)
_JOIN, _DOT, _HIGH = np.isin(_ORD, list(b"_+/-")), _ORD == 46, _ORD >= 128
_TOKEN = _LOWER | _UPPER | _DIGIT | _JOIN | _HIGH
HEX = _DIGIT | ((_ORD >= 97) & (_ORD <= 102))
_FOLD = np.where(_UPPER, _ORD + 32, _ORD).astype(np.uint8)
_CLASS = np.select([_LOWER, _UPPER, _DIGIT, _JOIN | _DOT, _HIGH], [1, 2, 3, 4, 5], 0).astype(np.uint8)
# One byte of marks per byte: of a token what it is made of, of a gap which separators it holds.
_MARKS = np.select([_LOWER, _UPPER, _DIGIT, _JOIN, _HIGH], [1, 2, 4, 8, 16], 0) | np.where(_TOKEN & ~HEX, 32, 0)
_GAP = np.select([_ORD == 61, _ORD == 58, np.isin(_ORD, list(b"\"'`")), _ORD == 10, _ORD > 32], [1, 2, 4, 8, 16], 0)
_MARKS = np.where(_TOKEN, _MARKS, _GAP).astype(np.uint8)
_EDGE = 31  # gap before the first and after the last token of a text


class Tokens:
    """Tokens of many texts laid end to end, found block by block of bytes."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, block: int = 4 << 20):
        self.data, self.n = data, len(data)
        starts, stops, digits, signs = [], [], np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
        edges = ends[:-1][np.diff(ends) > 0]
        for lo in range(0, self.n, block):
            hi = min(lo + block, self.n)
            left, right = max(lo - 1, 0), min(hi + 1, self.n)
            near = data[left:min(right + 1, self.n)]
            inside = _TOKEN[near]
            dots = np.flatnonzero(near[:-1] == 46)
            plain = _LOWER | _UPPER | _DIGIT
            inside[dots] = plain[near[dots + 1]] & ((left + dots) > 0) & _TOKEN[data[np.maximum(left + dots - 1, 0)]]
            cut = np.zeros(len(near) + 1, bool)
            cut[edges[(edges >= left) & (edges <= left + len(near))] - left] = True
            inside[dots[cut[dots] | cut[dots + 1]]] = False  # a dot beside a text's edge joins nothing
            before = np.concatenate([[False], inside[:-1]])
            begin, end = inside & (~before | cut[:-1]), before & (~inside | cut[:-1])
            at = np.flatnonzero(begin) + left
            starts.append(at[(at >= lo) & (at < hi)])
            at = np.flatnonzero(end) + left
            stops.append(at[(at >= max(lo, 1)) & (at < hi)])
            bounds = np.clip(ends, lo, hi) - lo
            for total, table in ((digits, _DIGIT), (signs, _GAP == 1)):
                total += np.concatenate([[0], np.cumsum(table[data[lo:hi]], dtype=np.int32)])[bounds]
        if self.n and _TOKEN[data[-1]]:
            stops.append(np.array([self.n]))
        self.starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.stops = np.concatenate(stops) if stops else np.zeros(0, np.int64)
        self.doc = np.searchsorted(ends, self.starts, "right") - 1
        size = np.diff(ends)
        share = np.diff(digits) / np.maximum(size, 1)
        dense = np.diff(signs) / np.maximum(size, 1)
        self.file_length = np.minimum(np.log2(size + 1).astype(np.int64), 31)
        self.file_mix = np.searchsorted([0.002, 0.01, 0.03, 0.08, 0.15, 0.3, 0.5], share) * 8 + np.searchsorted([0.0001, 0.0005, 0.002, 0.005, 0.01, 0.03, 0.1], dense)

    def __len__(self) -> int:
        return len(self.starts)

    def _hashes(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the folded token, hash of its first four bytes) of tokens first..last-1."""
        s, e = self.starts[first:last], self.stops[first:last]
        lo, hi = (s[0], e[-1]) if len(s) else (0, 0)
        pad = np.concatenate([np.zeros(8, np.uint8), self.data[lo:hi], np.zeros(8, np.uint8)])
        size = (e - s).astype(np.uint64)
        raw = np.ndarray((len(pad) - 7,), "<u8", np.ascontiguousarray(pad), strides=(1,))
        fold = np.ndarray((len(pad) - 7,), "<u8", np.ascontiguousarray(_FOLD[pad]), strides=(1,))
        short = np.minimum(size, np.uint64(8))
        keep = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * short)
        head = fold[s - lo + 8] & keep
        tail = np.where(size > 8, fold[e - lo], np.uint64(0))
        prefix = raw[s - lo + 8] & keep & np.uint64(0xFFFFFFFF)
        return _mixed(head ^ _mixed(tail + size)), _mixed(prefix)

    def random_looking(self) -> np.ndarray:
        """Tokens of at least LONG bytes that hold both letters and digits: they may be secrets."""
        at = np.flatnonzero(self.stops - self.starts >= LONG)
        out = np.zeros(len(self), bool)
        for i in at.tolist():
            own = self.data[self.starts[i]:self.stops[i]]
            out[i] = _DIGIT[own].any() and (_LOWER | _UPPER)[own].any()
        return out

    def features(self, first: int, last: int) -> np.ndarray:
        """(last - first) x kinds feature numbers."""
        n, total = last - first, len(self)
        out = np.empty((n, len(SIZES)), np.int32)
        if not n:
            return out
        lead, trail = max(first - 2, 0), min(last + 1, total)
        words, prefixes = self._hashes(lead, trail)
        doc = self.doc[lead:trail]

        def beside(shift: int) -> np.ndarray:
            """Hash of the token ``shift`` places away in the same text, 0 where there is none."""
            at = np.arange(first - lead, last - lead) + shift
            there = (at >= 0) & (at < len(words))
            at = np.where(there, at, 0)
            return np.where(there & (doc[at] == self.doc[first:last]), words[at], np.uint64(0))

        s, e = self.starts[first:last], self.stops[first:last]
        lo = self.stops[first - 1] if first else 0
        hi = self.starts[last] if last < total else self.n
        local = self.data[lo:hi]
        # Gap, token, gap, token, ..., gap: the marks of each stretch.
        cuts = np.empty(2 * n + 1, np.int64)
        cuts[0], cuts[1::2], cuts[2::2] = lo, s, e
        marks = _MARKS[local]
        stretches = np.bitwise_or.reduceat(np.append(marks, np.uint8(0)), cuts - lo)
        empty = np.append(np.diff(cuts), hi - cuts[-1]) == 0
        stretches[empty] = 0
        made, gaps = stretches[1::2].astype(np.int64), stretches[0::2].astype(np.int64) & 31
        own = self.doc[first:last]
        before = np.where(np.append(self.doc[first - 1] if first else -1, own[:-1]) == own, gaps[:-1], _EDGE)
        after = np.where(np.append(own[1:], self.doc[last] if last < total else -1) == own, gaps[1:], _EDGE)
        kinds = _CLASS[local]
        digits = np.concatenate([[0], np.cumsum(_DIGIT[local], dtype=np.int32)])
        changes = np.concatenate([[0, 0], np.cumsum(kinds[1:] != kinds[:-1], dtype=np.int32)])
        size = e - s
        length = np.searchsorted(LENGTHS, size, "right")
        n_digits = digits[e - lo] - digits[s - lo]
        switches = np.minimum(changes[e - lo] - changes[s - lo + 1], 7)
        previous = beside(-1)
        columns = {"shape": made * 11 + length, "made": made * 2 + (size >= LONG), "switches": switches * 11 + length,
                   "digits": (10 * n_digits // np.maximum(size, 1)) * 2 + ((made & 32) == 0),
                   "prefix": prefixes[first - lead:last - lead] % np.uint64(4096), "before": previous % np.uint64(8192), "after": beside(1) % np.uint64(8192),
                   "before2": beside(-2) % np.uint64(8192), "before_gap": _mixed(previous + before.astype(np.uint64)) % np.uint64(8192),
                   "gap_before": before, "gap_after": after, "file_length": self.file_length[own], "file_mix": self.file_mix[own]}
        for k, (name, values) in enumerate(columns.items()):
            out[:, k] = values.astype(np.int64) + STARTS[name]
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)


def emissions(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """n x 3 scores of the tags."""
    out = weights[features[:, 0]]
    for k in range(1, features.shape[1]):
        out += weights[features[:, k]]
    return out


def viterbi(scores: np.ndarray, moves: np.ndarray, closed: bool) -> list[int]:
    """Best tags of a stretch that follows an O (or a text's start); ``closed`` if an O follows it too."""
    step = moves.tolist()
    best, back = [s + m for s, m in zip(scores[0].tolist(), step[O])], []
    for row in scores[1:].tolist():
        came = [max(range(3), key=lambda p: best[p] + step[p][t]) for t in range(3)]
        best = [best[came[t]] + step[came[t]][t] + row[t] for t in range(3)]
        back.append(came)
    if closed:
        best = [b + step[t][O] for t, b in enumerate(best)]
    tags = [max(range(3), key=lambda t: best[t])]
    for came in reversed(back):
        tags.append(came[tags[-1]])
    return tags[::-1]


def certain(scores: np.ndarray, follows: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Tokens that are O on every best path. Setting such a token to O (and an I after it to B) changes at
    most three moves, which ``bound`` limits, and the next token's I by what B lacks.

    ``follows`` is how far I is above B for the next token of the same text (0 if none)."""
    real = moves[moves > FORBIDDEN / 2]
    bound = 3 * (real.max() - real.min())
    return scores[:, O] - scores[:, 1:].max(1) > bound + np.maximum(follows, 0) + 1e-3


def decode(tokens: Tokens, weights: np.ndarray, moves: np.ndarray, chunk: int = 200_000) -> np.ndarray:
    """Tags of all tokens. Between two tokens that are certainly O the best tags do not depend on the rest
    of the text, so only those stretches are searched; a stretch may go on over chunks."""
    n = len(tokens)
    tags = np.zeros(n, np.uint8)
    held_at, held = 0, np.empty((0, 3), np.float64)

    def settle(at: int, rows: np.ndarray) -> None:
        stop = at + len(rows)
        closed = stop < n and tokens.doc[stop] == tokens.doc[at]
        tags[at:stop] = viterbi(rows, moves, closed)

    for first in range(0, n, chunk):
        last = min(first + chunk, n)
        reach = min(last + 1, n)
        scores = emissions(weights, tokens.features(first, reach)).astype(np.float64)
        gain = np.zeros(last - first)
        nxt = scores[1:last - first + 1]
        same = tokens.doc[first + 1:first + 1 + len(nxt)] == tokens.doc[first:first + len(nxt)]
        gain[:len(nxt)] = np.where(same, nxt[:, I] - nxt[:, B], 0)
        scores = scores[:last - first]
        open_ = np.flatnonzero(~certain(scores, gain, moves))
        if len(open_) == 0:
            if len(held):
                settle(held_at, held)
                held = held[:0]
            continue
        doc = tokens.doc[first:last]
        new = np.flatnonzero((np.diff(open_) > 1) | (doc[open_[1:]] != doc[open_[:-1]])) + 1
        for part in np.split(open_, new):
            at, rows = first + int(part[0]), scores[part]
            if len(held):
                if held_at + len(held) == at and tokens.doc[at] == tokens.doc[held_at]:
                    at, rows = held_at, np.concatenate([held, rows])
                else:
                    settle(held_at, held)
                held = held[:0]
            if at + len(rows) == last and last < n:
                held_at, held = at, rows
            else:
                settle(at, rows)
    if len(held):
        settle(held_at, held)
    return tags


def expected(scores: np.ndarray, moves: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log of the summed weight of all paths, chances of the tags, summed chances of the moves) of padded
    windows (windows x width x 3, each after an O): forward and backward recursions over all at once."""
    count, width, _ = scores.shape
    rows, real = np.arange(count), np.arange(width)[None, :] < sizes[:, None]
    forward, backward = np.empty((width, count, 3)), np.zeros((width, count, 3))
    forward[0] = scores[:, 0] + moves[O]
    for t in range(1, width):
        x = forward[t - 1][:, :, None] + moves[None]
        top = x.max(1)
        forward[t] = top + np.log(np.exp(x - top[:, None]).sum(1)) + scores[:, t]
    for t in range(width - 2, -1, -1):
        x = (scores[:, t + 1] + backward[t + 1])[:, None, :] + moves[None]
        top = x.max(2)
        backward[t] = np.where(real[:, t + 1, None], top + np.log(np.exp(x - top[:, :, None]).sum(2)), 0.0)
    at_end = forward[sizes - 1, rows]
    top = at_end.max(1)
    total = top + np.log(np.exp(at_end - top[:, None]).sum(1))
    chance = np.exp(np.minimum(forward.transpose(1, 0, 2) + backward.transpose(1, 0, 2) - total[:, None, None], 0)) * real[:, :, None]
    moved = np.zeros((3, 3))
    moved[O] += chance[:, 0].sum(0)
    for t in range(1, width):
        pair = forward[t - 1][:, :, None] + moves[None] + (scores[:, t] + backward[t])[:, None, :] - total[:, None, None]
        moved += (np.exp(np.minimum(pair, 0)) * real[:, t, None, None]).sum(0)
    return total, chance, moved


def loss_and_slopes(weights: np.ndarray, moves: np.ndarray, features: np.ndarray, tags: np.ndarray, sizes: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log-likelihood of padded windows (windows x width x kinds) and its slopes. A token tagged
    UNKNOWN may have any tag: the likelihood sums over them."""
    count, width = tags.shape
    scores = emissions(weights, features.reshape(-1, features.shape[2])).reshape(count, width, 3).astype(np.float64)
    allowed = (tags[:, :, None] == np.arange(3)) | (tags[:, :, None] == UNKNOWN)
    total, chance, moved = expected(scores, moves, sizes)
    known, gold, gold_moved = expected(np.where(allowed, scores, FORBIDDEN), moves, sizes)
    real = (np.arange(width)[None, :] < sizes[:, None]).reshape(-1)
    flat, used = (chance - gold).reshape(-1, 3)[real], features.reshape(-1, features.shape[2])[real]
    slope = np.stack([np.bincount(used.reshape(-1), np.repeat(flat[:, k], used.shape[1]), len(weights)) for k in range(3)], 1)
    return float((total - known).sum()), slope, moved - gold_moved


def trained(features: np.ndarray, tags: np.ndarray, sizes: np.ndarray, steps: int = 240, batch: int = 128, penalty: float = 1e-4, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """(weights, moves) by Adam over batches of shuffled windows."""
    weights, moves = np.zeros((TABLE, 3)), np.zeros((3, 3))
    moves[O, I] = FORBIDDEN
    state, draw, order = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, moves)], np.random.default_rng(11), np.zeros(0, int)
    for step in range(1, steps + 1):
        if not len(order):
            order = draw.permutation(len(sizes))
        pick, order = order[:batch], order[batch:]
        _, *slopes = loss_and_slopes(weights, moves, features[pick], tags[pick], sizes[pick])
        for (m, v), value, slope in zip(state, (weights, moves), slopes):
            slope = slope / len(pick) + penalty * np.where(value > FORBIDDEN / 2, value, 0)
            m[:] = 0.9 * m + 0.1 * slope
            v[:] = 0.99 * v + 0.01 * slope**2
            value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        moves[O, I] = FORBIDDEN
    return weights.astype(np.float32), moves
