"""A gated recurrent language model in numpy with a class-factored output softmax.

Symbols are the head words (by falling frequency) followed by the tail classes, which stand for all
other words. Output classes are runs of head words (few frequent ones or more rare ones), then one class per tail
class, or one for all of them with the tail classes as its words: P(word) = P(class | state) * P(word | class, state).
Inside a tail class the caller goes on with counts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np


@dataclass(frozen=True)
class Layout:
    """Which output class a symbol belongs to."""

    cuts: np.ndarray  # head class k holds head words cuts[k] to cuts[k + 1]
    tails: int
    joint: bool = False  # all tail classes are the words of one output class

    @property
    def head(self) -> int:
        return int(self.cuts[-1])

    @property
    def classes(self) -> int:
        return len(self.runs) - 1 + (0 if self.joint else self.tails)

    @cached_property
    def runs(self) -> np.ndarray:
        """Class k of those that hold words has the symbols runs[k] to runs[k + 1]."""
        return np.append(self.cuts, self.head + self.tails) if self.joint else self.cuts

    @property
    def inner(self) -> int:
        """The number of symbols that are words of a class."""
        return int(self.runs[-1])

    def class_of(self, symbol: np.ndarray) -> np.ndarray:
        inside = np.searchsorted(self.runs, symbol, "right") - 1
        return np.where(symbol < self.inner, inside, symbol - self.inner + len(self.runs) - 1)

    @cached_property
    def of_symbol(self) -> np.ndarray:
        """The class of each symbol."""
        return self.class_of(np.arange(self.head + self.tails)).astype(np.int16)


def equal_mass(counts: np.ndarray, classes: int, tails: int, joint: bool = False) -> Layout:
    """Cut falling counts into at most ``classes`` runs of about equal total of their square roots, which
    makes the words of a token's class, summed over all tokens, about as few as any cuts do."""
    weight = np.sqrt(counts)
    share = np.cumsum(weight) / max(weight.sum(), 1)
    number = np.minimum((share - weight / max(weight.sum(), 1) / 2) * classes, classes - 1).astype(int)
    starts = np.flatnonzero(np.diff(number, prepend=-1) > 0)
    return Layout(np.append(starts, len(counts)), tails, joint)


def initial(layout: Layout, word_counts: np.ndarray, class_counts: np.ndarray, hidden: int, seed: int) -> dict[str, np.ndarray]:
    """Random small weights; the biases start at the counted frequencies."""
    draw = np.random.default_rng(seed)
    symbols = layout.head + layout.tails
    return {
        "inputs": draw.normal(0, 0.3, (3, symbols, hidden)).astype(np.float32),  # of the gates z and r and of the new value
        "state": draw.normal(0, 0.5 / np.sqrt(hidden), (3, hidden, hidden)).astype(np.float32),
        "to_class": np.zeros((hidden, layout.classes), np.float32),
        "class_bias": np.log(class_counts + 0.5).astype(np.float32),
        "to_word": np.zeros((layout.inner, hidden), np.float32),
        "word_bias": np.log(word_counts + 0.5).astype(np.float32),
    }


def lanes(documents: list[np.ndarray], width: int, begun: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Deal documents (symbols, the end symbol last) to lanes, longest first to the shortest lane. The first
    ``begun`` documents are the rests of lanes that were left; each is the first of a lane.

    (symbols, document numbers, lane lengths); a column per lane, -1 below its end, and lanes by
    falling length, so the active ones are always the first. A document far longer than the rest takes
    fewer lanes, so the table holds at most about twice the symbols there are.
    """
    longest = max(map(len, documents))
    load = [(0, i) for i in range(max(begun, min(width, len(documents), -(-2 * sum(map(len, documents)) // longest))))]
    dealt: list[list[int]] = [[] for _ in load]
    for d in sorted(range(len(documents)), key=lambda d: (d >= begun, -len(documents[d]), d)):
        length, i = heapq.heappop(load)
        dealt[i].append(d)
        heapq.heappush(load, (length + len(documents[d]), i))
    order = [i for _, i in sorted(load, key=lambda x: (-x[0], x[1]))]
    lengths = np.array([n for n, _ in sorted(load, key=lambda x: (-x[0], x[1]))])
    symbols = np.full((len(order), int(lengths[0])), -1, np.int32)
    owner = np.full(symbols.shape, -1, np.int32)
    for lane, i in enumerate(order):
        at = 0
        for d in dealt[i]:
            symbols[lane, at:at + len(documents[d])] = documents[d]
            owner[lane, at:at + len(documents[d])] = d
            at += len(documents[d])
    return np.ascontiguousarray(symbols.T), np.ascontiguousarray(owner.T), lengths


def windows(p: dict[str, np.ndarray], symbols: np.ndarray, lengths: np.ndarray, end: int, steps: int, keep: bool = False,
            begun: tuple[np.ndarray, list, list] | None = None) -> Iterator[tuple]:
    """Run all lanes, ``steps`` positions at a time, the state carried from window to window and
    cleared where a document begins. ``begun``: lanes that go on with a rest, their states and the symbols before.
    Yields (first row, lanes, inputs, states[, what backpropagation needs]);
    the last column of the states is 1 and belongs to the biases."""
    hidden = p["state"].shape[1]
    state = np.zeros((symbols.shape[1], hidden), p["state"].dtype)
    signs = np.array([-1, -1, 1], state.dtype)[:, None, None]  # a gate is 1 / (1 + exp(-what was added up))
    if begun is not None:
        state[begun[0]] = begun[1]
    for first in range(0, len(symbols), steps):
        last, width = min(first + steps, len(symbols)), int((lengths > first).sum())
        before = np.full((last - first, width), end, np.int32)
        before[int(first == 0):] = symbols[max(first - 1, 0):last - 1, :width]
        if not first and begun is not None:
            before[0, begun[0]] = begun[2]
        before = np.maximum(before, 0)
        fed, fresh = np.take(p["inputs"], before, 1), [np.flatnonzero(x) for x in before == end]
        states, h = np.ones((last - first, width, hidden + 1), state.dtype), state[:width]
        olds, turned, kept = np.empty((last - first, width, hidden), state.dtype), p["state"] * signs, None
        if keep:
            kept = (olds, fed, np.empty_like(olds))
        for t in range(last - first):
            old = olds[t]
            old[:] = h
            old[fresh[t]] = 0
            a, gates, new = np.matmul(old, turned), fed[:2, t], fed[2, t]
            np.subtract(a[:2], gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            if keep:
                kept[2][t] = a[2]
            a[2] *= gates[1]
            new += a[2]
            np.tanh(new, out=new)
            h = new - old
            h *= gates[0]
            h += old
            states[t, :, :hidden] = h
        state = h
        yield (first, width, before, states, fresh, kept)


def shifted(weights: np.ndarray, bias: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[bool]]:
    """(weights with the bias as last column, per group of rows whether exp() of its scores needs no look at each token).

    A state's entries lie in -1 to 1, which bounds every score, and the largest of a group from below; one
    shift of all scores to the middle of these bounds serves if they are not too far apart."""
    out = np.empty((len(weights), weights.shape[1] + 1), weights.dtype)
    out[:, :-1] = weights
    reach = np.abs(weights) @ np.ones(weights.shape[1], weights.dtype)
    high, low = np.maximum.reduceat(bias + reach, starts), np.maximum.reduceat(bias - reach, starts)
    out[:, -1] = bias - np.repeat((high + low) / 2, np.diff(starts, append=len(weights)))
    return out, (high - low < 80).tolist()


@cache
def ones(n: int, kind: np.dtype) -> np.ndarray:
    return np.ones(n, kind)


def exponents(logits: np.ndarray, bounded: bool) -> tuple[np.ndarray, np.ndarray | float]:
    """exp(logits) in place and the sum of each row."""
    if not bounded:
        logits -= logits.max(1, keepdims=True)
    np.exp(logits, out=logits)
    return logits, logits @ ones(logits.shape[1], logits.dtype)


def targets(layout: Layout, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places that hold a symbol, their classes), ordered by class."""
    real = np.flatnonzero(target >= 0)
    classes = layout.of_symbol[target[real]]
    order = np.argsort(classes, kind="stable")  # a radix sort
    return real[order], classes[order]


def by_class(layout: Layout, classes: np.ndarray, symbols: np.ndarray) -> Iterator[tuple[int, slice, slice, np.ndarray]]:
    """(class, its words, rows, the places of their symbols in a flat table of these rows and words) of each class
    of more than one word; classes must not fall."""
    bounds = np.searchsorted(classes, np.arange(len(layout.runs), dtype=classes.dtype))
    own, last = classes[:bounds[-1]], int(bounds[-1])
    places = np.arange(last) - np.take(bounds, own)
    places *= np.take(np.diff(layout.runs), own)
    places += symbols[:last] - np.take(layout.runs, own)
    runs, bounds = layout.runs.tolist(), bounds.tolist()
    for k in range(len(runs) - 1):
        if bounds[k + 1] > bounds[k] and runs[k + 1] - runs[k] > 1:
            rows = slice(bounds[k], bounds[k + 1])
            yield k, slice(runs[k], runs[k + 1]), rows, places[rows]


def softmax_parts(states: np.ndarray, weights: np.ndarray, bounded: bool, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row's softmax the scores at the flat places and the sums of the exponents."""
    logits = states @ weights.T
    if not bounded:
        logits -= logits.max(1, keepdims=True)
    score = np.take(logits, places)
    return score, exponents(logits, True)[1]


def log_chances(p: dict[str, np.ndarray], layout: Layout, documents: list[np.ndarray], end: int, width: int = 256, steps: int = 32) -> np.ndarray:
    """Natural log-likelihood of each whole document (of a tail word: of its class)."""
    out = np.zeros(len(documents))
    if not documents:
        return out
    symbols, owner, lengths = lanes(documents, width)
    to_class, (bounded,) = shifted(p["to_class"].T, p["class_bias"], np.zeros(1, int))
    to_word, words_bounded = shifted(p["to_word"], p["word_bias"], layout.runs[:-1])
    for first, wide, _, states, _, _ in windows(p, symbols, lengths, end, steps):
        target = symbols[first:first + len(states), :wide].ravel()
        real, classes = targets(layout, target)
        states, target = np.take(states.reshape(-1, states.shape[2]), real, 0), target[real]
        found, total = softmax_parts(states, to_class, bounded, np.arange(len(real)) * len(to_class) + classes)
        inside = np.ones_like(total)
        for k, own, rows, places in by_class(layout, classes, target):
            score, inside[rows] = softmax_parts(states[rows], to_word[own], words_bounded[k], places)
            found[rows] += score
        found -= np.log(total)
        found -= np.log(inside)
        out += np.bincount(owner[first:first + symbols[first:first + steps].shape[0], :wide].ravel()[real], found, len(documents))
    return out


def summed(values: np.ndarray, symbols: np.ndarray, often: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """(different symbols, the sums of ``values[:, i]`` over the places i of each): frequent ones by a product each,
    the others by adding all first places, all second places and so on."""
    order = np.argsort(symbols, kind="stable")
    ascending = symbols[order]
    starts = np.flatnonzero(np.append(True, ascending[1:] != ascending[:-1]))
    counts = np.diff(starts, append=len(order))
    rank = np.minimum(counts, often).astype(np.int16)
    falling = np.argsort(-rank, kind="stable")
    starts, counts, rank = starts[falling], counts[falling], rank[falling]
    more = np.searchsorted(-rank, -np.arange(often + 1, dtype=np.int16), "left").tolist()  # symbols of more than r places
    many = more[often - 1]
    out = np.take(values, order[starts], 1)
    for r in range(1, often - 1):
        out[:, many:more[r]] += np.take(values, order[starts[many:more[r]] + r], 1)
    ones = np.ones((1, int(counts[:many].max(initial=0))), values.dtype)
    for i, (start, n) in enumerate(zip(starts[:many].tolist(), counts[:many].tolist())):
        out[:, i] = np.matmul(ones[:, :n], np.take(values, order[start:start + n], 1))[:, 0]
    return ascending[starts], out


def put_rows(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """table[at] = rows, each row copied as one value."""
    kind = f"V{rows.itemsize * rows.shape[1]}"
    np.put(table.view(kind), at, rows.view(kind))


class Trainer:
    """Truncated backpropagation through time with Adagrad, one window a step."""

    def __init__(self, p: dict[str, np.ndarray], layout: Layout, end: int, rate: float):
        self.p, self.layout, self.end, self.rate = {k: v.copy() for k, v in p.items()}, layout, end, rate
        self.sums = {k: np.full(v.shape, 1e-6, np.float32) for k, v in p.items()}
        self.tokens = self.fullest = 0
        self.held: list[tuple[np.ndarray, np.ndarray, int]] = []  # rest, state and symbol before of each lane that waits

    def _move(self, name: str, slope: np.ndarray, symbols: tuple | None = None) -> None:
        weights, sums = self.p[name], self.sums[name]
        if symbols is not None:  # (all gates, symbols): the rows of a flat table
            at = (np.arange(len(weights))[:, None] * weights.shape[1] + symbols[1]).ravel()
            weights, sums, slope = (x.reshape(-1, x.shape[2]) for x in (weights, sums, slope))
        total = sums if symbols is None else np.take(sums, at, 0)
        total += slope * slope
        step = np.sqrt(total)
        np.divide(slope, step, out=step)
        step *= self.rate
        if symbols is None:
            weights -= step
        else:
            put_rows(sums, at, total)
            put_rows(weights, at, np.take(weights, at, 0) - step)

    def train(self, documents: list[np.ndarray], width: int, steps: int, more: bool = False) -> None:
        """Train on the documents and on what waits. With ``more`` to come, lanes wait for the next call as soon
        as fewer than half are busy, unless a rest is too long to share all lanes with as many symbols again."""
        held, self.held = self.held, []
        documents = [*(rest for rest, _, _ in held), *documents]
        if not documents:
            return
        symbols, owner, lengths = lanes(documents, width, len(held))
        begun = np.flatnonzero(owner[0] < len(held))
        own = [held[i] for i in owner[0, begun]]
        share = 2 * sum(map(len, documents)) / width
        for first, wide, before, states, fresh, kept in windows(
                self.p, symbols, lengths, self.end, steps, True, (begun, [x[1] for x in own], [x[2] for x in own]) if own else None):
            self._step(symbols[first:first + len(states), :wide], before, states, fresh, kept)
            last = first + len(states)
            busy = int((lengths > last).sum())
            if more and 2 * busy < width and len(symbols) - last <= share:
                self.held = [(symbols[last:lengths[i], i].copy(), states[-1, i, :-1].copy(), int(symbols[last - 1, i])) for i in range(busy)]
                return

    def _step(self, target: np.ndarray, before: np.ndarray, states: np.ndarray, fresh: list[np.ndarray], kept: tuple) -> None:
        p, layout, hidden = self.p, self.layout, states.shape[2] - 1
        flat, (real, classes) = states.reshape(-1, hidden + 1), targets(layout, target.ravel())
        own, y = np.take(flat, real, 0), np.take(target, real)
        # A token weighs the same in every window: the last ones of a batch hold only the rest of its longest texts.
        self.fullest = max(self.fullest, len(real), 1)
        scale = np.float32(1 / self.fullest)
        # The error of a row is (exponents - their sum at the target) * scale / sum; the factor goes to the narrow side of each product.
        weights, (bounded,) = shifted(p["to_class"].T, p["class_bias"], np.zeros(1, int))
        wrong, total = exponents(own @ weights.T, bounded)
        wrong.reshape(-1)[np.arange(len(real)) * layout.classes + classes] -= total
        factor = (scale / total)[:, None]
        back = wrong @ weights[:, :hidden]
        back *= factor
        class_move = (own * factor).T @ wrong
        word_move = np.zeros((layout.inner, hidden + 1), own.dtype)
        weights, bounded = shifted(p["to_word"], p["word_bias"], layout.runs[:-1])
        for k, words, rows, places in by_class(layout, classes, y):
            error, total = exponents(own[rows] @ weights[words].T, bounded[k])
            error.reshape(-1)[places] -= total
            factor = (scale / total)[:, None]
            back[rows] += (error @ weights[words, :hidden]) * factor
            word_move[words] = error.T @ (own[rows] * factor)
        slope = np.zeros((len(flat), hidden), own.dtype)
        slope[real] = back
        slope = slope.reshape(*states.shape[:2], hidden)
        inputs, moved = self._back(slope, fresh, *kept)
        recurrent = (kept[0].reshape(-1, hidden).T @ moved.reshape(-1, 3 * hidden)).reshape(hidden, 3, hidden).transpose(1, 0, 2)
        self._move("to_class", class_move[:hidden])
        self._move("class_bias", class_move[hidden])
        self._move("to_word", np.ascontiguousarray(word_move[:, :hidden]))
        self._move("word_bias", word_move[:, hidden])
        self._move("state", recurrent)
        narrow = before.ravel().astype(np.uint16) if layout.head + layout.tails < 1 << 16 else before.ravel()
        symbol, per_symbol = summed(inputs.reshape(3, -1, hidden), narrow)
        self._move("inputs", per_symbol, (slice(None), symbol))
        self.tokens += len(real)

    def _back(self, slope: np.ndarray, fresh: list[np.ndarray], olds: np.ndarray, gates: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slopes of what the inputs and, side by side, of what the states added to both gates and the new value."""
        z, r, new = gates
        inputs = np.empty_like(gates)  # first the factors of the slopes, for all positions at once
        kept = 1 - z
        np.subtract(new, olds, out=inputs[0])
        inputs[0] *= z
        inputs[0] *= kept
        np.multiply(new, new, out=inputs[2])
        np.subtract(1, inputs[2], out=inputs[2])
        inputs[2] *= z
        np.subtract(1, r, out=inputs[1])
        inputs[1] *= r
        inputs[1] *= a
        inputs[1] *= inputs[2]
        hidden = slope.shape[2]
        moved, turned = np.empty((*slope.shape[:2], 3 * hidden), slope.dtype), self.p["state"].transpose(0, 2, 1).reshape(3 * hidden, hidden)
        carry = np.zeros_like(slope[0])
        for t in range(len(slope) - 1, -1, -1):
            carry += slope[t]
            inputs[:, t] *= carry
            own = moved[t]
            own[:, :hidden], own[:, hidden:2 * hidden] = inputs[0, t], inputs[1, t]
            np.multiply(inputs[2, t], r[t], out=own[:, 2 * hidden:])
            carry *= kept[t]
            carry += own @ turned
            carry[fresh[t]] = 0
        return inputs, moved


def pack(p: dict[str, np.ndarray]) -> bytes:
    return b"".join(p[k].tobytes() for k in sorted(p))


def unpack(data: bytes, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = np.frombuffer(data, np.float32, like[k].size, at).reshape(like[k].shape)
        at += like[k].nbytes
    return out
