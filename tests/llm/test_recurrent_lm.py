import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward, documents, empty
from trolley.llm import gru, recurrent_lm as R, shingles as S

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.01"


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), None]


def check_base(rows, docs, training):
    counts = Counter(t for text in training for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    got = sorted((r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows)
    want = []
    for text in docs:
        own = tokens(text)
        want.append((len(own), sum(counts[t] > 0 for t in own), n, round(sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own), 5)))
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], rel=1e-6)


def test_query_beats_the_base_on_held_out_texts(spark):
    docs = documents(spark, SF).select("doc_id", "text").collect()
    rows = R.op5_recurrent_lm(spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0) for r in rows)
    check_base(rows, [r["text"] for r in docs], [r["text"] for r in docs if zlib.crc32(str(r["doc_id"]).encode()) % 10])
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) and all(r["score"] < 0 for r in rows)


def test_awkward_rows_and_rare_words_by_join(spark):
    docs = awkward(spark)
    model = R.fit(docs, head=3, frequent=4, share=1.0)
    rows = R.score(docs, model).collect()
    texts = [r["text"] for r in docs.collect()]
    check_base(rows, texts, texts)
    by_id = {r["doc_id"]: r["score"] for r in rows if r["doc_id"] is not None}
    assert by_id[3] == pytest.approx(by_id[4]) and by_id[6] == pytest.approx(by_id[7]) and by_id[1] == pytest.approx(by_id[2])
    assert R.score(empty(spark), model).count() == 0


def test_learning_from_nothing(spark):
    model = R.fit(empty(spark))
    rows = R.score(awkward(spark), model).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and np.isfinite(r["score"]) for r in rows)


def test_probabilities_of_all_words_and_unseen_sum_to_one(spark):
    """P(class) P(word | class) over all known words, plus one unseen word per tail class."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c a b", "b c d e f g", "xy xz yy a"] * 3)], "doc_id long, text string")
    model = R.fit(docs, head=4, frequent=6, share=1.0)
    seen = sorted({t for r in docs.collect() for t in WORD.findall(r["text"])})
    probe = spark.createDataFrame([(i, w) for i, w in enumerate([*seen, ""])], "doc_id long, text string")
    first = {r["doc_id"]: r["score"] for r in R.score(probe, model).collect()}
    ends = gru.log_chances(model.weights, model.layout, [np.array([s, model.words.end], np.int32) for s in range(model.layout.head + R.TAILS)], model.words.end)
    starts = gru.log_chances(model.weights, model.layout, [np.array([s], np.int32) for s in range(model.layout.head + R.TAILS)], model.words.end)
    assert np.exp(starts).sum() == pytest.approx(1, abs=1e-4)
    data = np.frombuffer("".join(seen).encode(), np.uint8)
    found, tail, _ = R.hashed(data, np.cumsum([0, *[len(w) for w in seen]]))
    symbol, _ = R.symbols(model.words, found, tail)
    inside = [10 ** (first[i] - (ends[s]) / math.log(10)) * (s >= model.layout.head) for i, s in enumerate(symbol)]
    for s in {s for s in symbol if s >= model.layout.head}:
        unseen = 0.1 / 10 ** model.words.tail_log[s - model.layout.head]
        assert sum(x for x, t in zip(inside, symbol) if t == s) + unseen == pytest.approx(1, abs=1e-3)


def test_gradient_and_carried_state():
    draw = np.random.default_rng(0)
    layout = gru.equal_mass(np.array([9.0, 5, 4, 3, 2, 1]), 3, 2)
    weights = gru.initial(layout, np.arange(6.0), np.arange(float(layout.classes)), 5, 1)
    weights = {k: (v + draw.normal(0, 0.3, v.shape)).astype(np.float64) for k, v in weights.items()}
    docs = [np.array([1, 6, 2, 3, 0], np.int32), np.array([4, 5, 0], np.int32), np.array([0], np.int32)]
    whole = gru.log_chances(weights, layout, docs, 0, width=1, steps=100)
    for width, steps in ((1, 2), (2, 1), (3, 4)):
        assert np.allclose(gru.log_chances(weights, layout, docs, 0, width=width, steps=steps), whole, atol=1e-4)
    slopes = {}
    trainer = gru.Trainer(weights, layout, 0, 0.1)
    trainer._move = lambda name, slope, rows=slice(None): slopes.setdefault(name, []).append((rows, slope))
    trainer.train(docs, 3, 100)
    n = sum(map(len, docs))
    for name in weights:
        full = np.zeros(weights[name].shape)
        for rows, slope in slopes[name]:
            full[rows] += slope
        at = np.unravel_index(np.argmax(np.abs(full)), full.shape)
        step = 1e-3
        up, down = ({**weights, name: weights[name].copy()} for _ in range(2))
        up[name][at] += step
        down[name][at] -= step
        numeric = -(gru.log_chances(up, layout, docs, 0).sum() - gru.log_chances(down, layout, docs, 0).sum()) / (2 * step) / n
        assert full[at] == pytest.approx(numeric, rel=0.03, abs=1e-4), name


def test_replicas_average_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(R, "REPLICA_TOKENS", 2_000)
    docs = documents(spark).repartition(12)
    model = R.fit(docs, head=200, share=1.0, rounds=1)
    rows = R.score(docs, model).agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert rows["s"] > rows["b"]


def test_every_training_document_is_trained_on_once(spark, monkeypatch):
    """Null and repeated ids included; by the query's own defaults."""
    docs = documents(spark).select("doc_id", "text").unionByName(awkward(spark).select("doc_id", "text"))
    seen, trained = [], R.trained

    def noted(rows, *more):
        seen.extend(r["text"] for r in rows.select("text").collect())
        return trained(rows, *more)

    monkeypatch.setattr(R, "trained", noted)
    R.fit(docs)
    assert Counter(seen) == Counter(r["text"] or "" for r in docs.collect())


def test_a_token_meets_few_words_of_its_class():
    counts = 1e7 / np.arange(1, 4097)
    layout = gru.equal_mass(counts, 32, 4)
    assert layout.head == 4096 and len(layout.cuts) <= 33
    assert (np.diff(layout.cuts) * np.add.reduceat(counts, layout.cuts[:-1])).sum() / counts.sum() < 70


@pytest.mark.parametrize("size", [0.3, 30.0])  # scores within the bounds, and far beyond
def test_chances_equal_plain_softmaxes(size):
    draw = np.random.default_rng(1)
    layout = gru.Layout(np.array([0, 1, 4, 9]), 3)
    weights = gru.initial(layout, np.arange(9.0), np.arange(6.0), 4, 1)
    weights = {k: (v + draw.normal(0, size if k.startswith("to_") else 0.3, v.shape)).astype(np.float32) for k, v in weights.items()}
    assert gru.shifted(weights["to_word"], weights["word_bias"], layout.cuts[:-1])[1] == [size < 1] * 3
    docs = [np.append(draw.integers(0, 12, n), 0).astype(np.int32) for n in (9, 5, 1)]  # each with the end symbol
    want = []
    for doc in docs:
        h, total, last = np.zeros(4), 0.0, 0
        for symbol in doc:
            h = h * (last != 0)
            a = h @ weights["state"]
            z, r = 1 / (1 + np.exp(-(weights["inputs"][:2, last] + a[:2])))
            h = h + z * (np.tanh(weights["inputs"][2, last] + r * a[2]) - h)
            k = int(layout.class_of(symbol))
            scores = h @ weights["to_class"] + weights["class_bias"]
            total += scores[k] - np.logaddexp.reduce(scores)
            if symbol < 9:
                own = np.arange(layout.cuts[k], layout.cuts[k + 1])
                scores = weights["to_word"][own] @ h + weights["word_bias"][own]
                total += scores[symbol - own[0]] - np.logaddexp.reduce(scores)
            last = symbol
        want.append(total)
    assert np.allclose(gru.log_chances(weights, layout, docs, 0, 2, 3), want, rtol=1e-3, atol=1e-3)


def test_hashes_are_found_whatever_their_upper_bits():
    draw = np.random.default_rng(2)
    known = np.unique(np.concatenate([draw.integers(0, 2**63, 50).astype(np.uint64), np.arange(40, dtype=np.uint64), np.uint64(2**64 - 1) - np.arange(40, dtype=np.uint64)]))
    v = R.Vocabulary(known[:1], known, known, known, known, 0, 0)
    probe = np.concatenate([known, known + np.uint64(1), known - np.uint64(1)])
    place = {int(k): i for i, k in enumerate(known)}
    assert v.find(probe).tolist() == [place.get(int(k), -1) for k in probe]


def test_word_hashes_of_short_and_very_long_words():
    texts = [b"a Bc a", b"x" * 70_000 + b" y", b"q " * 40_000, b"", b"Zz"]
    ends = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts, stops = S.words(data, ends)
    found = S.word_hashes(data, starts, stops)
    odd, mask = int(S._ODD), (1 << 64) - 1
    for i in {0, 1, 2, 3, 4, 5, 35_000, len(starts) - 1}:
        value = sum(int(S._BYTE[b]) * pow(odd, j + 1, 1 << 64) for j, b in enumerate(bytes(data[starts[i]:stops[i]]).lower())) & mask
        assert found[i] == S.mix(np.array([value], np.uint64) + np.uint64(stops[i] - starts[i]))[0]


def test_lanes_wait_for_more_documents():
    """Every token is trained on once, from the state its document had reached, in fewer windows than call by call."""
    draw = np.random.default_rng(2)
    layout = gru.equal_mass(np.array([9.0, 5, 4, 3, 2, 1]), 3, 2)
    weights = gru.initial(layout, np.arange(6.0), np.arange(float(layout.classes)), 5, 1)
    pieces = [[np.append(draw.integers(1, 8, n), 0).astype(np.int32) for n in draw.permutation([90, 60, *draw.integers(0, 30, 40)])] for _ in range(3)]

    def run(calls):
        trainer, seen = gru.Trainer(weights, layout, 0, 0.0), []  # at rate 0 the weights stay
        step = trainer._step

        def noted(target, before, states, *more):
            seen.append([(b, *s.round(4)) for t, b, s in zip(target.ravel(), before.ravel(), states.reshape(-1, states.shape[2])) if t >= 0])
            step(target, before, states, *more)

        trainer._step = noted
        for documents, more in calls:
            trainer.train(documents, 16, 4, more)
        assert not trainer.held and trainer.tokens == sum(map(len, sum(pieces, [])))
        return len(seen), sorted(sum(seen, []))

    windows, places = run([(p, False) for p in pieces])
    fewer, carried = run([*((p, True) for p in pieces), ([], False)])
    assert fewer < windows and np.allclose(places, carried, atol=2e-4)
    long = [np.append(np.ones(3000, int), 0).astype(np.int32)]  # too long a rest would leave the next call few lanes
    trainer = gru.Trainer(weights, layout, 0, 0.1)
    trainer.train(pieces[0] + long, 16, 4, more=True)
    assert sum(len(rest) for rest, _, _ in trainer.held) <= 2 * sum(map(len, pieces[0] + long)) / 16


def test_sums_per_symbol():
    draw = np.random.default_rng(3)
    for n, kinds in ((5000, 900), (300, 3), (40, 40), (17, 1), (16, 1), (15, 1), (1, 1)):
        symbols, values = np.minimum(draw.zipf(1.3, n) - 1, kinds - 1).astype(np.uint16), draw.normal(size=(3, n, 4))
        found, sums = gru.summed(values, symbols)
        assert sorted(found) == sorted(set(symbols)) and np.allclose(sums, np.stack([values[:, symbols == s].sum(1) for s in found], 1))


def test_tail_classes_share_one_output_class(spark):
    """A token meets the classes and the words of its own class; a class for each tail class would be met by every token."""
    model = R.fit(documents(spark))
    layout = model.layout
    assert layout.tails == R.TAILS and layout.classes == model.weights["to_class"].shape[1] <= R.CLASSES + 1
    counts = np.append(1e7 / np.arange(1, 4097), np.full(R.TAILS, 1e6))  # four tokens of ten in the tail
    layout = gru.equal_mass(counts[:4096], R.CLASSES, R.TAILS, joint=True)
    inside = np.diff(layout.runs)[layout.of_symbol]
    assert layout.classes + (inside * counts).sum() / counts.sum() < 105  # 96 + 43 with a class each


@pytest.mark.parametrize("size", [0.3, 30.0])
def test_joint_tails_chances_and_gradient(size):
    draw = np.random.default_rng(4)
    layout = gru.Layout(np.array([0, 1, 4, 9]), 3, joint=True)
    assert layout.classes == 4 and layout.of_symbol.tolist() == [0, 1, 1, 1, 2, 2, 2, 2, 2, 3, 3, 3]
    weights = gru.initial(layout, np.arange(12.0), np.arange(4.0), 4, 1)
    weights = {k: v + draw.normal(0, size if k.startswith("to_") else 0.3, v.shape) for k, v in weights.items()}
    starts = gru.log_chances(weights, layout, [np.array([s], np.int32) for s in range(12)], 0)
    assert np.exp(starts).sum() == pytest.approx(1, abs=1e-6)
    docs = [np.append(draw.integers(1, 12, n), 0).astype(np.int32) for n in (9, 5, 1)]
    slopes = {k: np.zeros(v.shape) for k, v in weights.items()}
    trainer = gru.Trainer(weights, layout, 0, 0.1)
    trainer._move = lambda name, slope, rows=slice(None): np.add.at(slopes[name], rows, slope)
    trainer.train(docs, 3, 100)
    n = sum(map(len, docs))
    for name, full in slopes.items():
        at = np.unravel_index(np.argmax(np.abs(full)), full.shape)
        up, down = ({**weights, name: weights[name].copy()} for _ in range(2))
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        numeric = -(gru.log_chances(up, layout, docs, 0).sum() - gru.log_chances(down, layout, docs, 0).sum()) / 2e-5 / n
        assert full[at] == pytest.approx(numeric, rel=1e-3, abs=1e-6), name


def test_moved_rows_are_those_of_the_symbols():
    draw = np.random.default_rng(5)
    layout = gru.Layout(np.array([0, 1, 4, 9]), 3, joint=True)
    weights = gru.initial(layout, np.arange(12.0), np.arange(4.0), 4, 1)
    trainer = gru.Trainer(weights, layout, 0, 0.1)
    symbols, slope = np.array([7, 2, 11], np.uint16), draw.normal(size=(3, 3, 4)).astype(np.float32)
    trainer._move("inputs", slope, (slice(None), symbols))
    want = weights["inputs"].copy()
    want[:, symbols] -= np.float32(0.1) * slope / np.sqrt(np.float32(1e-6) + slope * slope)
    assert np.allclose(trainer.p["inputs"], want, atol=1e-6)


def test_word_bounds_at_every_byte():
    data = np.arange(256, dtype=np.uint8)
    starts, stops = S.words(data, np.array([0, 256]))
    assert list(zip(starts.tolist(), stops.tolist())) == [(0, 9), (14, 32), (33, 256)]
