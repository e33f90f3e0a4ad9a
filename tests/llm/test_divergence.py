import random
import re
from collections import Counter

import pytest

from tests.llm.helpers import SF, awkward, empty
from trolley.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, top=50):
    docs = [(lang or "", source or "", Counter(t.translate(LOWER) for t in TERM.findall(text or ""))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in d[2])
        kept = [t for t in df if df[t] >= least]

        def shares(chosen):
            n = Counter()
            for d in chosen:
                n.update(d[2])
            total = sum(n[t] for t in kept)
            return n, {t: 1 + 1_000_000_000 * (n[t] + 5) // (total + 5 * len(kept)) for t in kept}

        _, q = shares(mine)
        groups = {s: shares([d for d in mine if d[1] == s]) for s in {d[1] for d in mine}}
        for s, (n, p) in groups.items():
            pairs = [(o, sum(abs(p[t] - r[t]) for t in kept)) for o, (_, r) in groups.items() if o != s]
            terms = [(t, p[t] - q[t]) for t in kept if n[t] and p[t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(ranked if part == "pair" else ranked[:top], 1)]
    return sorted(out)


def got(df):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect())


def rows_of(df):
    return [(r["lang"], r["source"], r["text"]) for r in df.select("lang", "source", "text").collect()]


def corpus(spark):
    draw, words = random.Random(7), [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["Été", "été", "İx", "日本"]
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(0, 30))) + draw.choice(["", ".A-b c9d\x00e"]), draw.choice(["en", "de", None]),
             f"s{draw.choice([0, 0, 0, 1, 2, 3, 4, 5, 6])}" if i % 11 else None, "extra") for i in range(400)]
    return spark.createDataFrame(rows + [(9, "lone", "xx", "a", "e"), (9, None, "xx", "b", "e")], "doc_id long, text string, lang string, source string, term string")


@pytest.mark.parametrize("sizes", [{}, {"least": 2, "top": 3}])
def test_equals_brute_force(spark, sizes):
    docs = corpus(spark)
    assert got(D.audit(docs, sizes.get("least", 30), sizes.get("top", 50))) == brute(rows_of(docs), **sizes)


def test_small_blocks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(D.pair_rows, "__defaults__", (2, 5))
    monkeypatch.setattr(D.counted, "__defaults__", (10,))
    docs = corpus(spark)
    assert got(D.audit(docs, 3, 4)) == brute(rows_of(docs), 3, 4)


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    assert got(D.audit(docs, 1)) == brute(rows_of(docs), 1)
    assert D.audit(empty(spark)).count() == 0


def test_long_texts_are_cut_between_terms():
    text = ("alpha Beta,gamma " * 5000 + "x" * 3000).encode()
    found = [t for part in D.tokens(text, 100) for t in part if t]
    assert found == text.decode().lower().replace(",", " ").encode().split()


def test_skyband_equals_counting_all_dominators():
    draw = random.Random(5)
    rows = sorted({(-draw.randint(0, 30), draw.randint(0, 30), f"t{draw.randint(0, 400)}".encode()) for _ in range(1500)})
    band = D.Skyband(4)
    kept = [r for r in rows if band.stays(r[1], r[2])]
    def dominated(r):
        return sum(o[0] <= r[0] and o[1] <= r[1] and o[2] < r[2] for o in rows)
    assert kept == [r for r in rows if dominated(r) < 4]
    assert len(kept) < len(rows)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(D.op13_source_divergence(spark, SF)) == brute(rows_of(docs))
