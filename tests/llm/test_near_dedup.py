import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import LONG, awkward, documents, empty
from trolley.llm import graph, near_dedup as N
from trolley.llm.graph import components
from trolley.llm.shingles import shingle_sets

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(zip(*[words[i:] for i in range(width)])) if len(words) >= width else frozenset([tuple(words)] if words else [])


def brute(rows, width, percent=80):
    """doc_id -> (set size, component), by comparing all pairs."""
    own = {}
    for i, text in rows:
        own.setdefault(i, sets(text, width))
    lead = {i: i for i in own}

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    for a, b in itertools.combinations(sorted(own), 2):
        x, y = own[a], own[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y) and find(a) != find(b):
            lead[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(own[i]), find(i)) for i in own}


def check(docs, width, **options):
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None], width)
    rows = N.near_duplicates(docs, width=width, **options).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_documents(spark, width):
    check(documents(spark), width)


def test_awkward_rows(spark):
    check(awkward(spark), 2)
    assert N.near_duplicates(empty(spark)).count() == 0


def test_hot_group_in_blocks(spark, monkeypatch):
    """Near copies of one text, many of them just outside the threshold: joined pairs and blocks."""
    draw, base = np.random.default_rng(4), [f"w{i}" for i in range(60)]
    rows = []
    for i in range(240):
        words = list(base)
        for at in draw.choice(60, draw.integers(0, 6), replace=False):
            words[at] = f"x{draw.integers(0, 40)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = check(docs, 2)
    monkeypatch.setattr(N, "SMALL", 3)
    monkeypatch.setattr(N, "BLOCK", 16)
    assert sorted(map(tuple, check(docs, 2))) == sorted(map(tuple, want))


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    kept = N.deduplicated(docs)
    assert kept.columns == docs.columns
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], 5)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in want.values()})


def test_posterior_bound():
    looks = [25, 100, 200]
    for n, m in zip(looks, N.least_matches(looks, 0.8, 1e-9)):
        grid = (np.arange(200_000) + 0.5) / 200_000
        density = grid**m * (1 - grid) ** (n - m)
        below = grid ** (m - 1) * (1 - grid) ** (n - m + 1)
        assert density[grid >= 0.8].sum() / density.sum() >= 1e-9 > below[grid >= 0.8].sum() / below.sum()


def test_shingles_of_long_words_and_texts(monkeypatch):
    from trolley.llm import shingles

    texts = ["", "One", "one two", "a" * 5000 + " b", LONG, " \t", "é É x", "tail "]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    found, bounds = shingle_sets(data, ends, 2)
    assert np.diff(bounds).tolist() == [len(sets(t, 2)) for t in texts]
    monkeypatch.setattr(shingles, "_CHUNK", 100)
    assert (shingle_sets(data, ends, 2)[0] == found).all()


@pytest.mark.parametrize("few", [0, 200_000])
def test_components_of_chains_and_stars(spark, monkeypatch, few):
    monkeypatch.setattr(graph, "FEW_LINKS", few)
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 300), (300, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 140)} | {200: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ids_sharing_a_row_number(spark):
    docs = spark.range(30).select((F.col("id") % 10).alias("doc_id"), F.concat(F.lit("same words in every row "), F.col("id") % 10).alias("text"))
    assert N.near_duplicates(docs, width=2).count() == 30
