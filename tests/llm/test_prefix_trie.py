import hashlib
import random
import zlib

import pytest

from tests.llm.helpers import SF
from trolley.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, depth string, k1 int, n_convs string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns, key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return own, out


def brute(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for key in nodes:
        if key:
            kids.setdefault(key[:-1], []).append(key)
    leaves, saved, out = {}, {}, []
    for key in sorted(nodes, key=len, reverse=True):
        below = kids.get(key, [])
        leaves[key] = sum(leaves[k] for k in below) or 1
        saved[key] = sum(saved[k] for k in below) + ((len(nodes[key]) - 1) * len(key[-1][1].encode()) if key else 0)
        ends = ",".join(str(c) for c in sorted(nodes[key]) if len(convs[c]) == len(key))
        out.append((min(nodes[key]), len(key), min(nodes[key[:-1]]) if key else None, len(nodes[key]), len(below), leaves[key], saved[key],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows], SCHEMA)


def mixed():
    draw, rows = random.Random(3), []
    for c in range(-7, 60):
        rows += [(c, t, draw.choice(["user", "assistant"]), draw.choice(["hi", "hallo", "é"])) for t in range(draw.randint(1, 14))]
    rows += [(100, None, None, None), (100, 1, "user", None), (100, 1, None, "b"), (100, 1, "a", "b"), (100, 1, "a", "b"), (None, 0, "user", "x"), (None, 1, "user", "y"), (None, None, None, None)]
    long = [(t, "user", f"turn {t}") for t in range(60)]
    rows += [(c, *t) for c in (200, 201, 203, 205) for t in long]                      # copies of a long conversation
    rows += [(c, t, r, x + ("!" if t > 20 else "")) for c in (206, 210) for t, r, x in long]  # leaving it after 21 turns
    rows += [(c, 0, "user", "very common") for c in range(300, 420)]
    return rows + [(500, 0, "user", "x" * 3_000_000)]


@pytest.fixture(scope="module")
def rows():
    return mixed()


@pytest.mark.parametrize("block,run,hot", [(512, 8192, 10_000), (4, 7, 2)])
def test_equals_brute_force(spark, monkeypatch, rows, block, run, hot):
    monkeypatch.setattr(P, "BLOCK", block)
    monkeypatch.setattr(P, "HOT_PARENTS", hot)
    monkeypatch.setattr(P.ends, "__defaults__", (run,))
    own, heads = rebuilt(rows)
    turns = P.stored(P.placed(frame(spark, rows)), "turns")
    assert got(P.prefix_trie(*P.rebuilt(turns))) == brute(heads)
    if run == 7:
        assert got(P.conversation_trie(frame(spark, rows))) == brute(own)


def test_hot_parents_are_joined_alike(spark, monkeypatch, rows):
    nodes = P.stored(P.peeled(*parts(spark, rows)), "nodes")
    plain = sorted(map(str, P.with_parents(nodes).select("depth", "k1", "k2", "parent_conv_id").collect()))
    monkeypatch.setattr(P, "HOT_LEAST", 3)
    monkeypatch.setattr(P, "HOT_PARENTS", 10**9)
    assert sorted(map(str, P.with_parents(nodes).select("depth", "k1", "k2", "parent_conv_id").collect())) == plain


def parts(spark, rows):
    turns, convs = P.rebuilt(P.stored(P.placed(frame(spark, rows)), "turns"))
    return P.summed(turns, convs)


def test_empty_table_and_turnless_conversations(spark):
    assert P.conversation_trie(frame(spark, [(None, 1, "user", "x")])).count() == 0
    rows = [(7, 0, "user", "only")]  # its first turns are replaced by those of an absent conversation
    assert got(P.prefix_trie(*P.rebuilt(P.stored(P.placed(frame(spark, rows)), "turns")))) == brute(rebuilt(rows)[1])


def test_query_returns_the_contracts_columns(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = P.op12_prefix_trie(spark, SF)
    assert found.columns == COLUMNS
    assert got(found) == brute(rebuilt(rows)[1])
