import hashlib
import itertools

import pytest
from pyspark.sql import functions as F

from tests.llm import helpers  # noqa: F401
from trolley.llm import chat as C

SF = "/root/testdata/sf0.01"
SAID = "\\### Assistant: </turn> ok"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def want(talks):
    out = {}
    for i, turns in talks.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[i] = (len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), digest(loss), sum(len(C.format_turn(r, t)[0]) for r, t in turns))
    return out


def grouped(rows):
    talks = {}
    for r in sorted(rows, key=lambda r: (r["conv_id"] is None, r["conv_id"], r["turn"] is not None, r["turn"], r["role"] or "", r["text"] or "")):
        talks.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    return talks


def test_query(spark):
    talks = grouped(spark.read.parquet(f"{SF}/conversations.parquet").collect()) | {-7: [("user", SAID), ("assistant", SAID)]}
    got = {r["conv_id"]: tuple(r)[1:] for r in C.op8_chat(spark, SF).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars").collect()}
    assert got == want(talks)


@pytest.mark.parametrize("text", ["", SAID, "</turn>\n### x: ", "\\", "\\\\h#<l:c\\n", "a\nb: ### ", "#" * 9])
def test_template_is_reversible(text):
    turns = [(r, t) for r, t in itertools.product(["user", "a: b\n#<\\", "", "assistant"], [text, "plain"])]
    formatted = "".join(C.format_turn(r, t)[0] for r, t in turns)
    assert C.parse(formatted) == turns
    assert formatted.count("</turn>") == formatted.count("### ") == len(turns)


def shared_rows(spark):
    """A first turn shared by all, deep and wide trees, copies, nulls, repeated rows, a long talk."""
    rows = []
    for i in range(60):
        turns = [("system", "same"), ("user", f"q{i % 5}"), ("assistant", f"a{i % 10}"), ("user", f"more {i % 20}"), ("assistant", "done " * (i % 3))]
        rows += [(i, t, r, x, "x") for t, (r, x) in enumerate(turns[:2 + i % 4])]
    rows += [(100, t, "user" if t % 2 else "assistant", f"turn {t}", "x") for t in range(400)]
    rows += [(101, 0, None, None, None), (101, None, "user", "first", None), (102, 0, "user", "twice", "x"), (102, 0, "user", "twice", "x"), (None, 0, "user", "no id", "x")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, leaf string")


@pytest.mark.parametrize("chars", [50, 2000, 10**6])
def test_trees(spark, chars):
    rows = shared_rows(spark)
    talks = C.conversations(rows)
    packed = C.packs(talks, chars)
    got = {r["conv_id"]: tuple(r)[1:] for r in talks.select("conv_id", "leaf").join(C.read_back(packed), "leaf")
           .select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars").collect()}
    assert got == want(grouped(rows.collect()))
    for p in packed.collect():
        end, seen = 0, set()
        for n in p["nodes"]:
            assert n["start"] == end  # depth-first, gapless, parents first
            end += n["length"]
            before, at, length = [], n["parent"], 0
            while at >= 0:
                above = p["nodes"][at]
                before += range(above["start"], above["start"] + above["length"])
                length += above["length"]
                at = above["parent"]
            assert sorted(before) == [c for a in n["attends"] for c in range(a["start"], a["end"])]
            assert n["position"] == length
            path = (tuple((a["start"], a["end"]) for a in n["attends"]), n["parent"], p["text"][n["start"]:end])
            assert path not in seen  # a shared turn is written once in a pack
            seen.add(path)
        assert end == len(p["text"])


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.read_back(C.packs(C.conversations(none))).count() == 0


def test_hot_first_turn_spreads(spark):
    rows = spark.range(2000).select(F.col("id").alias("conv_id"), F.explode(F.array(*[F.struct(F.lit(t).cast("long").alias("turn"), F.lit(r).alias("role"), x.alias("text"))
        for t, r, x in ((0, "system", F.lit("same")), (1, "user", F.col("id").cast("string")))])).alias("t")).select("conv_id", "t.*")
    packed = C.packs(C.conversations(rows), 2_000)
    assert packed.select(F.explode("leaves")).count() == 2000 and packed.count() > 10
