import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tests.llm.helpers import LONG, SF, awkward, documents, empty
from trolley.llm import bpe as B


@pytest.fixture(scope="module")
def codec():
    return B.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def test_like_the_library(codec, library):
    draw = random.Random(3)
    bits = ["a", "bc", " ", "  ", "\n", "\t", "'s", "1", "!", "é", "\xa0", "　", "the", "ing", "\x1c"]
    texts = ["", "x" * 3000, "ab" * 2000 + "é" * 700, LONG[:20_000], "日本語 ½ ١٢"] + ["".join(draw.choice(bits) for _ in range(draw.randint(0, 14))) for _ in range(1500)]
    for text in texts:
        ids = codec.encode(text)
        assert np.frombuffer(ids, np.uint32).tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_white_space_beside_spaces(codec, library):
    draw, bits = random.Random(4), [" ", " ", "\xa0", "\u3000", "\n", "\t", "\r", "\x1c", "\x85", "b", "!"]
    texts = ["x \xa0 \xa0", "\xa0 \xa0 \xa0 b", "a\n\xa0 b"] + ["".join(draw.choice(bits) for _ in range(draw.randint(1, 12))) for _ in range(20_000)]
    for text in texts:
        assert np.frombuffer(codec.encode(text), np.uint32).tolist() == library.encode_ordinary(text), repr(text)


def test_small_tables_change_nothing(library):
    codec = B.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), remembered=3)
    for text in ("the cat, the dog\nand others", "thonen inth reou", "thonen inth reou"):
        assert np.frombuffer(codec.encode(text), np.uint32).tolist() == library.encode_ordinary(text)


def test_queue_gives_the_lowest_rank_leftmost(codec):
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257}
    assert B.merge(b"aaaaa", B.Pairs(ranks), B.RankQueue(300)) == [256, 257]


def test_query(spark, library):
    want = sorted((r["doc_id"], len(ids := library.encode_ordinary(r["text"] or "")), hashlib.sha256(np.array(ids, np.uint32).tobytes()).hexdigest(),
                   hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in documents(spark).collect())
    assert sorted(tuple(r) for r in B.op3_byte_bpe(spark, SF).collect()) == want


def test_awkward_rows(spark, library):
    docs = awkward(spark)
    got = sorted(([np.frombuffer(r["ids"], np.uint32).tolist(), bytes(r["decoded"])] for r in B.decode(B.encode(docs)).collect()))
    assert got == sorted([library.encode_ordinary(r["text"] or ""), (r["text"] or "").encode()] for r in docs.collect())
    assert B.decode(B.encode(empty(spark))).count() == 0


def test_pre_tokens_merged_together_are_merged_as_alone(codec, library):
    pieces = [b"aaaaaaa", b"thonen", b"a", "日本語é".encode(), b"inginging" * 50, b" reouther"]
    together = B.merge_all(pieces, codec.pairs, codec.queue)
    assert [np.frombuffer(x, np.uint32).tolist() for x in together] == [B.merge(p, codec.pairs, codec.queue) for p in pieces]
    assert not codec.queue.top and not codec.queue.buckets
    # A join of a lower rank than the one in hand goes first in its own pre-token.
    ranks = {bytes([b]): b for b in range(256)} | {b"bcd": 256, b"bc": 258, b"cd": 257, b"ab": 259, b"abc": 260, b"bcde": 261}
    queue, pairs = B.RankQueue(300), B.Pairs(ranks)
    want = tiktoken.Encoding("low", pat_str=".+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abcbcd", "bcdbcd", "abcde", "cdbcdab", "bbcdcde" * 9):
        assert B.merge(text.encode(), pairs, queue) == want.encode_ordinary(text), text


def test_texts_encoded_together(codec, library):
    texts = ["x" * 300 + " the", "y　 z", "a  b", "", "the " * 50 + "end."] * 3
    for got, text in zip(codec.encode_batch(texts), texts, strict=True):
        assert np.frombuffer(got, np.uint32).tolist() == library.encode_ordinary(text)
    assert max(map(len, codec.known)) <= 200


def test_lists_decoded_together(codec, library, monkeypatch):
    texts = ["", "a", "日本語é", "x" * 5000, "", LONG[:3000], "end\n"]
    ids = codec.encode_all(texts)
    for together in (1, 40, 1 << 17):  # the end of a group at every list, at some, at none
        monkeypatch.setattr(B, "TOGETHER", together)
        assert codec.decode_all(ids) == [t.encode() for t in texts]
    # Ids need not be without holes.
    ranks = {b"a": 0, b"bc": 7, b"d": 3}
    other = object.__new__(B.Codec)
    other.bytes_of = {i: b for b, i in ranks.items()}
    other.tabulate()
    assert other.decode_all([np.array([7, 0, 3, 7], np.uint32).tobytes(), b""]) == [b"bcadbc", b""]


def test_new_words_of_several_texts_are_merged_once(library, monkeypatch):
    codec = B.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    texts = ["zqxv zqxv grumfel", "zqxv's grumfel zqxv", "grumfel zqxv"]
    merged, plain = [], B.merge_all
    monkeypatch.setattr(B, "merge_all", lambda pieces, *more: merged.extend(pieces) or plain(pieces, *more))
    for got, text in zip(codec.encode_all(texts), texts, strict=True):
        assert np.frombuffer(got, np.uint32).tolist() == library.encode_ordinary(text)
    assert sorted(merged) == sorted(set(merged))
    monkeypatch.setattr(codec, "learn", lambda cuts, words: [*words] and pytest.fail("known words are learnt again"))
    codec.encode_all(["zqxv grumfel"])
