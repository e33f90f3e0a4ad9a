import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import LONG, awkward, documents, empty
from trolley.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def check(pieces, docs, tokenizer, window):
    want = sorted(([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in docs.collect()))
    rows = pieces.collect()
    whole, places = {}, {}
    for r in rows:
        ids = np.frombuffer(r["ids"], np.uint32).tolist()
        assert len(ids) == r["length"] > 0
        whole.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], ids))
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sum(sorted(map(len, want))) == sum(r["length"] for r in rows)
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= window
    return whole, places, want


def test_every_id_once_and_little_padding(spark, tokenizer):
    docs = documents(spark)
    pieces = P.pack(docs)
    whole, places, want = check(pieces, docs, tokenizer, P.WINDOW)
    got = sorted([i for _, ids in sorted(parts) for i in ids] for parts in whole.values())
    assert got == want
    assert sum(n for held in places.values() for _, n in held) > 0.98 * P.WINDOW * (len(places) - 1)


def test_awkward_rows(spark, tokenizer):
    docs = awkward(spark)
    check(P.pack(docs), docs, tokenizer, P.WINDOW)
    assert P.pack(empty(spark)).count() == 0


def test_pools_of_few_bytes_pack_everything(spark, tokenizer):
    docs = documents(spark)
    check(P.pack(docs, window=256, pool_bytes=4000), docs, tokenizer, 256)


def test_sequences_and_digests(spark):
    pieces = P.pack(documents(spark)).cache()
    joined = P.sequences(pieces).collect()
    for r in joined:
        assert len(r["ids"]) == 4 * r["length"] and r["padding"] in (0, P.WINDOW - r["length"])
    assert sum(r["length"] for r in joined) == sum(r["length"] for r in pieces.collect())
    for r, d in zip(pieces.orderBy("doc_id", "start").collect(), P.digests(pieces).orderBy("doc_id", "start").collect()):
        assert zlib.crc32(r["ids"]) == d["ids_crc32"]


def test_tightest_window_is_found():
    draw = np.random.default_rng(1)
    lengths = sorted(draw.integers(1, 65, 400).tolist(), reverse=True)
    open_, want = [], []
    for n in lengths:  # plain best fit
        fits = [w for w in range(len(open_)) if open_[w] >= n]
        w = min(fits, key=lambda w: open_[w]) if fits else len(open_)
        if w == len(open_):
            open_.append(64)
        open_[w] -= n
        want.append(open_[w])
    got, room = [], {}
    for (w, offset), n in zip(P.best_fit(lengths, 64)[0], lengths):
        assert 64 - room.get(w, 64) == offset
        room[w] = room.get(w, 64) - n
        got.append(room[w])
    assert got == want


def test_chunks_encode_like_whole_texts(tokenizer):
    texts = ["", "a  b", "A\xa0B\x85C", "don't 'S", "x\x1cy", LONG[:5000], "ΣΑΣ İ é", "<|startoftext|>a", "“q”—1½", "ÀÉ Ýſ"]
    for chunks in (10, 10**6):
        encoder = P.ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"), chunks)
        for _ in range(2):
            assert [np.frombuffer(x, np.uint32).tolist() for x in encoder.encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_workers_keep_no_chunks_after_a_task(spark):
    assert P.pack(documents(spark).repartition(4)).count()

    def held(batches):
        import sys

        import pyarrow as pa

        for _ in batches:
            pass
        kept = vars(sys.modules["_trolley_llm_worker"]).values() if "_trolley_llm_worker" in sys.modules else []
        yield pa.record_batch([pa.array([sum(len(x.known) for x in kept if isinstance(x, P.ChunkEncoder))])], ["n"])

    assert sum(r["n"] for r in spark.range(0, 16, 1, 16).mapInArrow(held, "n long").collect()) == 0
