import hashlib
import random

import numpy as np
import pytest
from palaver.llm import bpe

P = pytest.importorskip("public_tokenizers")
RANKS, PATTERN = P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN


@pytest.fixture(scope="module")
def enc():
    return bpe.encoding(bpe.read_ranks(RANKS), PATTERN)


def texts():
    rng = random.Random(2)
    parts = ["Hello", " world", "don't", "'s", "  ", "\n\n", "\t", "12345", "ÄÖ", "日本語", "!?..", "<|endoftext|>", " ", "é", "x9y", " ", "\x1c", " ", "😀"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(200)]


def test_pieces_give_the_ids_of_the_whole(enc):
    for text in texts():
        want = enc.encode_ordinary(text)
        for size in (1, 7, 30):
            got = [i for p in bpe.pieces(text, size) for ids in bpe.piece_ids(enc, p) for i in ids.tolist()]
            assert got == want, (text, size)


def test_long_runs(enc):
    for text in (" " * 5000 + "a", "a" + "\n" * 4000, " " * 3000, "b" * 20000, "word " * 30000, "x" + " " * 2500 + "y" + " " * 2100, "a" + " \x1c" * 2000, "\u3000" * 2100 + "z"):
        assert np.concatenate(list(bpe.ids_of(enc, text))).tolist() == enc.encode_ordinary(text)


def test_round_trip_query(spark, documents, enc):
    rows = [None, "", *texts()[:40], "repeat", "repeat"]
    got = {r.doc_id: r for r in bpe.round_trip(documents(rows), RANKS, PATTERN).collect()}
    assert len(got) == len(rows)
    for i, t in enumerate(rows):
        ids = enc.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.round_trip(documents(rows).limit(0), RANKS, PATTERN).collect() == []


def test_ids_and_bytes(spark, documents):
    rows = [None, "Grüße, world", "日本"]
    ids = bpe.encode(documents(rows), RANKS, PATTERN, keep=("doc_id", "block"))
    assert [r["bytes"].decode() for r in bpe.decode(ids, RANKS, PATTERN).orderBy("doc_id").collect()] == ["", "Grüße, world", "日本"]
