import random

import numpy as np
from palaver.llm import langid

SYLLABLES = {"aa": ["kö", "mä", "tü", "lö"], "bb": ["ra", "no", "ti", "pe"], "cc": ["zx", "qu", "wy", "vv"]}


def made(n, seed=0):
    rng = random.Random(seed)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(n)]
    word = lambda s: "".join(rng.choices(s, k=rng.randint(1, 4)))
    return [" ".join(word(SYLLABLES[x]) for _ in range(rng.randint(3, 40))) for x in langs], langs


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    net = langid.Network(3, hidden=4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    ids, inside = langid.padded([b"abc", b"de", b"fghij"])
    target = np.array([0, 2, 1])
    forward = langid.Network._forward
    _, g = net.gradients(ids, inside, target)
    for name in net.p:
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in net.p[name].shape)
            if name.endswith("x"):
                at = (ord("a"), at[1])
            old, loss = net.p[name][at], []
            for step in (1e-3, -1e-3):
                net.p[name][at] = old + step
                loss.append(net.gradients(ids, inside, target)[0])
            net.p[name][at] = old
            assert abs((loss[0] - loss[1]) / 2e-3 - g[name][at]) < 2e-3, name
    assert forward is langid.Network._forward


def plain_labels(net, data):
    """Probabilities at each position by plain loops over one text."""
    H, sig = net.h, lambda v: 1 / (1 + np.exp(-v))
    states = {}
    for d in "fb":
        h, states[d] = np.zeros(H), [None] * len(data)
        for t in range(len(data)) if d == "f" else reversed(range(len(data))):
            x, u = net.p[d + "x"][data[t]] + net.p[d + "c"], net.p[d + "u"]
            z, r = sig(x[:H] + h @ u[:, :H]), sig(x[H : 2 * H] + h @ u[:, H : 2 * H])
            h = (1 - z) * h + z * np.tanh(x[2 * H :] + (r * h) @ u[:, 2 * H :])
            states[d][t] = h
    e = np.array([np.concatenate([states["f"][t], states["b"][t]]) @ net.p["o"] + net.p["ob"] for t in range(len(data))])
    return np.exp(e) / np.exp(e).sum(axis=1, keepdims=True)


def test_document_probabilities_equal_plain_loops():
    net = langid.Network(3, hidden=5)
    texts = ["ab cd, ab ab", "Ärger über Öl", "x", None, "", "wort und satz " * 15]
    got = langid.pooled(net, texts, len(texts))
    for text, row in zip(texts, got):
        want = plain_labels(net, (text or "").lower().encode()).mean(axis=0) if text else np.zeros(3)
        assert np.allclose(row, want, atol=1e-5), text


def test_state_runs_on_across_words_and_pieces():
    net = langid.Network(3, hidden=5)
    assert not np.allclose(plain_labels(net, b"ab cd")[3:], plain_labels(net, b"xy cd")[3:])
    long = " ".join(f"wort{i} satz" for i in range(200)).encode()
    pieces = langid.pieces_of(long)
    assert b"".join(p[a:b] for p, a, b in pieces) == long and len(pieces) > 5
    want = sum(plain_labels(net, p)[a:b].sum(axis=0) for p, a, b in pieces) / len(long)
    assert np.allclose(langid.pooled(net, [long.decode()], 1)[0], want, atol=1e-5)
    assert np.allclose(want, plain_labels(net, long).mean(axis=0), atol=2e-3)


def test_letters():
    assert [langid.has_letter(t) for t in ("½ ²", "Ⅷ ①", "12 _!", "a", "é", "中", "ª")] == [False] * 3 + [True] * 4


def test_repeated_ids_are_learned_from_once(spark, documents, monkeypatch):
    taken = []
    monkeypatch.setattr(langid.Network, "fit", lambda self, pieces, target, rounds: taken.append(len(pieces)))
    df = documents([f"wort satz {i % 5}" for i in range(50)], langs=["de"] * 25 + ["en"] * 25, ids=[1] * 50)
    langid.train(df, docs=1)
    assert taken == [2]
    langid.train(df, docs=100, sample=3)
    assert 2 <= taken[1] <= 3


def test_held_out_accuracy(spark, documents):
    texts, langs = made(400)
    df = documents(texts, langs)
    names, net = langid.train(df, rounds=120)
    assert names == sorted(SYLLABLES)
    rows = langid.predicted(df, names, net).collect()
    held = [r for r in rows if r.doc_id % 1 == 0]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_cases(spark, documents):
    texts, langs = made(60, 1)
    df = documents([*texts, None, "½ ² Ⅷ ①", "123 !!", texts[0], "w" * 100_000], [*langs, "aa", None, "bb", None, None])
    names, net = langid.train(df, rounds=20)
    out = {r.doc_id: r for r in langid.predicted(df, names, net).collect()}
    assert [out[i].lang_pred for i in (60, 61, 62)] == ["und"] * 3 and out[60].score == 0
    assert out[63].lang_pred == out[0].lang_pred and out[64].lang_pred in names
    assert langid.train(df.where("lang = 'none'")) == ([], None)
    assert {r.lang_pred for r in langid.predicted(df, [], None).collect()} == {"und"}
    assert langid.predicted(df.limit(0), names, net).collect() == []
