import math
import zlib
from collections import Counter, defaultdict

from palaver.llm import ppm

TEXTS = ["the cat sat on the mat", "The cat ran", "a dog and a cat", None, "", " \n ", "zebra zebra zebra", "the the the", "Ärger über Öl", "dog cat dog"] + [f"word{i} the cat w{i % 7} sat" for i in range(40)]


def brute(texts, order=ppm.ORDER):
    """Probability of every text by the definition, byte by byte, with dictionaries."""
    code = lambda t: b"\n" * order + b" ".join((t or "").encode().lower().split()) + b"\n"
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    train = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    trie, words = defaultdict(Counter), Counter()
    for t in train:
        words.update(tokens(t))
        b = code(t)
        for i in range(order, len(b)):
            for k in range(order + 1):
                trie[b[i - k : i]][b[i]] += 1
    n, v = sum(words.values()), len(words)
    out = []
    for i, t in enumerate(texts):
        b, score = code(t), 0.0
        for j in range(order, len(b)):
            out_of, p = set(), 1.0
            for k in range(order, -2, -1):
                if k < 0:
                    p /= 256 - len(out_of)
                    break
                here = {s: c for s, c in trie[b[j - k : j]].items() if s not in out_of}
                if not here:
                    continue
                whole = sum(here.values()) + len(here)
                if b[j] in here:
                    p *= here[b[j]] / whole
                    break
                p *= len(here) / whole
                out_of |= set(here)
            score += math.log10(p)
        ws = tokens(t)
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in ws)
        out.append((zlib.crc32(str(i).encode()) % 7 == 2, len(ws), sum(words[w] > 0 for w in ws), n, base, score))
    return out


def test_equals_brute_force(spark, documents):
    want = brute(TEXTS)
    for df in (documents(TEXTS), documents(TEXTS).repartition(3)):
        got = {r.doc_id: r for r in ppm.scores(df, keep=("doc_id", "block")).collect()}
        assert len(got) == len(TEXTS)
        for i, (held, n, known, total, base, score) in enumerate(want):
            r = got[i]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.block) == (held, n, known, total, 2)
            assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9), i


def test_several_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(ppm, "n_blocks", lambda *a: 5)
    want = brute(TEXTS)
    got = {r.doc_id: r.score for r in ppm.scores(documents(TEXTS)).collect()}
    assert all(math.isclose(got[i], w[-1], rel_tol=1e-9) for i, w in enumerate(want))


def test_cases(spark, documents):
    df = documents(TEXTS)
    assert ppm.scores(df.limit(0)).collect() == []
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    rows = ppm.scores(documents(["ab", "c"], ids=held)).collect()
    assert all(r.train_tokens == 0 and r.base_score == 0 for r in rows)
    assert sorted(round(r.score / math.log10(1 / 256), 6) for r in rows) == [2, 3]
    twice = ppm.scores(documents(["a b", "a b", "a b"], ids=[1, 1, None])).collect()
    assert len(twice) == 3 and len({r.score for r in twice}) == 1


def test_long_texts_and_held_out_only_contexts(spark, documents, monkeypatch):
    monkeypatch.setattr(ppm, "CHUNK", 200)
    texts = ["ab cd " * 300 + f"tail{i}" for i in range(12)] + ["xyzzy " * 50 + str(i) for i in range(8)]
    want = brute(texts)
    got = {r.doc_id: r for r in ppm.scores(documents(texts)).collect()}
    assert {w[0] for w in want} == {True, False}
    assert all(math.isclose(got[i].score, w[-1], rel_tol=1e-9) and got[i].n_tokens == w[1] for i, w in enumerate(want))


def test_rows_are_dealt_once_for_join_and_window(spark):
    """The last order's plan has one exchange on each side of its join and none for the window."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    plans, real = [], ppm.stored

    def spy(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    try:
        ppm.stored = spy
        grams = spark.range(2000).selectExpr("id * 1099511 % 281474976710656 as key", "id % 5 as c")
        ppm.log_probabilities(grams, 4)
    finally:
        ppm.stored = real
        spark.conf.set("spark.sql.adaptive.enabled", before)
    last = plans[-1]
    assert "SinglePartition" not in last and last.count("Exchange hashpartitioning") == (2 if "SortMergeJoin" in last else 1)
