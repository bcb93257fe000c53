import random
import re
from collections import Counter

import pytest
from palaver.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def texts():
    rng = random.Random(4)
    out = [None, "", " \n\t ", "a", "a b", "a b c", "a a a", "a a a a", "x y z x y z", "é\n é\né\n\n", "line\nline\nother\nline", "#*$%&|<>", "w " * 3000]
    out += [" ".join(rng.choices("abcde", k=rng.randint(3, 80))) for _ in range(60)]
    return out + ["\n".join(" ".join(rng.choices(["aa", "b#", "ccc"], k=4)) for _ in range(12)) for _ in range(10)]


def test_measures_equal_brute_force(spark, documents):
    rows = texts()
    got = {r.doc_id: r for r in quality.measured(documents(rows).select("doc_id", "text")).collect()}
    for i, t in enumerate(rows):
        assert tuple(got[i][c] for c in quality.BASE) == brute(t), t


@pytest.mark.parametrize("hashed", ["bigint(0 * xxhash64({}))", "pmod(xxhash64({}), 2)", "pmod(xxhash64({}), 7)"])
def test_equal_hash_bits_hide_no_repeat(spark, documents, monkeypatch, hashed):
    monkeypatch.setattr(quality, "HASH", hashed)
    rows = [t for t in texts() if len(t or "") < 2000]
    got = {r.doc_id: r for r in quality.measured(documents(rows).select("doc_id", "text")).collect()}
    for i, t in enumerate(rows):
        assert tuple(got[i][c] for c in quality.BASE) == brute(t), t


def test_very_long_text(spark, documents):
    rng = random.Random(8)
    rows = [" ".join(f"w{rng.randrange(40_000)}" for _ in range(200_000)) + " a b c d\n" * 200, "x" * 1_000_000]
    got = {r.doc_id: r for r in quality.measured(documents(rows).select("doc_id", "text")).collect()}
    for i, t in enumerate(rows):
        assert tuple(got[i][c] for c in quality.BASE) == brute(t)


def prose(rng, n=120):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(n))


def test_adaptive_limits(spark, documents):
    rng = random.Random(1)
    good = [prose(rng) for _ in range(300)]
    bad = [re.sub(" ", " ### ", prose(rng)) for _ in range(8)] + ["x" * 90 + " " + " ".join("y" * 60 + str(i) for i in range(60))]
    rows = [*good, *bad, None, "too short"]
    out = quality.filtered(documents(rows))
    kept = {r.doc_id for r in out.collect()}
    assert out.columns == documents(rows).columns
    assert kept == set(range(300))


def test_sketch_adds_up_and_is_close():
    b = lambda v: (v >> max(v.bit_length() - 7, 0)) << max(v.bit_length() - 7, 0)
    assert all(b(v) <= v <= b(v) * (1 + 1 / 64) for v in range(1, 100000, 7))


def test_buckets(spark):
    got = spark.range(0, 3000).select("id", quality.bucket("id").alias("b")).collect()
    assert all(r.b == ((r.id >> max(r.id.bit_length() - 7, 0)) << max(r.id.bit_length() - 7, 0)) for r in got)


def test_null_groups_repeated_rows_and_empty_table(spark, documents):
    rng = random.Random(9)
    text = prose(rng)
    df = documents([text, text, text], langs=[None, "en", None], ids=[1, 1, None])
    assert sorted(str(r.doc_id) for r in quality.filtered(df).collect()) == ["1", "1", "None"]
    assert quality.filtered(df.limit(0)).collect() == []
    assert quality.filtered(documents([None, "a"])).collect() == []
