import hashlib
import random

import numpy as np

from palaver.llm import suffixdedup


def brute(rows):
    """rows: (id, text) in order of id, ids distinct."""
    seen, out = set(), {}
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            w = data[p : p + 100]
            if w in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(w)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(data), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(data, gone) if not g)).hexdigest())
    return out


def made(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    prose = lambda k: " ".join(word() for _ in range(k))
    shared = [prose(60) for _ in range(4)]
    texts = []
    for i in range(n):
        parts = [prose(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 2)):
            s = rng.choice(shared)
            a = rng.randint(0, 80)
            parts += [s[a : a + rng.randint(60, 300)], prose(rng.randint(0, 20))]
        texts.append(" ".join(parts))
        if rng.random() < 0.15:
            texts.append(rng.choice(texts))
        if rng.random() < 0.1:
            t = rng.choice(texts)
            texts.append(t[: len(t) // 2] + word() + t[len(t) // 2 :])
    return texts


def compare(df, rows, block_bytes):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixdedup.remove_repeats(df, block_bytes=block_bytes).collect()}
    want = brute(rows)
    assert got == want
    return want


def test_equals_brute_force_over_many_blocks(spark, documents):
    texts = made(7, 120) + [None, "", "a" * 99, "a" * 100, "a" * 350, "ab" * 300, "x" * 40 + "a" * 120, "\0" * 230]
    rows = list(enumerate(texts))
    df = documents(texts)
    want = compare(df, rows, 6000)
    assert sum(w[1] > 0 for w in want.values()) > 30
    compare(df.repartition(3), rows, 1 << 22)


def test_very_long_text(spark, documents):
    rng = random.Random(3)
    long = "".join(rng.choices("abcdefgh ", k=600_000))
    rows = [(1, long), (2, "z" + long[300_000:300_400] + "z"), (3, long[100:99_000] + long[100:99_000])]
    compare(documents([t for _, t in rows], ids=[1, 2, 3]), rows, 100_000)


def test_repeated_rows_nulls_and_empty_table(spark, documents):
    a = "the first passage of this kind " * 5
    df = documents([a, a, a, a], ids=[4, 4, None, 9])
    got = sorted((r.doc_id or -1, r.n_removed) for r in suffixdedup.remove_repeats(df).collect())
    inner = brute([(0, a)])[0][1]
    assert got == [(-1, inner), (4, len(a)), (4, len(a)), (9, len(a))]
    assert suffixdedup.remove_repeats(df.limit(0)).collect() == []


def test_text_is_cut_at_characters(spark, documents):
    b = "é" * 50 + "".join(chr(0x100 + i) for i in range(60))
    df = documents([b + "x", "y" + b + "z"], ids=[1, 2])
    rows = {r.doc_id: r for r in suffixdedup.remove_repeats(df, keep=("doc_id", "block", "text"), with_text=True).collect()}
    assert rows[2].kept_text == "yz" and rows[2].block == 2


def test_merge_of_runs():
    rng = random.Random(1)
    runs = [sorted(bytes(rng.choices(b"ab", k=8)) for _ in range(rng.randint(0, 30))) for _ in range(7)]
    lcp = lambda a, b: next((i for i in range(8) if a[i] != b[i]), 8)
    given = [([0] + [lcp(a, b) for a, b in zip(r, r[1:])], r) for r in runs if r]
    run, at, common = suffixdedup.merge_runs(given)
    out = [given[r][1][i] for r, i in zip(run, at)]
    assert out == sorted(x for r in runs for x in r)
    assert common == [0] + [lcp(a, b) for a, b in zip(out, out[1:])]


def test_several_levels_of_merging(spark, documents, monkeypatch):
    monkeypatch.setattr(suffixdedup, "FAN", 3)
    texts = made(11, 150)
    levels = []
    real = suffixdedup.merged
    monkeypatch.setattr(suffixdedup, "merged", lambda sent, level: levels.append(level) or real(sent, level))
    want = compare(documents(texts), list(enumerate(texts)), 2500)
    assert sum(w[1] > 0 for w in want.values()) > 30 and max(levels) >= 3


def test_groups_of_ranges_refine_each_other():
    ranges = suffixdedup.Ranges([b"a%03d" % i for i in range(200)], 70, 4)
    every = np.arange(ranges.n)
    assert ranges.levels == 4
    for level in range(1, ranges.levels):
        coarse, fine = ranges.part(level, 0, every), ranges.part(level + 1, 0, every)
        assert (np.diff(coarse) >= 0).all() and len(set(coarse)) == min(ranges.n, 4**level)
        assert all(len(set(coarse[fine == f])) == 1 for f in set(fine) if 4**level <= ranges.n)
        assert {ranges.first(level, int(p)) for p in ranges.part(level, 5, every)} == {5}


def test_shared_prefixes_travel_with_the_runs():
    rng = np.random.default_rng(3)
    suffix = rng.integers(97, 99, (300, suffixdedup.LENGTH)).astype(np.uint8)
    suffix[:, : suffixdedup.GRAM] = suffix[rng.integers(0, 5, 300), : suffixdedup.GRAM]
    length = rng.integers(suffixdedup.GRAM, suffixdedup.LENGTH + 1, 300)
    suffix[np.arange(suffixdedup.LENGTH) >= length[:, None]] = 0
    order = np.argsort(suffix.view(f"S{suffixdedup.LENGTH}").ravel(), kind="stable")
    suffix, length = suffix[order], length[order]
    context = rng.integers(97, 99, (300, suffixdedup.LEFT)).astype(np.uint8)
    ids, masks = np.arange(300), np.arange(1, 301).astype(np.uint64)
    lcp = suffixdedup.shared(suffix)
    for rest in (np.arange(300), np.flatnonzero(rng.random(300) < 0.3), np.array([7]), np.array([0, 299])):
        less = suffixdedup.fewer(lcp, rest)
        assert (less == suffixdedup.shared(suffix[rest])).all()
        got = suffixdedup.read_run(suffixdedup.front_code(less, *(x[rest] for x in (suffix, length, context, ids, ids, ids, masks))))
        for a, b in zip(got, (less, suffix[rest], length[rest], context[rest], ids[rest], ids[rest], ids[rest], masks[rest])):
            assert (a == b).all()


def test_one_id_with_several_texts(spark, documents):
    passage = "the passage that both hold, long enough to be removed from one of them " * 3
    df = documents(["alpha " + passage, "beta " + passage, "gamma " + passage], ids=[7, 7, 7])
    removed = sorted(r.n_removed for r in suffixdedup.remove_repeats(df).collect())
    assert removed[0] < removed[1] == removed[2] and len(removed) == 3
