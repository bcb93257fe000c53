import random

import numpy as np
from brute_simhash import component_ids, fingerprint
from palaver.llm import simhash

TEXTS = [None, "", " \t\n", "one", "One two", "ONE TWO", "a b c", "a b c d", "Ärger ÄRGER x y", "a b c a b c a b c", "w " * 5000, "long text " * 40000]


def test_fingerprints_equal_brute_force():
    for text in TEXTS:
        assert simhash.fingerprint(text) == fingerprint(text)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def planted(seed, groups, size, flips):
    """Fingerprints in chains: each a few bits off an earlier one of its group."""
    rng, out = random.Random(seed), []
    for _ in range(groups):
        own = [rng.getrandbits(64)]
        for _ in range(size - 1):
            x = rng.choice(own)
            for b in rng.sample(range(64), rng.randint(0, flips)):
                x ^= 1 << b
            own.append(x)
        out += own
    return out


def linked(spark, fps, slice_size):
    points = spark.createDataFrame([(signed(x),) for x in sorted(set(fps))], "fp long")
    links = simhash.anchor_links(simhash._sliced(simhash.anchored(points), slice_size))
    return dict(simhash.components(links).collect())


def check(spark, fps, slice_size):
    order = sorted(set(map(signed, fps)))
    want = component_ids([(x, x % (1 << 64)) for x in order])
    got = linked(spark, fps, slice_size)
    assert {x: got.get(x, x) for x in order} == want


def test_links_equal_brute_force(spark):
    check(spark, planted(1, 60, 6, 3) + planted(2, 30, 4, 5), 2000)


def test_large_group_at_one_anchor(spark):
    check(spark, planted(3, 1, 400, 2), 2000)


def test_slices_lose_no_link(spark):
    check(spark, planted(4, 2, 200, 2) + planted(5, 20, 3, 3), 20)


def test_cases(spark, documents):
    df = documents([*TEXTS, "a b c", None], ids=[*range(len(TEXTS)), 0, None])
    rows = simhash.near_duplicates(df).collect()
    assert len(rows) == len(TEXTS) + 2
    assert {r.component_id for r in rows if r.fp == 0} == {0}
    assert {r.component_id for r in rows if r.fp == signed(fingerprint("a b c"))} == {0}
    assert simhash.near_duplicates(df.limit(0)).collect() == []


def test_one_of_each_group_stays(spark, documents):
    kept = simhash.deduplicated(documents(["a b c d e", "a b c d e", "other words are here", "x y z", "x y z"], ids=[5, 3, 4, 7, 7]))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 7]
    assert "block" in kept.columns


def test_near_copies_by_five_word_similarity(spark, documents):
    rng, texts = random.Random(9), []
    shingles = lambda t: {tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))}
    alike = lambda a, b: len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) >= 0.8
    for _ in range(40):
        base = [f"w{rng.randrange(5000)}" for _ in range(300)]
        texts.append(" ".join(base))
        for edits in (1, 2, 3, 5, 6, 9, 12):
            copy = list(base)
            for at in rng.sample(range(300), edits):
                copy[at] = f"x{rng.randrange(5000)}"
            texts.append(" ".join(copy))
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i // 8 * 8, i):
            if alike(texts[i], texts[j]):
                root = [root[j] if r == root[i] else r for r in root]
    kept = {r.doc_id for r in simhash.deduplicated(documents(texts)).collect()}
    assert kept == {min(i for i, r in enumerate(root) if r == x) for x in set(root)}
    # The setting of op1, three words and three bits, leaves many of these copies in.
    assert len({r.component_id for r in simhash.near_duplicates(documents(texts)).collect()}) > len(kept) + 40


def test_rows_that_share_an_id_or_have_none(spark, documents):
    texts = ["a b c d e f", "g h i j k l", "m n o p q r", "m n o p q r", "s t u v w x", "y z a b c d", "y z a b c d"]
    kept = simhash.deduplicated(documents(texts, ids=[None, None, None, 4, 5, 5, 5])).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == [("4", texts[2]), ("5", texts[4]), ("5", texts[5]), ("None", texts[0]), ("None", texts[1])]


def family(rng, size, edits, words=200):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    for _ in range(size):
        copy = list(base)
        for at in rng.sample(range(words), rng.choice(edits)):
            copy[at] = f"x{rng.randrange(10**6)}"
        yield " ".join(copy)


def kept_by_brute_force(texts):
    shingles = [{tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and 10 * len(shingles[i] & shingles[j]) >= 8 * len(shingles[i] | shingles[j]):
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    return {min(i for i, r in enumerate(root) if r == x) for x in set(root)}


def test_families_without_a_centre_lose_no_link(spark, documents):
    # Copies whose mutual similarity lies on both sides of 0.8, so that leads alone do not connect them.
    rng = random.Random(21)
    texts = [*family(rng, 90, (1, 2, 3, 4, 5)), *family(rng, 40, (2, 3)), *family(rng, 12, (0, 9))]
    want = kept_by_brute_force(texts)
    assert 20 < len(want) < 110
    for members in (500, 7):
        rows = simhash.near_copies(documents(texts), members=members).collect()
        got = {min(r.doc_id for r in rows if r.root == x) for x in {r.root for r in rows}}
        assert got == want


def test_few_homes_with_many_members_are_sliced(spark):
    rows = spark.createDataFrame([(1, i, i < 2) for i in range(200)] + [(2, 5, True)], "anchor long, fp long, home boolean")
    cells = simhash._sliced(rows, 5).where("anchor = 1").groupBy("cell").count().collect()
    assert len(cells) == 5 and max(r["count"] for r in cells) < 80
    check(spark, planted(4, 2, 200, 2), 3)


def test_anchors_larger_than_what_is_held(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HELD", 20)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        check(spark, planted(8, 2, 150, 2) + planted(9, 10, 4, 3), 2000)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_fingerprints_of_a_set_are_majorities():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 4, 8, 9, 100, 4097):
        hashes = rng.integers(0, 1 << 64, n, np.uint64)
        x = (hashes[:, None] ^ simhash.SALTS) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(29)
        ones = np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        assert (simhash.series(hashes).view(np.uint64) == np.packbits(2 * ones > n, bitorder="little").view(np.uint64)).all()


def test_near_copies_meet_at_anchors_only(spark, documents, monkeypatch):
    rng = random.Random(6)
    base = [f"w{k}" for k in range(200)]
    copy = [f"x{k}" if k in (30, 75, 120, 165) else w for k, w in enumerate(base)]  # similarity 0.81
    df = documents([" ".join(base), " ".join(copy), " ".join(rng.choices(base, k=200))])
    monkeypatch.setattr(simhash, "ROUND", simhash.SERIES)
    roots = lambda: [r.root for r in sorted(simhash.near_copies(df).collect())]
    a, b, c = roots()
    assert a == b != c
    monkeypatch.setattr(simhash, "anchor_links", lambda rows, max_bits: spark.createDataFrame([], "a long, b long, every boolean"))
    assert len(set(roots())) == 3


def test_later_rounds_give_no_links_inside_a_class(spark, documents, monkeypatch):
    # 150 near copies meet at anchors in each round; only the first may link all of them.
    df, given, links = documents(list(family(random.Random(3), 150, (1, 2), 400))), [], simhash.anchor_links
    monkeypatch.setattr(simhash, "ROUND", simhash.SERIES)

    def counted(rows, max_bits):
        out = links(rows, max_bits)
        given.append(out.count())
        return out

    monkeypatch.setattr(simhash, "anchor_links", counted)
    assert len({r.root for r in simhash.near_copies(df).collect()}) == 1
    assert sum(given) < 150 * 32


def test_group_links_between_labels_only():
    fp = np.array([0, 1, 1, 3, (1 << 64) - 1], np.uint64)
    ids = np.arange(5, dtype=np.int64)
    joined = lambda labels, n_home: simhash._group_links(fp, ids, np.array(labels), n_home, 3)
    assert joined([7, 7, 7, 7, 7], 5) == []
    assert [tuple(map(int, x)) for x in joined([7, 7, 7, 9, 9], 1)] == [(0, 3)]
    assert len(joined([0, 1, 2, 3, 4], 1)) == 3
