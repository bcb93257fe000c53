import random
import re
from collections import Counter

from palaver.llm import decontaminate
from pyspark.sql import functions as F


def brute(docs, items):
    """All pairs with a window of the item's size that is similar enough, by every window."""
    read = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    out = {}
    for i, item in items:
        iw = read(item)
        if not iw:
            continue
        k = min(5, len(iw))
        want = [tuple(iw[j : j + k]) for j in range(len(iw) - k + 1)]
        for d, text in docs:
            dw = read(text)
            if not dw:
                continue
            have = [tuple(dw[j : j + k]) for j in range(max(1, len(dw) - k + 1))]
            size = min(len(want), len(have))
            best = 0
            for s in range(len(have) - size + 1):
                common = sum((Counter(have[s : s + size]) & Counter(want)).values())
                best = max(best, common / (size + len(want) - common))
            if best >= 0.8:
                out[d, i] = best
    return out


def case(seed=3):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "klmnopqrst"]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    items = [prose(rng.randint(12, 70)) for _ in range(12)] + [["alpha", "beta", "gamma"], ["same"] * 12]
    docs = []
    for _ in range(60):
        body = prose(rng.randint(0, 120))
        if rng.random() < 0.6:
            leak = list(rng.choice(items))
            kind = rng.random()
            if kind < 0.25:
                leak = leak[: len(leak) - rng.randint(0, 6)]
            elif kind < 0.5:
                leak[rng.randrange(len(leak))] = "changed"
            at = rng.randint(0, len(body))
            body = body[:at] + leak + body[at:]
        docs.append(" ".join(body).capitalize() + ".")
    docs += [" ".join(items[0][:-1]), " ".join(items[0]).upper().replace(" ", ", "), None, "", "same " * 30]
    return docs, [(i, " ".join(t)) for i, t in enumerate(items)] + [(50, None), (51, "")]


def test_equals_brute_force(spark, documents):
    texts, items = case()
    got = decontaminate.contaminated(documents(texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute(list(enumerate(texts)), items)
    assert len(want) > 25
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}


def prints(spark, rows, key):
    """rows: (name, list of shingles); all of one size."""
    flat = [(i, 5, 1, hash(x) >> 1, c) for i, xs in rows for x, c in Counter(xs).items()]
    return decontaminate.fingerprints(spark.createDataFrame(flat, f"{key} long, k int, n long, h long, c long"), key, "k", "n")


def bits(fp):
    return sum((x & (1 << 64) - 1) << 64 * w for w, x in enumerate(fp))


def test_fingerprints_are_majorities_over_occurrences(spark):
    rows = [(1, ["a", "b", "a"]), (2, ["a"]), (3, [f"x{i}" for i in range(90)])]
    got = {r.item: bits(r.fp) for r in prints(spark, rows, "item").collect()}
    hashes = {}
    for _, xs in rows:
        for x in set(xs):
            parts = spark.range(1).select(*[F.xxhash64(F.lit(hash(x) >> 1), F.lit(i), F.lit(w)) for i in (1, 2) for w in (0, 1)]).first()
            hashes[x, 1], hashes[x, 2] = bits(parts[:2]), bits(parts[2:])
    for i, xs in rows:
        own = [hashes[x, k] for x, c in Counter(xs).items() for k in range(1, c + 1)]
        assert got[i] == sum(1 << b for b in range(128) if 2 * sum(h >> b & 1 for h in own) > len(own))


def test_index_alone_finds_all_within_the_radius(spark):
    rng, r = random.Random(7), decontaminate.RADIUS
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    halves = lambda x: [signed(x & (1 << 64) - 1), signed(x >> 64)]
    items = [rng.getrandbits(128) for _ in range(40)]
    queries = []
    for x in items:
        for far in (0, 1, 20, r - 1, r, r + 1, r + 9):
            queries.append(x ^ sum(1 << b for b in rng.sample(range(128), far)))
        queries.append(x ^ sum(1 << b for b in range(r)))  # all differences side by side
    schema = "k int, n long, fp array<long>"
    left = spark.createDataFrame([(i, 5, 9, halves(x)) for i, x in enumerate(queries)], "content long, " + schema)
    right = spark.createDataFrame([(i, 5, 9, halves(x)) for i, x in enumerate(items)] + [(99, 5, 8, halves(items[0]))], "item long, " + schema)
    got = {(row.content, row.item) for row in decontaminate.near_pairs(left, right).collect()}
    assert got == {(i, j) for i, q in enumerate(queries) for j, x in enumerate(items) if (q ^ x).bit_count() <= r}
    assert len(got) >= 40 * 6


def test_distance_at_the_least_similarity_is_far_within_the_radius(spark):
    rng, left, right = random.Random(5), [], []
    for case in range(200):
        n = rng.choice((9, 18, 45, 90, 180, 270))
        item = [f"{case}-{i}" for i in range(n)]
        other = -(-8 * 2 * n // 18)  # shared by a window of the same size, at a similarity of 0.8
        kind = rng.choice(("new", "one repeated"))
        right.append((case, item))
        left.append((case, item[:other] + [f"{case}+{i if kind == 'new' else 0}" for i in range(n - other)]))
    a = {x.item: bits(x.fp) for x in prints(spark, left, "item").collect()}
    b = {x.item: bits(x.fp) for x in prints(spark, right, "item").collect()}
    far = [(a[i] ^ b[i]).bit_count() for i in a]
    assert 14 < sum(far) / len(far) < 24 and max(far) <= decontaminate.RADIUS - 12


def test_documents_go_or_stay(spark, documents):
    item = " ".join(f"w{i}" for i in range(30))
    bench = spark.createDataFrame([(1, item), (1, item), (2, item)], "item_id long, text string")
    df = documents(["x " + item + " y", "clean text", None, "x " + item, item], ids=[1, 2, 3, None, 1])
    left = decontaminate.decontaminated(df, bench)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [2, 3]
    pairs = decontaminate.contaminated(df, bench).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in pairs) == [("1", 1), ("None", 1)]
    assert sorted(map(tuple, decontaminate.item_classes(bench).collect())) == [(1, 1), (1, 1), (2, 1)]
    assert decontaminate.contaminated(df.limit(0), bench).collect() == []
    assert decontaminate.decontaminated(df, bench.limit(0)).count() == 5


def test_clean_rows_with_the_same_id_stay(spark, documents):
    item = " ".join(f"w{i}" for i in range(30))
    df = documents(["x " + item, "clean text", "more clean text", item + " z", "clean too"], ids=[None, None, None, 7, 7])
    left = decontaminate.decontaminated(df, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(r.text for r in left.collect()) == ["clean text", "clean too", "more clean text"]


def test_repeated_shingles_lose_no_window(spark, documents):
    rng = random.Random(4)
    items = [[f"w{rng.randrange(10**6)}" for _ in range(274)] for _ in range(12)]
    texts = [" ".join(i[:247] + ["z"] * 27) for i in items]
    items = [(n, " ".join(i)) for n, i in enumerate(items)]
    got = decontaminate.contaminated(documents(texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute(list(enumerate(texts)), items)
    assert len(want) == 12
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
