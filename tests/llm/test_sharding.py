import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from palaver.llm import sharding


def test_curve_visits_every_cell_by_steps_of_one():
    for bits, dims in ((3, 2), (2, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        order = sharding.hilbert_index(cells, bits)
        assert sorted(order) == list(range(len(cells)))
        walk = cells[np.argsort(order)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_rows_law_slots_and_sizes(spark, documents):
    texts = [None, "", *("text %d" % (i % 37) * (1 + i % 5) for i in range(500)), "é"]
    rows = sharding.hilbert_shards(documents(texts)).collect()
    assert len(rows) == len(texts)
    count = Counter(r.shard for r in rows)
    assert set(count) == set(range(8)) and max(count.values()) - min(count.values()) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_equal_texts_stay_together(spark, documents):
    texts = [f"group {i % 60}" for i in range(600)]
    where = defaultdict(set)
    for r in sharding.hilbert_shards(documents(texts)).collect():
        where[texts[r.doc_id]].add(r.shard)
    assert sum(len(s) > 1 for s in where.values()) <= 7


def test_few_rows_nulls_and_empty_table(spark, documents):
    df = documents(["a", "a", "b"], langs=[None, "en", None], ids=[None, 2, 2])
    assert sorted(r.slot for r in sharding.hilbert_shards(df).collect()) == [0, 0, 0]
    assert sharding.hilbert_shards(df.limit(0)).collect() == []


def test_files(spark, documents, tmp_path):
    sharding.write_shards(documents([f"t {i}" for i in range(40)]), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("shard").count().count() == 8


def test_names_keep_their_order_however_many(spark):
    for n in (3, 40, 3000):
        names = [f"n{i:05d}" for i in range(n)]
        df = spark.createDataFrame([(x,) for x in [*names, None, names[0]]], "name string")
        got = sharding.with_name_cell(df, "name", "cell", 8).collect()
        cells = {r.name: r.cell for r in got}
        assert len(got) == n + 2 and cells[None] == 0
        assert [cells[x] for x in names] == [1 + i * 255 // n for i in range(n)]


def test_size_cells_rise_with_size(spark):
    got = [r.c for r in spark.range(1, 5000).select(sharding.size_cell("id", 8).alias("c")).collect()]
    assert got == sorted(got) and got[:8] == [0, 4, 6, 8, 9, 10, 11, 12]


def test_whole_result_equals_plain_python(spark, documents):
    rng = random.Random(6)
    texts = [rng.choice([None, "", "x" * 70_000, f"text {rng.randrange(90)} " * rng.randint(1, 9)]) for _ in range(400)]
    langs = [rng.choice([None, "en", "de", "fr"]) for _ in texts]
    rows = list(zip(range(400), texts, langs, [f"src{i % 2}" for i in range(400)]))
    place = {x: 1 + i * 255 // 3 for i, x in enumerate(["de", "en", "fr"])} | {None: 0, "src0": 1, "src1": 1 + 255 // 2}
    low = {}
    for _, t, lang, source in rows:
        a, b = low.get(t or "", (999, 999))
        low[t or ""] = (min(a, place[source]), min(b, place[lang]))
    keyed = []
    for i, t, _, _ in rows:
        data = (t or "").encode()
        size = len(data) + 1
        octave = size.bit_length() - 1
        cell = np.array([[*low[t or ""], octave << 2 | (size << 2 >> octave) & 3]])
        keyed.append((int(sharding.hilbert_index(cell, 8)[0]), size, zlib.crc32(data), int(hashlib.md5(data).hexdigest()[:15], 16), i))
    keyed.sort()
    want = {k[-1]: (r * 8 // 400, r - -(-(r * 8 // 400) * 400 // 8), k[0]) for r, k in enumerate(keyed)}
    got = {r.doc_id: (r.shard, r.slot, r.hilbert) for r in sharding.hilbert_shards(documents(texts, langs)).collect()}
    assert got == want
