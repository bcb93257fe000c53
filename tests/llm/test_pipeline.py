import hashlib
import random

import corpus_pipeline
import pytest
from test_decontaminate import brute as leaks
from test_quality import brute as measures
from test_simhash import kept_by_brute_force
from test_suffixdedup import brute as cut


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    item, passage = prose(30), prose(70)
    rows = [(i, prose(rng.randint(60, 150))) for i in range(230)]
    rows += [(230, rows[3][1]), (231, rows[3][1]), (232, rows[8][1]), (233, prose(20)), (234, None), (235, "w " * 100), (236, prose(70).replace(" ", " ### "))]
    rows += [(i, prose(60) + " " + passage + " " + prose(10)) for i in (237, 238, 239)] + [(i, prose(50) + " " + item + " " + prose(50)) for i in (240, 241, 242)]
    # Null ids, an id of several texts, a row twice, near copies with few words changed, and a leak without an id.
    rows += [(None, prose(80)), (None, prose(80)), (7, prose(90)), (7, prose(90)), rows[20], (None, prose(50) + " " + item + " " + prose(50)), (None, rows[30][1])]
    for i, at in ((300, 40), (301, 41)):
        words = rows[at][1].split()
        words[len(words) // 2] = "changed"
        rows.append((i, " ".join(words)))
    rows += [(302, ""), (303, "long " + prose(40_000))]
    return rows, item


def place(row):
    """The order in which repeated passages count: by id, none first, then by digest."""
    return (-(1 << 63) if row[0] is None else row[0], int(hashlib.md5(row[1].encode()).hexdigest()[:15], 16))


def keyed(rows):
    return sorted(((i, t) for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_stages_and_run(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    rows, item = corpus()
    df = spark.createDataFrame([(i, t, "en", f"src{k % 2}", len(t or "")) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    df = df.selectExpr("*", "'x' as fp", "1 as n_words", "2 as block", "'k' as key", "0 as root", "true as kept")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, left = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == df.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left[name] = [(r.doc_id, r.text) for r in docs.collect()]
        assert docs.where("fp <> 'x' or n_words <> 1 or block <> 2 or key <> 'k' or root <> 0 or not kept or n_chars <> length(text)").count() == 0
    bad = {233, 234, 235, 236, 302}
    assert keyed(left["quality_rules"]) == keyed(r for r in rows if r[0] not in bad)
    assert all(measures(t)[0] < 50 or i in (235, 236) for i, t in rows if i in bad)
    known = sorted(left["quality_rules"], key=lambda r: (r[0] is None, r[0] or 0))
    first = {known[i] for i in kept_by_brute_force([t for _, t in known])}
    assert keyed(left["near_dedup"]) == keyed(first) and not {230, 231, 232, 300, 301} & {i for i, _ in first}
    ordered = sorted(left["near_dedup"], key=place)
    want = cut([(k, t) for k, (_, t) in enumerate(ordered)])
    assert sorted((str(i), hashlib.sha256(t.encode()).hexdigest()) for i, t in left["passage_dedup"]) == sorted((str(i), want[k][3]) for k, (i, _) in enumerate(ordered))
    assert sum(w[1] for w in want.values()) > 700
    clean = left["passage_dedup"]
    found = {k for k, _ in leaks([(k, t) for k, (_, t) in enumerate(clean) if len(t) < 100_000], [(1, item)])}
    assert len(found) == 1 and keyed(left["decontamination"]) == keyed(r for k, r in enumerate(clean) if k not in found)
    assert sum(i is None for i, _ in left["decontamination"]) == 2
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.decoded_sha256) for r in got) == sorted((str(i), hashlib.sha256(t.encode()).hexdigest()) for i, t in left["decontamination"])


def test_empty_table(spark, documents, tmp_path):
    pytest.importorskip("public_tokenizers")
    documents(["x"]).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
