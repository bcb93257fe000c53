import random
import zlib

import pyarrow as pa

from palaver.llm import toxicity

BAD = ["stupid", "idiot", "worthless", "trash"]


def made(n, seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices(["ta", "ri", "no", "el", "su", "mo"], k=rng.randint(1, 4)))
    texts, labels = [], []
    for i in range(n):
        ws = [word() for _ in range(rng.randint(5, 60))]
        labels.append(int(rng.random() < 0.25))
        if labels[-1]:
            ws.insert(rng.randrange(len(ws)), rng.choice(BAD))
        texts.append(" ".join(ws))
    return texts, labels


def model(spark, documents, n=400):
    texts, labels = made(n)
    df = documents(texts)
    return df, labels, toxicity.train(df, spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "doc_id long, toxic int"))


def test_held_out_and_disguised(spark, documents):
    df, labels, m = model(spark, documents)
    rows = toxicity.scored(df, m).collect()
    assert sum(r.predicted == labels[r.doc_id] for r in rows) / len(rows) > 0.97
    plain = "rino sumo tael mori nosu "
    for word in ("1d10t", "idiooot", "i d i o t", "s.t.u.p.i.d", "w0rthle55", "tr@sh!", "STUPID", "t-r-a-s-h"):
        assert m.score(plain + word + " elno") >= 0.7, word
    assert m.score(plain + "elno taelri") < 0.3
    assert m.restored("1d10t")[1:] == ["idiot"]


def test_cases(spark, documents):
    _, _, m = model(spark, documents)
    df = documents([None, "", "!!! ...", "a" * 50_000, "stupid", "stupid"])
    rows = sorted(toxicity.scored(df, m).collect())
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows) and rows[4].score == rows[5].score
    assert rows[0].predicted == 0
    assert toxicity.scored(df.limit(0), m).collect() == []
    none = toxicity.train(df, spark.createDataFrame([(1, None)], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.scored(df, none).collect()} == {0.0}


def test_words_at_any_place_of_a_disguised_phrase(spark, documents):
    _, _, m = model(spark, documents)
    spaced = lambda t: " ".join(t.replace(" ", ""))
    for phrase in ("a idiot", "rino sumo idiot", "rino sumo tael mori nosu rino sumo tael mori nosu idiot rino"):
        assert "idiot" in m.restored(spaced(phrase)), phrase
        assert m.score("rino sumo tael mori nosu " + spaced(phrase) + " elno") >= 0.7, phrase
    assert "idiot" in m.restored("-".join("rinosumotaelmorinosu" * 3 + "idiot"))
    assert m.channel.decode("t4ri" * 5000 + "1d10t") == "tari" * 5000 + "idiot"
    assert m.score(spaced("rino sumo tael mori nosu")) < 0.3


def paths(channel, options, state="^^", score=0.0, out=""):
    """Every reading of a lattice with its score, by full enumeration."""
    if not options:
        yield score + channel.log_p(state, "$"), out
        return
    for emit, cost in options[0]:
        s, now = state, score + cost
        for letter in emit:
            now += channel.log_p(s, letter)
            s = s[1] + letter
        yield from paths(channel, options[1:], s, now, out + emit)


def test_decoding_finds_the_best_of_all_readings():
    rng = random.Random(2)
    tri = {}
    for w in ("idiot", "trash", "little", "toll", "tar", "ilia", "ooze", "stool"):
        for i in range(len(w) + 1):
            t = f"^^{w}$"[i : i + 3]
            tri[t] = tri.get(t, 0) + rng.randint(1, 9)
    channel = toxicity.Channel(tri)
    for _ in range(150):
        token = "".join(rng.choices("aiotlsr01!|.-3 ", k=rng.randint(1, 8)))
        token = token.replace("o", "ooo", 1) if rng.random() < 0.3 else token
        every = list(paths(channel, channel.lattice(token)))
        best = max(s for s, _ in every)
        assert channel.decode(token) in {out for s, out in every if s > best - 1e-9}, token


def test_sample_is_bounded_for_repeated_ids(spark, documents, monkeypatch):
    rows = []
    monkeypatch.setattr(toxicity, "logistic", lambda x, y: rows.append(len(y)) or (0.0,) * x.shape[1])
    texts, labels = made(60)
    df = documents([*texts, *(["some text"] * 50), *(f"text {i}" for i in range(20))], ids=[*range(60), *[3] * 70])
    marks = spark.createDataFrame([(i, y, 1.5, "x") for i, y in enumerate(labels)], "doc_id long, toxic int, text double, label string")
    known = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    toxicity.train(df, marks)
    toxicity.train(df, marks, sample=7)
    assert rows == [len(known), 7]


def test_long_words_train_and_nothing_is_cut():
    word = "ab" * 60
    counted = list(toxicity._count(iter([pa.RecordBatch.from_arrays([pa.array([word] * 3), pa.array([1, 0, 0])], ["text", "label"])])))
    table = dict(zip(counted[0].column(0).to_pylist(), zip(counted[0].column(1).to_pylist(), counted[0].column(2).to_pylist())))
    assert table["=" + word] == (1, 2) and table["\taba"][0] == 3 * 59


def test_all_labelled_texts_train_whatever_their_number(spark, documents, monkeypatch):
    texts, labels = made(400, seed=3)
    df, marks = documents(texts), spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    whole = toxicity.train(df, marks)
    collected = []
    monkeypatch.setattr(toxicity, "logistic", lambda x, y: collected.append(len(y)))
    for limit in ("SAMPLE", "IN_HAND"):  # far fewer than there are
        monkeypatch.setattr(toxicity, limit, 20, raising=False)
    more = toxicity.train(df, marks)
    assert not collected and more.counts == whole.counts and more.channel.tri == whole.channel.tri
    assert max(abs(a - b) for a, b in zip(more.coefficients, whole.coefficients, strict=True)) < 1e-5
    assert toxicity.train(df.repartition(7), marks.repartition(5)).coefficients == more.coefficients


def test_no_label_is_left_out_beyond_the_former_sample(spark):
    n = 31_000  # about 20,600 that are not held out
    docs = spark.range(n).selectExpr("id as doc_id", "if(id % 2 = 0, 'mori nosu idiot', 'mori nosu tael') as text")
    marks = spark.range(n).selectExpr("id as doc_id", "int(id % 2 = 0) as toxic")
    learned = [i for i in range(n) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert len(learned) > 20_000
    m = toxicity.train(docs, marks)
    assert m.counts["=idiot"] == (sum(i % 2 == 0 for i in learned), 0)
    assert m.channel.tri["^^m"] == len(learned)
    assert m.score("mori nosu idiot") > 0.9 and m.score("mori nosu tael") < 0.1
