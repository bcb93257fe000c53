import re

import pytest
from palaver.functions.text import unescape
from palaver.operators import backends, completion, labeling, tokenising
from pyspark.sql import functions as F

ANSWERS = [
    "1:\nReason: warm words\nLabel: empathy_provider\n2:\nLabel: none\nReason: plain",
    "[1].\nReason: a\nLabel: Empathy_seeker.\n[2]. text\n[Label]: None\n[Reason]: b c",
    "nothing here",
    "index:1: \nReason: x \nLabel: empathy_seeker\nindex:2: \nReason: y \nLabel: none",
]


def by_python(text):
    out = []
    for m in re.findall(labeling.EMPATHY_PATTERN, text):
        if m[6] or m[12]:
            out.append((m[11], m[8]) if m[6] else (m[14], m[17]))
    return out


def test_labels_as_the_pattern_gives_them(spark):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ANSWERS)], "i int, r string")
    for row in df.select("i", labeling.parsed_labels(F.col("r")).alias("p")).collect():
        assert [(x.label, x.reason) for x in row.p] == by_python(ANSWERS[row.i])


def test_completion(spark):
    df = spark.createDataFrame([("Reason: it flows.\nThe final answer is: complete",), ("no",)], "r string")
    got = [tuple(r.p) for r in df.select(labeling.parsed_completion(F.col("r")).alias("p")).collect()]
    assert got == [("complete", "it flows. "), (None, None)]


def vote(spark, labels, order, strict=True):
    df = spark.createDataFrame([("c", i, x, f"r{i}") for i, x in enumerate(labels)], "c string, i int, k int, r string")
    return labeling.votes(df, ["c"], "k", order, "r", "i", strict).first()


def test_votes(spark):
    assert vote(spark, [1, 2], labeling.EMPATHY_ORDER).label == 1
    assert vote(spark, [2, 0], labeling.EMPATHY_ORDER).label == 2
    assert vote(spark, [0, 1], labeling.COMPLETION_ORDER).label == 1
    row = vote(spark, [2, 2, 0, None], labeling.EMPATHY_ORDER)
    assert (row.label, row.n_votes, row.reasons, row.share_1) == (2, 3, ["r0", "r1"], 0.0)
    assert vote(spark, [None], labeling.EMPATHY_ORDER).label is None
    assert vote(spark, [None], labeling.EMPATHY_ORDER, strict=False).label == 1
    assert vote(spark, [None], labeling.COMPLETION_ORDER, strict=False).label == 1


def test_answers_of_the_wrong_length_do_not_count(spark):
    df = spark.createDataFrame([("c", 0, 2, ANSWERS[0]), ("c", 1, 2, "1:\nReason: x\nLabel: none"), ("d", 0, 1, "nothing")], "conv string, i int, n int, r string")
    got = {(r.conv, r.position): (r.label, r.n_votes) for r in labeling.empathy_votes(df, "conv", "r", "i", "n").collect()}
    assert got == {("c", 0): (2, 1), ("c", 1): (0, 1), ("d", 0): (None, 0)}


class Flaky:
    chat = False

    def __init__(self, bad):
        self.bad, self.asked = bad, []

    def complete(self, prompt, choices):
        self.asked.append(choices)
        if len(self.asked) <= self.bad:
            return ["bad"] * choices
        return ["good"] * (choices - 1) + ["bad"]


def test_rounds_ask_for_what_is_missing():
    c = Flaky(2)
    assert completion.rounds(c, "p", lambda a: a == "good", 5, 5) == ["good"] * 4 and c.asked[:4] == [5, 5, 5, 1]
    c = Flaky(100)
    assert completion.rounds(c, "p", lambda a: a == "good", 5, 2) == [] and len(c.asked) == completion.IDLE_ROUNDS


class Broken:
    chat = True

    def complete(self, prompt, choices):
        raise OSError("down")


def test_failures_are_bounded_and_seen():
    with pytest.raises(OSError):
        completion.ask(Broken(), "p", 3, pause=0)

    class Once(Broken):
        def __init__(self):
            self.n = 0

        def complete(self, prompt, choices):
            self.n += 1
            return super().complete(prompt, choices) if self.n == 1 else ["x"] * choices

    assert completion.ask(Once(), "p", 2, pause=0) == ["x", "x"]


def test_answers_are_accepted_as_the_votes_read_them(spark):
    answers = [
        "1:\nReason: a\nLabel: none\n2:\nReason: b\nLabel: Empathy_seeker", "1:\\nReason: a\\nLabel: none\\n2:\\nReason: b\\nLabel: none",
        "Label: none Label: none", "1:\nReason: a\nLabel: none", "1:\nLabel: none\nReason: a\n2:\nLabel: none\nReason: b", "",
    ]
    valid = completion.valid_answer("empathy", 2)
    rows = [("c", i, 2, a) for i, a in enumerate(answers)]
    df = spark.createDataFrame(rows, "conv string, number int, n int, response string").withColumn("response", unescape(F.col("response")))
    sizes = [r.s for r in df.select("number", F.size(labeling.parsed_labels(F.col("response"))).alias("s")).orderBy("number").collect()]
    assert [valid(a) for a in answers] == [s == 2 for s in sizes] and sum(map(valid, answers)) == 3
    done = completion.valid_answer("completion", 2)
    texts = ["Reason: x.\nThe final answer is: complete", "The final answer is: complete", "final answer is Reason: x", "Reason: y the final answer is Incomplete"]
    got = [r.x is not None for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", labeling.parsed_completion(F.col("t"))["label"].alias("x")).orderBy("i").collect()]
    assert [done(t) for t in texts] == got and sum(got) == 2


def test_backends_ask_in_their_form():
    sent = []

    def send(url, headers, body):
        sent.append(body)
        n = body.get("n", 1)
        return {"choices": [{"message": {"content": f"c{i}"}} for i in range(n)]} if "messages" in body else {"output": {"choices": [{"text": f"t{i}"} for i in range(n)]}}

    asked = {}
    for form in backends.FORMS:
        sent.clear()
        b = backends.backend(form, "u", "m", send=send)
        assert len(b.complete([{"role": "user", "content": "p"}] if b.chat else "p", 3)) == 3
        asked[form] = (len(sent), b.chat, b.pause)
        assert all(x["model"] == "m" for x in sent) and ("temperature" in sent[0]) == (form != "text/single-plain")
    assert asked == {"text/single": (3, False, 1.0), "text/single-plain": (3, False, 1.0), "text/many": (1, False, 1.0), "chat/single": (3, True, 0.0), "chat/many": (1, True, 0.0)}
    with pytest.raises(ValueError):
        backends.backend("other", "u")
    with pytest.raises(ValueError):
        backends.texts_of({"error": "x"})
    assert backends.texts_of(["a", {"generated_text": "b"}]) == ["a", "b"]


def test_models_behind_chains(spark):
    load = completion.deployed(lambda: lambda xs: [x * 2 for x in xs], (lambda xs: [len(x) for x in xs],), lambda out: [o + 1 for o in out])
    assert load()(["a", "bcd"]) == [3, 7]


def test_token_ids(spark):
    tokenizers = pytest.importorskip("public_tokenizers")
    path, end = tokenizers.path("word_bpe_49k.json"), "<|endoftext|>"
    df = spark.createDataFrame([(1, "hello there"), (2, None), (3, "word " * 300)], "id int, t string").selectExpr("*", "1 as input_ids")
    rows = {r.id: r for r in tokenising.tokenised(df, "t", path, 16, ("id",), begin="<|startoftext|>", end=end).collect()}
    for r in rows.values():
        assert len(r.input_ids) == len(r.attention_mask) == len(r.token_type_ids) == 16 and r.input_ids[0] == 49406 and not any(r.token_type_ids)
    assert sum(rows[2].attention_mask) == 2 and sum(rows[1].attention_mask) == 4 and rows[1].input_ids[4:] == [49407] * 12
    assert sum(rows[3].attention_mask) == 16 and rows[3].input_ids[-1] == 49407
    assert tokenising.tokenised(df.limit(0), "t", path, 16).collect() == []
    with pytest.raises(ValueError):
        tokenising.loaded(path, 8, begin="<none of these>")


def test_offline_labels_end_to_end(spark):
    df = spark.createDataFrame([("a", 0, "xxxx", "A"), ("a", 1, "xx", "B"), ("b", 0, "abc", "A")], "conv_id string, utter_id long, utterance string, speaker string")
    answers = completion.responses(df, completion.OfflineCompleter(), "conv_id", "utter_id", "utterance", "empathy", 10)
    got = {(r.conv_id, r.utter_id): r for r in completion.labelled(df, answers).collect()}
    assert {k: r.empathy_kind for k, r in got.items()} == {("a", 0): 1, ("a", 1): 2, ("b", 0): 0}
    assert got["a", 0].empathy_percents["seeking"] == 1.0 and len(got["a", 0].empathy_reasons) == 10


def test_classifiers_as_batches(spark):
    import numpy as np

    df = spark.createDataFrame([("a", 0, "x"), ("a", 1, "yy"), ("b", 0, "z")], "conv_id string, utter_id long, utterance string")
    size = lambda: lambda texts: np.array([len(t) % 3 for t in texts])
    many = lambda: lambda texts: np.array([float(t.count("<BOU>") > 1) for t in texts])
    got = {(r.conv_id, r.utter_id): (r.empathy_kind, r.is_empathy) for r in completion.classified(df, size, many).collect()}
    assert got == {("a", 0): (1, 1.0), ("a", 1): (2, 1.0), ("b", 0): (1, 0.0)}
