import pytest
from palaver.functions import text as tx
from palaver.operators import relational as rel
from pyspark.sql import functions as F


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id string, utter_id long, speaker string")


def talk(spark, **convs):
    return frame(spark, [(c, i, s if s != "-" else None) for c, text in convs.items() for i, s in enumerate(text)])


def test_parties_count_a_missing_speaker_once(spark):
    got = {r.conv_id: r.num_party for r in rel.party_count(talk(spark, a="AB-", b="A", c="--")).collect()}
    assert got == {"a": 3, "b": 1, "c": 1}
    assert {r.conv_id for r in rel.two_party(talk(spark, a="AB-", b="ABAB", c="A-")).collect()} == {"b", "c"}


def test_turns(spark):
    kept = rel.alternating(talk(spark, a="ABA", b="AAB", c="ABC", d="A", e="A-A", f="ABAB")).collect()
    assert {r.conv_id for r in kept} == {"a", "e", "f"}


def test_mode_takes_the_least_of_equals(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "b"), ("k", "a"), ("k", None), ("n", None), (None, "x")], "k string, v string")
    assert {r.k: r.v for r in rel.first_mode(df, ["k"]).collect()} == {"k": "a", "n": None}


def test_leading_speaker_tie(spark):
    df = spark.createDataFrame([("c", 0, "B", 2), ("c", 1, "A", 2), ("d", 0, "A", 1)], "conv_id string, utter_id long, speaker string, empathy_kind int")
    assert [(r.conv_id, r.speaker) for r in rel.leading_speaker(df).collect()] == [("c", "A")]


@pytest.mark.parametrize(("groups", "sizes"), [(5, (4, 0, 1)), (7, (6, 0, 1)), (18, (14, 2, 2)), (0, (0, 0, 0))])
def test_split_sizes(spark, groups, sizes):
    df = frame(spark, [(f"c{g}", i, "A") for g in range(groups) for i in range(3)])
    got = rel.group_split(df, "conv_id").groupBy("split").agg(F.count_distinct("conv_id").alias("n")).collect()
    n = {r.split: r.n for r in got}
    assert (n.get("train", 0), n.get("test", 0), n.get("validation", 0)) == sizes


def test_chunks_go_through_all_groups(spark):
    df, done = talk(spark, a="AB", b="AB", c="AB"), None
    seen = []
    for _ in range(3):
        part = rel.next_chunk(df, done, "conv_id", 1)
        seen += sorted({r.conv_id for r in part.collect()})
        done = rel.upserted(done, part, "conv_id", "utter_id")
    assert seen == ["a", "b", "c"] and done.count() == 6
    assert rel.upserted(done, part, "conv_id", "utter_id").count() == 6


def test_unprocessed_takes_nulls_as_equal(spark):
    df = talk(spark, a="A-", b="B")
    assert rel.unprocessed_count(df, df.where("conv_id = 'a'")) == (1, 3)


def test_unequal_lists_are_an_error(spark):
    df = spark.createDataFrame([("a", [1, 2], [1])], "c string, x array<int>, y array<int>")
    with pytest.raises(Exception, match="unequal"):
        rel.exploded_together(df, "x", "y").collect()


def test_enriched_does_not_multiply_rows(spark):
    other = spark.createDataFrame([("a", 0, "y"), ("a", 0, "x")], "conv_id string, utter_id long, v string")
    assert [r.v for r in rel.enriched(talk(spark, a="A"), other, "conv_id", "utter_id").collect()] == ["x"]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_text_functions(spark):
    lit = F.lit
    for text, want in [("0:01:07", 67.0), ("23:59:59", 86399.0), ("1:2", None), ("x:1:2", None), ("1:75:0", None), (None, None)]:
        assert one(spark, tx.clock_seconds(lit(text).cast("string"))) == want
    assert one(spark, tx.url_tail_id(lit("https://www.youtube.com/watch?v=PaS&t=4"))) == "PaS"
    assert one(spark, tx.url_tail_id(lit("https://youtu.be/AbC"))) == "AbC"
    assert one(spark, tx.clean_text(lit('Hi, \\ Bob\'s—"x"'))) == "hi    bob s  x "
    for path, kept, fixed in [("a/b.mp4", "a/b..wav", "a/b.wav"), ("a/b.mp3", "a/b.mp3.wav", "a/b.wav")]:
        assert (one(spark, tx.audio_path(lit(path), True)), one(spark, tx.audio_path(lit(path)))) == (kept, fixed)
    assert one(spark, tx.directory(lit("a/b/c.x"))) == "a/b" and one(spark, tx.directory(lit("c.x"))) == ""
    assert one(spark, tx.conversation_string(F.array(lit("a"), lit("b")))) == "<BOU> a <EOU> <BOU> b <EOU> "
    assert one(spark, tx.numbered(F.array(lit("a"), lit("b")))) == "1. a\n2. b\n"
    assert one(spark, tx.unescape(lit("a\\nb\\tc"))) == "a\nb\tc"
    assert one(spark, tx.argmax(F.array(lit(1.0), lit(3.0), lit(3.0)))) == 1
    assert one(spark, tx.one_hot(lit(1), 3)) == [0, 1, 0]
    assert one(spark, tx.above(lit(0.5))) == 0.0
    assert [one(spark, tx.empathy_key(lit(x))) for x in ("Empathy_seeker", "empathy_provider", "None", "other")] == [1, 2, 0, None]
