import hashlib
import json
from pathlib import Path

import pytest
from palaver import settings
from palaver.functions.text import clock_seconds
from palaver.plans import cli, merge, pipeline
from palaver.sources import readers, sinks
from palaver.spec import ANNOMI, DAILYTALK, MELD, MUSTARD
from palaver.streaming import chunks
from pyspark.sql import functions as F


def meld(path, ids):
    head = "Dialogue_ID,Utterance_ID,Utterance,Speaker,Emotion,Sentiment,Old_Dialogue_ID,Old_Utterance_ID,Other\n"
    path.write_text(head + "".join(f'{d},{u},"Say ""{u}"",\nthen",{s},joy,good,{d},{u},z\n' for d, u, s in ids))


def test_csv_with_quotes_and_splits(spark, tmp_path):
    meld(tmp_path / "dev_sent_emo_dya.csv", [(0, 0, "A"), (0, 1, "B"), (0, 2, "A")])
    meld(tmp_path / "test_sent_emo_dya.csv", [(0, 0, "A"), (0, 1, "B"), (1, 0, "A"), (1, 1, "A")])
    meld(tmp_path / "train_sent_emo_dya.csv", [(0, 0, "C"), (0, 1, "D"), (0, 2, "C"), (0, 3, "D"), (1, 0, "A")])
    frames = readers.read_splits(spark, {s: str(tmp_path / f"{s}_sent_emo_dya.csv") for s in ("dev", "test", "train")})
    df = readers.offset_union(frames, "Dialogue_ID")
    assert sorted({(r.split, r.Dialogue_ID) for r in df.collect()}) == [("dev", 0), ("test", 3), ("test", 4), ("train", 7), ("train", 8)]
    assert df.where("Utterance_ID = 1").first().Utterance == 'Say "1",\nthen'
    out = cli.cleaner(MELD, str(tmp_path))(spark).collect()
    assert {r.Dialogue_ID for r in out} == {0, 3, 7} and all(r.file_path is None for r in out)


def test_nested_json(spark, tmp_path):
    talk = {"7": {"0": {"dialog_idx": 7, "utterance_idx": 0, "text": "hi", "speaker": "0", "emotion": "joy", "act": "x"}, "1": {"dialog_idx": 7, "utterance_idx": 1, "text": "ho", "speaker": "1", "emotion": "joy", "act": "x"}}}
    (tmp_path / "metadata.json").write_text(json.dumps(talk, indent=1))
    (tmp_path / "data/7").mkdir(parents=True)
    (tmp_path / "data/7/0_0_d7.wav").write_bytes(b"x")
    got = {r.utterance_idx: r.file_path for r in cli.cleaner(DAILYTALK, str(tmp_path))(spark).collect()}
    assert got[0].endswith("data/7/0_0_d7.wav") and got[1] is None


def test_context_and_target(spark, tmp_path):
    rec = {"r1": {"utterance": "t", "speaker": "B", "context": ["a"], "context_speakers": ["A"], "sarcasm": True, "show": "S"}, "r0": {"utterance": "u", "speaker": "A", "context": ["b", "c"], "context_speakers": ["A", "B"], "sarcasm": False}}
    (tmp_path / "sarcasm_data.json").write_text(json.dumps(rec))
    rows = sorted((r.conv_id, r.utter_id, r.utterance, r.type_utter, r.scam) for r in readers.read_mustard(spark, str(tmp_path / "sarcasm_data.json")).collect())
    assert rows == [(0, 0, "a", "context", True), (0, 1, "t", "target", True), (1, 0, "b", "context", False), (1, 1, "c", "context", False), (1, 2, "u", "target", False)]
    assert cli.cleaner(MUSTARD, str(tmp_path), False)(spark).count() == 5


def test_annotations_are_joined_and_files_required(spark, tmp_path):
    head = "transcript_id,utterance_id,utterance_text,interlocutor,video_url,timestamp,client_talk_type,main_therapist_behaviour\n"
    row = "{},{},text,{},https://www.youtube.com/watch?v={},0:00:0{},{},\n"
    body = "".join(row.format(*x) for x in [(1, 0, "t", "K", 1, "b"), (1, 0, "t", "K", 1, "a"), (1, 1, "c", "K", 5, "a"), (2, 0, "t", "none", 1, "a")])
    (tmp_path / "AnnoMI-full.csv").write_text(head + body)
    (tmp_path / "K.wav").write_bytes(b"x")
    rows = sorted((r.transcript_id, r.utterance_id, r.timestamp, r.client_talk_type) for r in cli.cleaner(ANNOMI, str(tmp_path))(spark).collect())
    assert rows == [("1", 0, 1.0, "a"), ("1", 1, 5.0, "a")]


def scan(spark):
    rows = [(c, i, "x" * n, "AB"[i % 2]) for c, lengths in enumerate([(1, 2, 4, 2), (3, 1, 2), (1, 1), (4, 5, 2)]) for i, n in enumerate(lengths)]
    return spark.createDataFrame(rows, "dialog_idx long, utterance_idx long, text string, speaker string").withColumn("emotion", F.lit("e")).withColumn("act", F.lit("a"))


def test_stages_resume_and_chunks(spark, tmp_path):
    run = pipeline.Pipeline(spark, DAILYTALK, str(tmp_path / "a"), scan)
    whole = run.run()
    assert run.next_stage() == len(pipeline.STAGES) and run.run() is not None
    assert whole.columns == ["conv_id", "utter_id", "utterance", "speaker", "file_name", "emotion", "act"]
    rows = sorted((r.conv_id, r.utter_id) for r in whole.collect())
    assert rows == [("0_0", 0), ("0_0", 1), ("0_0", 2), ("0_0", 3), ("1_0", 0), ("1_0", 1), ("3_0", 0), ("3_0", 1)]
    assert [r.stage for r in run.progress().collect()] == list(pipeline.STAGES)
    with pytest.raises(ValueError):
        run.run("nothing")
    part = pipeline.Pipeline(spark, DAILYTALK, str(tmp_path / "b"), scan)
    with pytest.raises(ValueError):
        part.run("label")
    part.run(stop="two_party")
    for _ in range(4):
        before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "b/dailytalk/label").glob("*.parquet")} if part.stored("label") else {}
        part.run("label", "label", 1)
        after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "b/dailytalk/label").glob("*.parquet")}
        assert before.items() <= after.items()  # a chunk leaves the files of others alone
    assert part.load("label").count() == 12 and part.load("label").select("conv_id").distinct().count() == 4
    assert sorted((r.conv_id, r.utter_id) for r in part.run("empathetic").collect()) == rows


def test_edited_copy_is_taken(spark, tmp_path):
    plain = pipeline.Pipeline(spark, DAILYTALK, str(tmp_path / "plain"), scan)
    plain.run(stop="label")
    assert not sinks.exists(spark, f"{plain.path('label')}.edit")
    run = pipeline.Pipeline(spark, DAILYTALK, str(tmp_path), scan, editable=True)
    run.run(stop="label")
    labelled = run.load("label")
    edit = sinks.read_editable(spark, f"{run.path('label')}.edit", labelled.schema)
    assert sorted(map(str, edit.collect())) == sorted(map(str, labelled.collect()))
    sinks.write_editable(edit.withColumn("empathy_kind", F.lit(0)), f"{run.path('label')}.edited")
    assert run.run("empathetic", "empathetic").count() == 0


def test_merge_and_files(spark, tmp_path):
    (tmp_path / "x.wav").write_bytes(b"x")
    one = spark.createDataFrame([(str(c), i, "t", "s", f"{tmp_path}/x.wav", "e") for c in range(10) for i in range(2)], "dialog_idx string, utterance_idx long, text string, speaker string, file_path string, emotion string")
    two = spark.createDataFrame([("k", 0, "t", "s", None, True)], "conv_id string, utter_id long, utterance string, speaker string, file_path string, scam boolean")
    out = merge.merged({"dailytalk": one, "mustard": two})
    assert merge.leakage(out).count() == 0 and {"emotion", "scam", "file_name"} <= set(out.columns)
    assert {r.conv_id for r in out.collect()} == {*(f"0_{i}" for i in range(10)), "1_k"}
    merge.save_merged(out, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 21 and Path(tmp_path / "m/split=train").is_dir()
    sinks.save_dataset(merge.with_roles(one, DAILYTALK.columns), str(tmp_path / "d"), media=True)
    assert (tmp_path / "d/audio_files/3_1.wav").read_bytes() == b"x"
    assert readers.read_merged(spark, str(tmp_path / "d"), "conv_id string, utter_id long, file_name string").count() == 20


def test_stream_takes_new_files_once(spark, tmp_path):
    src, to, mark = (str(tmp_path / x) for x in "abc")
    stage = lambda df: df.withColumn("seen", F.lit(1))
    df = spark.createDataFrame([("a", 0), ("b", 0)], "conv_id string, utter_id long")
    df.where("conv_id = 'a'").write.parquet(src)
    chunks.run_available(spark, src, to, mark, stage)
    df.where("conv_id = 'b'").write.mode("append").parquet(src)
    chunks.run_available(spark, src, to, mark, stage)
    chunks.run_available(spark, src, to, mark, stage)
    assert sorted(r.conv_id for r in spark.read.parquet(to).collect()) == ["a", "b"]


def test_arguments_and_clock(spark, capsys):
    assert cli.main(["stages"]) == 0 and "segment:" in capsys.readouterr().out
    assert cli.arguments(["run", "--corpus", "mustard", "--root", "r", "--chunk", "200"]).chunk == 200
    assert spark.range(1).select(clock_seconds(F.lit("0:00:09"))).first()[0] == 9.0


def test_interrupted_swaps_lose_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_swapped(spark.range(3), path)
    (tmp_path / "t").rename(tmp_path / "t.old")  # as if ended between the two renames
    sinks.settled(spark, path, f"{path}.old")
    assert spark.read.parquet(path).count() == 3
    (tmp_path / "t").rename(tmp_path / "t.old")
    sinks.write_swapped(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and not (tmp_path / "t.old").exists()


def test_upsert_touches_only_its_parts(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(200).selectExpr("cast(id as string) as conv_id", "id as n")
    sinks.upsert_parts(df, path, ("conv_id",), 8)
    times = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    sinks.upsert_parts(df.where("n = 5").withColumn("n", F.lit(-1).cast("long")), path, ("conv_id",), 8)
    assert sum(p.exists() and p.stat().st_mtime_ns == t for p, t in times.items()) == len(times) - 1
    rows = {r.conv_id: r.n for r in spark.read.parquet(path).collect()}
    assert len(rows) == 200 and rows["5"] == -1 and rows["6"] == 6
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_ranks_need_no_window_over_all_groups(spark):
    from palaver.operators import relational

    df = spark.range(500).selectExpr("cast(id as string) as conv_id", "if(id % 7 = 0, null, id % 3) as place")
    for by in ((), ("place",)):
        out = relational.group_split(df, "conv_id", by=by)
        plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
        single = [i for i, line in enumerate(plan) if "SinglePartition" in line]
        assert all("HashAggregate(keys=[__b#" in plan[i + 1] for i in single) and len(single) <= (not by)  # counts of buckets only
        rows = out.collect()
        assert len(rows) == 500
        for p in {r.place for r in rows} if by else {None}:
            own = sorted((hashlib.md5(f"200{r.conv_id}".encode()).hexdigest(), r.split) for r in rows if not by or r.place == p)
            t = round(len(own) * 0.8)
            e = round((len(own) - t) * 0.5)
            assert [s for _, s in own] == ["train"] * t + ["test"] * e + ["validation"] * (len(own) - t - e)


def test_settings(tmp_path):
    (tmp_path / "s.env").write_text("# a note\nROOT='x'\nexport SEED=7\n\nmeld = /m\n")
    got = settings.load(str(tmp_path / "s.env"), {"PALAVER_MELD": "/n", "OTHER": "1"})
    assert (got.root, got.seed, got.meld) == ("x", 7, "/n")
    (tmp_path / "s.json").write_text('{"seed": 9}')
    assert settings.load(str(tmp_path / "s.json"), {}).seed == 9
    (tmp_path / "bad").write_text("nothing=1")
    with pytest.raises(ValueError):
        settings.load(str(tmp_path / "bad"), {})


def test_merge_and_run_commands(spark, tmp_path):
    for name in ("dailytalk", "mustard"):
        df = spark.createDataFrame([(str(c), i, "t", "s", None) for c in range(10) for i in range(2)], "conv_id string, utter_id long, utterance string, speaker string, file_name string")
        sinks.save_dataset(df, str(tmp_path / name))
    assert cli.main(["merge", "--target", str(tmp_path / "m"), "--input", f"dailytalk={tmp_path}/dailytalk", "--input", f"mustard={tmp_path}/mustard"]) == 0
    out = spark.read.parquet(str(tmp_path / "m"))
    assert out.count() == 40 and {r.conv_id[:2] for r in out.collect()} == {"0_", "1_"}
    with pytest.raises(SystemExit):
        cli.main(["merge", "--target", str(tmp_path / "n"), "--root", str(tmp_path / "none")])
    talk = {str(c): {str(i): {"dialog_idx": c, "utterance_idx": i, "text": "x" * n, "speaker": "AB"[i % 2], "emotion": "e", "act": "a"} for i, n in enumerate((1, 2))} for c in range(3)}
    (tmp_path / "data").mkdir()
    (tmp_path / "data/metadata.json").write_text(json.dumps(talk))
    assert cli.main(["run", "--corpus", "dailytalk", "--root", str(tmp_path / "r"), "--data", f"file://{tmp_path}/data", "--no-media"]) == 0
    assert spark.read.parquet(str(tmp_path / "r/dailytalk/final")).count() == 6
    with pytest.raises(SystemExit):
        cli.main(["run", "--corpus", "dailytalk", "--root", str(tmp_path / "r"), "--data", str(tmp_path / "nowhere")])


def test_files_are_staged_under_new_names(spark, tmp_path):
    for split in ("dev", "test", "train"):
        meld(tmp_path / f"{split}_sent_emo_dya.csv", [(0, 0, "A"), (0, 1, "B")])
    (tmp_path / "dev_splits_complete").mkdir()
    (tmp_path / "dev_splits_complete/dia0_utt1.mp4").write_bytes(b"film")
    rows = cli.cleaner(MELD, str(tmp_path), stage_files=True)(spark).collect()
    paths = {(r.Dialogue_ID, r.Utterance_ID): r.file_path for r in rows}
    assert paths[0, 1] == f"{tmp_path}/audio_files/0_1.mp3" and Path(paths[0, 1]).read_bytes() == b"film"
    assert sum(p is not None for p in paths.values()) == 1
