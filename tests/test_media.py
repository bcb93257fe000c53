import pytest
from palaver.sources import media
from palaver.spec import DAILYTALK, MELD, MUSTARD


def tools():
    """Defined in a function, and so sent to workers by value."""

    class Fetcher:
        def fetch(self, url, folder):
            return None if "bad" in url else f"{folder}/{url}.mp4"


    class Tool:
        def extract(self, video, target):
            return target

        def seconds(self, recording):
            return 9.5

        def cut(self, recording, start, end, target):
            return f"{recording}[{start}-{end}]>{target}"

    return Fetcher(), Tool()


def test_media(spark):
    fetcher, tool = tools()
    df = spark.createDataFrame([("a", 1, "u", 0.0), ("a", 3, "u", 2.0), ("b", 0, "v", 0.0), ("c", 0, "bad", 0.0)], "conv_id string, utter_id long, url string, at double")
    got = media.downloaded(df, fetcher, "url", "/f")
    assert {(r.conv_id, r.file_name) for r in got.collect()} == {("a", "/f/u.mp4"), ("b", "/f/v.mp4"), ("c", None)}
    audio = media.extracted(got, tool)
    assert {(r.conv_id, r.file_name) for r in audio.collect()} == {("a", "/f/u.wav"), ("b", "/f/v.wav"), ("c", None)}
    out = {(r.conv_id, r.utter_id): r.file_name for r in media.cut(audio, tool, "/o", "at").collect()}
    assert out == {("a", 1): "/f/u.wav[0.0-2.0]>/o/a_1.wav", ("a", 3): "/f/u.wav[2.0-9.5]>/o/a_3.wav", ("b", 0): "/f/v.wav", ("c", 0): None}


def test_stage_follows_the_corpus(spark):
    fetcher, tool = tools()

    class Aligner:
        def starts(self, recording, texts):
            return [10.0 * i for i in range(len(texts))]

    df = spark.createDataFrame([("a", 1, "x", "/f/u.mp4"), ("a", 3, "yy", "/f/u.mp4"), ("b", 0, "z", None)], "conv_id string, utter_id long, utterance string, file_name string")
    paths = lambda run: {(r.conv_id, r.utter_id): r.file_name for r in run(df).collect()}
    assert paths(media.stage(MELD, "/o", tool=tool)) == {("a", 1): "/f/u.wav", ("a", 3): "/f/u.wav", ("b", 0): None}
    assert paths(media.stage(MUSTARD, "/o", tool=tool, aligner=Aligner())) == {("a", 1): "/f/u.wav[0.0-10.0]>/o/audio/a_1.wav", ("a", 3): "/f/u.wav[10.0-9.5]>/o/audio/a_3.wav", ("b", 0): None}
    assert paths(media.stage(DAILYTALK, "/o")) == {("a", 1): "/f/u.mp4", ("a", 3): "/f/u.mp4", ("b", 0): None}
    with pytest.raises(ValueError):
        media.stage(MELD, "/o")


def test_upload_tries_again():
    class Hub:
        def __init__(self, bad):
            self.bad, self.got = bad, []

        def upload(self, folder, target):
            if self.bad:
                self.bad -= 1
                raise OSError("busy")
            self.got.append((folder, target))

    hub = Hub(2)
    media.upload(hub, "f", "t", pause=0)
    assert hub.got == [("f", "t")]
    with pytest.raises(OSError):
        media.upload(Hub(9), "f", "t", retries=3, pause=0)
