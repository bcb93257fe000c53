"""Media behind interfaces: the relational part is native, the bytes are another program's.

A fetcher and an audio tool are objects that executors can be sent; neither is given here. Each distinct
recording is handled once, whatever the number of its utterances.
"""

from __future__ import annotations

import time
import zipfile
from collections.abc import Callable
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palaver.functions.text import audio_path, media_name
from palaver.operators.relational import grouped
from palaver.shipping import ship
from palaver.spec import SourceSpec


class Fetcher(Protocol):
    """Brings what is at the URL into the folder; its path, or None if that fails."""

    def fetch(self, url: str, folder: str) -> str | None: ...


class AudioTool(Protocol):
    def extract(self, video: str, target: str) -> str: ...

    def seconds(self, recording: str) -> float: ...

    def cut(self, recording: str, start: float, end: float, target: str) -> str: ...


class Aligner(Protocol):
    """Finds when each of a recording's utterances begins, in seconds, one number for each text."""

    def starts(self, recording: str, texts: list[str]) -> list[float]: ...


def unpack(archive: str, folder: str) -> None:
    """Unpacks a zip file, on the driver."""
    with zipfile.ZipFile(archive) as z:
        z.extractall(folder)


def _each(df: DataFrame, column: str, made: str, kind: str, function) -> DataFrame:
    """column and function(column) for each distinct value."""
    ship(df.sparkSession)

    def run(batches):
        for batch in batches:
            yield pd.DataFrame({column: batch[column], made: [function(x) for x in batch[column]]})

    once = df.select(column).where(F.col(column).isNotNull()).distinct()
    return once.mapInPandas(run, f"{column} string, {made} {kind}")


def downloaded(df: DataFrame, fetcher: Fetcher, url: str, folder: str, name: str = "file_name") -> DataFrame:
    """df with the path of each row's recording, null where it could not be had."""
    return df.drop(name).join(_each(df, url, name, "string", lambda u: fetcher.fetch(u, folder)), url, "left")


def extracted(df: DataFrame, tool: AudioTool, path: str = "file_name") -> DataFrame:
    """df with the sound track's path in place of the video's."""
    pairs = df.withColumn("__to", audio_path(F.col(path))).select(F.concat_ws("\t", path, "__to").alias("__job"), path)
    made = _each(pairs.where(F.col(path).isNotNull()), "__job", "__audio", "string", lambda j: tool.extract(*j.split("\t")))
    by_path = made.select(F.substring_index("__job", "\t", 1).alias(path), "__audio")
    return df.join(by_path, path, "left").drop(path).withColumnRenamed("__audio", path)


def aligned(df: DataFrame, aligner: Aligner, name: str, conv: str = "conv_id", utter: str = "utter_id", text: str = "utterance", path: str = "file_name") -> DataFrame:
    """df with the second at which each utterance begins in its recording; null without a recording."""
    ship(df.sparkSession)
    order = F.struct(F.col(utter).alias("o"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    talks = grouped(df.where(F.col(path).isNotNull()), conv).groupBy(conv, path).agg(F.array_sort(F.collect_list(order)).alias("__u"))
    asked = talks.select(conv, path, F.transform("__u", lambda u: u["t"]).alias("texts"))

    def run(batches):
        for batch in batches:
            found = [list(map(float, aligner.starts(p, list(t)))) for p, t in zip(batch[path], batch["texts"], strict=True)]
            yield pd.DataFrame({conv: batch[conv], path: batch[path], "__starts": found})

    kind = df.schema[conv].dataType.simpleString()
    times = asked.mapInPandas(run, f"{conv} {kind}, {path} string, __starts array<double>")
    at = F.row_number().over(Window.partitionBy(conv, path).orderBy(utter)) - 1
    return df.withColumn("__at", at).join(times, [conv, path], "left").withColumn(name, F.get("__starts", F.col("__at"))).drop("__at", "__starts")


def cut(df: DataFrame, tool: AudioTool, folder: str, start: str, conv: str = "conv_id", utter: str = "utter_id", path: str = "file_name") -> DataFrame:
    """df with a file of each utterance's own: from its start to the next one's, the last to the end.

    A recording of a single utterance stays as it is. Files are named by conversation and utterance id.
    """
    length = _each(df, path, "__seconds", "double", tool.seconds)
    w = Window.partitionBy(conv, path)
    timed = grouped(df, conv).join(length, path, "left").withColumns({"__n": F.count("*").over(w), "__end": F.lead(start).over(w.orderBy(utter))})
    timed = timed.withColumn("__to", F.concat(F.lit(f"{folder}/"), media_name(F.col(conv), F.col(utter)))).withColumn("__end", F.coalesce("__end", "__seconds"))
    wanted = timed.where(F.col(path).isNotNull() & (F.col("__n") > 1))
    job = F.concat_ws("\t", F.col(path), F.col(start).cast("string"), F.col("__end").cast("string"), F.col("__to"))

    def one(text: str) -> str:
        recording, a, b, target = text.split("\t")
        return tool.cut(recording, float(a), float(b), target)

    pieces = _each(wanted.select(job.alias("__job")), "__job", "__piece", "string", one)
    out = timed.withColumn("__job", F.when(F.col("__n") > 1, job)).join(pieces, "__job", "left")
    return out.withColumn(path, F.coalesce("__piece", path)).drop("__job", "__piece", "__n", "__end", "__to", "__seconds")


def stage(spec: SourceSpec, folder: str, fetcher: Fetcher | None = None, tool: AudioTool | None = None, aligner: Aligner | None = None) -> Callable[[DataFrame], DataFrame]:
    """What a corpus's media need, by its flags: download, sound track out of a video, one file per utterance.

    Utterances are cut at the corpus's times, or, where it has none, at those that the aligner finds.
    """
    needs = {"fetcher": spec.download and fetcher is None, "tool": (spec.video_to_audio or spec.audio_split) and tool is None}
    if any(needs.values()):
        raise ValueError(f"{spec.name} needs {' and '.join(k for k, v in needs.items() if v)}")

    def run(df: DataFrame) -> DataFrame:
        if spec.download:
            df = downloaded(df, fetcher, spec.url, f"{folder}/raw")
        if spec.video_to_audio:
            df = extracted(df, tool)
        if spec.audio_split:
            times = spec.timestamp
            if times is None or times not in df.columns:
                if aligner is None:
                    return df
                times = "__begin"
                df = aligned(df, aligner, times)
            df = cut(df, tool, f"{folder}/audio", times).drop("__begin")
        return df

    return run


class Uploader(Protocol):
    """Sends a folder to a hub."""

    def upload(self, folder: str, target: str) -> None: ...


def upload(uploader: Uploader, folder: str, target: str, retries: int = 5, pause: float = 5.0) -> None:
    """Sends a saved data set from the driver; the last failure is raised."""
    for attempt in range(retries):
        try:
            return uploader.upload(folder, target)
        except OSError:
            if attempt + 1 == retries:
                raise
            time.sleep(pause)
