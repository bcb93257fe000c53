"""Command line: run stages, show progress, merge corpora, explain stages.

    python -m palaver.plans.cli run --corpus annomi --data DIR --root DIR [--start S] [--stop S] [--chunk N]
        [--editable] [--tool MODULE:NAME] [--fetcher MODULE:NAME] [--aligner MODULE:NAME]
    python -m palaver.plans.cli progress --corpus annomi --root DIR
    python -m palaver.plans.cli merge --target DIR [--input CORPUS=DIR ...] [--root DIR] [--files]
    python -m palaver.plans.cli stages

Folders may be on any file system that Spark reads. Defaults come from --settings FILE and the environment.
A tool is a function or class without arguments that makes one.
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver import settings
from palaver.functions.text import clock_seconds
from palaver.operators.backends import backend
from palaver.operators.relational import alternating, first_mode
from palaver.plans import merge
from palaver.plans.pipeline import STAGES, Pipeline
from palaver.sources import media, readers, sinks
from palaver.spec import SOURCES, SourceSpec

ABOUT = {
    "clean": "read the corpus into one row per utterance", "media": "turn media into audio per utterance", "two_party": "keep conversations of two speakers",
    "label": "label utterances as seeking or providing empathy", "empathetic": "keep conversations in which seeking is answered", "segment": "cut conversations into empathetic segments",
    "check": "judge whether segments are complete", "complete": "keep complete segments", "final": "keep the result's columns",
}


def cleaner(spec: SourceSpec, folder: str, probe: bool = True, stage_files: bool = False):
    """The corpus's reader: scan, repair and file lookup; stage_files copies files to names by conversation and utterance."""

    def scan(spark: SparkSession):
        files = lambda: readers.listing(spark, folder)
        if spec.name == "annomi":
            df = readers.read_csv(spark, f"{folder}/AnnoMI-full.csv", readers.ANNOMI_SCHEMA).withColumn("timestamp", clock_seconds(F.col("timestamp")))
            df = first_mode(df, [spec.conv, spec.utter, spec.text])
            return readers.with_files(df, files(), readers.annomi_file(F.col(spec.url)), True) if probe else df
        if spec.name == "dailytalk":
            df = readers.read_dailytalk(spark, f"{folder}/metadata.json")
            return readers.with_files(df, files(), readers.dailytalk_file(F.col(spec.conv), F.col(spec.utter), F.col(spec.speaker)), False) if probe else df
        if spec.name == "meld":
            frames = readers.read_splits(spark, {s: f"{folder}/{s}_sent_emo_dya.csv" for s in ("dev", "test", "train")})
            df = alternating(readers.offset_union(frames, spec.conv), spec.conv, spec.utter, spec.speaker)
            if not probe:
                return df
            df = readers.with_files(df, files(), readers.meld_file(F.col("split"), F.col("Old_Dialogue_ID"), F.col("Old_Utterance_ID")), False)
            return sinks.staged(df, f"{folder}/audio_files", spec.conv, spec.utter) if stage_files else df
        df = alternating(readers.read_mustard(spark, f"{folder}/sarcasm_data.json"), spec.conv, spec.utter, spec.speaker)
        return readers.with_files(df, files(), readers.mustard_file(F.col("record_id"), F.col("type_utter")), False) if probe else df

    return scan


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="palaver")
    tasks = parser.add_subparsers(dest="task", required=True)
    for task in ("run", "progress", "merge"):
        p = tasks.add_parser(task)
        p.add_argument("--settings", help="a file of settings")
        p.add_argument("--root", help="folder of the stages' tables")
        if task == "merge":
            p.add_argument("--target", help="folder of the merged splits")
            p.add_argument("--input", action="append", default=[], metavar="CORPUS=DIR", help="a saved data set; default: the final stage of each corpus below the root")
            p.add_argument("--files", action="store_true", help="copy the media too")
            p.add_argument("--seed", type=int)
            continue
        p.add_argument("--corpus", choices=sorted(SOURCES), required=True)
        p.add_argument("--data")
        p.add_argument("--start", choices=STAGES)
        p.add_argument("--stop", choices=STAGES)
        p.add_argument("--chunk", type=int)
        p.add_argument("--editable", action="store_true", help="write copies for people to edit")
        p.add_argument("--no-media", action="store_true", help="neither look media files up nor work on them")
        for tool in ("fetcher", "tool", "aligner"):
            p.add_argument(f"--{tool}", metavar="MODULE:NAME")
    tasks.add_parser("stages")
    return parser.parse_args(argv)


def made(place: str | None):
    """What MODULE:NAME makes."""
    if not place:
        return None
    module, _, name = place.partition(":")
    return getattr(importlib.import_module(module), name)()


def folder_there(spark: SparkSession, path: str) -> str:
    if not path or not sinks.exists(spark, path):
        raise SystemExit(f"no folder {path or '(none given)'}")
    return path


def media_stage(args: argparse.Namespace, spec: SourceSpec):
    """The media stage, if tools are given; without them it passes rows on as they are."""
    tools = [made(args.fetcher), made(args.tool), made(args.aligner)]
    return None if args.no_media or not any(tools) else media.stage(spec, f"{args.root}/{spec.name}", *tools)


def merge_inputs(spark: SparkSession, pairs: list[str], root: str) -> dict[str, DataFrame]:
    """Saved data sets by corpus, in the order in which their ids are numbered."""
    given = dict(p.split("=", 1) for p in pairs)
    if unknown := given.keys() - SOURCES.keys():
        raise SystemExit(f"no corpus {', '.join(sorted(unknown))}")
    out = {}
    for name in SOURCES:
        if name in given:
            schema = readers.header_schema(spark, f"{folder_there(spark, given[name])}/metadata.csv")
            out[name] = readers.read_merged(spark, given[name], schema).withColumn("utter_id", F.col("utter_id").cast("long"))
        elif not given and sinks.exists(spark, f"{root}/{name}/final/_SUCCESS"):
            out[name] = spark.read.parquet(f"{root}/{name}/final")
    if not out:
        raise SystemExit("nothing to merge")
    return out


def main(argv: list[str]) -> int:
    args = arguments(argv)
    if args.task == "stages":
        print("\n".join(f"{s}: {ABOUT[s]}" for s in STAGES))
        return 0
    known = settings.load(args.settings)
    args.root = args.root or known.root
    spark = SparkSession.builder.appName("palaver").getOrCreate()
    if args.task == "merge":
        frames = merge_inputs(spark, args.input, args.root)
        merge.save_merged(merge.merged(frames, args.seed or known.seed), args.target or known.merged, args.files)
        return 0
    spec = SOURCES[args.corpus]
    data = args.data or getattr(known, spec.name) or "."
    pipeline = Pipeline(spark, spec, args.root, cleaner(spec, data, not args.no_media, args.tool is not None), media_stage(args, spec), editable=args.editable)
    if known.service_form:
        headers = {"Authorization": f"Bearer {known.service_key}"} if known.service_key else {}
        pipeline.labeller = pipeline.checker = backend(known.service_form, known.service_url, known.service_model or None, headers=headers)
    if args.task == "run":
        folder_there(spark, data)
        pipeline.run(args.start, args.stop, args.chunk)
    for row in pipeline.progress().collect():
        print(*row, sep="\t")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
