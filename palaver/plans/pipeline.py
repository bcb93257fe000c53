"""The stages of a corpus, run in order with a stored table after each, resumable and in chunks."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.operators import completion, relational, sequence
from palaver.sources import sinks
from palaver.spec import ROLES, SourceSpec

LOG = logging.getLogger(__name__)
STAGES = ("clean", "media", "two_party", "label", "empathetic", "segment", "check", "complete", "final")
EDITABLE = ("label", "check")
#: What a chunk is counted in, by stage: conversations, or after the cut segments.
SEGMENT_STAGES = ("check", "complete", "final")


def role_columns(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """df with the role names; conversation ids as text, a missing file column as null."""
    named = df.withColumnsRenamed({a: b for a, b in spec.columns.items() if a in df.columns})
    if "file_name" not in named.columns:
        named = named.withColumn("file_name", F.lit(None).cast("string"))
    return named.withColumns({"conv_id": F.col("conv_id").cast("string"), "utter_id": F.col("utter_id").cast("long")})


def final_columns(df: DataFrame, extras: tuple[str, ...]) -> DataFrame:
    """New ids in place of the old ones, and only the columns of the result."""
    if "new_conv_id" in df.columns:
        df = df.drop("conv_id", "utter_id").withColumnsRenamed({"new_conv_id": "conv_id", "new_utter_idx": "utter_id"})
    return df.select(*ROLES, *extras)


@dataclass
class Pipeline:
    """Runs a corpus's stages. scan reads the cleaned rows; media, if given, turns paths into audio paths.

    root holds <corpus>/<stage>, one Parquet table each. On request (editable) <corpus>/<stage>.edit is the
    CSV copy of stages that people may edit; an edited copy in <stage>.edited is taken before the table.
    With chunks a stage adds each chunk's files to its table and leaves the others alone.
    """

    spark: SparkSession
    spec: SourceSpec
    root: str
    scan: Callable[[SparkSession], DataFrame]
    media: Callable[[DataFrame], DataFrame] | None = None
    labeller: completion.Completer = field(default_factory=completion.OfflineCompleter)
    checker: completion.Completer | None = field(default_factory=lambda: completion.OfflineCompleter("completion"))
    based_on: str = "contain_empathy"
    strict: bool = True
    classifiers: tuple[Callable, Callable] | None = None
    editable: bool = False

    def path(self, stage: str) -> str:
        return f"{self.root}/{self.spec.name}/{stage}"

    def stored(self, stage: str, ending: str = "") -> bool:
        sinks.settled(self.spark, self.path(stage), f"{self.path(stage)}.old")
        return sinks.exists(self.spark, f"{self.path(stage)}{ending}/_SUCCESS")

    def load(self, stage: str) -> DataFrame:
        kept = self.spark.read.parquet(self.path(stage))
        if stage in EDITABLE and self.stored(stage, ".edited"):
            LOG.info("reading %s.edited", self.path(stage))
            return sinks.read_editable(self.spark, f"{self.path(stage)}.edited", kept.schema)
        return kept

    def next_stage(self) -> int:
        """One more than the last stage that is stored."""
        return max((i + 1 for i, s in enumerate(STAGES) if self.stored(s)), default=0)

    def validate(self, start: str | None, stop: str | None) -> tuple[int, int]:
        for s in (start, stop):
            if s is not None and s not in STAGES:
                raise ValueError(f"no stage {s!r}; stages are {', '.join(STAGES)}")
        first = self.next_stage() if start is None else STAGES.index(start)
        last = len(STAGES) - 1 if stop is None else STAGES.index(stop)
        if 0 < first < len(STAGES) and not self.stored(STAGES[first - 1]):
            raise ValueError(f"stage {STAGES[first]!r} needs {STAGES[first - 1]!r}, which is not stored")
        return first, last

    def apply(self, stage: str, df: DataFrame | None) -> DataFrame:
        if stage == "clean":
            return role_columns(self.scan(self.spark), self.spec)
        if stage == "media":
            return self.media(df) if self.media else df
        if stage == "two_party":
            return relational.two_party(df)
        if stage == "label":
            if self.classifiers:
                return completion.classified(df, *self.classifiers)
            answers = completion.responses(df, self.labeller, "conv_id", "utter_id", "utterance", "empathy", self.spec.labels_per_conversation)
            return completion.labelled(df, sinks.write_swapped(answers, f"{self.path(stage)}.answers"), strict=self.strict)
        if stage == "empathetic":
            return sequence.empathetic(df, self.based_on)
        if stage == "segment":
            return sequence.segmented(df)
        if stage == "check":
            if self.checker is None:
                return df.withColumn("is_complete", F.lit(0))
            answers = completion.responses(df, self.checker, "new_conv_id", "new_utter_idx", "utterance", "completion", self.spec.checks_per_conversation)
            return completion.checked(df, sinks.write_swapped(answers, f"{self.path(stage)}.answers"), strict=self.strict)
        if stage == "complete":
            return relational.complete_only(df)
        return final_columns(df, tuple(c for c in self.spec.extras if c in df.columns))

    def run(self, start: str | None = None, stop: str | None = None, chunk: int | None = None) -> DataFrame | None:
        """Runs the stages from start (none: where the stored ones end) to stop; chunk: at most so many new groups a stage."""
        first, last = self.validate(start, stop)
        df = self.load(STAGES[first - 1]) if first else None
        for i in range(first, last + 1):
            stage = STAGES[i]
            old = self.spark.read.parquet(self.path(stage)) if chunk and self.stored(stage) else None
            if chunk and df is not None:
                key = "new_conv_id" if stage in SEGMENT_STAGES else "conv_id"
                done = old.withColumnRenamed("conv_id", key) if old is not None and stage == "final" else old
                df = relational.next_chunk(df, done, key, chunk)
            out = self.apply(stage, df)
            # A chunk holds groups that the table has no row of.
            df = sinks.write_swapped(out, self.path(stage)) if old is None else sinks.append(out, self.path(stage))
            if self.editable and stage in EDITABLE:
                sinks.write_editable(df, f"{self.path(stage)}.edit")
            LOG.info("wrote %s", self.path(stage))
            df = self.load(stage)
        return df

    def progress(self) -> DataFrame:
        """stage, unprocessed, total for each stored stage (-1 where there is none before it)."""
        rows = []
        for i, stage in enumerate(STAGES[: self.next_stage()]):
            counts = relational.unprocessed_count(self.load(STAGES[i - 1]), self.load(stage)) if i and self.stored(STAGES[i - 1]) else (-1, -1)
            rows.append((stage, *counts))
        return self.spark.createDataFrame(rows, "stage string, unprocessed long, total long")
