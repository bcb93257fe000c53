"""Puts the corpora together: common columns, ids that tell the source, splits without leakage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.functions.text import media_name, prefixed_id
from palaver.operators.relational import group_split, union_all
from palaver.sources.sinks import copy_files, save_splits, without_index
from palaver.spec import SOURCES


def with_roles(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns under their role names; others stay."""
    return without_index(df).withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def merged(frames: dict[str, DataFrame], seed: int = 200) -> DataFrame:
    """All corpora, ids as "<place>_<id>", over the union of their columns, with `split` by conversation in each."""
    parts = []
    for i, name in enumerate(frames):
        names = SOURCES[name].columns if name in SOURCES else {}
        df = with_roles(frames[name], names)
        parts.append(group_split(df.withColumn("conv_id", prefixed_id(i, F.col("conv_id"))), "conv_id", seed=seed))
    return union_all(parts)


def save_merged(df: DataFrame, folder: str, files: bool = False) -> DataFrame:
    """Writes one folder per split; file names are <split>/audio/<conv>_<utter>.wav below it, on request with the files."""
    place = F.concat(F.lit(f"{folder}/"), F.col("split"), F.lit("/audio/"), media_name(F.col("conv_id"), F.col("utter_id")))
    out = df.withColumn("__to", F.when(F.col("file_name").isNotNull(), place))
    if files:
        copy_files(out, "file_name", "__to")
    out = out.withColumn("file_name", F.col("__to")).drop("__to")
    save_splits(out, folder)
    return out


def leakage(df: DataFrame, conv: str = "conv_id", split: str = "split") -> DataFrame:
    """Conversations in more than one split; there are none."""
    return df.groupBy(conv).agg(F.count_distinct(split).alias("n_splits")).where("n_splits > 1")
