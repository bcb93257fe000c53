"""Patterns in the sequence of labels of a conversation, by windows in one pass each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palaver.operators.relational import grouped, joined, numbered_rows, semi
from palaver.spec import PROVIDING, SEEKING


def label_sequence(df: DataFrame, conv: str = "conv_id", utter: str = "utter_id", kind: str = "empathy_kind") -> DataFrame:
    """Beside each row its conversation's labels, joined in order, and whether seeking is answered at once."""
    return df.join(sequences(df, conv, utter, kind), conv)


def sequences(df: DataFrame, conv: str = "conv_id", utter: str = "utter_id", kind: str = "empathy_kind") -> DataFrame:
    """One row per conversation: its labels, joined, and the flag."""
    one = grouped(df, conv).groupBy(conv).agg(joined(F.col(kind).cast("int"), F.col(utter)).alias("empathy_kind_seq"))
    return one.withColumn("contain_empathy_seq", F.col("empathy_kind_seq").contains(f"{SEEKING}, {PROVIDING}").cast("int"))


def empathetic(df: DataFrame, based_on: str = "contain_empathy", **names: str) -> DataFrame:
    """Conversations that the flag of the sequence, of the classifier (is_empathy) or both keep."""
    if based_on not in ("both", "contain_empathy", "is_empathy"):
        raise ValueError(f"unknown rule {based_on!r}")
    kept = df if based_on == "contain_empathy" else df.where(F.col("is_empathy") == 1)
    if based_on == "is_empathy":
        return kept
    if "contain_empathy_seq" in df.columns:
        return kept.where(F.col("contain_empathy_seq") == 1)
    return semi(kept, sequences(df, **names).where(F.col("contain_empathy_seq") == 1), names.get("conv", "conv_id"))


def segment_numbers(df: DataFrame, conv: str = "conv_id", utter: str = "utter_id", kind: str = "empathy_kind", name: str = "segment") -> DataFrame:
    """Number of the segment that a row lies in, null outside.

    A segment is the longest chain of links, each one seeker and an odd number of providers after it. A
    row that is no provider opens a run with the providers behind it; a run of a seeker and n providers
    is kept up to the greatest odd number, and a kept row behind one that is not opens a segment.
    """
    w = Window.partitionBy(conv).orderBy(utter)
    k = F.col(kind).cast("int")
    runs = grouped(df, conv).withColumn("__run", F.sum((F.coalesce(k, F.lit(-1)) != PROVIDING).cast("int")).over(w))
    own = Window.partitionBy(conv, "__run")
    facts = runs.withColumns({
        "__head": F.max(F.when(F.coalesce(k, F.lit(-1)) != PROVIDING, F.coalesce(k, F.lit(-1)))).over(own),
        "__n": F.count(F.when(k == PROVIDING, 1)).over(own),
        "__pos": F.row_number().over(own.orderBy(utter)) - 1,
    })
    most = F.col("__n") - F.when(F.col("__n") % 2 == 0, 1).otherwise(0)
    facts = facts.withColumn("__keep", F.coalesce((F.col("__head") == SEEKING) & (F.col("__n") >= 1) & (F.col("__pos") <= most), F.lit(False)))
    opens = F.col("__keep") & ~F.coalesce(F.lag("__keep").over(w), F.lit(False))
    facts = facts.withColumn("__open", opens.cast("int"))
    number = F.when(F.col("__keep"), F.sum("__open").over(w) - 1).cast("long")
    return facts.withColumn(name, number).drop("__run", "__head", "__n", "__pos", "__keep", "__open")


def segmented(df: DataFrame, conv: str = "conv_id", utter: str = "utter_id", kind: str = "empathy_kind") -> DataFrame:
    """Rows inside segments, with new_conv_id ("conversation_segment") and new_utter_idx from 0."""
    cut = segment_numbers(df, conv, utter, kind).where(F.col("segment").isNotNull())
    named = cut.withColumn("new_conv_id", F.concat_ws("_", F.col(conv).cast("string"), F.col("segment").cast("string"))).drop("segment")
    return numbered_rows(named, "new_conv_id", utter)
