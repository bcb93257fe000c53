"""Scalar functions of the engine as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 36 punctuation marks that cleaning turns into blanks.
PUNCTUATION = "!()-[]{.};:'\"\\,<>/?@#$%^&*_~`|’“”…—–"


def clock_seconds(text: Column) -> Column:
    """Seconds of an H:M:S text as double; null where a part is missing, no number or out of range."""
    part = F.split(text, ":")
    h, m, s = (F.get(part, F.lit(i)).try_cast("int") for i in range(3))
    good = (F.size(part) == 3) & h.between(0, 23) & m.between(0, 59) & s.between(0, 61)
    return F.when(good, (h * 3600 + m * 60 + s).cast("double"))


def url_tail_id(url: Column) -> Column:
    """The id in a video URL: the last path part, after watch?v=, before the first &."""
    return F.substring_index(F.substring_index(F.substring_index(url, "/", -1), "watch?v=", -1), "&", 1)


def audio_path(path: Column, compatible: bool = False) -> Column:
    """The path with .wav as its suffix; compatible keeps what stands after a cut at 'mp4' (a.mp4 -> a..wav)."""
    return F.concat(F.substring_index(path, "mp4", 1), F.lit(".wav")) if compatible else F.regexp_replace(path, r"\.[^./]+$", ".wav")


def directory(path: Column) -> Column:
    """All before the last slash; nothing if there is none."""
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.when(path.isNotNull(), ""))


def clean_text(text: Column) -> Column:
    """Lower case, each punctuation mark a blank."""
    return F.translate(F.lower(text), PUNCTUATION, " " * len(PUNCTUATION))


def conversation_string(texts: Column) -> Column:
    """Utterances between the tokens that open and close one."""
    return F.array_join(F.transform(texts, lambda t: F.concat(F.lit("<BOU> "), t, F.lit(" <EOU> "))), "")


def numbered(texts: Column) -> Column:
    """1. text, 2. text, a line each."""
    return F.array_join(F.transform(texts, lambda t, i: F.concat((i + 1).cast("string"), F.lit(". "), t, F.lit("\n"))), "")


def unescape(text: Column) -> Column:
    """Backslash n and backslash t as the characters that they stand for."""
    return F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("\\t"), F.lit("\t"))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def above(x: Column, threshold: float = 0.5) -> Column:
    """1.0 where x is greater than the threshold, else 0.0."""
    return (x > threshold).cast("float")


def argmax(values: Column) -> Column:
    """Position from 0 of the greatest value, the first of equals."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def one_hot(label: Column, classes: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: (i == label).cast("int"))


def empathy_key(label: Column) -> Column:
    """0, 1, 2 for a label's name; looked for in the order seek, provide, none, in any case."""
    low = F.lower(label)
    return F.when(low.contains("seek"), 1).when(low.contains("provide"), 2).when(low.contains("none"), 0)


def completion_key(label: Column) -> Column:
    return F.when(F.lower(label) == "complete", 1).when(F.lower(label) == "incomplete", 0)


def prefixed_id(position: int, conv: Column) -> Column:
    return F.concat_ws("_", F.lit(position), conv.cast("string"))


def media_name(conv: Column, utter: Column, suffix: str = "wav") -> Column:
    return F.concat(conv.cast("string"), F.lit("_"), utter.cast("string"), F.lit(f".{suffix}"))
