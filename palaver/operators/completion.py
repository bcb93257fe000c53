"""Asking language models: a pluggable completer, rounds of requests, and classifiers as batch functions.

Only here, in `tokenising` and with media does Python run on the executors. The default completer works
offline and is deterministic; `backends` has those that ask a service.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.functions.text import conversation_string, numbered, unescape
from palaver.operators import labeling
from palaver.operators.relational import grouped, ordered_list
from palaver.shipping import ship

IDLE_ROUNDS = 6
DONE_SHARE = 0.4


class Completer(Protocol):
    """choices answers to one prompt; chat tells which form of prompt it takes."""

    chat: bool

    def complete(self, prompt, choices: int) -> list[str]: ...


@dataclass(frozen=True)
class OfflineCompleter:
    """Answers from the text's length alone, without a network: utterance i gets label (length % 3)."""

    kind: str = "empathy"
    chat: bool = False

    def complete(self, prompt, choices: int) -> list[str]:
        text = prompt if isinstance(prompt, str) else prompt[-1]["content"]
        lines = [x.split(". ", 1)[1] for x in text.split("\n") if ". " in x and x.split(". ", 1)[0].isdigit()]
        if self.kind == "completion":
            label = "complete" if len(lines) % 2 == 0 else "incomplete"
            return [f"Reason: {len(lines)} utterances.\nThe final answer is: {label}"] * choices
        names = ("none", "empathy_seeker", "empathy_provider")
        return ["\n".join(f"{i + 1}:\nReason: length {len(x)}\nLabel: {names[len(x) % 3]}" for i, x in enumerate(lines))] * choices


def ask(completer: Completer, prompt, choices: int, retries: int = 3, pause: float = 1.0) -> list[str]:
    """Answers to one prompt; the failure of the last of `retries` tries is raised, so that no rows are lost unseen."""
    for attempt in range(retries):
        try:
            return list(completer.complete(prompt, choices))
        except Exception:  # any failure of a service is worth another try
            if attempt + 1 == retries:
                raise
            time.sleep(pause)
    return []


def valid_answer(kind: str, n_utter: int) -> Callable[[str], bool]:
    """What the votes will accept, told by the patterns that they read with."""
    plain = lambda a: a.replace("\\n", "\n").replace("\\t", "\t")
    if kind == "empathy":
        return lambda a: sum(1 for _ in re.finditer(labeling.EMPATHY_PATTERN, plain(a))) == n_utter
    return lambda a: re.search(labeling.COMPLETION_PATTERN, plain(a).replace("\n", " ")) is not None


def rounds(completer: Completer, prompt, valid: Callable[[str], bool], number: int, least: int, pause: float = 0.0) -> list[str]:
    """Valid answers: asks for as many as are missing, until `least` are there or six rounds in a row brought none."""
    got: list[str] = []
    missing, idle = number, 0
    while True:
        fresh = [a for a in ask(completer, prompt, missing, pause=pause) if valid(a)]
        got += fresh
        idle = 0 if fresh else idle + 1
        missing -= len(fresh)
        if len(got) >= least or idle >= IDLE_ROUNDS or missing <= 0:
            return got
        time.sleep(pause)


def responses(df: DataFrame, completer: Completer, conv: str, utter: str, text: str, kind: str, number: int, partitions: int | None = None) -> DataFrame:
    """conv, n_utter, number, response: valid answers about each conversation. Write it before it is used twice."""
    ship(df.sparkSession)
    system, query = (labeling.EMPATHY_SYSTEM, labeling.EMPATHY_QUERY) if kind == "empathy" else (labeling.COMPLETION_SYSTEM, labeling.COMPLETION_QUERY)
    least = max(3 if kind == "empathy" else 1, int(number * DONE_SHARE))
    texts = grouped(df, conv).groupBy(conv).agg(ordered_list(F.coalesce(F.col(text), F.lit("")), F.col(utter)).alias("t"))
    asked = texts.select(conv, F.size("t").alias("n_utter"), labeling.prompt(numbered(F.col("t")), system, query, completer.chat).alias("prompt"))
    if partitions:
        asked = asked.repartition(partitions, conv)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, n, prompt in batch.itertuples(index=False):
                sent = prompt if isinstance(prompt, str) else [dict(m) if isinstance(m, dict) else m.asDict() for m in prompt]
                found = rounds(completer, sent, valid_answer(kind, n), number, least, getattr(completer, "pause", 0.0))
                rows += [(key, n, i, a) for i, a in enumerate(found)]
            yield pd.DataFrame(rows, columns=["conv", "n_utter", "number", "response"])

    schema = f"{conv} {df.schema[conv].dataType.simpleString()}, n_utter int, number int, response string"
    out = asked.mapInPandas(lambda it: (b.rename(columns={"conv": conv}) for b in run(it)), schema)
    return out.withColumn("response", unescape(F.col("response")))


def labelled(df: DataFrame, answers: DataFrame, conv: str = "conv_id", utter: str = "utter_id", strict: bool = True) -> DataFrame:
    """df with empathy_kind, empathy_reasons and empathy_percents by vote over stored answers."""
    found = labeling.empathy_votes(answers, conv, "response", "number", "n_utter", strict)
    shares = F.create_map(F.lit("none"), F.col("share_0"), F.lit("seeking"), F.col("share_1"), F.lit("providing"), F.col("share_2"))
    found = found.select(conv, F.col("position").alias("__at"), F.col("label").cast("int").alias("empathy_kind"), F.col("reasons").alias("empathy_reasons"), shares.alias("empathy_percents"))
    at = F.row_number().over(Window.partitionBy(conv).orderBy(utter)) - 1
    return grouped(df, conv).withColumn("__at", at).join(found, [conv, "__at"], "left").drop("__at")


def checked(df: DataFrame, answers: DataFrame, conv: str = "new_conv_id", strict: bool = True) -> DataFrame:
    """df with is_complete, complete_check_reasons and complete_check_percent."""
    found = labeling.completion_votes(answers, conv, "response", "number", strict)
    shares = F.create_map(F.lit("incomplete"), F.col("share_0"), F.lit("complete"), F.col("share_1"))
    return df.join(found.select(conv, F.col("label").cast("int").alias("is_complete"), F.col("reasons").alias("complete_check_reasons"), shares.alias("complete_check_percent")), conv, "left")


def deployed(load: Callable[[], Callable], before: tuple[Callable, ...] = (), after: Callable | None = None) -> Callable[[], Callable]:
    """A model behind a chain: each function of `before` maps the batch on, `after` the model's output.

    The result loads everything once on the executor and is what `classified` and `predict_batch_udf` take.
    """

    def make():
        model = load()

        def predict(batch):
            for step in before:
                batch = step(batch)
            out = model(batch)
            return after(out) if after else out

        return predict

    return make


def classified(df: DataFrame, kind_model: Callable[[], Callable], exist_model: Callable[[], Callable], conv: str = "conv_id", utter: str = "utter_id", text: str = "utterance") -> DataFrame:
    """df with empathy_kind (per utterance) and is_empathy (per conversation) by classifiers.

    Each model is a function that loads one on the executor and returns texts -> numbers; `deployed` makes
    one of a model with steps before it, such as `tokenising.batch`, and after it.
    """
    from pyspark.ml.functions import predict_batch_udf

    ship(df.sparkSession)
    kind = predict_batch_udf(kind_model, return_type=T.IntegerType(), batch_size=256)
    exist = predict_batch_udf(exist_model, return_type=T.FloatType(), batch_size=64)
    whole = grouped(df, conv).groupBy(conv).agg(conversation_string(ordered_list(F.coalesce(F.col(text), F.lit("")), F.col(utter))).alias("__t"))
    return df.withColumn("empathy_kind", kind(F.col(text))).join(whole.select(conv, exist("__t").alias("is_empathy")), conv)
