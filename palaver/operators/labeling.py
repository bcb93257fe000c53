"""Prompts, reading of responses, and votes over them: all native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.functions.text import completion_key, empathy_key

#: The forms in which responses give a label and a reason.
EMPATHY_PATTERN = r"(index:)?(\d+|\[\d+\])(\.|:)( |\n)?.*( |\n)?(((Reason|\[Reason\]): (.+)( |\n)?(Label|\[Label\]): (None|none|Empathy_seeker|empathy_provider|Empathy_provider|empathy_seeker)\.?)|((Label|\[Label\]): (None|none|Empathy_seeker|empathy_provider|Empathy_provider|empathy_seeker)\.?( |\n)?(Reason|\[Reason\]): (.+)))"
COMPLETION_PATTERN = r"(Reason|\[Reason\]|reason): (.+)( |\n)*((T|t)he final answer is):? (complete|incomplete|Complete|Incomplete)"
#: Votes of labels, in the order that settles equal shares.
EMPATHY_ORDER = (1, 2, 0)
COMPLETION_ORDER = (1, 0)

EMPATHY_SYSTEM = "You study how people talk to each other and you recognise empathy in what they say."
EMPATHY_QUERY = (
    "Give every utterance of the conversation one label, judging it by what was said before it: empathy_seeker if the "
    "speaker tells of own feelings, thoughts or experiences; empathy_provider if the speaker answers such feelings with "
    "warmth, understanding or questions that invite more; none for anything else.\nAnswer in this form for each:\n"
    "[index]:\nReason: [reason]\nLabel: [label]\n\n{conversation}\nAnswer:"
)
COMPLETION_SYSTEM = "You judge whether a conversation is complete."
COMPLETION_QUERY = (
    "A complete conversation leaves no gap in what is needed to follow it, and its utterances fit each other. Say whether "
    "this one is complete or incomplete, in this form:\nReason: [reason]\nThe final answer is: [complete or incomplete]\n\n{conversation}\nAnswer:"
)


def prompt(conversation: Column, system: str, query: str, chat: bool = False) -> Column:
    """One text, or for chat models an array of (role, content)."""
    before, after = query.split("{conversation}")
    user = F.concat(F.lit(before), conversation, F.lit(after))
    if not chat:
        return F.concat(F.lit(f"{system}\n"), user)
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(message("system", F.lit(system)), message("user", user))


def parsed_labels(response: Column) -> Column:
    """Array of (label, reason), one for each match, in order; either may come first in a match."""
    every = lambda g: F.regexp_extract_all(response, F.lit(f"(?d){EMPATHY_PATTERN}"), F.lit(g))
    both = F.arrays_zip(every(7).alias("a"), every(9).alias("b"), every(12).alias("c"), every(15).alias("d"), every(18).alias("e"))
    return F.transform(both, lambda x: F.struct(F.when(x["a"] != "", x["c"]).otherwise(x["d"]).alias("label"), F.when(x["a"] != "", x["b"]).otherwise(x["e"]).alias("reason")))


def parsed_completion(response: Column) -> Column:
    """(label, reason) of the first match, nulls if there is none."""
    flat = F.translate(response, "\n", " ")
    part = lambda g: F.nullif(F.regexp_extract(flat, f"(?d){COMPLETION_PATTERN}", g), F.lit(""))
    return F.struct(part(6).alias("label"), part(2).alias("reason"))


def votes(df: DataFrame, keys: list[str], label: str, order: tuple[int, ...], reason: str | None = None, number: str | None = None, strict: bool = True) -> DataFrame:
    """Per key: n_votes, the share of each label (share_<label>), the label of the greatest share, and its reasons.

    Equal shares are settled by `order`. Without any vote the label is null, or, not strict, the first of the order.
    """
    n = F.count(label)
    share = lambda k: F.coalesce(F.count(F.when(F.col(label) == k, 1)) / F.nullif(n, F.lit(0)), F.lit(0.0))
    aggs = [n.alias("n_votes"), *[share(k).alias(f"share_{k}") for k in order]]
    if reason:
        at = F.col(number) if number else F.col(reason)
        aggs.append(F.array_sort(F.collect_list(F.when(F.col(reason).isNotNull() & F.col(label).isNotNull(), F.struct(at.alias("o"), F.col(label).alias("k"), F.col(reason).alias("r"))))).alias("__all"))
    out = df.groupBy(*keys).agg(*aggs)
    best = F.greatest(*[F.col(f"share_{k}") for k in order])
    pick = F.when(F.lit(False), 0)
    for k in order:
        pick = pick.when(F.col(f"share_{k}") == best, k)
    out = out.withColumn("label", F.when((F.col("n_votes") > 0) | F.lit(not strict), pick))
    if reason:
        out = out.withColumn("reasons", F.transform(F.filter("__all", lambda x: x["k"] == F.col("label")), lambda x: x["r"])).drop("__all")
    return out


def empathy_votes(responses: DataFrame, conv: str, response: str, number: str, n_utter: str, strict: bool = True) -> DataFrame:
    """Votes per place of a conversation over its valid responses: those with as many labels as utterances."""
    read = responses.withColumn("__p", parsed_labels(F.col(response))).where(F.size("__p") == F.col(n_utter))
    flat = read.select(conv, number, F.posexplode("__p").alias("position", "p")).select(conv, number, "position", empathy_key(F.col("p.label")).alias("kind"), F.col("p.reason").alias("reason"))
    every = responses.select(conv, F.explode(F.expr(f"sequence(0, int({n_utter}) - 1)")).alias("position")).distinct()
    return votes(every.join(flat, [conv, "position"], "left"), [conv, "position"], "kind", EMPATHY_ORDER, "reason", number, strict)


def completion_votes(responses: DataFrame, conv: str, response: str, number: str, strict: bool = True) -> DataFrame:
    read = responses.withColumn("__p", parsed_completion(F.col(response)))
    flat = read.select(conv, number, completion_key(F.col("__p.label")).alias("complete"), F.col("__p.reason").alias("reason"))
    return votes(flat, [conv], "complete", COMPLETION_ORDER, "reason", number, strict)
