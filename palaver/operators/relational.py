"""Filters, joins, aggregates and windows over utterance tables.

Conversations are the partitions of every window, so one exchange by conversation serves a chain of
these. Rows without a conversation id belong to no group and are left out by all group operators.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

NOBODY = "\0nobody"
#: Leading hexadecimal digits of a hash that deal groups over buckets when they are ranked.
BUCKET_DIGITS = 4


def grouped(df: DataFrame, *keys: str) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))


def party_count(df: DataFrame, conv: str = "conv_id", speaker: str = "speaker", name: str = "num_party") -> DataFrame:
    """Different speakers of each conversation beside its rows; a missing speaker counts as one."""
    who = F.coalesce(F.col(speaker).cast("string"), F.lit(NOBODY))
    return grouped(df, conv).withColumn(name, F.size(F.collect_set(who).over(Window.partitionBy(conv))))


def two_party(df: DataFrame, conv: str = "conv_id", speaker: str = "speaker", parties: int = 2) -> DataFrame:
    have = df if "num_party" in df.columns else party_count(df, conv, speaker)
    return have.where(F.col("num_party") == parties)


def alternating(df: DataFrame, conv: str = "conv_id", utter: str = "utter_id", speaker: str = "speaker") -> DataFrame:
    """Conversations in which two speakers take strict turns; one utterance alone is no turn-taking."""
    w = Window.partitionBy(conv)
    who = F.coalesce(F.col(speaker).cast("string"), F.lit(NOBODY))
    own = grouped(df, conv).withColumn("__who", who).withColumn("__same", (F.lag("__who").over(w.orderBy(utter)) == F.col("__who")).cast("int"))
    kept = own.withColumns({"__n": F.size(F.collect_set("__who").over(w)), "__again": F.coalesce(F.max("__same").over(w), F.lit(0))})
    return kept.where((F.col("__n") == 2) & (F.col("__again") == 0)).drop("__who", "__same", "__n", "__again")


def complete_only(df: DataFrame, flag: str = "is_complete") -> DataFrame:
    return df.where(F.col(flag).cast("int") == 1)


def semi(df: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    return df.join(keys.select(*on), list(on), "left_semi")


def anti(df: DataFrame, done: DataFrame, *on: str) -> DataFrame:
    return df.join(done.select(*on), list(on), "left_anti")


def enriched(df: DataFrame, other: DataFrame, *on: str) -> DataFrame:
    """Columns of other beside df's rows; other has one row per key (the first by its columns, if more)."""
    rest = [c for c in other.columns if c not in on]
    once = other.groupBy(*on).agg(F.min(F.struct(*rest)).alias("__r")).select(*on, "__r.*")
    return df.join(once, list(on))


def ordered_list(value: Column, order: Column) -> Column:
    """Aggregate: the values in the order given (not that in which rows arrive)."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda x: x["v"])


def joined(value: Column, order: Column, separator: str = ", ") -> Column:
    return F.array_join(ordered_list(value.cast("string"), order), separator)


def first_mode(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Per key the most frequent value of each other column, the least of equals; null if all are null."""
    rest = columns or [c for c in df.columns if c not in keys]
    return grouped(df, *keys).groupBy(*keys).agg(*[F.mode(c, True).alias(c) for c in rest])


def first_per_group(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    return grouped(df, *keys).groupBy(*keys).agg(F.min(column).alias(name))


def count_per_group(df: DataFrame, keys: Sequence[str], column: str, name: str = "n") -> DataFrame:
    return grouped(df, *keys).groupBy(*keys).agg(F.count(column).alias(name))


def leading_speaker(df: DataFrame, conv: str = "conv_id", utter: str = "utter_id", speaker: str = "speaker", kind: str = "empathy_kind", label: int = 2) -> DataFrame:
    """Per conversation the speaker of most utterances with the label; the least name of equals; none: no row."""
    counts = count_per_group(df.where(F.col(kind) == label), [conv, speaker], utter)
    return counts.groupBy(conv).agg(F.min_by(speaker, F.struct(-F.col("n"), F.col(speaker))).alias(speaker))


def numbered_rows(df: DataFrame, group: str, order: str, name: str = "new_utter_idx") -> DataFrame:
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1).cast("long"))


def intervals(df: DataFrame, conv: str, order: str, start: str, duration: Column | None = None) -> DataFrame:
    """interval_start, interval_end: from each row's time to the next one's; the last ends with the recording."""
    after = F.lead(start).over(Window.partitionBy(conv).orderBy(order))
    return df.withColumns({"interval_start": F.col(start), "interval_end": after if duration is None else F.coalesce(after, duration)})


def exploded_together(df: DataFrame, *columns: str) -> DataFrame:
    """One row per place of equally long arrays; unequal lengths are an error."""
    same = reduce(lambda a, b: a & b, (F.size(columns[0]) == F.size(c) for c in columns[1:]), F.lit(True))
    zipped = F.when(same, F.arrays_zip(*columns)).otherwise(F.raise_error(F.lit("arrays of unequal lengths")))
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.explode(zipped).alias("__z")).select(*rest, *[F.col(f"__z.{c}") for c in columns])


def first_groups(df: DataFrame, key: str, count: int) -> DataFrame:
    """Rows of the first `count` groups by ascending key."""
    return semi(df, grouped(df.select(key), key).distinct().orderBy(key).limit(count), key)


def next_chunk(df: DataFrame, done: DataFrame | None, key: str, count: int) -> DataFrame:
    """The first `count` groups that are not done."""
    return first_groups(df if done is None else anti(df, done, key), key, count)


def unprocessed_count(before: DataFrame, after: DataFrame | None) -> tuple[int, int]:
    """Rows of a stage's input that its output lacks, and all; compared on the input's columns, nulls equal."""
    total = before.count()
    if after is None:
        return total, total
    shared = [c for c in before.columns if c in after.columns]
    # Maps can not be compared, their JSON can.
    plain = lambda df, side: df.select(*[(F.to_json(c) if isinstance(df.schema[c].dataType, MapType) else F.col(c)).alias(f"{side}_{c}") for c in shared])
    on = reduce(lambda x, y: x & y, (F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in shared))
    return plain(before, "a").join(plain(after, "b"), on, "left_anti").count(), total


def group_split(df: DataFrame, conv: str, by: Sequence[str] = (), seed: int = 200, train: float = 0.8, test: float = 0.5, name: str = "split") -> DataFrame:
    """Each group's split: round(train * G) groups train, round(test * rest) test, the rest validation.

    Groups are ranked by a hash of seed and id within `by`; sizes are exact (half to even), the same ids
    always fall alike, and a conversation is never parted. A rank is the place in a bucket of hashes and the
    number of groups in the buckets before it, so the only window without a key is over the buckets' counts.
    """
    groups = grouped(df.select(*by, conv), conv).distinct()
    groups = groups.withColumn("__h", F.md5(F.concat(F.lit(str(seed)), F.col(conv).cast("string")))).withColumn("__b", F.substring("__h", 1, BUCKET_DIGITS))
    keys = [*by, "__b"]
    own = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))  # 16 ** BUCKET_DIGITS rows at most
    counts = groups.groupBy(*keys).agg(F.count("*").alias("__n"))
    counts = counts.withColumns({"__before": F.sum("__n").over(own.orderBy("__b")) - F.col("__n"), "__g": F.sum("__n").over(own)}).drop("__n")
    counts = counts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__before", "__g")
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("__h", conv))
    placed = groups.withColumn("__i", rank).join(counts, same).withColumn("__r", F.col("__before") + F.col("__i"))
    placed = placed.withColumn("__t", F.bround(F.col("__g") * F.lit(train)).cast("long"))
    placed = placed.withColumn("__e", F.bround((F.col("__g") - F.col("__t")) * F.lit(test)).cast("long"))
    split = F.when(F.col("__r") <= F.col("__t"), "train").when(F.col("__r") <= F.col("__t") + F.col("__e"), "test").otherwise("validation")
    placed = placed.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate([*by, conv])], split.alias(name))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate([*by, conv])))
    return df.join(placed, same).drop(*[f"__k{i}" for i in range(len(by) + 1)])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames over the union of their columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def upserted(old: DataFrame | None, new: DataFrame, *keys: str) -> DataFrame:
    """old and new rows; a key that is in new takes its rows from there alone."""
    return new if old is None else anti(old, new, *keys).unionByName(new, allowMissingColumns=True)
