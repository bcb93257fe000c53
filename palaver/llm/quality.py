"""Quality rules whose thresholds follow each language and source. DataFrame functions only.

Each document gets counts of its words, symbols, repeated lines and repeated three-word windows. Their
ratios, as whole numbers, go into a mergeable quantile sketch per language and source: a histogram
whose buckets keep the seven leading bits of a value (relative error below 1/64). Adding counts
merges sketches, in any order, with the same result; the sketches of a language, and of all rows,
are sums of those below them and serve groups with few documents. A document is kept if it passes
the two base rules and no ratio lies beyond its group's fences: the quartiles, widened by `WIDTH`
times their distance (or the ratio's least distance, where a group hardly varies).

Defined cases: a null text has no words and fails the base rules; null language or source form a
group of their own; a document without words has ratios of zero; a ratio equal to a fence is inside; repeated
rows are judged alike and each is returned; long texts are read whole (a text of n words needs arrays of n
places in its task); an empty table gives an empty result; columns other than doc_id, text, lang and
source are neither read nor in the way (`judge` works on any frame with those four).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palaver.llm.common import WORD, join_sized, stored, table, words

SYMBOLS = "[#*$%&|<>]"
#: Hash of a window's three words; results do not depend on it.
HASH = "xxhash64({})"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: Documents that a group needs for thresholds of its own.
MIN_GROUP = 200
WIDTH = 3
#: Ratio -> (per how many, least distance of the quartiles). symbols and dup_lines and repeats have no lower fence.
RATIOS = {"symbols": 60, "dup_lines": 120, "repeats": 120, "word_length": 60}
LOWER = ("word_length",)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def windows(ws: str, bits: str) -> Column:
    """Every three-word window of an array column of words as one long, sorted.

    The leading bits of the window's hash stand above the `bits` bits of its place (a column). The array
    holds plain longs without nulls, which Spark sorts without a comparator.
    """
    hashed = HASH.format(f"{ws}[i], {ws}[i + 1], {ws}[i + 2]")
    packed = f"sort_array(transform(sequence(0, size({ws}) - 3), i -> shiftleft({hashed}, {bits}) | bigint(i)))"
    return F.expr(f"case when size({ws}) > 3 then {packed} else cast(array() as array<bigint>) end")


def covered(ws: str, packed: str, mask: str) -> Column:
    """Words inside windows that occur at least twice, exactly.

    Windows of equal hash bits are neighbours in `packed`. If all such neighbours have equal words, windows
    are equal to one of theirs or to none. Else, where different windows share bits, they may stand between
    equal ones; there the windows with a neighbour of equal bits are sorted by their words.
    """
    place = lambda x: f"int({x} & {mask})"
    bits = lambda a, b: f"(({a} ^ {b}) <= {mask} and ({a} ^ {b}) >= 0)"
    alike = lambda a, b: " and ".join(f"{ws}[{place(a)} + {k}] = {ws}[{place(b)} + {k}]" for k in range(3))
    beside = lambda p, same: f"filter({p}, (x, j) -> (j > 0 and {same('x', p + '[j - 1]')}) or (j < size({p}) - 1 and {same('x', p + '[j + 1]')}))"
    near = beside(packed, bits)
    clash = f"exists(sequence(0, size({packed}) - 2), j -> {bits(f'{packed}[j]', f'{packed}[j + 1]')} and not ({alike(f'{packed}[j]', f'{packed}[j + 1]')}))"
    spelt = f"array_sort(transform({near}, x -> struct(concat_ws(' ', slice({ws}, {place('x')} + 1, 3)) as w, {place('x')} as at)))"
    places = f"""case when {clash} then transform(transform(array({spelt}), s -> {beside('s', lambda a, b: f'{a}.w = {b}.w')})[0], x -> x.at)
      else transform({beside(packed, lambda a, b: f'({bits(a, b)} and {alike(a, b)})')}, x -> {place('x')}) end"""
    return F.expr(f"case when size(__next) = 0 then 0 else size(array_distinct(flatten(transform({places}, i -> array(i, i + 1, i + 2))))) end").cast("long")


def measured(df: DataFrame) -> DataFrame:
    """df with the columns of BASE and n_lines; df's text column is read once, nothing is shuffled."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    step = df.withColumns({"__words": words(F.col("text")), "__lines": lines})
    step = step.withColumn("__bits", F.length(F.bin(F.size("__words"))))
    step = step.withColumns({
        "__mask": F.expr("shiftleft(1L, __bits) - 1L"),
        "__packed": windows("__words", "__bits"),
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
    })
    # Most documents have no window twice; for them one cheap look at each neighbour is all.
    step = step.withColumn("__next", F.expr("filter(__packed, (x, j) -> shiftrightunsigned(x ^ get(__packed, j + 1), __bits) = 0)"))
    return step.withColumn("n_repeat_words", covered("__words", "__packed", "__mask")).drop("__words", "__lines", "__packed", "__bits", "__mask", "__next")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT)


def ratios() -> dict[str, Column]:
    per = lambda a, b, n: F.coalesce(F.expr(f"{a} * {n} div nullif({b}, 0)"), F.lit(0)).cast("long")
    return {"symbols": per("n_symbols", "n_words", 1000), "dup_lines": per("n_dup_lines", "n_lines", 1000), "repeats": per("n_repeat_words", "n_words", 1000), "word_length": per("word_chars", "n_words", 100)}


def bucket(value: str) -> Column:
    """The lowest value that shares the seven leading bits."""
    shift = f"greatest(length(bin({value})) - 7, 0)"
    return F.expr(f"shiftleft(shiftright({value}, {shift}), {shift})")


def sketches(measures: DataFrame) -> DataFrame:
    """level, lang, source, ratio, bucket, n: the sketch of each ratio at each level (0: language and source).

    Rows that fail the base rules are not counted. A level's sketch is the sum of those below it, so the
    documents are summed once; counts are combined before they are shuffled, and no group meets in one task.
    """
    rows = measures.where(~base_failed()).select("lang", "source", F.explode(F.array(*[F.struct(F.lit(k).alias("ratio"), v.alias("value")) for k, v in ratios().items()])).alias("r"))
    own = rows.select("lang", "source", "r.ratio", bucket("r.value").alias("bucket")).groupBy("lang", "source", "ratio", "bucket").agg(F.count("*").alias("n"))
    none = F.lit(None).cast("string")
    lang = own.groupBy("lang", "ratio", "bucket").agg(F.sum("n").alias("n"))
    every = lang.groupBy("ratio", "bucket").agg(F.sum("n").alias("n"))
    at = lambda level, df, **null: df.withColumns({k: none for k in null}).select(F.lit(level).alias("level"), "lang", "source", "ratio", "bucket", "n")
    return at(0, own).unionByName(at(1, lang, source=1)).unionByName(at(2, every, lang=1, source=1))


def fences(sketch: DataFrame) -> DataFrame:
    """level, lang, source and for each ratio its lowest and highest value that is kept."""
    key = ["level", "lang", "source", "ratio"]
    w = Window.partitionBy(*key)
    up = sketch.withColumns({"cum": F.sum("n").over(w.orderBy("bucket")), "total": F.sum("n").over(w)})
    q = lambda percent: F.min(F.when(F.col("cum") * 100 >= F.col("total") * percent, F.col("bucket")))
    quartiles = up.groupBy(*key).agg(q(25).alias("q1"), q(75).alias("q3"), F.max("total").alias("total"))
    least = F.element_at(F.create_map(*[F.lit(x) for kv in RATIOS.items() for x in kv]), F.col("ratio"))
    span = F.greatest(F.col("q3") - F.col("q1"), least) * WIDTH
    wide = quartiles.withColumns({"low": F.when(F.col("ratio").isin(*LOWER), F.col("q1") - span).otherwise(0), "high": F.col("q3") + span})
    agg = [f(F.when(F.col("ratio") == r, F.col(c))).alias(f"{c}_{r}") for r in RATIOS for c, f in (("low", F.max), ("high", F.max))]
    return wide.groupBy("level", "lang", "source").agg(F.max("total").alias("total"), *agg)


def judge(measures: DataFrame) -> DataFrame:
    """measures (a stored table, read twice) with base_failed and kept added."""
    limits = stored(fences(sketches(measures)))
    cols = [f"{c}_{r}" for r in RATIOS for c in ("low", "high")]
    pick = lambda level, *keys: limits.where((F.col("level") == level) & (F.col("total") >= MIN_GROUP)).select(*[F.col(k).alias(f"__{k}") for k in keys], F.struct(*cols).alias(f"__l{level}"))
    same = lambda a: F.col(a).eqNullSafe(F.col(f"__{a}"))
    out = join_sized(measures, pick(0, "lang", "source"), same("lang") & same("source"), "left").drop("__lang", "__source")
    out = join_sized(out, pick(1, "lang"), same("lang"), "left").drop("__lang")
    every = limits.where(F.col("level") == 2).select(*cols).first()  # one row, of all documents
    if every is None:
        return out.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed")).drop("__l0", "__l1")
    use = F.coalesce("__l0", "__l1", F.struct(*[F.lit(every[c]).cast("long").alias(c) for c in cols]))
    good = F.lit(True)
    for name, value in ratios().items():
        good = good & value.between(use[f"low_{name}"], use[f"high_{name}"])
    return out.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & F.coalesce(good, F.lit(True))).drop("__l0", "__l1")


def filtered(df: DataFrame) -> DataFrame:
    """The rows of df that are kept, with df's columns, whatever their names."""
    rows = df.select("doc_id", "text", "lang", "source", F.struct(*[F.col(c) for c in df.columns]).alias("__row"))
    return judge(stored(measured(rows).drop("text"))).where("kept").select("__row.*")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    measures = stored(measured(docs).drop("text"))
    return judge(measures).select("doc_id", *BASE, "base_failed", "kept")


_RATIO_SQL = {"symbols": "coalesce(n_symbols * 1000 // nullif(n_words, 0), 0)", "dup_lines": "coalesce(n_dup_lines * 1000 // nullif(n_lines, 0), 0)", "repeats": "coalesce(n_repeat_words * 1000 // nullif(n_words, 0), 0)", "word_length": "coalesce(word_chars * 100 // nullif(n_words, 0), 0)"}
_VALUES_SQL = " union all ".join(f"select lang, source, '{k}' as ratio, {v} as v, {RATIOS[k]} as least, {int(k in LOWER)} as lower from m where not base_failed" for k, v in _RATIO_SQL.items())
_INSIDE_SQL = " and ".join(f"({v} between pick['{k}'].low and pick['{k}'].high)" for k, v in _RATIO_SQL.items())
#: The same by exact tables in SQL; the sketch's buckets are whole numbers in both.
ORACLE = f"""
with w as (select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from documents),
t as (select rid, i, s from (select rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as s from (select rid, ws, unnest(range(1, len(ws) - 1)) as i from w)) qualify count(*) over (partition by rid, s) > 1),
c as (select rid, count(distinct p) as n from (select rid, unnest([i, i + 1, i + 2]) as p from t) group by 1),
b as (select w.rid, doc_id, lang, source, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars, (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint as n_symbols,
  len(ls)::bigint as n_lines, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words from w left join c using (rid)),
m as (select *, n_words < {MIN_WORDS} or n_repeat_words * 100 > n_words * {MAX_REPEATED_PERCENT} as base_failed from b),
v as ({_VALUES_SQL}),
k as (select lang, source, ratio, least, lower, (v >> greatest(length(bin(v)) - 7, 0)) << greatest(length(bin(v)) - 7, 0) as bucket from v),
s as (select 0 as level, lang, source, ratio, least, lower, bucket, count(*) as n from k group by all
  union all select 1, lang, null, ratio, least, lower, bucket, count(*) from k group by all
  union all select 2, null, null, ratio, least, lower, bucket, count(*) from k group by all),
u as (select *, sum(n) over (partition by level, lang, source, ratio order by bucket) as cum, sum(n) over (partition by level, lang, source, ratio) as total from s),
q as (select level, lang, source, ratio, max(least) as least, max(lower) as lower, max(total) as total, min(bucket) filter (cum * 100 >= total * 25) as q1, min(bucket) filter (cum * 100 >= total * 75) as q3 from u group by 1, 2, 3, 4),
f as (select level, lang, source, max(total) as total, map_from_entries(list((ratio, {{'low': case when lower = 1 then q1 - {WIDTH} * greatest(q3 - q1, least) else 0 end, 'high': q3 + {WIDTH} * greatest(q3 - q1, least)}}))) as fence from q group by 1, 2, 3),
j as (select m.*, coalesce(f0.fence, f1.fence, f2.fence) as pick from m
  left join f f0 on f0.level = 0 and f0.total >= {MIN_GROUP} and f0.lang is not distinct from m.lang and f0.source is not distinct from m.source
  left join f f1 on f1.level = 1 and f1.total >= {MIN_GROUP} and f1.lang is not distinct from m.lang left join f f2 on f2.level = 2)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and coalesce({_INSIDE_SQL}, true) as kept from j
"""
