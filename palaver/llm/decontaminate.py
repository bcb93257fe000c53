"""Finds passages of benchmark items in documents. DataFrame functions only.

Texts are lower-cased and read as words (runs of letters and digits), words as shingles of five (an item
of fewer words is one shingle). A document holds an item if some window of the item's size, in shingles,
has a weighted similarity of 0.8 or more with it: shingles weighted by their number of occurrences, the
sum of the lesser weights over the sum of the greater ones. Steps:

1. Windows of the size of items. A window that holds an item begins, without loss, at a place whose
   shingle is one of an item (or is the document's last): moving it there keeps every shingle that counts.
   Windows of a size with fewer such places than the similarity needs hold no item, whichever it be. What
   item a place belongs to is not kept; equal window contents are one.
2. SimHash of each window and each item: 128 bits, by majority over hashes of (shingle, number of the
   occurrence). As each occurrence has a hash of its own, a repeated shingle weighs no more than others.
3. Multi-index: the bits are parted into RADIUS + 1 blocks, and a window meets the items of its size with
   which it has a block in common. Every fingerprint within RADIUS bits is met, as so many differences
   can not touch all blocks. Others are dropped by their distance.
4. The exact similarity of each pair that is left decides.

RADIUS is 52 of 128: at a similarity of 0.8, 20 bits differ on average with a deviation of 4.1, so a pair
at the very limit is beyond it with a probability of about 1e-12, and closer pairs with less.

Equal items are one item, with the least item_id; `item_classes` gives the others' class.

Defined cases: null or empty texts hold no item and null or empty items are in no document; a document
shorter than an item is one window, whole; long texts are read whole; rows that share doc_id give the
pairs of all their texts, each pair once, with the best window, the first of equals; an empty table on
either side gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.common import join_sized, stored, table

SHINGLE = 5
PERCENT = 80
#: Bits of a fingerprint (in longs of 64), and how many of them may differ.
LONGS = 2
RADIUS = 52
#: Keys of one or two longs that may be broadcast.
NARROW_ROWS = 500_000


def plain_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def shingle_hashes(words: str, k: int | str) -> Column:
    """Hashes of the k-word shingles of an array column; one of the whole if it has fewer words."""
    each = f"transform(sequence(0, greatest(size({words}) - {k}, 0)), i -> xxhash64(slice({words}, i + 1, {k})))"
    return F.expr(f"case when size({words}) > 0 then {each} else cast(array() as array<bigint>) end")


def items_of(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items (item, k, n: shingles) and their shingles (item, k, n, h, c: occurrences), equal items once."""
    ws = benchmark.select("item_id", plain_words(F.col("text")).alias("ws")).where(F.size("ws") > 0)
    ws = ws.groupBy("ws").agg(F.min("item_id").alias("item")).withColumn("k", F.least(F.size("ws"), F.lit(SHINGLE)))
    hashed = ws.withColumn("hs", shingle_hashes("ws", "k")).select("item", "k", F.size("hs").cast("long").alias("n"), "hs")
    shingles = stored(hashed.select("item", "k", "n", F.explode("hs").alias("h")).groupBy("item", "k", "n", "h").agg(F.count("*").alias("c")))
    return shingles.select("item", "k", "n").distinct(), shingles


def _hashed(docs: DataFrame, k: int) -> DataFrame:
    return docs.withColumn("ws", plain_words(F.col("text"))).withColumn("hs", shingle_hashes("ws", k)).drop("ws", "text")


def hits(docs: DataFrame, shingles: DataFrame, k: int) -> DataFrame:
    """doc, d, m (shingles of the document), pos, h: places of documents with a shingle of an item."""
    keys = shingles.where(F.col("k") == k).select("h").distinct()
    # The outer form: for the inner one Spark would add a filter on the array's size, in which it computes the array anew.
    places = _hashed(docs, k).select("doc", "d", F.size("hs").cast("long").alias("m"), F.posexplode_outer("hs").alias("pos", "h"))
    return join_sized(places, keys, "h", "inner", NARROW_ROWS)


def windows(found: DataFrame, shingles: DataFrame) -> DataFrame:
    """doc, d, k, n, start, size: windows of the size n of some item (or the whole of a shorter document) with as many
    places as any item of that size needs."""
    sizes = shingles.select("k", "n", "h").distinct()
    places = found.join(sizes, "h").groupBy("doc", "d", "k", "n", "m").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    w = places.withColumn("size", F.least("n", "m"))
    w = w.withColumn("need", F.expr(f"int(({PERCENT} * (n + size) + {99 + PERCENT}) div {100 + PERCENT})"))
    starts = F.expr("filter(at, (p, i) -> p <= m - size and get(at, i + need - 1) < p + size)")
    last = F.expr("filter(array(int(m - size)), s -> get(at, size(at) - need) >= s)")
    return w.where(F.size("at") >= F.col("need")).select("doc", "d", "k", "n", "size", F.explode(F.array_distinct(F.concat(starts, last))).alias("start"))


def contents(docs: DataFrame, places: DataFrame, sizes: list[int]) -> DataFrame:
    """places with the window's hashes (hs) and their digest (content)."""
    null_safe = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    cut = None
    for k in sizes:
        own = places.where(F.col("k") == k)
        wanted = own.select(F.col("doc").alias("doc2"), F.col("d").alias("d2")).distinct()
        again = join_sized(docs, wanted, null_safe("doc", "doc2") & (F.col("d") == F.col("d2")), "left_semi", NARROW_ROWS).dropDuplicates(["doc", "d"])
        hashed = _hashed(again, k).select(F.col("doc").alias("doc2"), F.col("d").alias("d2"), "hs")
        part = own.join(hashed, null_safe("doc", "doc2") & (F.col("d") == F.col("d2"))).select("doc", "d", "k", "n", "start", F.slice("hs", F.col("start") + 1, F.col("size").cast("int")).alias("hs"))
        cut = part if cut is None else cut.unionByName(part)
    return cut.withColumn("content", F.xxhash64("hs"))


def fingerprints(weighted: DataFrame, *key: str) -> DataFrame:
    """key and fp, an array of longs, from rows (key, h, c): bit by bit the majority over hashes of each occurrence of h."""
    each = weighted.select(*key, F.explode(F.transform(F.sequence(F.lit(1), F.col("c").cast("int")), lambda i: F.struct(*[F.xxhash64("h", i, F.lit(w)).alias(f"f{w}") for w in range(LONGS)]))).alias("f"))
    ones = [F.sum(F.shiftrightunsigned(f"f.f{w}", b).bitwiseAND(1)).alias(f"b{w}_{b}") for w in range(LONGS) for b in range(64)]
    sums = each.groupBy(*key).agg(F.count("*").alias("all"), *ones)
    word = lambda w: " + ".join(f"shiftleft(bigint(2 * b{w}_{b} > all), {b})" for b in range(64))
    return sums.select(*key, F.array(*[F.expr(word(w)) for w in range(LONGS)]).alias("fp"))


def blocks(fp: str) -> Column:
    """The fingerprint's bits in RADIUS + 1 blocks, each with its number above them, as one array of longs."""
    bits, edges = 64 * LONGS, [i * 64 * LONGS // (RADIUS + 1) for i in range(RADIUS + 2)]
    out = []
    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        w, at = divmod(a, 64)
        low = f"shiftrightunsigned({fp}[{w}], {at})"
        if at + b - a > 64:  # goes on in the next long
            low = f"({low} | shiftleft({fp}[{w + 1}], {64 - at}))"
        out.append(f"({low} & {(1 << (b - a)) - 1}L) + {i << 8}L")
    assert edges[-1] == bits
    return F.expr(f"array({', '.join(out)})")


def near_pairs(window_prints: DataFrame, item_prints: DataFrame) -> DataFrame:
    """content, item: pairs of the same k and n whose fingerprints differ in RADIUS bits or fewer.

    window_prints: content, k, n, fp; item_prints: item, k, n, fp.
    """
    key = ["k", "n", "block"]
    left = window_prints.withColumn("block", F.explode(blocks("fp")))
    right = item_prints.select("item", "k", "n", F.col("fp").alias("fp2"), F.explode(blocks("fp")).alias("block"))
    far = sum((F.bit_count(F.col("fp")[w].bitwiseXOR(F.col("fp2")[w])) for w in range(LONGS)), F.lit(0))
    return join_sized(left, right, key, "inner", NARROW_ROWS).where(far <= RADIUS).select("content", "item").distinct()


def found_windows(documents: DataFrame, benchmark: DataFrame) -> DataFrame | None:
    """doc, d (hash of the text), item, k, start, similarity, size: windows that hold an item; None without items."""
    docs = documents.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("d"), "text").where(F.col("text").isNotNull())
    items, shingles = items_of(benchmark)
    sizes = sorted(r[0] for r in items.select("k").distinct().collect())  # at most SHINGLE of them
    if not sizes:
        return None
    places = None
    for k in sizes:
        own = windows(hits(docs, shingles, k), shingles.where(F.col("k") == k))
        places = own if places is None else places.unionByName(own)
    cut = stored(contents(docs, stored(places.distinct()), sizes))
    once = stored(cut.groupBy("content", "k", "n").agg(F.first("hs").alias("hs")))
    weighted = stored(once.select("content", "k", "n", F.explode("hs").alias("h")).groupBy("content", "k", "n", "h").agg(F.count("*").alias("c")))
    pairs = stored(near_pairs(fingerprints(weighted, "content", "k", "n"), fingerprints(shingles, "item", "k", "n")))
    shared = pairs.join(weighted, "content").join(shingles.select("item", "k", "n", "h", F.col("c").alias("ci")), ["item", "k", "n", "h"])
    common = shared.groupBy("item", "content", "k", "n").agg(F.sum(F.least("c", "ci")).alias("common"))
    sized = once.select("content", "k", "n", F.size("hs").cast("long").alias("size"))
    good = common.join(sized, ["content", "k", "n"]).where(F.col("common") * (100 + PERCENT) >= (F.col("size") + F.col("n")) * PERCENT)
    good = good.select("content", "k", "n", "item", "size", (F.col("common") / (F.col("size") + F.col("n") - F.col("common"))).alias("similarity"))
    return cut.drop("hs").join(good, ["content", "k", "n"])


def item_classes(benchmark: DataFrame) -> DataFrame:
    """item_id, item: the least id of the items with the same words, which stands for all of them in the results."""
    ws = benchmark.select("item_id", plain_words(F.col("text")).alias("ws")).where(F.size("ws") > 0)
    return ws.join(ws.groupBy("ws").agg(F.min("item_id").alias("item")), "ws").select("item_id", "item")


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, first_word (of the best window, the first such), n_words: one row per pair."""
    found = found_windows(documents, benchmark)
    if found is None:
        return documents.sparkSession.createDataFrame([], f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, item_id {benchmark.schema['item_id'].dataType.simpleString()}, similarity double, first_word int, n_words bigint")
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "start", (F.col("size") + F.col("k") - 1).alias("n_words")))
    return (
        found.groupBy("doc", "item").agg(best.alias("b"))
        .select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), (-F.col("b.s")).alias("similarity"), F.col("b.start").alias("first_word"), "b.n_words")
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """documents without those whose own text holds a benchmark item."""
    found = found_windows(documents, benchmark)
    if found is None:
        return documents
    bad = stored(found.select(F.col("doc").alias("__bad"), F.col("d").alias("__d")).distinct())
    same = documents["doc_id"].eqNullSafe(F.col("__bad")) & (F.xxhash64(documents["text"]) == F.col("__d"))
    return join_sized(documents, bad, same, "left_anti", NARROW_ROWS)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The same pairs by looking at every window that begins at a shared shingle, on the shingles' words.
ORACLE = """
with w as (
  select doc_id, hash(text) as d, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') as ws from documents where text is not null
), iw as (
  select ws, min(item_id) as item, least(len(ws), 5) as k from (
    select item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') as ws from benchmark where text is not null) where len(ws) > 0 group by ws
), ish as (
  select item, k, len(ws) - k + 1 as n, array_to_string(ws[i:i + k - 1], ' ') as s, count(*) as c from (select item, k, ws, unnest(range(1, len(ws) - k + 2)) as i from iw) group by all
), dsh as (
  select doc_id, d, k, i - 1 as pos, greatest(len(ws) - k + 1, 1) as m, array_to_string(ws[i:i + k - 1], ' ') as s
  from (select doc_id, d, ws, k, unnest(range(1, greatest(len(ws) - k + 1, 1) + 1)) as i from (select distinct * from w where len(ws) > 0), (select distinct k from ish))
), hit as (
  select doc_id, d, item, dsh.k, n, m, pos, least(n, m) as size, c from dsh join ish using (k, s)
), st as (
  select distinct doc_id, d, item, k, n, size, least(pos, m - size) as start from hit
), inter as (
  select st.doc_id, st.d, st.item, st.k, st.n, st.size, start, s, count(*) as cw
  from st join dsh on st.doc_id = dsh.doc_id and st.d = dsh.d and st.k = dsh.k and dsh.pos between start and start + st.size - 1 group by all
), sim as (
  select doc_id, item, k, size, start, sum(least(cw, c))::double / (size + n - sum(least(cw, c))) as similarity, sum(least(cw, c)) as x, n
  from inter join ish using (item, k, n, s) group by doc_id, d, item, k, n, size, start
)
select doc_id, item as item_id, similarity, start::int as first_word, (size + k - 1)::bigint as n_words from sim
where x * 180 >= (size + n) * 80
qualify row_number() over (partition by doc_id, item order by similarity desc, start) = 1
"""
