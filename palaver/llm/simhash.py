"""SimHash near-duplicates by anchor-point covering.

A text's 64-bit fingerprint: bit by bit the majority over the hashes of its word shingles. Two
fingerprints that differ in at most three bits differ in at most one bit of one 32-bit half. In each
half the anchors are the codewords of the perfect Hamming code of length 31 (one bit of the half
stays outside the code): every point lies within its covering radius, 1, of exactly one anchor, its
home. A point is replicated to every anchor within covering radius plus threshold, 1 + 1, of it: 16
anchors, or one for a codeword. So of two fingerprints with at most one differing bit in a half, one
meets the other at its home anchor, and comparing homes with all members, anchor by anchor, finds
every link. Equal fingerprints are one point; 2**26 anchors a half keep the meetings few.

Where many distinct fingerprints share an anchor, its homes and members are dealt into slices, and each
pair of slices is compared in a task of its own. An anchor gives links enough to connect whatever its
comparisons connect, not all pairs.

Those shingles of three words and three bits are op1's. The pipeline's stage (`deduplicated`) takes
texts for near copies whose sets of five-word shingles have a similarity (common over all) of 0.8 or
more. At 0.8 fingerprints differ in a seventh of their bits, so a pair meets at an anchor of either half of one
fingerprint in about one case of six. A set therefore has SERIES fingerprints, each the majority over hashes of
its own, and all go to their anchors as op1's do; the exact similarity of the sets decides about those that meet.

Defined cases: null and empty texts, and texts of white space, have no shingle and the fingerprint
zero; texts with fewer words than a shingle are one shingle; repeated rows and equal texts share a
fingerprint and a component; a null doc_id is kept, but names a component only if it has no other
id; an empty table gives an empty result; columns beyond the two named are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import drop_stored, join_sized, stored, table
from palaver.llm.components import components
from palaver.shipping import ship

SEED = 42
SHINGLE = 3
MAX_BITS = 3
#: Homes at one anchor beyond which its members are dealt into slices of about so many.
SLICE = 2000
#: Rows of an anchor that are in hand at a time; of those gone through only the homes stay.
HELD = 1 << 20
#: Ids that may be broadcast.
NARROW_ROWS = 500_000
#: Shingles that are hashed at a time, whatever the text's length.
STEP = 1 << 17
#: Near copies for the pipeline: words of a shingle, least similarity of two texts' sets of shingles.
COPY_SHINGLE = 5
PERCENT = 80
#: Their fingerprints. Sets of similarity 0.8 meet at no anchor of any of them with probability 0.845^64 = 2e-5.
SERIES, ROUND = 64, 8
#: Fingerprints of the first round. Sets that it connects share a label, and the other rounds look for links between labels only.
FIRST = 1
SALTS = np.random.default_rng(SEED).integers(0, 1 << 64, SERIES, np.uint64, endpoint=False)
#: Bits of one fingerprint that may differ where two meet: the half in which they meet has up to 3, the other 5 on average.
NEAR_BITS = 12
#: Bits of all fingerprints together: 620 at similarity 0.8 with a deviation of 23 (770 for sets of 4 and 5), 2,048 by chance.
FAR_BITS = 1000
#: Members and shingles of a slice of a class of candidates, and shingles of sets that are in hand at a time.
MEMBERS, SHINGLES = 500, 500_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A text's fingerprint as an unsigned integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # on bytes: A-Z only, the six ASCII spaces only
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    ones, h = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), STEP):
        pairs = zip(starts[at : at + STEP].tolist(), ends[at : at + STEP].tolist(), strict=True)
        hashes = np.array([h(flat[a:b], SEED) for a, b in pairs], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(df: DataFrame, shingle: int = SHINGLE, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep` and fp: the fingerprint as a long with the same 64 bits."""
    ship(df.sparkSession)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in batches:
            column = batch.column(len(keep))
            fps = np.array([fingerprint(column[i].as_py(), shingle) for i in range(batch.num_rows)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), pa.array(fps)], schema.fieldNames())

    return df.select(*keep, text).mapInArrow(run, schema)


def _masks() -> list[list[int]]:
    """For each syndrome of the code: what to flip to reach the home (first), then the other anchors within distance 2."""
    bit = lambda i: 1 << (i - 1)
    return [[0]] + [[bit(s)] + [bit(i) | bit(i ^ s) for i in range(1, 32) if i < i ^ s] for s in range(1, 32)]


def anchored(points: DataFrame, homes_only: bool = False) -> DataFrame:
    """points: fp, series if there are several, and what goes with them. Returns anchor (with series and half in its top
    bits), fp, home, and what goes with them: one row for each anchor that fp goes to, or for its homes only."""
    kept = [c for c in points.columns if c != "series"]
    series_ = [c for c in points.columns if c == "series"]
    top = F.col("half").cast("long") * (1 << 31) + sum((F.col(c).cast("long") * (1 << 32) for c in series_), F.lit(0))
    columns = [sum(1 << (i - 1) for i in range(1, 32) if i >> b & 1) for b in range(5)]
    table_ = F.array(*[F.array(*[F.lit(m).cast("long") for m in (row[:1] if homes_only else row)]) for row in _masks()])
    halves = points.select(*kept, *series_, F.posexplode(F.array(F.col("fp").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("fp", 32))).alias("half", "h"))
    coded = halves.select(*kept, *series_, "half", F.col("h").bitwiseAND(0x7FFFFFFF).alias("h"))
    syndrome = F.lit(0)
    for b, mask in enumerate(columns):
        syndrome = syndrome + (F.bit_count(F.col("h").bitwiseAND(mask)) % 2) * (1 << b)
    near = coded.withColumn("s", syndrome.cast("int")).select(*kept, *series_, "half", "h", F.posexplode(table_[F.col("s")]).alias("k", "m"))
    return near.select((F.col("h").bitwiseXOR(F.col("m")) + top).alias("anchor"), *kept, (F.col("k") == 0).alias("home"))


def _hot(homes: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """Anchors with many homes or members: into how many slices their homes and members are dealt, kh and km; kh is 0 where
    all rows have one label, so that no link is wanted. homes: the rows that are homes, or more columns of them."""
    # Members are counted only where homes are many: beside those few, a group's cost is linear in its members.
    homes = stored(homes.groupBy("anchor").agg(F.count("*").alias("homes")).where(F.col("homes") > size // 16))
    several = (F.min("label") < F.max("label")) if "label" in rows.columns else F.lit(True)
    count = join_sized(rows, homes, "anchor", "inner").groupBy("anchor").agg(F.first("homes").alias("homes"), F.count("*").alias("members"), several.alias("several"))
    hot = count.where((F.col("homes") > size) | (F.col("members") > 8 * size))
    kh = F.greatest(F.lit(1), F.ceil(F.sqrt(F.col("homes") / size)).cast("int"))
    km = F.greatest(kh, F.ceil(F.col("members") / (8 * size)).cast("int"))
    return stored(hot.select("anchor", F.when(F.col("several"), kh).otherwise(F.lit(0)).alias("kh"), km.alias("km")))


def _celled(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """rows with a cell: 0, or for hot anchors one cell for each pair of a slice of homes and one of members."""
    kept = [c for c in rows.columns if c != "home"]
    kh, km, own = F.col("kh"), F.col("km"), F.xxhash64("id" if "id" in kept else "fp")
    cell = lambda i, j, home: F.struct((i * km + j).cast("int").alias("cell"), F.lit(home).alias("home"))
    # A member stands in the cells of its column; if at home here, in those of its row as well, as a home.
    cells = F.when(kh.isNull(), F.array(F.struct(F.lit(0).alias("cell"), F.col("home").alias("home")))).otherwise(
        F.concat(
            F.transform(F.sequence(F.lit(0), kh - 1), lambda i: cell(i, F.pmod(own, km), False)),
            F.when(F.col("home"), F.transform(F.sequence(F.lit(0), km - 1), lambda j: cell(F.pmod(own, kh), j, True))).otherwise(F.expr("cast(array() as array<struct<cell:int,home:boolean>>)")),
        )
    )
    dealt = join_sized(rows, hot, "anchor", "left").where("kh is null or kh > 0")
    return dealt.select(*kept, F.explode(cells).alias("c")).select(*kept, "c.home", "c.cell")


def _sliced(rows: DataFrame, size: int) -> DataFrame:
    """rows with a cell, see `_celled`; which anchors are hot is found from the rows."""
    hot = _hot(rows.where("home"), rows, size)
    return rows.withColumn("cell", F.lit(0)) if hot.isEmpty() else _celled(rows, hot)


def _group_links(fp: np.ndarray, ids: np.ndarray, labels: np.ndarray, n_home: int, max_bits: int) -> list[tuple[int, int]]:
    """Links of ids that connect all labels that comparing homes (the first n_home) with all connects, fewer than there are labels."""
    label = np.unique(labels, return_inverse=True)[1]
    apart, links = label.max() + 1, []
    if apart == 1:
        return links
    # Points that share both fingerprint and label are one; homes come first in each such set.
    order = np.lexsort((np.arange(len(fp)) >= n_home, label, fp))
    first = np.concatenate(([True], (fp[order][1:] != fp[order][:-1]) | (label[order][1:] != label[order][:-1])))
    at = order[first]
    points, ids, label, homes = fp[at], ids[at], label[at], np.flatnonzero(at < n_home)
    for i in homes:
        near = np.flatnonzero((np.bitwise_count(points ^ points[i]) <= max_bits) & (label != label[i]))
        if len(near):
            others, one = np.unique(label[near], return_index=True)
            links += [(ids[i], ids[j]) for j in near[one]]
            label[np.isin(label, others)] = label[i]
            apart -= len(others)
            if apart == 1:
                break
    return links


def anchor_links(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """a, b: links found at the anchors; every: whether all of that anchor's are given.

    rows: anchor, cell, fp, home. Links are between different fingerprints; if rows have id and label, they are links
    of ids between different labels.
    """
    ship(rows.sparkSession)
    key = ["anchor", "cell"]
    names = [*key, "fp", "home", *(c for c in ("id", "label") if c in rows.columns)]
    dealt = rows.select(*names).repartition(*key).sortWithinPartitions(*key, F.desc("home"), "fp")

    def given(links):
        a, b, every = links
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(every)], ["a", "b", "every"])

    def parts(cols):
        """Fingerprints, ids and labels."""
        fp = cols[2].astype(np.int64)
        return (fp.view(np.uint64), *(c.astype(np.int64) for c in cols[4:])) if len(cols) > 4 else (fp.view(np.uint64), fp, fp)

    def run(batches):
        rest = None
        for batch in _then_none(batches):
            if batch is not None:
                cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
                cols = cols if rest is None else [np.concatenate([a, b]) for a, b in zip(rest, cols, strict=True)]
            elif rest is None:
                return
            else:
                cols = rest
            anchor, cell, home = cols[0], cols[1], cols[3]
            new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (cell[1:] != cell[:-1])) + 1
            # The last group may go on in the next batch.
            end = len(anchor) if batch is None else (new[-1] if len(new) else 0)
            rest = [c[end:] for c in cols]
            if not end:
                if len(anchor) > HELD:
                    at_home = home.astype(bool)
                    links = _group_links(*parts(cols), at_home.sum(), max_bits)
                    if links:
                        a, b = np.array(links, np.int64).T
                        yield given((a, b, np.zeros(len(a), bool)))
                    rest = [c[at_home] for c in cols]
                continue
            starts = np.concatenate(([0], new[new < end]))
            sizes = np.diff(np.concatenate((starts, [end])))
            n_home = np.add.reduceat(home[:end].astype(np.int64), starts)
            fp, ids, label = parts([c[:end] for c in cols])
            found_a, found_b, found_every = [], [], []
            use = (n_home > 0) & (sizes > 1)
            small = use & (sizes <= 64)
            if small.any():  # all pairs of a home and a member, of many groups at once
                s, z, h = starts[small], sizes[small], n_home[small]
                group = np.repeat(np.arange(len(s)), h)
                place = np.arange(len(group)) - np.repeat(np.cumsum(h) - h, h)
                left = s[group] + place
                width = z[group]
                a = np.repeat(left, width)
                b = np.repeat(s[group], width) + (np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width))
                near = (np.bitwise_count(fp[a] ^ fp[b]) <= max_bits) & (label[a] != label[b])
                found_a.append(ids[a][near])
                found_b.append(ids[b][near])
                found_every.append(np.ones(near.sum(), np.int64))
            for i in np.flatnonzero(use & ~small):
                s, z, h = starts[i], sizes[i], n_home[i]
                links = _group_links(fp[s : s + z], ids[s : s + z], label[s : s + z], h, max_bits)
                if links:
                    a, b = np.array(links, np.int64).T
                    found_a.append(a)
                    found_b.append(b)
                    found_every.append(np.zeros(len(a), np.int64))
            if found_a:
                a, b = np.concatenate(found_a), np.concatenate(found_b)
                pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b), np.concatenate(found_every)], axis=1), axis=0)
                yield given((*(np.ascontiguousarray(pair[:, k]) for k in range(2)), pair[:, 2] == 1))

    return dealt.mapInArrow(run, "a long, b long, every boolean")


def _then_none(batches):
    yield from batches
    yield None


def near_duplicates(df: DataFrame, shingle: int = SHINGLE, slice_size: int = SLICE, text: str = "text") -> DataFrame:
    """doc_id, fp, component_id: the least doc_id reachable over links."""
    prints = stored(fingerprints(df, shingle, text))
    points = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    links = stored(anchor_links(_sliced(anchored(points.select("fp")), slice_size)))
    roots = components(links).withColumnRenamed("node", "fp")
    named = points.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    byprint = stored(named.join(least, "root").select("fp", "component_id"))
    return prints.join(byprint, "fp").select("doc_id", "fp", "component_id")


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The different hashes of a text's word shingles, sorted."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    k, flat, h = min(shingle, len(words)), b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends + 1))[: len(words) - k + 1 if words else 0]
    return np.unique(np.array([h(flat[a:b], SEED) for a, b in zip(starts.tolist(), ends[max(k - 1, 0) :].tolist(), strict=True)], np.uint64))


def _counted(levels: list[np.ndarray]) -> list[np.ndarray]:
    """Numbers of ones, bit by bit, as binary digits (least first, one row each); levels: rows that count 1, 2, 4, ..."""
    out, k = [], 0
    levels = list(levels)
    while k < len(levels):
        rows, carried = levels[k], []
        while len(rows) > 1:
            t = max(1, len(rows) // 3)
            a, b = rows[:t], rows[t : 2 * t]
            x = a ^ b
            c = rows[2 * t : 3 * t] if len(rows) > 2 else np.zeros_like(x)
            carried.append((a & b) | (x & c))
            rows = np.concatenate([x ^ c, rows[3 * t :]])
        if carried:
            if k + 1 == len(levels):
                levels.append(np.concatenate(carried))
            else:
                levels[k + 1] = np.concatenate([levels[k + 1], *carried])
        out.append(rows)
        k += 1
    return out


def series(hashes: np.ndarray) -> np.ndarray:
    """The SERIES fingerprints of a set of shingles, as longs."""
    digits: list[np.ndarray] = []
    for at in range(0, len(hashes), 4096):
        x = (hashes[at : at + 4096, None] ^ SALTS) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(29)
        new = _counted([x])
        both = [np.concatenate([d[k] for d in (digits, new) if k < len(d)]) for k in range(max(len(digits), len(new)))]
        digits = _counted(both)
    # More than half: compared digit by digit, the greatest first.
    half, full = len(hashes) // 2, ~np.uint64(0)
    more, same = np.zeros(SERIES, np.uint64), np.full(SERIES, full)
    for k in reversed(range(max(len(digits), half.bit_length()))):
        digit = digits[k][0] if k < len(digits) else np.zeros(SERIES, np.uint64)
        if half >> k & 1:
            same &= digit
        else:
            more |= same & digit
            same &= ~digit
    return more.view(np.int64)


def sketches(df: DataFrame, shingle: int = COPY_SHINGLE) -> DataFrame:
    """doc_id, d (hash of the text), s (hash of its set of shingles), n (their number), code (its fingerprints)."""
    ship(df.sparkSession)
    schema = T.StructType([df.schema["doc_id"], *T._parse_datatype_string("d long, s long, n int, code array<long>").fields])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part, out = batch.slice(at, 1000), []
                for text in part.column(2):
                    hs = shingle_set(text.as_py(), shingle)
                    out.append((np.uint64(xxhash.xxh64_intdigest(hs.tobytes(), SEED)).astype(np.int64), len(hs), series(hs) if len(hs) else np.zeros(0, np.int64)))
                s, n, code = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(s, pa.int64()), pa.array(n, pa.int32()), pa.array(code, pa.list_(pa.int64()))], schema.fieldNames())

    return df.select("doc_id", F.xxhash64("text").alias("d"), "text").mapInArrow(run, schema)


def meetings(points: DataFrame, slice_size: int = SLICE) -> tuple[DataFrame, DataFrame]:
    """Candidates (ids a and b, sets s and t) that connect all that fingerprints which meet at an anchor connect, and the
    classes of ids that they form (node, root); points: id, s, code.

    Sets that the first round connects share a label, and the other rounds give links between different labels only,
    so that the links of a large class do not come again in each round. Of few fingerprints at an anchor all such links
    are given, of many as many as connect them. The former are dropped if the two sets' fingerprints differ in more
    than FAR_BITS altogether.
    """
    far = F.aggregate(F.zip_with("code", "code2", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    end = points.select(F.col("id").alias("a"), "s", "code")
    other = points.select(F.col("id").alias("b"), F.col("s").alias("t"), F.col("code").alias("code2"))

    def met(named: DataFrame, first: int, last: int) -> DataFrame:
        """a, b, s, t: links of the fingerprints from first to last; named: id, label, code."""
        own = lambda at, to: named.select("id", "label", F.posexplode(F.slice("code", at + 1, to - at)).alias("series", "fp")).withColumn("series", F.col("series") + at)
        hot = _hot(anchored(own(first, last), homes_only=True), anchored(own(first, last)), slice_size)
        even, found = hot.isEmpty(), None
        for at in range(first, last, ROUND):
            rows = anchored(own(at, min(at + ROUND, last)))
            part = stored(anchor_links(rows.withColumn("cell", F.lit(0)) if even else _celled(rows, hot), NEAR_BITS))
            found = part if found is None else found.union(part)
        found = found.groupBy("a", "b").agg(F.min("every").alias("every"))
        return stored(found.join(end, "a").join(other, "b").where(~F.col("every") | (far <= FAR_BITS)).select("a", "b", "s", "t"))

    start = met(points.select("id", F.col("id").alias("label"), "code"), 0, FIRST)
    labels = components(start.select("a", "b"))
    named = stored(points.join(labels.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("root", "id").alias("label"), "code"))
    more = met(named, FIRST, SERIES)
    drop_stored(named)
    classes = components(more.select("a", "b").union(labels.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    return start.union(more), classes


def shingle_sets(df: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """s, hs (sorted hashes) of the sets wanted; wanted: s and d, the hash of a text that has the set."""
    texts = join_sized(df.select("text", F.xxhash64("text").alias("d")), wanted, "d", "inner", NARROW_ROWS).dropDuplicates(["s"])

    def run(batches):
        for batch in batches:
            at, held, hs = 0, 0, []
            for i, t in enumerate(batch.column(1)):
                hs.append(shingle_set(t.as_py(), shingle).view(np.int64))
                held += len(hs[-1])
                if i + 1 == batch.num_rows or held >= SHINGLES:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(hs)), pa.array(hs, pa.list_(pa.int64()))], ["s", "hs"])
                    at, held, hs = i + 1, 0, []

    return texts.select("s", "text").mapInArrow(run, "s long, hs array<long>")


def open_links(members: DataFrame) -> DataFrame:
    """a, b: links of exact similarity PERCENT or more that connect, in each group, all roots that such links connect.

    members: key (of the group), cell, part (slice), first and second (the slices that meet in the cell), s,
    root, n, code, hs. Pairs are compared inside the task; only links between roots not connected yet leave it.
    """
    ship(members.sparkSession)
    dealt = members.repartition("key", "cell").sortWithinPartitions("key", "cell", "s")

    def compare(rows):
        s, root, part, first, second, hs, code = ([r[c] for r in rows] for c in ("s", "root", "part", "first", "second", "hs", "code"))
        sets = [np.sort(np.asarray(x, np.int64)) for x in hs]
        codes, sizes, part = np.array(code, np.int64).view(np.uint64), np.array([len(x) for x in sets]), np.array(part)
        label = np.unique(root, return_inverse=True)[1]
        across = first[0] != second[0]
        for i in range(len(s)):
            if across and part[i] != first[0]:
                continue
            differ = np.bitwise_count(codes ^ codes[i]).sum(axis=1, dtype=np.int64)
            near = (differ <= FAR_BITS) & (np.minimum(sizes, sizes[i]) * 100 >= np.maximum(sizes, sizes[i]) * PERCENT)
            near &= (part == second[0]) if across else (np.arange(len(s)) > i)
            for j in np.flatnonzero(near & (label != label[i])).tolist():
                if label[i] == label[j]:
                    continue
                common = sizes[i] + sizes[j] - len(np.union1d(sets[i], sets[j]))
                if common * (100 + PERCENT) >= (sizes[i] + sizes[j]) * PERCENT:
                    label[label == label[j]] = label[i]
                    yield s[i], s[j]

    def run(batches):
        columns = ["key", "cell", "s", "root", "part", "first", "second", "hs", "code"]
        group: list[dict] = []
        for batch in _then_none(batches):
            rows = (r.as_py() for r in pa.Table.from_batches([batch]).select(columns).to_struct_array()) if batch is not None else [None]
            links = []
            for row in rows:
                if group and (row is None or (row["key"], row["cell"]) != (group[0]["key"], group[0]["cell"])):
                    links += compare(group)
                    group.clear()
                if row is not None:
                    group.append(row)
            if links:
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _dealt(rows: DataFrame, members: int) -> DataFrame:
    """rows (key, root, n, ...) of groups with several roots, with the cells in which their slices meet."""
    groups = rows.groupBy("key").agg(F.count("*").alias("m"), F.sum("n").alias("all"), F.min("root").alias("low"), F.max("root").alias("high"))
    k = F.ceil(F.greatest(F.col("m") / members, F.col("all") / SHINGLES)).cast("int")
    groups = stored(groups.where("low <> high").select("key", F.greatest(k, F.lit(1)).alias("k")))
    own = F.pmod(F.xxhash64("s"), F.col("k")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda j: F.struct(F.least(own, j).alias("first"), F.greatest(own, j).alias("second")))
    placed = join_sized(rows, groups, "key", "inner").withColumn("part", own).withColumn("meet", F.explode(meets))
    return placed.select("key", "s", "root", "n", "part", "meet.first", "meet.second", (F.col("meet.first") * F.col("k") + F.col("meet.second")).alias("cell"))


def near_copies(df: DataFrame, shingle: int = COPY_SHINGLE, members: int = MEMBERS) -> DataFrame:
    """doc_id, d (hash of the text), root: one value for texts that links of similarity PERCENT or more connect.

    Candidates meet at anchors (`meetings`), and sets that candidates connect are a class. First each is compared
    with two leads of its class (the set that is a candidate with most others, and that of the least hash). Classes
    that those links leave in several parts are compared whole inside the tasks. Only exact similarity makes a link.
    """
    coded = stored(sketches(df, shingle))
    points = stored(coded.drop("doc_id").where("n > 0").dropDuplicates(["s"]).withColumn("id", F.monotonically_increasing_id()))
    prints = stored(coded.select("doc_id", "d", "s"))
    drop_stored(coded)
    found, classes = meetings(points)
    ends = F.array(F.struct(F.col("a").alias("id"), "s"), F.struct(F.col("b").alias("id"), F.col("t").alias("s")))
    score = found.select(F.inline(ends)).groupBy("id", "s").agg(F.count("*").alias("score"))
    shared = stored(score.join(classes.withColumnRenamed("node", "id"), "id", "left").select("s", "score", F.coalesce("root", "id").alias("key")))
    lead = lambda order: F.max_by("s", order)
    leads = stored(shared.groupBy("key").agg(lead(F.struct("score", "s")).alias("lead0"), lead(F.xxhash64("s")).alias("lead1")))
    led = join_sized(shared, leads, "key", "inner").select("s", F.explode(F.array("lead0", "lead1")).alias("lead")).where("s <> lead")
    pairs = stored(led.distinct())
    wanted = stored(points.select("s", "d").join(shared.select("s"), "s"))
    sets = stored(shingle_sets(df, wanted, shingle))
    other = sets.select(F.col("s").alias("lead"), F.col("hs").alias("hs2"))
    enough = F.size(F.array_intersect("hs", "hs2")) * (100 + PERCENT) >= (F.size("hs") + F.size("hs2")) * PERCENT
    links = stored(pairs.join(sets, "s").join(other, "lead").where(enough).select(F.col("s").alias("a"), F.col("lead").alias("b")))
    roots = stored(components(links).withColumnRenamed("node", "s"))
    rooted = shared.join(roots, "s", "left").withColumn("root", F.coalesce("root", "s"))
    mixed = stored(rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key"))
    if not mixed.isEmpty():
        left = join_sized(rooted, mixed, "key", "left_semi").select("s", "root", "key")
        facts = stored(points.select("s", "n", "code").join(left, "s"))
        placed = _dealt(facts.select("s", "root", "n", "key"), members)
        full = placed.join(facts.select("s", "code").join(sets, "s"), "s")
        links = links.union(stored(open_links(full)))
        roots = stored(components(links).withColumnRenamed("node", "s"))
    return prints.join(roots, "s", "left").select("doc_id", "d", F.coalesce("root", "s").alias("root"))


def deduplicated(df: DataFrame, shingle: int = COPY_SHINGLE) -> DataFrame:
    """df without all but one document of each group of near copies (five-word shingles, similarity 0.8 or more).

    Documents are known by doc_id and a hash of their text. The one with the least doc_id stays, one
    without an id only if none has one; of equal rows one stays.
    """
    rows = stored(near_copies(df, shingle))
    # Both sides are stored, so that Spark may split a large group's rows over tasks.
    first = stored(rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "d")).alias("first")))
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("d") == F.col("first.d"))
    ids = stored(rows.join(first, "root").groupBy("doc_id", "d").agg(F.max(kept).alias("kept"), F.count("*").alias("n")))
    key = [F.col("doc_id").alias("__id"), F.col("d").alias("__d")]
    gone, many = ids.where("not kept").select(key), ids.where("kept and n > 1").select(key)
    same = df["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(df["text"]) == F.col("__d"))
    left = join_sized(df, gone, same, "left_anti", NARROW_ROWS)
    if many.isEmpty():
        return left
    return join_sized(left, many, same, "left_anti", NARROW_ROWS).unionByName(join_sized(left, many, same, "left_semi", NARROW_ROWS).dropDuplicates(["doc_id", "text"]))


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _sql() -> str:
    """op1 in SQL: XXH64 by its definition on whole numbers, majorities, and all pairs of fingerprints."""
    whole = "18446744073709551616::uhugeint"
    #: The hash's primes.
    p1, p2, p3, p4, p5 = (f"{p}::uhugeint" for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
    mul = lambda a, b: f"(({a}) * ({b}) % {whole})"
    add = lambda *xs: f"(({' + '.join(xs)}) % {whole})"
    turn = lambda x, r: f"(({x}) * {1 << r} % {whole} + ({x}) // {1 << 64 - r})"
    number = lambda at, n: "('0x' || " + " || ".join(f"substr(hx, 2 * ({at}) + {2 * i + 1}, 2)" for i in range(n - 1, -1, -1)) + ")::uhugeint"
    fold = lambda first, count, at, n, step: f"list_reduce(list_concat([{first}], list_transform(range({count}), lambda q: {number(at, n)})), lambda a, x: {step})"
    mixed = lambda x: mul(turn(mul(x, p2), 31), p1)
    starts = [add(f"{SEED}::uhugeint", p1, p2), add(f"{SEED}::uhugeint", p2), f"{SEED}::uhugeint", f"({whole} + {SEED} - {p1})"]
    lanes = ", ".join(f"{fold(s, 'n // 32', f'32 * q + {8 * j}', 8, mul(turn(add('a', mul('x', p2)), 31), p1))} as v{j}" for j, s in enumerate(starts))
    merge = [add(mul(f"xor(e, {mixed(f'v{j}')})", p1), p4) for j in range(4)]
    steps = "".join(f"e{j} as (select * replace ({m} as e) from e{j - 1 if j else ''}),\n" for j, m in enumerate(merge))
    eight = fold("h", "(n % 32) // 8", "n // 32 * 32 + 8 * q", 8, add(mul(turn(f"xor(a, {mixed('x')})", 27), p1), p4))
    four = fold("h", "(n % 8) // 4", "n // 8 * 8", 4, add(mul(turn(f"xor(a, {mul('x', p1)})", 23), p2), p3))
    one = fold("h", "n % 4", "n // 4 * 4 + q", 1, mul(turn(f"xor(a, {mul('x', p5)})", 11), p1))
    down = lambda r: f"xor(h, h // {1 << r})"
    bits = " + ".join(f"(2 * sum((h >> {b}) & 1) > count(*))::int::uhugeint * {1 << b}" for b in range(64))
    return f"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as ws from documents),
t as (select doc_id, array_to_string(ws[i:i + least({SHINGLE}, len(ws)) - 1], ' ') as s from (select doc_id, ws, unnest(range(1, len(ws) - least({SHINGLE}, len(ws)) + 2)) as i from w where len(ws) > 0)),
b as (select s, hex(encode(s)) as hx, octet_length(encode(s)) as n from (select distinct s from t)),
v as (select *, {lanes} from b),
e as (select *, {add(turn('v0', 1), turn('v1', 7), turn('v2', 12), turn('v3', 18))} as e from v),
{steps}h0 as (select s, hx, n, {add('case when n < 32 then ' + add(f'{SEED}::uhugeint', p5) + ' else e end', 'n::uhugeint')} as h from e3),
h1 as (select * replace ({eight} as h) from h0), h2 as (select * replace ({four} as h) from h1), h3 as (select * replace ({one} as h) from h2),
h4 as (select * replace ({mul(down(33), p2)} as h) from h3), h5 as (select * replace ({mul(down(29), p3)} as h) from h4), h6 as (select s, ({down(32)})::ubigint as h from h5),
f as (select doc_id, ({bits})::ubigint as fp from t join h6 using (s) group by 1),
a as (select w.doc_id, coalesce(fp, 0::ubigint) as fp from w left join f using (doc_id)),
u as (select fp, min(doc_id) as least_id from a group by 1),
l as (select x.fp as p, y.fp as q from u x, u y where bit_count(xor(x.fp, y.fp)::hugeint) <= {MAX_BITS}),
c as (select p, q from l union select c.p, l.q from c join l on c.q = l.p),
r as (select p as fp, min(least_id) as component_id from c join u on c.q = u.fp group by 1)
select doc_id, lpad(lower(hex(fp)), 16, '0') as fingerprint, component_id from a join r using (fp)
"""


ORACLE = _sql()
