"""Shards along a Hilbert curve over document metadata.

The dimensions (source, language, size) are quantised, each row gets the index of its cell on the
curve, rows are sorted by it, and the sorted sequence is cut into runs of equal counts. A shard then
covers a compact region in every dimension, so its files can be pruned by any of them. Names are placed
by their rank among the column's distinct names, so cells keep their order however many there are; sizes
by their octave and steps within it.

Groups are equal texts (by size, crc32 and a digest): all rows of a group take the group's lowest cell in
each dimension, so they share one cell and lie side by side; a cut, of which there are `shards - 1`, is
all that can part them. Rows of one cell are ordered by size, crc32, digest and doc_id, nulls first.

Defined cases: a null text has no bytes (size 1, crc32 of the empty string) and forms a group with
the empty text; null source or language take the lowest cell; long texts are read whole; repeated rows get
places of their own, in any order among themselves; an empty table gives an empty result; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import join_sized, stored, table
from palaver.shipping import ship

BITS = 8
#: Bits of a size's cell that tell its octave; the rest divide the octave evenly.
OCTAVE_BITS = 6


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cells (n x dimensions, values below 2**bits).

    The bits of the coordinates are turned, from the highest down, into the transposed index by
    reflections and exchanges; a Gray decoding and an interleaving of the bits finish it.
    """
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit, low = one << np.uint64(level), (one << np.uint64(level)) - one
        for axis in range(n):
            on = (x[axis] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(on, low, swap)
            x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[n - 1] & (one << np.uint64(level)), (one << np.uint64(level)) - one, 0)
    x ^= flip
    index = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            index = (index << one) | ((x[axis] >> np.uint64(level)) & one)
    return index.astype(np.int64)


def _ranked(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """df, sorted, with its rows' places in `rank` from 0, and their number.

    The rows are dealt over ranges and sorted there; only each range's row count comes to the driver. The
    table is stored, so partition counts and places agree.
    """
    run = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    starts, total = [], 0
    for p, n in sorted((r[0], r[1]) for r in run.groupBy(part).count().collect()):  # one row per partition
        starts.append((p, total))
        total += n
    offsets = F.broadcast(df.sparkSession.createDataFrame(starts, "__part long, __start long"))
    placed = run.withColumn("__part", part).join(offsets, "__part")
    return placed.withColumn("rank", F.col("__start") + F.col("__at").bitwiseAND((1 << 33) - 1)).drop("__part", "__at", "__start"), total


def with_name_cell(df: DataFrame, column: str, cell: str, bits: int) -> DataFrame:
    """df with the number of the name's cell, from 1 in order of names; 0 for null."""
    names, n = _ranked(df.select(F.col(column).alias("__name")).where(F.col(column).isNotNull()).distinct(), ["__name"])
    cells = names.select("__name", (F.lit(1) + F.expr(f"rank * {(1 << bits) - 1} div {max(n, 1)}")).cast("int").alias(cell))
    return join_sized(df, cells, F.col(column) == F.col("__name"), "left").drop("__name").withColumn(cell, F.coalesce(cell, F.lit(0)))


def size_cell(size: str, bits: int) -> Column:
    """Octave and even steps within it, as whole numbers."""
    step = bits - OCTAVE_BITS
    octave = f"(length(bin({size})) - 1)"
    return F.expr(f"int(shiftleft({octave}, {step}) | (shiftright(shiftleft({size}, {step}), {octave}) & {(1 << step) - 1}))")


def metadata(df: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, tie (of a digest), source, lang: all that sharding needs of a row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    tie = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
    return df.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), tie.alias("tie"), "source", "lang")


def hilbert_shards(df: DataFrame, shards: int = 8, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, source, lang, hilbert, shard, slot; row counts of shards differ by one at most."""
    ship(df.sparkSession)
    group = ["size", "text_crc32", "tie"]
    meta = stored(metadata(df))
    cells = stored(with_name_cell(with_name_cell(meta, "source", "c0", bits), "lang", "c1", bits))
    low = [F.min(c).alias(f"low_{c}") for c in ("c0", "c1")]
    # Only groups whose rows differ are joined back; stored, so that Spark may split a large one's rows over tasks.
    mixed = cells.groupBy(*group).agg(*low, *[F.max(c).alias(f"high_{c}") for c in ("c0", "c1")]).where("low_c0 < high_c0 or low_c1 < high_c1")
    placed = join_sized(cells, stored(mixed.select(*group, "low_c0", "low_c1")), group, "left")
    placed = placed.select("doc_id", *group, "source", "lang", F.coalesce("low_c0", "c0").alias("c0"), F.coalesce("low_c1", "c1").alias("c1"), size_cell("size", bits).alias("c2"))
    schema = T.StructType([*(placed.schema[c] for c in ("doc_id", *group, "source", "lang")), T.StructField("hilbert", T.LongType())])

    def index(batches):
        for batch in batches:
            cells = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("c0", "c1", "c2")], axis=1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in schema.fieldNames()[:-1]), pa.array(hilbert_index(cells, bits))], schema.fieldNames())

    ranked, total = _ranked(placed.mapInArrow(index, schema), ["hilbert", *group, "doc_id"])
    shard = F.expr(f"int(rank * {shards} div {max(total, 1)})")
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return (
        ranked.withColumn("shard", shard).withColumn("slot", F.col("rank") - first)
        .select("doc_id", "size", "text_crc32", "source", "lang", "hilbert", "shard", "slot")
    )


def write_shards(df: DataFrame, path: str, shards: int = 8) -> None:
    """The sharded metadata as one folder of Parquet files per shard, each sorted along the curve."""
    hilbert_shards(df, shards).repartition(shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op8_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert_shards(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")


def _curve_sql(bits: int) -> str:
    """Steps of `hilbert_index` in SQL, from h(…, x0, x1, x2) to curve(…, hilbert)."""
    steps, source, n = [], "h", 0
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for axis in range(3):
            other = "" if axis == 0 else f", case when x{axis} & {bit} = 0 then xor(x{axis}, xor(x0, x{axis}) & {low}) else x{axis} end as x{axis}"
            first = f"case when x{axis} & {bit} <> 0 then xor(x0, {low}) else xor(x0, xor(x0, x{axis}) & {low}) end as x0"
            n += 1
            steps.append(f"s{n} as (select * replace ({first}{other}) from {source})")
            source = f"s{n}"
    flips = " # ".join(f"(case when y2 & {1 << v} <> 0 then {(1 << v) - 1} else 0 end)" for v in range(bits - 1, 0, -1)).split(" # ")
    flip = flips[0]
    for f in flips[1:]:
        flip = f"xor({flip}, {f})"
    steps.append(f"g as (select *, x0 as y0, xor(x0, x1) as y1, xor(xor(x0, x1), x2) as y2 from {source})")
    steps.append(f"k as (select *, {flip} as flip from g)")
    bit = " + ".join(f"(((xor(y{a}, flip) >> {v}) & 1) << {3 * v + 2 - a})" for v in range(bits) for a in range(3))
    return ",\n".join([*steps, f"curve as (select *, ({bit})::bigint as hilbert from k)"])


#: The same in SQL, with the checksum's table of 256 numbers made by its polynomial.
ORACLE = f"""
with tab as (select list(v order by i) as t from (select i, list_reduce(list_concat([i], range(8)), lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as v from range(256) r(i))),
b as (select *, hex(encode(coalesce(text, ''))) as hx from documents),
m as (select doc_id, source, lang, strlen(coalesce(text, '')) + 1 as size, ('0x' || substr(md5(coalesce(text, '')), 1, 15))::bigint as tie,
  xor(list_reduce(list_concat([4294967295::bigint], list_transform(range(length(hx) // 2), lambda i: ('0x' || substr(hx, 2 * i + 1, 2))::bigint)), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) as text_crc32 from b, tab),
n0 as (select source, 1 + (row_number() over (order by source) - 1) * 255 // count(*) over () as c0 from (select distinct source from documents where source is not null)),
n1 as (select lang, 1 + (row_number() over (order by lang) - 1) * 255 // count(*) over () as c1 from (select distinct lang from documents where lang is not null)),
h as (select doc_id, size, text_crc32, tie, min(coalesce(c0, 0)) over w as x0, min(coalesce(c1, 0)) over w as x1,
  ((length(bin(size)) - 1) << 2) | (((size << 2) >> (length(bin(size)) - 1)) & 3) as x2 from m left join n0 using (source) left join n1 using (lang) window w as (partition by size, text_crc32, tie)),
{_curve_sql(BITS)},
r as (select *, row_number() over (order by hilbert, size, text_crc32, tie, doc_id nulls first) - 1 as rank, count(*) over () as total from curve),
s as (select *, (rank * 8 // total)::int as shard from r)
select doc_id, size::bigint as size, text_crc32::bigint as text_crc32, 'rows' as law, shard, (rank - (shard * total + 7) // 8)::bigint as slot, null::int as grown_shard, hilbert from s
"""
