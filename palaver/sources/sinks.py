"""Writers: stage tables, editable copies, and final data sets with their media."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from palaver.functions.text import media_name


def without_index(df: DataFrame) -> DataFrame:
    """df without the index columns that tables saved elsewhere bring along."""
    return df.drop(*[c for c in df.columns if "Unnamed" in c or c == ""])


def filesystem(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def scratch(spark: SparkSession) -> str:
    """A new folder's name in the storage that all executors share; only a local[...] session may go without
    spark.checkpoint.dir, which names it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="palaver-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = filesystem(spark, path)
    return fs.exists(where)


def settled(spark: SparkSession, path: str, aside: str) -> None:
    """Puts back what an interrupted swap has set aside: what is at `path` is the old or the new, never nothing."""
    fs, final = filesystem(spark, path)
    _, old = filesystem(spark, aside)
    if fs.exists(old):
        if fs.exists(final):
            fs.delete(old, True)
        elif not fs.rename(old, final):
            raise OSError(f"{aside} could not be put back")


def swap(spark: SparkSession, fresh: str, path: str, aside: str) -> None:
    """Puts `fresh` in the place of `path`, which stands aside until that is done."""
    fs, final = filesystem(spark, path)
    _, new = filesystem(spark, fresh)
    _, old = filesystem(spark, aside)
    fs.mkdirs(final.getParent())
    fs.mkdirs(old.getParent())
    if fs.exists(final) and not fs.rename(final, old):
        raise OSError(f"{path} could not be set aside")
    if not fs.rename(new, final):
        raise OSError(f"{fresh} could not take the place of {path}")
    fs.delete(old, True)


def write_swapped(df: DataFrame, path: str) -> DataFrame:
    """Writes beside the table and puts it in its place when whole, so a table may feed its own update."""
    spark = df.sparkSession
    settled(spark, path, f"{path}.old")
    without_index(df).write.mode("overwrite").parquet(f"{path}.new")
    swap(spark, f"{path}.new", path, f"{path}.old")
    return spark.read.parquet(path)


def append(df: DataFrame, path: str) -> DataFrame:
    """Adds files to the table; what is there stays as it is, so the cost is that of the new rows."""
    spark = df.sparkSession
    without_index(df).select(*spark.read.parquet(path).columns).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def upsert_parts(df: DataFrame, path: str, keys: tuple[str, ...], parts: int = 64, part: str = "__part") -> None:
    """Puts df's rows into the table, in place of those with the same keys.

    The table is parted by a hash of the first key, and only the parts that df has rows of are read and
    written again, each swapped when whole. Running the same call again changes nothing.
    """
    spark = df.sparkSession
    new = without_index(df).withColumn(part, F.pmod(F.xxhash64(F.col(keys[0]).cast("string")), F.lit(parts)).cast("int")).persist()
    try:
        touched = [r[0] for r in new.select(part).distinct().collect()]  # at most `parts`
        for p in touched:
            settled(spark, f"{path}/{part}={p}", f"{path}.old/{part}={p}")
        rows = new
        if any(exists(spark, f"{path}/{part}={p}") for p in touched):
            old = spark.read.parquet(path).where(F.col(part).isin(touched))
            rows = old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)
        rows.repartition(part).write.mode("overwrite").partitionBy(part).parquet(f"{path}.new")
    finally:
        new.unpersist()
    for p in touched:
        swap(spark, f"{path}.new/{part}={p}", f"{path}/{part}={p}", f"{path}.old/{part}={p}")
    for rest in ("new", "old"):
        fs, folder = filesystem(spark, f"{path}.{rest}")
        fs.delete(folder, True)


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for CSV."""
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (ArrayType, MapType, StructType)) else F.col(f.name) for f in df.schema])


def write_editable(df: DataFrame, path: str) -> None:
    """A copy as CSV files with a header each, for people to edit."""
    flat(df).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def read_editable(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """An edited copy with the types that its stage had."""
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    nested = (ArrayType, MapType, StructType)
    return raw.select(*[(F.from_json(f.name, f.dataType) if isinstance(f.dataType, nested) else F.col(f.name).cast(f.dataType)).alias(f.name) for f in schema])


def copy_files(df: DataFrame, source: str, target: str) -> None:
    """Copies each row's file between folders that the executors share; rows without a path are passed over."""

    def run(rows):
        import shutil
        from pathlib import Path

        for row in rows:
            Path(row[1]).parent.mkdir(parents=True, exist_ok=True)
            shutil.copyfile(row[0].removeprefix("file:"), row[1])

    df.where(F.col(source).isNotNull()).select(source, target).foreachPartition(run)


def staged(df: DataFrame, folder: str, conv: str, utter: str, path: str = "file_path", suffix: str = "mp3") -> DataFrame:
    """df with each row's file copied to <folder>/<conv>_<utter>.<suffix>; rows without a file keep null."""
    out = df.withColumn("__to", F.when(F.col(path).isNotNull(), F.concat(F.lit(f"{folder}/"), media_name(F.col(conv), F.col(utter), suffix))))
    copy_files(out, path, "__to")
    return out.withColumn(path, F.col("__to")).drop("__to")


def save_dataset(df: DataFrame, folder: str, media: bool = False, path: str = "file_name") -> DataFrame:
    """metadata with the media's new places, and on request the media themselves, below the folder."""
    new: Column = F.concat(F.lit(f"{folder}/audio_files/"), media_name(F.col("conv_id"), F.col("utter_id")))
    out = df.withColumn("__to", F.when(F.col(path).isNotNull(), new))
    if media:
        copy_files(out, path, "__to")
    named = out.withColumn(path, F.col("__to")).drop("__to")
    flat(without_index(named)).write.mode("overwrite").csv(f"{folder}/metadata.csv", header=True, quote='"', escape='"')
    return named


def save_splits(df: DataFrame, folder: str) -> None:
    """One folder per split."""
    without_index(df).write.mode("overwrite").partitionBy("split").parquet(folder)
