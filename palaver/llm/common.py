"""What the operators of this subpackage share: table access, shared scratch space, text words."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Spark removes a query's shuffle files when it ends, as nothing but its table is read afterwards.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Raw text bytes that one block of documents holds on average (see `n_blocks`).
BLOCK_BYTES = 24 << 20


_made: dict[str, list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder name in the storage that driver and executors share.

    It is below spark.checkpoint.dir. Only a local[...] session, whose executors are the driver
    itself, may go without that setting; anything else must name shared storage.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="palaver-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The same rows, read back from a table in shared storage: evaluated once, safe from lost executors."""
    spark = df.sparkSession
    path = scratch(spark)
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def clear_stored(spark: SparkSession) -> None:
    """Remove all tables that `stored` has made in this application and that are still there; call it once results are written."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in _made.pop(spark.sparkContext.applicationId, []):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)


def drop_stored(df: DataFrame) -> None:
    """Remove the files of a table made by `stored` once nothing reads them any more."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """The words of a text, an empty array for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RUN, -1), lambda w: w != "")


def id_remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo mod; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def n_blocks(df: DataFrame, column: str, block_bytes: int = BLOCK_BYTES) -> int:
    """How many blocks of about block_bytes the column's texts fill; their count follows the input."""
    total = df.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0
    return max(1, -(-int(total) // block_bytes))


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether df has at most so many rows, found without counting further than that."""
    return df.limit(rows + 1).count() <= rows


def join_sized(left: DataFrame, right: DataFrame, on, how: str, rows: int = 100_000) -> DataFrame:
    """left joined with right: by broadcast if right has at most `rows` rows, else by a shuffle.

    The rows of right must be narrow (keys and a few numbers), so the row limit bounds its bytes.
    """
    return left.join(F.broadcast(right) if small_enough(right, rows) else right, on, how)
