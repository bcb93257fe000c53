"""The incremental form of a stage: new files of the stage before are taken up as they come."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from palaver.sources.sinks import upsert_parts


def run_available(spark: SparkSession, source: str, target: str, checkpoint: str, stage: Callable[[DataFrame], DataFrame], keys: tuple[str, ...] = ("conv_id", "utter_id"), files: int | None = None) -> StreamingQuery:
    """Runs `stage` over all files of source that came since the last call and puts its rows into target.

    A file holds whole conversations. Rows of a key that is there already are replaced, so a batch that
    is run again after a failure changes nothing. The target is parted by a hash of the first key, and a
    batch rewrites only the parts that it has rows of.
    """
    stream = spark.readStream.schema(spark.read.parquet(source).schema)
    stream = stream.option("maxFilesPerTrigger", files) if files else stream

    def put(batch: DataFrame, _: int) -> None:
        upsert_parts(stage(batch), target, keys)

    query = stream.parquet(source).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
