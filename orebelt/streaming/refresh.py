"""Contributions kept current by a stream of arriving files.

Every file is its own source, so a batch aggregates new files only and never reads
a source again. A batch is one directory whatever the number of its files, and batches are
compacted level by level as they come. Versions come from the file's own modification time,
and the manifest's last entry per source counts: a replayed batch replaces what it wrote
before, which makes the sink idempotent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orebelt.operators.incremental import source_id
from orebelt.operators.star import star_input
from orebelt.plans.star_refresh import StarStore

_IDENTITY = ("source_id", "version")


def file_stream(spark: SparkSession, schema, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of a Parquet folder with the id and version of each row's file."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).select(
        "*",
        source_id(F.col("_metadata.file_path")).alias("source_id"),
        F.unix_micros("_metadata.file_modification_time").cast("string").alias("version"),
    )


def stream_contributions(
    stream: DataFrame,
    store: StarStore,
    checkpoint: str,
    to_canonical: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    fanout: int = 8,
) -> StreamingQuery:
    """Process what has arrived, then stop. ``to_canonical`` must keep the identity columns.

    ``fanout`` is the number of batches of one level that are merged into one of the next.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = store.stage(star_input(to_canonical(batch), carry=_IDENTITY))
        # files without a trip have no contribution to replace or keep
        store.commit(spark, store.staged_versions(spark, staged), staged)
        if batch_id % fanout == fanout - 1:  # no level fills up sooner
            store.compact(spark, fanout)

    return (
        stream.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
