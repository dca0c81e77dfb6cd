"""Run states kept current by a stream of audit events.

Every micro-batch is folded by itself and added to a merged table, so no event is read twice.
Late events, repeated events and replayed batches change nothing: the merged state is that of the
set of all events, in whatever batches they came.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from orebelt.operators.audit import RunFold
from orebelt.sources.merged import MergedTable


def run_table(root: str, fold: RunFold) -> MergedTable:
    """The kept states of one kind of run."""
    return MergedTable(f"{root}/{fold.key}", fold.merge)


def stream_runs(
    events: DataFrame,
    folds: list[RunFold],
    root: str,
    checkpoint: str,
    to_events: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    fanout: int = 8,
) -> StreamingQuery:
    """Fold what has arrived into the tables below ``root``, then stop.

    ``to_events`` brings a batch to the event schema.
    """

    def fold_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        for fold in folds:
            table = run_table(root, fold)
            table.add(fold.state(to_events(batch)))
            if batch_id % fanout == fanout - 1:  # no level fills up sooner
                table.compact(spark, fanout)

    return events.writeStream.foreachBatch(fold_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_runs(spark: SparkSession, fold: RunFold, root: str) -> DataFrame | None:
    """Runs as of all events so far; None before the first batch."""
    state = run_table(root, fold).read(spark)
    return None if state is None else fold.rows(state)
