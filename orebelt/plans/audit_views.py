"""Dashboard views of the audit log as Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orebelt.operators import audit
from orebelt.sources.sinks import overwrite
from orebelt.sources.tables import read_event_log


def history_views(events: DataFrame) -> dict[str, DataFrame]:
    """State of all runs, stages, files and rules."""
    return {
        "pipeline_runs": audit.pipeline_runs(events),
        "stage_runs": audit.stage_runs(events),
        "file_runs": audit.file_runs(events),
        "quality_results": audit.quality_results(events),
    }


def latest_views(history: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Views of the latest run and of the latest successful run."""
    runs, stages = history["pipeline_runs"], history["stage_runs"]
    latest, success = audit.latest_run(runs), audit.latest_run(runs, "SUCCESS")
    return {
        "latest_pipeline_run": latest,
        "latest_stage_runs": audit.latest_stages(stages, latest),
        "latest_successful_pipeline": success,
        "latest_successful_stage_runs": audit.latest_stages(stages, success),
        "latest_quality_results": audit.with_quality_fields(audit.latest_quality(history["quality_results"], success)),
        "latest_file_runs": audit.with_file_fields(audit.latest_files(history["file_runs"], success)),
    }


def export_views(spark: SparkSession, log_path: str, target: str) -> dict[str, DataFrame]:
    """Write history first, then derive the latest views from the stored history."""
    for name, view in history_views(read_event_log(spark, log_path)).items():
        overwrite(view, f"{target}/{name}")
    names = ("pipeline_runs", "stage_runs", "file_runs", "quality_results")
    history = {name: spark.read.parquet(f"{target}/{name}") for name in names}
    latest = latest_views(history)
    for name, view in latest.items():
        overwrite(view, f"{target}/{name}")
    return {**history, **{name: spark.read.parquet(f"{target}/{name}") for name in latest}}
