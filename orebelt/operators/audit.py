"""Audit log: event schema, checks, state folds, views and dashboard measures.

Events are folded to the last start and the first and last finish per run, so a run's events
are merged map-side and never replayed in one place. The order of events is their time, then
``event_seq``, which the log reader fills with the place in the log where the log has none;
if it is missing altogether, a finish follows a start of equal time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebelt import contract
from orebelt.functions.values import json_fields, ratio

PAYLOAD_SCHEMA = (
    "struct<parameters: string, metrics: string, command: string, duration_seconds: double, return_code: int, "
    "stdout_log: string, stderr_log: string, file_name: string, target_path: string, source_hash: string, "
    "metadata: string, dataset_name: string, rule_id: string, rule_name: string, records_evaluated: bigint, "
    "records_failed: bigint, failure_rate: double, allowed_failure_rate: double>"
)
# Open objects are typed as text: the JSON reader then keeps their own spelling.
EVENT_SCHEMA = (
    "event_id string, event_type string, event_seq bigint, occurred_at timestamp, pipeline_id string, "
    "pipeline_name string, pipeline_version string, environment string, host_name string, process_id bigint, "
    f"stage_name string, stage_run_id string, status string, message string, payload {PAYLOAD_SCHEMA}"
)

_ORDER = ("occurred_at", "event_seq")
_EMPTY_OBJECT = "{}"
_EMPTY_LIST = "[]"


def invalid_events(events: DataFrame) -> DataFrame:
    """Events of unknown type or with a status outside the domain of their type."""
    kind, status = F.col("event_type"), F.col("status")
    domain = (
        F.when(kind.startswith("PIPELINE_"), status.isin(*contract.PIPELINE_STATUSES))
        .when(kind.startswith("STAGE_"), status.isin(*contract.STAGE_STATUSES))
        .when(kind == "QUALITY_RULE_EVALUATED", status.isin(*contract.RULE_STATUSES))
        .otherwise(F.lit(True))
    )
    problem = F.when(~kind.isin(*contract.EVENT_TYPES), "unknown event type").when(
        ~F.coalesce(domain, F.lit(False)), "status outside domain"
    )
    return events.select("event_id", "event_type", "status", problem.alias("problem")).where(F.col("problem").isNotNull())


@dataclass(frozen=True)
class RunFold:
    """The last state per run: a start resets the row, a later finish updates it, and a finish
    without a start takes its header from the first such finish.

    What decides is the last start, the first finish and the last finish. These three form a
    state that merges in any order and grouping, whole or repeated, so it can be kept as a table
    and brought forward with new events alone. ``started`` and ``finished`` map columns to
    expressions over events; ``unfinished`` columns keep those of the start or are filled.
    """

    key: str
    prefix: str
    header: tuple[str, ...]
    started: Mapping[str, Callable[[], Column]]
    finished: Mapping[str, Callable[[], Column]]
    fill: Mapping[str, str]

    def state(self, events: DataFrame) -> DataFrame:
        """One row per run that the events touch: last start, first and last finish with their order."""
        order = F.struct(*_ORDER)
        is_start, is_finish = F.col("event_type") == f"{self.prefix}_STARTED", F.col("event_type") == f"{self.prefix}_FINISHED"
        start_values = F.struct(*self.header, *[v().alias(n) for n, v in self.started.items()])
        finish_values = F.struct(*[v().alias(n) for n, v in self.finished.items()])
        parts = events.where(is_start | is_finish).select(
            self.key,
            F.when(is_start, start_values).alias("s"),
            F.when(is_start, order).alias("s_at"),
            F.when(is_finish, F.struct(*self.header)).alias("h"),
            F.when(is_finish, order).alias("h_at"),
            F.when(is_finish, finish_values).alias("f"),
            F.when(is_finish, order).alias("f_at"),
        )
        return self.merge(parts)

    def merge(self, states: DataFrame) -> DataFrame:
        """States of the same runs as one; equal orders are told apart by the values."""
        last = {c: F.max(F.when(F.col(f"{c}_at").isNotNull(), F.struct(F.col(f"{c}_at").alias("at"), F.col(c).alias("v")))) for c in "sf"}
        first = F.min(F.when(F.col("h_at").isNotNull(), F.struct(F.col("h_at").alias("at"), F.col("h").alias("v"))))
        merged = states.groupBy(self.key).agg(last["s"].alias("s"), first.alias("h"), last["f"].alias("f"))
        return merged.select(self.key, *[F.col(f"{c}.{part}").alias(name) for c in "shf" for part, name in (("v", c), ("at", f"{c}_at"))])

    def rows(self, state: DataFrame) -> DataFrame:
        """The runs of a state."""
        has_start = F.col("s_at").isNotNull()
        # Unnumbered events of equal time: a finish follows its start.
        later = F.when(F.col("f_at.occurred_at") != F.col("s_at.occurred_at"), F.col("f_at.occurred_at") > F.col("s_at.occurred_at")).otherwise(
            F.coalesce(F.col("f_at.event_seq") > F.col("s_at.event_seq"), F.lit(True))
        )
        ended = F.col("f_at").isNotNull() & (~has_start | later)
        columns = [F.when(has_start, F.col(f"s.{c}")).otherwise(F.col(f"h.{c}")).alias(c) for c in self.header]
        columns += [F.when(has_start, F.col(f"s.{c}")).otherwise(F.lit(self.fill.get(c))).alias(c) for c in self.started if c not in self.finished]
        columns += [
            F.when(ended, F.col(f"f.{c}")).otherwise(F.col(f"s.{c}") if c in self.started else F.lit(self.fill.get(c))).alias(c) for c in self.finished
        ]
        return state.select(self.key, *columns)

    def __call__(self, events: DataFrame) -> DataFrame:
        return self.rows(self.state(events))


def _own(name: str, default: str | None = None) -> Callable[[], Column]:
    return lambda: F.col(name) if default is None else F.coalesce(F.col(name), F.lit(default))


_OUTCOME = {"status": _own("status"), "message": _own("message")}

PIPELINE_FOLD = RunFold(
    "pipeline_id",
    "PIPELINE",
    ("pipeline_name", "pipeline_version", "environment", "host_name", "process_id"),
    {"started_at": _own("occurred_at"), "parameters_json": _own("payload.parameters", _EMPTY_OBJECT), **_OUTCOME},
    {"finished_at": _own("occurred_at"), **_OUTCOME, "metrics_json": _own("payload.metrics", _EMPTY_OBJECT)},
    {"parameters_json": _EMPTY_OBJECT, "metrics_json": _EMPTY_OBJECT},
)
STAGE_FOLD = RunFold(
    "stage_run_id",
    "STAGE",
    ("pipeline_id", "stage_name"),
    {"started_at": _own("occurred_at"), "command_json": _own("payload.command", _EMPTY_LIST), **_OUTCOME},
    {
        "finished_at": _own("occurred_at"), **_OUTCOME, "metrics_json": _own("payload.metrics", _EMPTY_OBJECT),
        **{c: _own(f"payload.{c}") for c in ("duration_seconds", "return_code", "stdout_log", "stderr_log")},
    },
    {"command_json": _EMPTY_LIST, "metrics_json": _EMPTY_OBJECT},
)


def pipeline_runs(events: DataFrame) -> DataFrame:
    """One row per pipeline run."""
    return PIPELINE_FOLD(events)


def stage_runs(events: DataFrame) -> DataFrame:
    """One row per stage run."""
    return STAGE_FOLD(events)


_EVENT_KEYS = ("event_id", "occurred_at", "pipeline_id", "stage_run_id", "stage_name", "status")


def file_runs(events: DataFrame) -> DataFrame:
    """One row per processed file."""
    fields = [F.col(f"payload.{c}") for c in ("file_name", "target_path", "source_hash")]
    metadata = F.coalesce(F.col("payload.metadata"), F.lit(_EMPTY_OBJECT)).alias("metadata_json")
    return events.where(F.col("event_type") == "FILE_PROCESSED").select(*_EVENT_KEYS, *fields, metadata)


def quality_results(events: DataFrame) -> DataFrame:
    """One row per evaluated quality rule."""
    names = (
        "dataset_name", "rule_id", "rule_name", "records_evaluated",
        "records_failed", "failure_rate", "allowed_failure_rate",
    )
    metadata = F.coalesce(F.col("payload.metadata"), F.lit(_EMPTY_OBJECT)).alias("metadata_json")
    rules = events.where(F.col("event_type") == "QUALITY_RULE_EVALUATED")
    return rules.select(*_EVENT_KEYS, *[F.col(f"payload.{c}") for c in names], metadata)


def latest_run(runs: DataFrame, status: str | None = None) -> DataFrame:
    """Latest run by start time, unknown starts last, ties by id; one row at most."""
    chosen = runs if status is None else runs.where(F.col("status") == status)
    return chosen.orderBy(F.desc_nulls_last("started_at"), F.desc("pipeline_id")).limit(1)


def rows_of_run(rows: DataFrame, run: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows of the selected run in view order, NULLs last."""
    # run holds at most one row by construction
    selected = rows.join(F.broadcast(run.select("pipeline_id")), "pipeline_id", "left_semi")
    return selected.orderBy(*[F.asc_nulls_last(c) for c in order])


def latest_stages(stages: DataFrame, run: DataFrame) -> DataFrame:
    return rows_of_run(stages, run, ("started_at", "stage_name"))


def latest_quality(results: DataFrame, run: DataFrame) -> DataFrame:
    return rows_of_run(results, run, ("dataset_name", "rule_id", "occurred_at"))


def latest_files(files: DataFrame, run: DataFrame) -> DataFrame:
    return rows_of_run(files, run, ("stage_name", "occurred_at", "target_path", "file_name"))


def with_quality_fields(results: DataFrame) -> DataFrame:
    """Quality view with the fields kept in its metadata text."""
    fields = json_fields(
        F.col("metadata_json"), "taxi_type string, year bigint, dimension string, score double, threshold double"
    )
    return results.select("*", fields.alias("_m")).select(*results.columns, "_m.*")


def with_file_fields(files: DataFrame) -> DataFrame:
    """File view with the fields kept in its metadata text."""
    fields = json_fields(F.col("metadata_json"), "change_type string, size_bytes bigint, extension string")
    return files.select("*", fields.alias("_m")).select(*files.columns, "_m.*")


def pipeline_measures(runs: DataFrame) -> DataFrame:
    """Status if all runs share one, last finish and seconds from start to finish."""
    single = F.when(F.count_distinct("status") == 1, F.max("status")).otherwise(F.lit("SIN DATOS"))
    begin, end = F.max("started_at"), F.max("finished_at")
    return runs.agg(
        single.alias("status"),
        end.alias("last_finished_at"),
        F.timestamp_diff("SECOND", begin, end).alias("duration_seconds"),
    )


def stage_measures(stages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Stage counts by outcome, success rate, total time and the slowest stage."""
    status = F.col("status")
    total = F.count(F.lit(1))
    # Longest first; unknown durations rank lowest; equal durations by name.
    rank = F.struct(-F.coalesce(F.col("duration_seconds"), F.lit(float("-inf"))), F.col("stage_name"))
    measures = stages.groupBy(*by).agg(
        total.alias("stages"),
        F.count_if(status == "SUCCESS").alias("succeeded"),
        F.count_if(status == "FAILED").alias("failed"),
        F.count_if(status == "SKIPPED").alias("skipped"),
        F.sum("duration_seconds").alias("total_seconds"),
        F.min_by("stage_name", rank).alias("slowest_stage"),
    )
    return measures.select("*", ratio(F.col("succeeded"), F.col("stages"), 0.0).alias("success_rate"))


def quality_measures(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Passed and failed rules, approval rate, weighted failure rate, mean threshold."""
    status = F.col("status")
    measures = results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if(status == "PASSED").alias("passed"),
        F.count_if(status == "FAILED").alias("failed"),
        F.sum("records_failed").alias("_bad"),
        F.sum("records_evaluated").alias("_all"),
        F.avg("allowed_failure_rate").alias("mean_threshold"),
    )
    return measures.select(
        *by,
        "rules",
        "passed",
        "failed",
        ratio(F.col("passed"), F.col("rules"), 0.0).alias("approval_rate"),
        ratio(F.col("_bad"), F.col("_all"), 0.0).alias("weighted_failure_rate"),
        "mean_threshold",
    )


def artifact_measures(files: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Artifacts in total, created and modified, and their size in MB."""
    change = F.col("change_type")
    return files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("artifacts"),
        F.count_if(change == "CREATED").alias("created"),
        F.count_if(change == "MODIFIED").alias("modified"),
        (F.coalesce(F.sum("size_bytes"), F.lit(0)) / F.lit(1048576)).alias("size_mb"),
    )


def share_by(rows: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Count and share of every value of a column, in total or within groups."""
    counts = rows.groupBy(*by, column).agg(F.count(F.lit(1)).alias("rows"))
    if by:
        totals = counts.groupBy(*by).agg(F.sum("rows").alias("_total"))
        counts, total = counts.join(totals, list(by)), F.col("_total")
    else:
        total = rows.agg(F.count(F.lit(1))).scalar()
    return counts.select(*by, column, "rows", (F.col("rows") / total).alias("share"))


def duration_by_stage(stages: DataFrame) -> DataFrame:
    """Seconds per stage name, longest first."""
    return stages.groupBy("stage_name").agg(F.sum("duration_seconds").alias("seconds")).orderBy(
        F.desc("seconds"), "stage_name"
    )


def failures_by(rows: DataFrame, column: str) -> DataFrame:
    """Failed stages or rules per value of a column."""
    return rows.where(F.col("status") == "FAILED").groupBy(column).agg(F.count(F.lit(1)).alias("failures"))


def failed_stages(stages: DataFrame) -> DataFrame:
    """Error page: failed stages with code, message and logs."""
    return stages.where(F.col("status") == "FAILED").select(
        "stage_run_id", "stage_name", "return_code", "message", "duration_seconds", "stdout_log", "stderr_log"
    )


def failure_vs_allowed(results: DataFrame) -> DataFrame:
    """Mean observed and allowed failure rate per rule name."""
    return results.groupBy("rule_name").agg(
        F.avg("failure_rate").alias("failure_rate"), F.avg("allowed_failure_rate").alias("allowed_failure_rate")
    )


def run_metrics(stages: DataFrame, files: DataFrame) -> DataFrame:
    """Stages in total, successful and skipped, and artifacts, per run."""
    status = F.col("status")
    outcome = stages.groupBy("pipeline_id").agg(
        F.count(F.lit(1)).alias("stages_total"),
        F.count_if(status == "SUCCESS").alias("stages_success"),
        F.count_if(status == "SKIPPED").alias("stages_skipped"),
    )
    artifacts = files.groupBy("pipeline_id").agg(F.count(F.lit(1)).alias("artifacts_detected"))
    return outcome.join(artifacts, "pipeline_id", "left").fillna(0, ["artifacts_detected"])
