"""Audit log folds, views and measures over the event table.

Events become audit events: users are pipeline runs, event kinds are audit event
types, values and keys fill status and payload. Restarts, finishes without a start
and unfinished runs all occur.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from orebelt.operators import audit as a
from orebelt.plans.audit_views import history_views, latest_views
from orebelt.session import materialize, scratch_path
from orebelt.sources.sinks import append_events
from orebelt.sources.tables import read_event_log
from orebelt.streaming.runs import current_runs, stream_runs
from suite import trips as t
from suite.registry import query, rounded, with_ctes

_STATUS = {
    "pipe": "CASE k % 4 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'PARTIAL_SUCCESS' ELSE 'SUCCESS' END",
    "stage": "CASE k % 5 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'SKIPPED' ELSE 'SUCCESS' END",
}
_TYPE = (
    "CASE event_type WHEN 'signup' THEN 'PIPELINE_STARTED' WHEN 'error' THEN 'PIPELINE_FINISHED' WHEN 'click' THEN 'STAGE_STARTED' "
    "WHEN 'view' THEN 'STAGE_FINISHED' ELSE CASE WHEN k % 2 = 0 THEN 'FILE_PROCESSED' ELSE 'QUALITY_RULE_EVALUATED' END END"
)
_FINAL_STATUS = (
    f"CASE WHEN kind = 'PIPELINE_FINISHED' THEN {_STATUS['pipe']} WHEN kind = 'STAGE_FINISHED' THEN {_STATUS['stage']} "
    "WHEN kind = 'FILE_PROCESSED' THEN 'SUCCESS' WHEN kind = 'QUALITY_RULE_EVALUATED' THEN CASE WHEN k > 50 THEN 'FAILED' ELSE 'PASSED' END "
    "WHEN k = 99 THEN 'UNKNOWN' ELSE 'RUNNING' END"
)
# JSON texts; every seventh file and rule carries a broken one.
_FILE_META = (
    "CASE WHEN event_id % 7 = 0 THEN '{broken' ELSE concat('{\"change_type\":\"', CASE WHEN event_id % 3 = 0 THEN 'CREATED' ELSE 'MODIFIED' END, "
    "'\",\"size_bytes\":', k * 100000, ',\"extension\":\".parquet\"}') END"
)
_RULE_META = (
    "CASE WHEN event_id % 7 = 0 THEN 'oops' ELSE concat('{\"taxi_type\":\"green\",\"year\":', 2020 + k % 5, "
    "',\"dimension\":\"validez\",\"score\":0.', 10 + k % 90, '}') END"
)
# header and payload columns in SQL that both engines read
_FLAT = {
    "event_id": "concat('e', event_id)",
    "event_type": "kind",
    "event_seq": "event_id",
    "occurred_at": "ts",
    "pipeline_id": "concat('run-', user_id)",
    "pipeline_name": "concat('pipeline-', event_id % 3)",
    "pipeline_version": "'1.0'",
    "environment": "concat('env-', event_id % 2)",
    "host_name": "'host'",
    "process_id": "event_id % 1000",
    "stage_name": "CASE WHEN kind LIKE 'PIPELINE%' THEN NULL ELSE concat('stage-', event_id % 7) END",
    "stage_run_id": "CASE WHEN kind LIKE 'PIPELINE%' THEN NULL ELSE concat('run-', user_id, '-', event_id % 7) END",
    "status": _FINAL_STATUS,
    "message": "concat('m', event_id)",
}
_PAYLOAD = {
    "parameters": "CASE WHEN kind = 'PIPELINE_STARTED' THEN props END",
    "metrics": "CASE WHEN kind LIKE '%FINISHED' AND k % 3 <> 0 THEN props END",
    "command": "CASE WHEN kind = 'STAGE_STARTED' THEN concat('[', k, ']') END",
    "duration_seconds": "CASE WHEN kind = 'STAGE_FINISHED' THEN value END",
    "return_code": "CASE WHEN kind = 'STAGE_FINISHED' THEN k % 5 END",
    "stdout_log": "CASE WHEN kind = 'STAGE_FINISHED' THEN concat('out-', event_id) END",
    "stderr_log": "CASE WHEN kind = 'STAGE_FINISHED' THEN concat('err-', event_id) END",
    "file_name": "CASE WHEN kind = 'FILE_PROCESSED' THEN concat('f', k) END",
    "target_path": "CASE WHEN kind = 'FILE_PROCESSED' THEN concat('p/', k) END",
    "source_hash": "CASE WHEN kind = 'FILE_PROCESSED' THEN md5(props) END",
    "metadata": f"CASE WHEN kind = 'FILE_PROCESSED' THEN {_FILE_META} WHEN kind = 'QUALITY_RULE_EVALUATED' THEN {_RULE_META} END",
    "dataset_name": "CASE WHEN kind = 'QUALITY_RULE_EVALUATED' THEN concat('d', k % 4) END",
    "rule_id": "CASE WHEN kind = 'QUALITY_RULE_EVALUATED' THEN concat('r', k % 10) END",
    "rule_name": "CASE WHEN kind = 'QUALITY_RULE_EVALUATED' THEN concat('rule ', k % 10) END",
    "records_evaluated": "CASE WHEN kind = 'QUALITY_RULE_EVALUATED' THEN 1000 END",
    "records_failed": "CASE WHEN kind = 'QUALITY_RULE_EVALUATED' THEN k END",
    "failure_rate": "CASE WHEN kind = 'QUALITY_RULE_EVALUATED' THEN cast(k AS double) / 1000 END",
    "allowed_failure_rate": "CASE WHEN kind = 'QUALITY_RULE_EVALUATED' THEN cast(0.05 AS double) END",
}


def log(spark, sf_dir):
    """Audit events in the library's event schema."""
    return to_log(t.table(spark, sf_dir, "events"))


def to_log(events):
    keyed = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    typed = keyed.withColumn("kind", F.expr(_TYPE))
    payload = F.struct(*[F.expr(sql).alias(name) for name, sql in _PAYLOAD.items()])
    return typed.select(*[F.expr(sql).alias(name) for name, sql in _FLAT.items()], payload.alias("payload"))


LOG = (
    "src AS (SELECT *, regexp_extract(props, '[0-9]+')::INT AS k FROM events)",
    f"typed AS (SELECT *, {_TYPE} AS kind FROM src)",
    "log AS MATERIALIZED (SELECT "
    + ", ".join(f"{sql} AS {name}" for name, sql in {**_FLAT, **_PAYLOAD}.items())
    + " FROM typed)",
)


def _fold(name: str, key: str, prefix: str, header: tuple, start: dict, finish: dict, empty: dict, no_start: dict) -> str:
    """Newest start, newest finish after it, first finish for headers without a start."""
    columns = [f"CASE WHEN s.{key} IS NOT NULL THEN s.{c} ELSE h.{c} END AS {c}" for c in header]
    columns += [f"CASE WHEN s.{key} IS NOT NULL THEN {sql} ELSE {no_start[c]} END AS {c}" for c, sql in start.items()]
    columns += [f"CASE WHEN s.{key} IS NULL OR f.event_seq > s.event_seq THEN {sql} ELSE {empty[c]} END AS {c}" for c, sql in finish.items()]
    return f"""{name} AS MATERIALIZED (SELECT ids.{key}, {", ".join(columns)}
FROM (SELECT DISTINCT {key} FROM log WHERE event_type IN ('{prefix}_STARTED', '{prefix}_FINISHED')) ids
LEFT JOIN (SELECT * FROM log WHERE event_type = '{prefix}_STARTED' QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY occurred_at DESC, event_seq DESC) = 1) s USING ({key})
LEFT JOIN (SELECT * FROM log WHERE event_type = '{prefix}_FINISHED' QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY occurred_at DESC, event_seq DESC) = 1) f USING ({key})
LEFT JOIN (SELECT * FROM log WHERE event_type = '{prefix}_FINISHED' QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY occurred_at, event_seq) = 1) h USING ({key}))"""


RUNS = _fold(
    "runs", "pipeline_id", "PIPELINE",
    ("pipeline_name", "pipeline_version", "environment", "host_name", "process_id"),
    {"started_at": "s.occurred_at", "parameters_json": "coalesce(s.parameters, '{}')"},
    {"finished_at": "f.occurred_at", "status": "f.status", "message": "f.message", "metrics_json": "coalesce(f.metrics, '{}')"},
    {"finished_at": "NULL", "status": "s.status", "message": "s.message", "metrics_json": "'{}'"},
    {"started_at": "NULL", "parameters_json": "'{}'"},
)
STAGES = _fold(
    "stages", "stage_run_id", "STAGE",
    ("pipeline_id", "stage_name"),
    {"started_at": "s.occurred_at", "command_json": "coalesce(s.command, '[]')"},
    {
        "finished_at": "f.occurred_at", "status": "f.status", "message": "f.message", "metrics_json": "coalesce(f.metrics, '{}')",
        **{c: f"f.{c}" for c in ("duration_seconds", "return_code", "stdout_log", "stderr_log")},
    },
    {
        "finished_at": "NULL", "status": "s.status", "message": "s.message", "metrics_json": "'{}'",
        **{c: "NULL" for c in ("duration_seconds", "return_code", "stdout_log", "stderr_log")},
    },
    {"started_at": "NULL", "command_json": "'[]'"},
)
_KEYS = "event_id, occurred_at, pipeline_id, stage_run_id, stage_name, status"
FILES = (
    f"files AS (SELECT {_KEYS}, file_name, target_path, source_hash, coalesce(metadata, '{{}}') AS metadata_json FROM log WHERE event_type = 'FILE_PROCESSED')",
    """filesx AS (SELECT *, nullif(regexp_extract(metadata_json, 'change_type":"([A-Z]+)', 1), '') AS change_type,
  nullif(regexp_extract(metadata_json, 'size_bytes":([0-9]+)', 1), '')::BIGINT AS size_bytes,
  nullif(regexp_extract(metadata_json, 'extension":"([.a-z]+)', 1), '') AS extension FROM files)""",
)
RULES = (
    f"""rules AS (SELECT {_KEYS}, dataset_name, rule_id, rule_name, records_evaluated, records_failed, failure_rate, allowed_failure_rate,
  coalesce(metadata, '{{}}') AS metadata_json FROM log WHERE event_type = 'QUALITY_RULE_EVALUATED')""",
    """rulesx AS (SELECT *, nullif(regexp_extract(metadata_json, 'taxi_type":"([a-z]+)', 1), '') AS taxi_type,
  nullif(regexp_extract(metadata_json, 'year":([0-9]+)', 1), '')::BIGINT AS year,
  nullif(regexp_extract(metadata_json, 'dimension":"([a-z]+)', 1), '') AS dimension,
  nullif(regexp_extract(metadata_json, 'score":([0-9.]+)', 1), '')::DOUBLE AS score, NULL::DOUBLE AS threshold FROM rules)""",
)
_LATEST = "latest AS (SELECT * FROM runs ORDER BY started_at DESC NULLS LAST, pipeline_id DESC LIMIT 1)"
_SUCCESS = "success AS (SELECT * FROM runs WHERE status = 'SUCCESS' ORDER BY started_at DESC NULLS LAST, pipeline_id DESC LIMIT 1)"


@query("aud_pipeline_runs", with_ctes(*LOG, RUNS, select="SELECT * FROM runs"))
def pipeline_runs(spark, sf_dir):
    return a.pipeline_runs(log(spark, sf_dir))


@query("aud_stage_runs", with_ctes(*LOG, STAGES, select="SELECT * FROM stages"))
def stage_runs(spark, sf_dir):
    return a.stage_runs(log(spark, sf_dir))


def _streamed(spark, sf_dir, fold):
    """Events arrive in four files, the newest first, and the first file once more at the end."""
    arrived = scratch_path(spark, "arriving-events")
    events = t.table(spark, sf_dir, "events")
    events.repartitionByRange(4, F.col("ts").desc(), "event_id").write.parquet(arrived)
    events.where("event_id % 5 = 0").coalesce(1).write.mode("append").parquet(arrived)
    root = scratch_path(spark, "run-states")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(arrived)
    stream_runs(stream, [fold], root, scratch_path(spark, "run-checkpoint"), to_log, fanout=2).awaitTermination()
    return current_runs(spark, fold, root)


@query("str_pipeline_runs", with_ctes(*LOG, RUNS, select="SELECT * FROM runs"))
def streamed_pipeline_runs(spark, sf_dir):
    return _streamed(spark, sf_dir, a.PIPELINE_FOLD)


@query("str_stage_runs", with_ctes(*LOG, STAGES, select="SELECT * FROM stages"))
def streamed_stage_runs(spark, sf_dir):
    return _streamed(spark, sf_dir, a.STAGE_FOLD)


@query("aud_file_runs", with_ctes(*LOG, *FILES, select="SELECT * FROM files"))
def file_runs(spark, sf_dir):
    return a.file_runs(log(spark, sf_dir))


@query("aud_quality_results", with_ctes(*LOG, *RULES, select="SELECT * FROM rules"))
def quality_results(spark, sf_dir):
    return a.quality_results(log(spark, sf_dir))


@query(
    "aud_invalid_events",
    with_ctes(*LOG, select="SELECT event_id, event_type, status, 'status outside domain' AS problem FROM log WHERE status = 'UNKNOWN'"),
)
def invalid_events(spark, sf_dir):
    return a.invalid_events(log(spark, sf_dir))


@query("aud_json_fields", with_ctes(*LOG, *RULES, select="SELECT * FROM rulesx"))
def json_fields(spark, sf_dir):
    """Quality view with fields from its metadata; broken texts give NULLs."""
    return a.with_quality_fields(a.quality_results(log(spark, sf_dir)))


@query("aud_file_fields", with_ctes(*LOG, *FILES, select="SELECT * FROM filesx"))
def file_fields(spark, sf_dir):
    return a.with_file_fields(a.file_runs(log(spark, sf_dir)))


@query("aud_latest_state", with_ctes(*LOG, RUNS, _LATEST, _SUCCESS, select="SELECT 'latest' AS view, * FROM latest UNION ALL SELECT 'success', * FROM success"))
def latest_state(spark, sf_dir):
    """Latest run and latest successful run."""
    runs = materialize(a.pipeline_runs(log(spark, sf_dir)), "runs")
    latest = a.latest_run(runs).select(F.lit("latest").alias("view"), "*")
    return latest.unionByName(a.latest_run(runs, "SUCCESS").select(F.lit("success").alias("view"), "*"))


@query(
    "aud_latest_views",
    with_ctes(
        *LOG, RUNS, STAGES, *FILES, *RULES, _LATEST, _SUCCESS,
        select="""SELECT 'latest_stage_runs' AS view, stage_run_id AS item FROM stages WHERE pipeline_id IN (SELECT pipeline_id FROM latest)
UNION ALL SELECT 'latest_successful_stage_runs', stage_run_id FROM stages WHERE pipeline_id IN (SELECT pipeline_id FROM success)
UNION ALL SELECT 'latest_quality_results', event_id FROM rules WHERE pipeline_id IN (SELECT pipeline_id FROM success)
UNION ALL SELECT 'latest_file_runs', event_id FROM files WHERE pipeline_id IN (SELECT pipeline_id FROM success)""",
    ),
)
def latest_view_rows(spark, sf_dir):
    """Rows of the four latest views."""
    history = {name: materialize(view, name) for name, view in history_views(log(spark, sf_dir)).items()}
    views = latest_views(history)
    items = {
        "latest_stage_runs": "stage_run_id",
        "latest_successful_stage_runs": "stage_run_id",
        "latest_quality_results": "event_id",
        "latest_file_runs": "event_id",
    }
    parts = [views[name].select(F.lit(name).alias("view"), F.col(column).alias("item")) for name, column in items.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "aud_pipeline_measures",
    with_ctes(
        *LOG, RUNS,
        select="""SELECT CASE WHEN count(DISTINCT status) = 1 THEN max(status) ELSE 'SIN DATOS' END AS status, max(finished_at) AS last_finished_at,
  trunc(epoch(max(finished_at) - max(started_at)))::BIGINT AS duration_seconds FROM runs""",
    ),
)
def pipeline_measures(spark, sf_dir):
    return a.pipeline_measures(a.pipeline_runs(log(spark, sf_dir)))


_STAGE_MEASURES = """count(*) AS stages, count(*) FILTER (status = 'SUCCESS') AS succeeded, count(*) FILTER (status = 'FAILED') AS failed,
  count(*) FILTER (status = 'SKIPPED') AS skipped, round(sum(duration_seconds), 4) AS total_seconds,
  list(stage_name ORDER BY duration_seconds DESC NULLS LAST, stage_name)[1] AS slowest_stage, round(count(*) FILTER (status = 'SUCCESS') / count(*), 6) AS success_rate"""


@query("aud_stage_measures", with_ctes(*LOG, STAGES, select=f"SELECT pipeline_id, {_STAGE_MEASURES} FROM stages GROUP BY 1"))
def stage_measures(spark, sf_dir):
    """Stage measures per run."""
    return rounded(a.stage_measures(a.stage_runs(log(spark, sf_dir)), ["pipeline_id"]), 6, total_seconds=4)


@query("aud_stage_totals", with_ctes(*LOG, STAGES, select=f"SELECT {_STAGE_MEASURES} FROM stages"))
def stage_totals(spark, sf_dir):
    return rounded(a.stage_measures(a.stage_runs(log(spark, sf_dir))), 6, total_seconds=4)


@query(
    "aud_quality_measures",
    with_ctes(
        *LOG, *RULES,
        select="""SELECT dataset_name, count(*) AS rules, count(*) FILTER (status = 'PASSED') AS passed, count(*) FILTER (status = 'FAILED') AS failed,
  round(count(*) FILTER (status = 'PASSED') / count(*), 6) AS approval_rate, round(sum(records_failed) / sum(records_evaluated), 6) AS weighted_failure_rate,
  round(avg(allowed_failure_rate), 6) AS mean_threshold FROM rules GROUP BY 1""",
    ),
)
def quality_measures(spark, sf_dir):
    return rounded(a.quality_measures(a.quality_results(log(spark, sf_dir)), ["dataset_name"]))


@query(
    "aud_artifact_measures",
    with_ctes(
        *LOG, *FILES,
        select="""SELECT stage_name, count(*) AS artifacts, count(*) FILTER (change_type = 'CREATED') AS created,
  count(*) FILTER (change_type = 'MODIFIED') AS modified, round(coalesce(sum(size_bytes), 0) / 1048576, 6) AS size_mb FROM filesx GROUP BY 1""",
    ),
)
def artifact_measures(spark, sf_dir):
    return rounded(a.artifact_measures(a.with_file_fields(a.file_runs(log(spark, sf_dir))), ["stage_name"]))


@query("aud_duration_by_stage", with_ctes(*LOG, STAGES, select="SELECT stage_name, round(sum(duration_seconds), 4) AS seconds FROM stages GROUP BY 1"))
def duration_by_stage(spark, sf_dir):
    return rounded(a.duration_by_stage(a.stage_runs(log(spark, sf_dir))), 4)


@query("aud_status_share", with_ctes(*LOG, STAGES, select="SELECT status, count(*) AS rows, round(count(*) / (SELECT count(*) FROM stages), 6) AS share FROM stages GROUP BY 1"))
def status_share(spark, sf_dir):
    return rounded(a.share_by(a.stage_runs(log(spark, sf_dir)), "status"))


@query(
    "aud_change_share",
    with_ctes(
        *LOG, *FILES,
        select="""SELECT stage_name, change_type, count(*) AS rows, round(count(*) / sum(count(*)) OVER (PARTITION BY stage_name), 6) AS share
FROM filesx GROUP BY 1, 2""",
    ),
)
def change_share(spark, sf_dir):
    files = a.with_file_fields(a.file_runs(log(spark, sf_dir)))
    return rounded(a.share_by(files, "change_type", ["stage_name"]))


@query("aud_failures_by_stage", with_ctes(*LOG, STAGES, select="SELECT stage_name, count(*) AS failures FROM stages WHERE status = 'FAILED' GROUP BY 1"))
def failures_by_stage(spark, sf_dir):
    return a.failures_by(a.stage_runs(log(spark, sf_dir)), "stage_name")


@query("aud_failures_by_dataset", with_ctes(*LOG, *RULES, select="SELECT dataset_name, count(*) AS failures FROM rules WHERE status = 'FAILED' GROUP BY 1"))
def failures_by_dataset(spark, sf_dir):
    return a.failures_by(a.quality_results(log(spark, sf_dir)), "dataset_name")


@query(
    "aud_failed_stages",
    with_ctes(*LOG, STAGES, select="SELECT stage_run_id, stage_name, return_code, message, duration_seconds, stdout_log, stderr_log FROM stages WHERE status = 'FAILED'"),
)
def failed_stages(spark, sf_dir):
    return a.failed_stages(a.stage_runs(log(spark, sf_dir)))


@query(
    "aud_failure_vs_allowed",
    with_ctes(*LOG, *RULES, select="SELECT rule_name, round(avg(failure_rate), 6) AS failure_rate, round(avg(allowed_failure_rate), 6) AS allowed_failure_rate FROM rules GROUP BY 1"),
)
def failure_vs_allowed(spark, sf_dir):
    return rounded(a.failure_vs_allowed(a.quality_results(log(spark, sf_dir))))


@query(
    "aud_run_metrics",
    with_ctes(
        *LOG, STAGES, *FILES,
        select="""SELECT s.pipeline_id, count(*) AS stages_total, count(*) FILTER (status = 'SUCCESS') AS stages_success,
  count(*) FILTER (status = 'SKIPPED') AS stages_skipped, coalesce(max(n), 0) AS artifacts_detected FROM stages s
LEFT JOIN (SELECT pipeline_id, count(*) AS n FROM files GROUP BY 1) f ON f.pipeline_id = s.pipeline_id GROUP BY 1""",
    ),
)
def run_metrics(spark, sf_dir):
    events = log(spark, sf_dir)
    return a.run_metrics(a.stage_runs(events), a.file_runs(events))


@query(
    "aud_unnumbered_runs",
    "SELECT concat('run-', event_id) AS pipeline_id, CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN 'RUNNING' ELSE 'SUCCESS' END AS status, "
    "NOT (event_id % 5 = 0 OR event_id % 7 = 0) AS finished, concat('m', CASE WHEN event_id % 5 = 0 THEN 1 WHEN event_id % 7 = 0 THEN 3 ELSE 2 END) AS message FROM events",
)
def unnumbered_runs(spark, sf_dir):
    """Runs of a log that does not number its events, all events of a run at the same time.

    Each fifth run never finishes, each seventh of the others starts again after its finish;
    only their place in the log tells.
    """
    path = scratch_path(spark, "unnumbered-log")
    runs = t.table(spark, sf_dir, "events").select("event_id", "ts")
    last = F.when(F.col("event_id") % 5 == 0, 1).when(F.col("event_id") % 7 == 0, 3).otherwise(2)
    lines = runs.select("event_id", "ts", F.explode(F.sequence(F.lit(1), last)).alias("n"))
    finish = F.col("n") == 2
    append_events(
        lines.select(
            F.format_string("e%d-%d", "event_id", "n").alias("event_id"),
            F.when(finish, "PIPELINE_FINISHED").otherwise("PIPELINE_STARTED").alias("event_type"),
            F.date_trunc("second", "ts").alias("occurred_at"),
            F.concat(F.lit("run-"), "event_id").alias("pipeline_id"),
            F.when(finish, "SUCCESS").otherwise("RUNNING").alias("status"),
            F.concat(F.lit("m"), "n").alias("message"),
        ),
        path,
    )
    folded = a.pipeline_runs(read_event_log(spark, path))
    return folded.select("pipeline_id", "status", F.col("finished_at").isNotNull().alias("finished"), "message")
