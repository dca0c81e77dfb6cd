import json
import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebelt.operators import audit as a
from orebelt.plans.audit_views import export_views
from orebelt.sources.tables import read_event_log
from orebelt.streaming.runs import current_runs, run_table, stream_runs


def event(seq, kind, pipeline="p", stage=None, status="RUNNING", message=None, **payload):
    return {
        "event_id": f"e{seq}", "event_seq": seq, "event_type": kind, "occurred_at": f"2024-01-01T00:00:{seq:02d}Z", "pipeline_id": pipeline,
        "pipeline_name": f"n{seq}", "stage_run_id": stage, "stage_name": stage, "status": status, "message": message, "payload": payload,
    }


def events(spark, tmp_path, *items):
    path = tmp_path / "log.jsonl"
    path.write_text("\n".join(json.dumps(i) for i in items))
    return read_event_log(spark, str(path))


def test_restart_resets_and_finish_updates(spark, tmp_path):
    log = events(
        spark, tmp_path,
        event(1, "PIPELINE_STARTED", parameters={"a": 1}),
        event(2, "PIPELINE_FINISHED", status="FAILED", metrics={"m": 1}),
        event(3, "PIPELINE_STARTED", message="again"),
        event(4, "PIPELINE_FINISHED", pipeline="q", status="SUCCESS"),
        event(5, "PIPELINE_FINISHED", pipeline="q", status="FAILED", message="late"),
        event(6, "PIPELINE_STARTED", pipeline="r"),
        event(7, "PIPELINE_FINISHED", pipeline="r", status="SUCCESS", metrics={"k": [1]}),
    )
    got = {r.pipeline_id: r for r in a.pipeline_runs(log).collect()}
    p, q, r = got["p"], got["q"], got["r"]
    assert (p.status, p.finished_at, p.message, p.metrics_json, p.parameters_json, p.pipeline_name) == ("RUNNING", None, "again", "{}", "{}", "n3")
    assert (q.status, q.started_at, q.message, q.pipeline_name, q.parameters_json) == ("FAILED", None, "late", "n4", "{}")
    assert (r.status, r.metrics_json) == ("SUCCESS", '{"k": [1]}') and r.started_at < r.finished_at
    assert a.latest_run(a.pipeline_runs(log)).first().pipeline_id == "r"
    assert a.latest_run(a.pipeline_runs(log), "PARTIAL_SUCCESS").isEmpty()


def test_stage_fold_and_measures(spark, tmp_path):
    log = events(
        spark, tmp_path,
        event(1, "STAGE_STARTED", stage="s1", command=["x"]),
        event(2, "STAGE_FINISHED", stage="s1", status="SUCCESS", duration_seconds=5.0, return_code=0),
        event(3, "STAGE_FINISHED", stage="s2", status="SKIPPED", duration_seconds=5.0),
        event(4, "STAGE_STARTED", stage="s0"),
    )
    stages = a.stage_runs(log)
    got = {r.stage_run_id: r for r in stages.collect()}
    assert (got["s1"].command_json, got["s1"].return_code, got["s2"].command_json, got["s0"].duration_seconds) == ('["x"]', 0, "[]", None)
    m = a.stage_measures(stages).first()
    assert (m.stages, m.succeeded, m.skipped, m.slowest_stage, m.total_seconds) == (3, 1, 1, "s1", 10.0)
    assert m.success_rate == 1 / 3


def test_equal_starts_resolve_by_id_and_unknown_starts_lose(spark):
    runs = spark.sql("SELECT * FROM VALUES ('a', timestamp'2024-01-01'), ('b', timestamp'2024-01-01'), ('z', NULL) AS t(pipeline_id, started_at)")
    assert a.latest_run(runs).first().pipeline_id == "b"


def test_invalid_events(spark, tmp_path):
    log = events(spark, tmp_path, event(1, "PIPELINE_STARTED", status="SKIPPED"), event(2, "STAGE_FINISHED", status="SKIPPED"), event(3, "OTHER"))
    assert {r.event_id: r.problem for r in a.invalid_events(log).collect()} == {"e1": "status outside domain", "e3": "unknown event type"}


def test_measures_on_empty_views(spark):
    empty = spark.createDataFrame([], "status string, started_at timestamp, finished_at timestamp")
    got = a.pipeline_measures(empty).first()
    assert (got.status, got.last_finished_at, got.duration_seconds) == ("SIN DATOS", None, None)


def test_export_writes_all_views(spark, tmp_path):
    events(
        spark, tmp_path,
        event(1, "PIPELINE_STARTED"),
        event(2, "STAGE_STARTED", stage="s1"),
        event(3, "STAGE_FINISHED", stage="s1", status="SUCCESS", duration_seconds=1.0),
        event(4, "FILE_PROCESSED", stage="s1", status="SUCCESS", file_name="f", metadata={"change_type": "CREATED", "size_bytes": 2097152}),
        event(5, "QUALITY_RULE_EVALUATED", stage="s1", status="PASSED", rule_id="r", records_evaluated=10, records_failed=1, metadata={"year": 2024}),
        event(6, "PIPELINE_FINISHED", status="SUCCESS"),
    )
    views = export_views(spark, f"{tmp_path}/log.jsonl", f"{tmp_path}/views")
    assert len(views) == 10
    assert views["latest_file_runs"].select("change_type", "size_bytes", "extension").first()[:] == ("CREATED", 2097152, None)
    assert views["latest_quality_results"].first().year == 2024
    assert a.artifact_measures(views["latest_file_runs"]).first().size_mb == 2.0
    assert a.run_metrics(views["stage_runs"], views["file_runs"]).first()[1:] == (1, 1, 0, 1)
    assert views["latest_successful_stage_runs"].agg(F.count(F.lit(1))).first()[0] == 1


def test_log_without_numbers(spark, tmp_path):
    def at(kind, pipeline, **more):
        item = event(1, kind, pipeline=pipeline, **more)
        del item["event_seq"]
        return item

    log = events(
        spark, tmp_path,
        at("PIPELINE_STARTED", "p"), at("PIPELINE_FINISHED", "p", status="SUCCESS", message="done"),
        at("PIPELINE_STARTED", "q"), at("PIPELINE_FINISHED", "q", status="FAILED"), at("PIPELINE_STARTED", "q", message="again"),
        at("STAGE_STARTED", "p", stage="s"), at("STAGE_FINISHED", "p", stage="s", status="SUCCESS"),
    )
    runs = {r.pipeline_id: r for r in a.pipeline_runs(log).collect()}
    assert (runs["p"].status, runs["p"].message, runs["p"].finished_at is None) == ("SUCCESS", "done", False)
    assert (runs["q"].status, runs["q"].message, runs["q"].finished_at) == ("RUNNING", "again", None)
    assert a.stage_runs(log).first().status == "SUCCESS"
    unplaced = log.withColumn("event_seq", F.lit(None).cast("long")).where("pipeline_id = 'p'")
    assert a.pipeline_runs(unplaced).first().status == "SUCCESS" and a.stage_runs(unplaced).first().status == "SUCCESS"


def _random_events(spark, tmp_path, seed):
    rng = random.Random(seed)
    kinds = ["PIPELINE_STARTED", "PIPELINE_FINISHED", "STAGE_STARTED", "STAGE_FINISHED"]
    items = []
    for n in range(60):
        kind = rng.choice(kinds)
        stage = f"s{rng.randint(1, 5)}" if kind.startswith("STAGE") else None
        items.append(event(n, kind, f"p{rng.randint(1, 5)}", stage, rng.choice(["SUCCESS", "FAILED", "RUNNING"]), f"m{n}"))
    return events(spark, tmp_path, *items)


@pytest.mark.parametrize("seed", [1, 2])
def test_run_state_of_any_split_equals_the_whole_log(spark, tmp_path, seed):
    log = _random_events(spark, tmp_path, seed)
    for fold in (a.PIPELINE_FOLD, a.STAGE_FOLD):
        whole = sorted(map(str, fold(log).collect()))
        for parts in (2, 5):
            pieces = [fold.state(log.where(F.pmod(F.hash("event_id", F.lit(seed)), F.lit(parts)) == n)) for n in range(parts)]
            pieces += [pieces[0], fold.state(log.where("event_seq % 3 = 0"))]  # repeated and late events
            merged = reduce(DataFrame.unionByName, reversed(pieces))
            assert sorted(map(str, fold.rows(fold.merge(merged)).collect())) == whole


def test_streamed_runs_equal_the_whole_log_at_every_step(spark, tmp_path):
    log, source, root = _random_events(spark, tmp_path, 3), tmp_path / "in", f"{tmp_path}/state"
    assert current_runs(spark, a.PIPELINE_FOLD, root) is None
    for step, part in enumerate(("event_seq >= 30", "event_seq < 10", "event_seq between 5 and 40")):
        log.where(part).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(log.schema).parquet(str(source))
        # the last step also replays everything under a new checkpoint
        stream_runs(stream, [a.PIPELINE_FOLD, a.STAGE_FOLD], root, f"{tmp_path}/check{step // 2}", fanout=2).awaitTermination()
        so_far = spark.read.parquet(str(source))
        for fold in (a.PIPELINE_FOLD, a.STAGE_FOLD):
            assert sorted(map(str, current_runs(spark, fold, root).collect())) == sorted(map(str, fold(so_far).collect()))
    table = run_table(root, a.PIPELINE_FOLD)
    before = sorted(map(str, table.read(spark).collect()))
    table.compact(spark, fanout=2)
    assert sorted(table.deltas(spark).values()) == [0, 1]  # three batches
    assert table.vacuum(spark, grace_seconds=-60)
    assert sorted(map(str, table.read(spark).collect())) == before
