import datetime as dt
import hashlib
import shutil

import pytest
from pyspark.sql import functions as F

from orebelt.operators import catalog as c
from orebelt.operators import schema as s
from orebelt.plans import bronze
from orebelt.plans.bronze import load_bronze_files
from orebelt.sources import commits, files, sinks, tables, versions
from suite import QUERIES


def test_probe_and_validate(spark, tmp_path):
    spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string").coalesce(1).write.parquet(f"{tmp_path}/ok")
    (tmp_path / "empty.parquet").write_bytes(b"")
    (tmp_path / "text.parquet").write_bytes(b"no parquet at all")
    (tmp_path / "torn.parquet").write_bytes(b"PAR1garbagePAR1")
    (tmp_path / "data.csv").write_bytes(b"PAR1abcdPAR1")
    names = ["empty.parquet", "text.parquet", "torn.parquet", "data.csv", "absent.parquet"]
    catalog = spark.createDataFrame([(f"file:{tmp_path}/{n}",) for n in names], "path string")
    listed = files.file_inventory(spark, f"{tmp_path}/ok", "*.parquet").select("path")
    probed = files.probe_files(listed.unionByName(catalog), 4)
    got = {r.path.rsplit("/", 1)[1]: r for r in files.validate_files(probed).collect()}
    good = next(r for name, r in got.items() if name.startswith("part-"))
    assert (good.validation_status, good.records, good.validation_error) == ("valid", 2, None)
    stored = next((tmp_path / "ok").glob("*.parquet"))
    assert good.sha256 == hashlib.sha256(stored.read_bytes()).hexdigest()
    assert got["absent.parquet"].validation_error == "missing file"
    assert got["empty.parquet"].validation_error == "empty file"
    assert got["text.parquet"].validation_error == "bad signature"
    assert got["torn.parquet"].validation_error.startswith("not readable")
    assert got["data.csv"].validation_error == "wrong extension"
    columns = {(r.column, r.dtype) for r in files.schemas_by_file(probed).collect()}
    assert columns == {("a", "int"), ("b", "string")}


def test_inventory_reads_no_content(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"123")
    inventory = files.file_inventory(spark, str(tmp_path))
    assert "content" not in inventory._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    assert inventory.first().size_bytes == 3


@pytest.mark.parametrize("name", ["src_file_inventory", "src_row_counts"])
def test_tables_stored_as_folders_of_files(spark, tmp_path, name):
    tables_of = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
    for i, table in enumerate(tables_of):
        rows = spark.range(10 + i).withColumnRenamed("id", f"{table}_id")
        rows.repartition(3).write.parquet(f"{tmp_path}/{table}.parquet") if i % 2 else rows.toPandas().to_parquet(tmp_path / f"{table}.parquet")
    got = sorted((r.file, r.records) for r in QUERIES[name](spark, str(tmp_path)).collect())
    wanted = tables_of if name == "src_file_inventory" else ["customer", "orders"]
    assert got == sorted((f"{t}.parquet", 10 + tables_of.index(t)) for t in wanted)


def test_table_with_a_bad_file_is_invalid(spark, tmp_path):
    spark.range(4).write.parquet(f"{tmp_path}/orders.parquet")
    (tmp_path / "orders.parquet" / "part-x.parquet").write_bytes(b"no parquet at all")
    probed = files.probe_files(files.file_inventory(spark, str(tmp_path), "*.parquet"))
    assert [tuple(r) for r in files.validate_tables(probed, ["orders"]).collect()] == [("orders.parquet", 4, "invalid")]


def test_months_with_different_schemas(spark, tmp_path):
    base = f"{tmp_path}/bronze"
    spark.sql("SELECT 1 AS a, timestamp_ntz'2024-01-01 00:00:00' AS t").write.parquet(f"{base}/tipo_dataset=green/anio=2024/mes=01")
    spark.sql("SELECT 2L AS a").write.parquet(f"{base}/tipo_dataset=green/anio=2024/mes=02")
    spark.sql("SELECT 0.5D AS b, 3 AS a").write.mode("append").parquet(f"{base}/tipo_dataset=green/anio=2024/mes=02")
    snap = s.snapshot_of_files(files.schemas_by_file(files.probe_files(files.file_inventory(spark, base, "*.parquet"))))
    got = {(r.month, r.column, r.dtype) for r in snap.collect()}
    assert got == {(1, "a", "int"), (1, "t", "timestamp"), (2, "a", "bigint"), (2, "b", "double")}
    assert tables.read_period(spark, base, "green", 2024, 1).count() == 1
    assert {n: d for n, d in tables.read_period(spark, base, "green", 2024, 1).dtypes}["t"] == "timestamp_ntz"


def test_partition_filters_prune(spark, tmp_path):
    base = f"{tmp_path}/bronze"
    raw = spark.range(6).selectExpr("IF(id < 3, 'fhv', 'green') AS tipo_dataset", "2023 + CAST(id % 2 AS INT) AS anio", "1 AS mes", "id")
    sinks.load_bronze(raw, base)
    found = tables.read_trips(spark, base, ["fhv"], [2023], [1])
    assert "PartitionFilters: [isnotnull" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in found.collect()) == [0, 2]


def test_source_identity_from_names(spark, tmp_path):
    spark.range(1).coalesce(1).write.parquet(f"{tmp_path}/fhvhv_2024.parquet")
    spark.range(1).coalesce(1).write.parquet(f"{tmp_path}/other_2024.parquet")
    known = tables.with_source_identity(spark.read.parquet(f"{tmp_path}/fhvhv_2024.parquet")).first()
    assert (known.source_type, known.source_year) == ("fhvhv", 2024)
    unknown = tables.with_source_identity(spark.read.parquet(f"{tmp_path}/other_2024.parquet")).first()
    assert (unknown.source_type, unknown.source_year) == ("desconocido", None)


def test_zone_lookup_cache_and_validation(spark, tmp_path):
    (tmp_path / "z.csv").write_text("LocationID,Borough,Zone,service_zone\n1,B,Z,S\n2,B,Y,S\n")
    lookup = tables.cache_zone_lookup(spark, f"{tmp_path}/z.csv", f"{tmp_path}/z.parquet")
    assert lookup.columns == ["locationid", "borough", "zone", "service_zone"] and lookup.count() == 2
    (tmp_path / "z.csv").unlink()
    assert tables.cache_zone_lookup(spark, f"{tmp_path}/z.csv", f"{tmp_path}/z.parquet").count() == 2
    full = spark.createDataFrame([(1, "a", "b", "c"), (1, "a", "b", "c")], "LocationID int, Borough string, Zone string, service_zone string")
    assert tables.lookup_issues(full).first().validation_error == "duplicate LocationID"
    assert tables.lookup_issues(full.limit(0)).first().validation_error == "no records"
    assert tables.lookup_issues(full.drop("Zone")).first().validation_error == "missing columns: Zone"


def test_broken_log_line_fails(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"event_id": "1", "pipeline_id": "p"}\n{broken\n')
    with pytest.raises(Exception):
        tables.read_event_log(spark, f"{tmp_path}/log.jsonl").collect()


def test_log_keeps_open_objects_as_text(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"event_id": "1", "event_type": "FILE_PROCESSED", "payload": {"metadata": {"size_bytes": 5, "x": [1]}}}\n')
    assert tables.read_event_log(spark, f"{tmp_path}/log.jsonl").first().payload.metadata == '{"size_bytes": 5, "x": [1]}'


def test_published_version_is_swapped_whole(spark, tmp_path):
    base = f"{tmp_path}/t"
    versions.publish_version(spark.range(3), base)
    versions.publish_version(spark.range(5), base)
    assert versions.read_current(spark, base).count() == 5


def test_overtaken_publication_fails_and_changes_nothing(spark, tmp_path):
    base = f"{tmp_path}/t"
    versions.publish_version(spark.range(3), base)
    seen = versions.last_commit(spark, base)
    versions.publish_version(spark.range(5), base, after=seen)
    with pytest.raises(commits.CommitConflict):
        versions.publish_version(spark.range(9), base, after=seen)
    assert versions.read_current(spark, base).count() == 5 and versions.last_commit(spark, base) == 2


LOG = "k string, v int, at timestamp"


def test_commits_are_ordered_by_number_not_by_clock(spark, tmp_path):
    log = commits.CommitLog(f"{tmp_path}/log", LOG, "k")
    assert log.last(spark) == 0 and log.state(spark).count() == 0
    clocks = [dt.datetime(2030, 1, 1), dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1), dt.datetime(2010, 1, 1)]
    for n, at in enumerate(clocks, 1):
        assert log.append(spark.createDataFrame([("a", n, at), (f"k{n}", n, at)], LOG)) == n
    state = {r.k: (r.v, r.seq) for r in log.state(spark).collect()}
    assert state == {"a": (4, 4), "k1": (1, 1), "k2": (2, 2), "k3": (3, 3), "k4": (4, 4)}


def test_of_two_writers_of_one_number_one_fails(spark, tmp_path):
    log = commits.CommitLog(f"{tmp_path}/log", LOG, "k")
    row = spark.createDataFrame([("a", 1, None)], LOG)
    log.append(row, after=0)
    for stale in (0, 5):  # behind, and ahead of what exists
        with pytest.raises(commits.CommitConflict):
            log.append(row, after=stale)
    assert log.last(spark) == 1 and log.read(spark).count() == 1
    # the rename itself refuses an existing commit, without any look before it
    row.write.parquet(f"{tmp_path}/log/_pending-x")
    assert not sinks.move_exclusively(spark, f"{tmp_path}/log/_pending-x", f"{tmp_path}/log/seq={1:020d}")


def test_checkpoint_shortens_the_log_and_keeps_the_state(spark, tmp_path):
    log = commits.CommitLog(f"{tmp_path}/log", LOG, "k")
    for n in range(1, 8):
        log.append(spark.createDataFrame([(f"k{n % 3}", n, None)], LOG).coalesce(1))
        log.checkpoint(spark, every=3)
    before = sorted(map(tuple, log.state(spark).collect()))
    assert [(k, v) for k, v, *_ in before] == [("k0", 6), ("k1", 7), ("k2", 5)]
    assert len(log.trim(spark, dt.datetime(2100, 1, 1).timestamp())) == 7  # six commits, the first checkpoint
    assert len([f for f in log.read(spark).inputFiles() if "/log/seq=" in f]) == 1
    assert sorted(map(tuple, log.state(spark).collect())) == before
    assert log.append(spark.createDataFrame([("k0", 9, None)], LOG)) == 8
    assert {r.k: r.v for r in log.state(spark).collect()} == {"k0": 9, "k1": 7, "k2": 5}


def test_expected_periods_stop_at_the_current_month(spark):
    expected = c.expected_periods(spark, 2023, 2024, ["a", "b"], until=dt.date(2024, 2, 1))
    assert expected.count() == 28
    actual = expected.where("NOT (dataset = 'b' AND month = 12)")
    assert c.require_coverage(expected, actual, strict=False).count() == 1
    with pytest.raises(RuntimeError, match="incomplete"):
        c.require_coverage(expected, actual)


def test_required_outputs_by_glob(spark, tmp_path):
    for name in ("a.parquet", "b.parquet", "c.json"):
        (tmp_path / name).write_bytes(b"1")
    inventory = files.file_inventory(spark, str(tmp_path))
    rules = [(str(tmp_path), "*.parquet", 3), (str(tmp_path), "[!a].*", 1), (f"{tmp_path.name}/", "**", 3), (tmp_path.name, "c+.json", 1)]
    rules = spark.createDataFrame(rules + rules[:1], "root string, pattern string, minimum_files int")
    got = {r.pattern: (r.actual_files, r.passed) for r in c.required_outputs(inventory, rules).collect()}
    assert got == {"*.parquet": (2, False), "[!a].*": (2, True), "**": (3, True), "c+.json": (0, False)}
    with pytest.raises(RuntimeError, match="2 of 3"):
        c.require_outputs(inventory, rules)


@pytest.mark.parametrize(
    "glob, matching, other",
    [
        ("a*.p?", ["ab.pq", "a.pp"], ["a.p", "a/b.pq", "xab.pq"]),
        ("**/x.p", ["x.p", "a/x.p", "a/b/x.p"], ["ax.p", "a/bx.p"]),
        ("a/**", ["a/b", "a/b/c"], ["a", "b/a/c"]),
        ("[ab][!c]+", ["ad+"], ["ac+", "cd+", "add", "ad"]),
        ("(1){2}|$^.\\", ["(1){2}|$^.\\"], ["11", "(1){2}"]),
    ],
)
def test_globs(spark, glob, matching, other):
    df = spark.createDataFrame([(p, glob) for p in matching + other], "path string, glob string")
    hit = df.where(F.rlike("path", c.glob_pattern(F.col("glob")))).collect()
    assert sorted(r.path for r in hit) == sorted(matching)


def test_required_outputs_do_not_depend_on_the_number_of_rules(spark):
    inventory = spark.range(500).selectExpr("CONCAT('lake/d', id % 50, '/y', id % 2, '/f', id, '.parquet') AS path")
    rules = spark.range(60).selectExpr("CONCAT('d', id) AS root", "IF(id % 2 = 0, 'y0/*.parquet', '*.parquet') AS pattern", "5 AS minimum_files")
    got = {r.root: r.actual_files for r in c.required_outputs(inventory, rules).collect()}
    assert len(got) == 60 and all(got[f"d{n}"] == (10 if n < 50 else 0) for n in range(60))


def test_bronze_takes_valid_files_and_audits_every_file(spark, tmp_path):
    raw, base = tmp_path / "raw files", f"{tmp_path}/bronze"
    frames = {"a": "SELECT id, 'x' AS mes FROM range(5)", "b": "SELECT id, 'y' AS mes FROM range(3)", "c": "SELECT CAST(id AS INT) AS id, 1.5D AS tip FROM range(4)"}
    for name, sql in frames.items():
        spark.sql(sql).coalesce(1).write.parquet(f"{tmp_path}/{name}")
        raw.mkdir(exist_ok=True)
        shutil.copy(next((tmp_path / name).glob("*.parquet")), raw / f"{name}.parquet")
    (raw / "bad.parquet").write_bytes(b"PAR1 no table PAR1")
    (raw / "empty.parquet").write_bytes(b"")
    places = {"a": ("green", 2024, 1), "b": ("green", 2024, 2), "c": ("green", 2024, 2), "bad": ("fhv", 2024, 1), "empty": ("fhv", 2024, 1), "none": ("fhv", 2024, 1)}
    catalog = spark.createDataFrame([(f"{raw}/{n}.parquet", *p) for n, p in places.items()], "path string, tipo_dataset string, anio int, mes int")
    for _ in range(2):  # a repeated load changes nothing
        audit = {r.path.split("/")[-1].split(".")[0]: r for r in load_bronze_files(spark, catalog, base, f"{tmp_path}/audit").collect()}
        assert {n: r.bronze_status for n, r in audit.items()} == {n: "loaded" if n in "abc" else "skipped_invalid" for n in places}
        assert (audit["a"].records, audit["c"].records, audit["bad"].bronze_path) == (5, 4, None)
        assert audit["b"].bronze_path.endswith("/tipo_dataset=green/anio=2024/mes=2") and audit["none"].reason == "missing file"
        found = {r[0]: r[1] for r in spark.read.schema("id long, mes int").parquet(base).groupBy("mes").count().collect()}
        assert found == {1: 5, 2: 7}
    assert spark.read.parquet(f"{tmp_path}/audit").count() == 12


def test_bronze_reports_rows_that_do_not_add_up(spark, tmp_path, monkeypatch):
    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/raw")
    catalog = files.file_inventory(spark, f"{tmp_path}/raw", "*.parquet").selectExpr("path", "'fhv' AS tipo_dataset", "2024 AS anio", "1 AS mes")
    checked = bronze.validate_files
    monkeypatch.setattr(bronze, "validate_files", lambda probed, extension: checked(probed, extension).withColumn("records", F.lit(6).cast("long")))
    assert [r.bronze_status for r in load_bronze_files(spark, catalog, f"{tmp_path}/bronze").collect()] == ["count_differs"]
