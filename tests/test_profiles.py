import pytest

from orebelt.operators import profile as p
from orebelt.plans.profile_store import ProfileStore
from orebelt.operators import quality as q
from orebelt.operators import schema as s


def test_null_counts_as_a_distinct_value(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('a', 1, 1.0D, DATE'2024-01-01', TRUE), ('a', 1, 2.0D, NULL, TRUE), (NULL, 2, 2.0D, NULL, FALSE) AS t(s, i, d, day, b)"
    )
    got = {r.column: r for r in p.column_profile(df).collect()}
    assert {c: r.distinct for c, r in got.items()} == {"s": 2, "i": 2, "d": 2, "day": 2, "b": 2}
    assert (got["day"].nulls, round(got["day"].null_pct, 4)) == (2, 66.6667)
    assert (got["d"].min, got["d"].max, round(got["d"].mean, 6), round(got["d"].stddev, 6)) == (1.0, 2.0, 1.666667, 0.57735)
    assert got["s"].min is None and got["b"].mean is None


def test_distinct_timestamps_of_both_kinds_and_nested_values(spark):
    df = spark.sql(
        "SELECT timestamp'2024-01-01 00:00:00' AS a, timestamp_ntz'2024-01-01 00:00:00' AS b, array(1, 2) AS c, map('k', 1) AS m, 1.10 AS e "
        "UNION ALL SELECT timestamp'2024-01-01 00:00:00.000001', timestamp_ntz'2024-01-01 00:00:00.000001', array(1, 3), map('k', 2), 1.11"
    )
    assert {r.column: r.distinct for r in p.column_profile(df).collect()} == {"a": 2, "b": 2, "c": 2, "m": 2, "e": 2}


def test_approximate_profile_agrees_on_small_data(spark):
    df = spark.range(50).selectExpr("id % 7 AS g", "IF(id % 2 = 0, NULL, id % 5) AS x")
    exact = {r.column: (r.n, r.nulls, r.distinct) for r in p.column_profile(df).collect()}
    approx = {r.column: (r.n, r.nulls, r.distinct) for r in p.column_profile(df, exact_distinct=False).collect()}
    assert exact == approx


def test_scoring_policies(spark):
    rows = [("a", 10, 35.0, 3, 30.0), ("b", 10, 20.0, 1, 10.0), ("c", 10, 0.0, 5, 50.0)]
    df = spark.createDataFrame(rows, "column string, n long, null_pct double, distinct long, distinct_pct double")
    assert p.profile_scores(df, []).first().quality_score == 93.0
    assert p.profile_scores(df, [], "final").first().quality_score == 80.0
    with pytest.raises(ValueError):
        p.profile_scores(df, [], "other")


def test_exact_merge_equals_direct_profile(spark):
    df = spark.range(500).selectExpr("'d' AS ds", "id % 5 AS month", "IF(id % 3 = 0, NULL, 1e6 + id * 0.37D) AS x", "CAST(id % 5 AS INT) AS y")
    merged = {r.column: r for r in p.merge_profiles(p.column_profile(df, ["ds", "month"], ["x", "y"]), ["ds"], "month", exact=True).collect()}
    direct = {r.column: r for r in p.column_profile(df, ["ds"], ["x", "y"]).collect()}
    for name in ("x", "y"):
        assert merged[name].nulls == direct[name].nulls and merged[name].records == direct[name].n
        assert merged[name].mean == pytest.approx(direct[name].mean, rel=1e-12)
        assert merged[name].stddev == pytest.approx(direct[name].stddev, rel=1e-6)


def test_improvement_matches_columns_without_case(spark):
    schema = "ds string, column string, null_pct double"
    before = spark.createDataFrame([("d", "Fee", 30.0), ("d", "gone", 1.0)], schema)
    after = spark.createDataFrame([("d", "fee", 10.0)], schema)
    got = p.null_improvement(before, after, ["ds"]).collect()
    assert [(r.column, r.improvement_pct, r.improved) for r in got] == [("fee", 20.0, True)]


def test_quality_without_checked_columns_scores_one(spark):
    df = spark.createDataFrame([("x", 1, None)], "ds string, a int, b string")
    got = {r.dimension: r.score for r in q.quality_scores(q.quality_measures(df, ["ds"]), ["ds"]).collect()}
    assert got["precision"] == got["validez"] == got["unicidad"] == 1.0
    assert got["completitud"] == pytest.approx(2 / 3)


def test_quality_accepts_local_timestamps_and_rejects_nested_types(spark):
    df = spark.sql("SELECT 'x' AS ds, timestamp_ntz'2024-01-01 00:00:00' AS t, array(1) AS a, CAST(1 AS DECIMAL(9, 2)) AS d")
    got = {r.dimension: r.score for r in q.quality_scores(q.quality_measures(df, ["ds"]), ["ds"]).collect()}
    assert got["consistencia"] == 0.75


def test_rule_status_and_passed_can_differ_at_the_boundary(spark):
    scores = spark.createDataFrame([("t", 2024, 3, "validez", 0.899, 0.9, False)], "k string, y int, records long, dimension string, score double, threshold double, passed boolean")
    got = q.rule_results(scores, "k", "y").first()
    assert (got.records_failed, got.status, got.passed) == (0, "PASSED", False)
    assert got.rule_id == "DQ_T_2024_VALIDEZ" and got.rule_name == "Validez de t 2024"


def test_invalid_rule_results_are_found(spark):
    bad = spark.createDataFrame([(10, 11, 0.1), (10, 1, 1.5), (10, 1, 0.1)], "records_evaluated long, records_failed long, allowed_failure_rate double")
    assert q.invalid_rule_results(bad).count() == 2


@pytest.mark.parametrize(
    "types, widest",
    [
        (["double", "decimal(10,2)"], "double"),
        (["decimal(10,2)", "decimal(38,10)", "int"], "decimal(38,10)"),
        (["int", "bigint"], "bigint"),
        (["timestamp_ntz", "int"], "timestamp"),
        (["string", "timestamp"], "string"),
        (["date", "boolean"], "boolean"),
    ],
)
def test_widest_type(spark, types, widest):
    df = spark.createDataFrame([("c", t) for t in types], "column string, dtype string")
    assert s.widest_types(df, ["column"]).first().dtype == widest


SNAP = "dataset string, year int, month int, column string, dtype string"


def test_drift_by_month_and_year(spark):
    rows = [("d", 2023, 1, "a", "int"), ("d", 2023, 1, "b", "int"), ("d", 2023, 4, "a", "bigint"), ("d", 2023, 4, "c", "int"), ("d", 2024, 2, "a", "int")]
    snap = spark.createDataFrame(rows, SNAP)
    month = {(r.column, r.change, r.from_period, r.to_period) for r in s.drift_by_month(snap).collect()}
    assert month == {("a", "type", "2023-01", "2023-04"), ("b", "removed", "2023-01", "2023-04"), ("c", "new", "2023-01", "2023-04")}
    year = {(r.column, r.change, r.from_period, r.to_period) for r in s.drift_by_year(snap).collect()}
    assert year == {("b", "removed", "2023", "2024")}


def test_unified_schema_merges_spellings_and_defaults(spark):
    snap = spark.createDataFrame([("yellow", 2023, 1, "Airport_fee", "int"), ("yellow", 2023, 1, "brand_new", "int")], SNAP)
    got = s.as_mapping(s.unified_schema(snap, s.default_schemas(spark)), "yellow")
    assert got["airport_fee"] == "double" and "Airport_fee" not in got and got["brand_new"] == "int"
    assert len(got) == 20 and list(got) == sorted(got)


def test_drift_report_form_turns_reported_columns_into_text(spark):
    drift = spark.createDataFrame([("yellow", "airport_fee", "removed"), ("yellow", "extra", "type")], "dataset string, column string, change string")
    got = s.as_mapping(s.unified_schema_from_drift(s.default_schemas(spark), drift), "yellow")
    assert got["airport_fee"] == "string" and got["extra"] == "double"


def test_default_schema_sizes(spark):
    sizes = {r.dataset: r["count"] for r in s.default_schemas(spark).groupBy("dataset").count().collect()}
    assert sizes == {"yellow": 19, "green": 20, "fhv": 6, "fhvhv": 25}


def _months(spark, offset=1e9):
    return spark.range(4000).selectExpr(
        "'d' AS taxi_type", "2024 AS file_year", "CAST(1 + id % 4 AS INT) AS file_month",
        f"IF(id % 7 = 0, NULL, {offset}D + (id * 37 % 1000) * 0.001D) AS x", "CAST(id % 1300 AS INT) AS y", "CONCAT('v', id) AS s",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id % 50 AS INT)) AS m", "CAST(NULL AS DOUBLE) AS z",
    )


def test_stored_months_equal_a_profile_of_all_rows_even_far_from_zero(spark, tmp_path):
    df, store = _months(spark), ProfileStore(f"{tmp_path}/states")
    assert store.states(spark) is store.profile(spark) is store.trend(spark) is None
    store.refresh(spark, df.where("file_month < 3"))
    store.refresh(spark, df)
    merged = {r.column: r for r in store.profile(spark).collect()}
    direct = {r.column: r for r in p.column_profile(df, ["taxi_type", "file_year"], ["x", "y", "s", "m", "z"]).collect()}
    assert set(merged) == set(direct)
    for name, got in merged.items():
        want = direct[name]
        assert (got.n, got.nulls, got.dtype, got.min, got.max) == (want.n, want.nulls, want.dtype, want.min, want.max)
        assert (got.mean, got.stddev) == (None, None) if want.mean is None else (got.mean, got.stddev) == (pytest.approx(want.mean, rel=1e-15), pytest.approx(want.stddev, rel=1e-6))
        assert got.distinct == pytest.approx(want.distinct, rel=0.03)
    assert direct["x"].stddev == pytest.approx(0.2887, rel=1e-2)
    trend = store.trend(spark).first()
    assert (trend.months, trend.records) == (4, 4000)
    whole = {r.column: r for r in store.profile(spark, by=()).collect()}
    assert whole["x"].stddev == pytest.approx(direct["x"].stddev, rel=1e-6) and whole["x"].n == 4000


def test_exact_merge_is_stable_far_from_zero(spark):
    df = _months(spark)
    scope = ["taxi_type", "file_year"]
    merged = p.merge_profiles(p.column_profile(df, [*scope, "file_month"], ["x"]), scope, "file_month", exact=True).first()
    direct = p.column_profile(df, scope, ["x"]).first()
    assert merged.mean == pytest.approx(direct.mean, rel=1e-15) and merged.stddev == pytest.approx(direct.stddev, rel=1e-6)


def test_only_pending_months_are_scanned(spark, tmp_path):
    path, store = f"{tmp_path}/records", ProfileStore(f"{tmp_path}/states")
    _months(spark).write.partitionBy("taxi_type", "file_year", "file_month").parquet(path)
    records = spark.read.parquet(path)
    assert store.refresh(spark, records.where("file_month <> 3")).count() == 3
    # a month with a state is not opened again: its broken file does no harm
    for part in (tmp_path / "records" / "taxi_type=d" / "file_year=2024" / "file_month=1").glob("*.parquet"):
        part.write_bytes(b"broken")
        (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    months = spark.createDataFrame([("d", 2024, n) for n in range(1, 5)], "taxi_type string, file_year int, file_month int")
    done = store.refresh(spark, spark.read.schema(records.schema).parquet(path), available=months)
    assert [r.file_month for r in done.collect()] == [3]
    assert store.refresh(spark, spark.read.schema(records.schema).parquet(path), available=months).isEmpty()
    assert store.trend(spark).first().months == 4 and store.profile(spark).where("column = 's'").first().n == 4000


def test_distinct_counts_scan_the_columns_of_one_class(spark, tmp_path):
    spark.sql("SELECT 'a' AS s, 1.5D AS d, 1 AS i").write.parquet(f"{tmp_path}/t")
    plan = p.column_profile(spark.read.parquet(f"{tmp_path}/t"))._jdf.queryExecution().executedPlan().toString()
    assert all(f"ReadSchema: struct<{column}>" in plan for column in ("s:string", "d:double", "i:int"))
