"""The rule engine against a literal replay of the rules, one after another."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orebelt.operators import rules as r
from orebelt.operators.enrich import with_trip_parts, with_zones

SCHEMA = (
    "taxi_type string, file_year int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "total_amount double, fare_amount double, tip_amount double, tolls_amount double, trip_distance double, "
    "passenger_count int, payment_type int, PULocationID int, DOLocationID int"
)
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
T0 = dt.datetime(2024, 5, 1, 10)
GOOD = ("yellow", 2024, T0, T0 + dt.timedelta(minutes=9), 12.0, 10.0, 1.0, 0.0, 2.0, 1, 1, 10, 20)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def row(**changes):
    return tuple(changes.get(name, value) for name, value in zip(COLUMNS, GOOD))


def replay(rows):
    """Removed per scope and rule, by applying the rules in order."""
    removed = {}
    for scope in {x[:2] for x in rows}:
        left = [dict(zip(COLUMNS, x)) for x in rows if x[:2] == scope]

        def step(rule, keep):
            nonlocal left
            stay = [x for x in left if keep(x)]
            removed[(*scope, rule)] = len(left) - len(stay)
            left = stay

        def between(value, low, high):
            return value is not None and low <= value <= high

        typed = scope[0] in ("yellow", "green")
        step("pickup_datetime_present", lambda x: x["tpep_pickup_datetime"] is not None)
        step("dropoff_datetime_present", lambda x: not typed or x["tpep_dropoff_datetime"] is not None)
        step("monto_total_present", lambda x: not typed or x["total_amount"] is not None)
        unique = list({tuple(x.values()): x for x in left}.values())
        removed[(*scope, "unique_rows")] = len(left) - len(unique)
        left = unique
        for rule, column in (("fare_not_negative", "fare_amount"), ("tip_not_negative", "tip_amount"), ("tolls_not_negative", "tolls_amount")):
            step(rule, lambda x, c=column: x[c] is not None and x[c] >= 0)
        step("distance_in_range", lambda x: between(x["trip_distance"], 0.1, 500))
        step("passengers_in_range", lambda x: between(x["passenger_count"], 0, 6))
        guard = any(x["tpep_dropoff_datetime"] is not None for x in left)
        step(
            "duration_in_range",
            lambda x: not guard
            or x["tpep_dropoff_datetime"] is not None
            and (x["tpep_dropoff_datetime"] - x["tpep_pickup_datetime"]).total_seconds() <= 86400,
        )
        for rule, column, high in (("payment_known", "payment_type", 6), ("pickup_zone_known", "PULocationID", 263), ("dropoff_zone_known", "DOLocationID", 263)):
            step(rule, lambda x, c=column, h=high: x[c] is None or 1 <= x[c] <= h)
        step("pickup_in_period", lambda x: dt.datetime(2020, 1, 1) <= x["tpep_pickup_datetime"] < dt.datetime(2028, 1, 1))
        removed[(*scope, "left")] = sorted(map(str, (tuple(x.values()) for x in left)))
    return removed


def engine(spark, rows):
    df = frame(spark, rows)
    rules = r.trip_rules()
    counted = {(x.taxi_type, x.file_year, x.rule): x.removed for x in r.cleaning_counts(df, rules).collect()}
    kept = {}
    for x in r.clean(df, rules).collect():
        kept.setdefault((x.taxi_type, x.file_year, "left"), []).append(str(tuple(x)))
    charged = {}
    for x in r.quarantine(df, rules).collect():
        key = (x.taxi_type, x.file_year, x.rule)
        charged[key] = charged.get(key, 0) + x.records
    return counted, {k: sorted(v) for k, v in kept.items()}, charged


def check(spark, rows):
    expected = replay(rows)
    counted, kept, charged = engine(spark, rows)
    counts = {k: v for k, v in expected.items() if k[2] != "left"}
    assert counted == counts
    assert charged == {k: v for k, v in counts.items() if v}
    assert kept == {k: v for k, v in expected.items() if k[2] == "left" and v}


cell = st.sampled_from
rows_strategy = st.lists(
    st.tuples(
        cell(["yellow", "fhv"]),
        cell([2023, 2024]),
        cell([None, T0, dt.datetime(2019, 1, 1), dt.datetime(2027, 12, 31, 23)]),
        cell([None, None, T0 + dt.timedelta(minutes=5), T0 + dt.timedelta(days=2)]),
        cell([None, 5.0]),
        cell([None, -1.0, 4.0, 4.0]),
        cell([0.0, 0.0, -0.5]),
        cell([0.0]),
        cell([None, 0.05, 3.0, 3.0]),
        cell([None, 7, 1, 1]),
        cell([None, 9, 1]),
        cell([None, 0, 5]),
        cell([5, 264]),
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy)
def test_engine_equals_replay(spark, rows):
    check(spark, rows + rows[: len(rows) // 2])


def test_last_day_of_the_period_is_kept(spark):
    check(spark, [row(tpep_pickup_datetime=dt.datetime(2027, 12, 31, 23), tpep_dropoff_datetime=dt.datetime(2027, 12, 31, 23, 5))])


def test_duration_rule_is_off_where_no_dropoff_survives(spark):
    lone = [row(taxi_type="fhv", tpep_dropoff_datetime=None, fare_amount=1.0 + i) for i in range(3)]
    counts = r.cleaning_counts(frame(spark, lone), r.trip_rules()).where("rule = 'duration_in_range'").first()
    assert (counts.removed, counts.status) == (0, "not_applicable")
    assert r.clean(frame(spark, lone), r.trip_rules()).count() == 3
    bad_but_filled = row(taxi_type="fhv", fare_amount=-1.0)
    check(spark, [*lone, bad_but_filled])
    check(spark, [*lone, row(taxi_type="fhv")])


def test_missing_column_is_reported_not_skipped(spark):
    df = frame(spark, [GOOD]).drop("trip_distance")
    status = {x.rule: x.status for x in r.cleaning_counts(df, r.trip_rules()).collect()}
    assert status["distance_in_range"] == "not_applicable" and status["fare_not_negative"] == "applied"


def test_summary_adds_up(spark):
    rows = [GOOD, GOOD, row(fare_amount=-1.0), row(trip_distance=0.0), row(total_amount=None)]
    s = r.cleaning_summary(r.cleaning_counts(frame(spark, rows), r.trip_rules())).first()
    assert (s.original, s.removed, s.final, s.removed_pct, s.quality_score) == (5, 4, 1, 80.0, 20.0)
    assert (s.removed_completitud, s.removed_unicidad, s.removed_exactitud, s.removed_razonabilidad) == (1, 1, 1, 1)


def test_negative_duration_rule_is_optional(spark):
    back = row(tpep_dropoff_datetime=T0 - dt.timedelta(hours=1))
    assert r.clean(frame(spark, [back]), r.trip_rules()).count() == 1
    assert r.clean(frame(spark, [back]), r.trip_rules(reject_negative_duration=True)).count() == 0


def test_light_cleaning_accounts_for_every_row(spark):
    rows = [GOOD, row(fare_amount=3.0), row(tpep_pickup_datetime=None), row(tpep_pickup_datetime=dt.datetime(2030, 1, 1)), row(PULocationID=None), row(PULocationID=None)]
    df = frame(spark, rows)
    c = r.light_counts(df).first()
    assert (c.original, c.removed_missing, c.removed_undated, c.removed_duplicate, c.final) == (6, 1, 1, 2, 2)
    kept = r.light_clean(df)
    assert kept.count() == 2 and kept.where("PULocationID = 10").first().fare_amount == 3.0


def test_dealt_rows_count_alike(spark):
    """Rows dealt to a number of tasks are counted as before, by one shuffle that nothing merges."""
    zeros = [row(tolls_amount=0.0), row(tolls_amount=-0.0), row(tolls_amount=-1.0), row(), row(fare_amount=float("nan"))]
    df = frame(spark, [*zeros, *zeros[2:], row(PULocationID=None), row(PULocationID=None, DOLocationID=20)]).withColumn("one", F.lit(0.5))
    plain, dealt = r.RuleSet(df, r.trip_rules()), r.RuleSet(df, r.trip_rules(), tasks=3)
    assert sorted(map(str, plain.counts().collect())) == sorted(map(str, dealt.counts().collect()))
    assert sorted(map(str, plain.judged().collect())) == sorted(map(str, dealt.judged().collect()))
    assert dealt.groups().rdd.getNumPartitions() == 3
    plan = dealt.groups()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan


@pytest.mark.parametrize("partitions", [1, 8])
def test_counts_do_not_depend_on_partitioning(spark, partitions):
    rows = [GOOD] * 30 + [row(fare_amount=float(i % 3 - 1)) for i in range(20)]
    df = frame(spark, rows).repartition(partitions)
    assert r.cleaning_summary(r.cleaning_counts(df, r.trip_rules())).first().final == 3


def test_zone_join_keeps_unknown_zones(spark):
    lookup = spark.createDataFrame([(10, "B", "Z", "S")], "locationid int, borough string, zone string, service_zone string")
    got = with_zones(frame(spark, [GOOD]), lookup).first()
    assert (got.pickup_zone, got.dropoff_zone) == ("Z", None)


def test_trip_parts_count_sunday_as_one(spark):
    sunday = dt.datetime(2024, 5, 5, 23, 59)
    got = with_trip_parts(frame(spark, [row(tpep_pickup_datetime=sunday, tpep_dropoff_datetime=sunday + dt.timedelta(seconds=90))])).first()
    assert (got.pickup_day, got.pickup_hour, got.trip_duration_minutes) == (1, 23, 1.5)


def test_closed_midnight_ends_at_the_last_days_first_moment(spark):
    last = dt.datetime(2027, 12, 31)
    rows = [row(tpep_pickup_datetime=last + dt.timedelta(seconds=n), tpep_dropoff_datetime=last + dt.timedelta(seconds=n)) for n in (-1, 0, 1)]
    assert r.clean(frame(spark, rows), r.trip_rules()).count() == 3
    kept = r.clean(frame(spark, rows), r.trip_rules(closed_midnight=True)).collect()
    assert sorted(x.tpep_pickup_datetime for x in kept) == [last - dt.timedelta(seconds=1), last]


def test_roles_of_different_types_meet_without_failing(spark):
    df = frame(spark, [row(payment_type=None), row(payment_type=9), row(payment_type=2), row(payment_type=None)])
    df = df.selectExpr("*", "CASE WHEN payment_type IS NULL THEN 'x' ELSE '7' END AS paymenttype")
    found = {x.rule: x.removed for x in r.cleaning_counts(df, r.trip_rules()).collect()}
    assert found["payment_known"] == 1 and found["unique_rows"] == 1


def _scans(plan):
    """Per leaf of the executed plan: the operators above it, root first."""
    paths = []

    def walk(node, above):
        above = [*above, (node.nodeName(), node.verboseString(200))]
        children = [node.children().apply(i) for i in range(node.children().size())]
        if not children:
            paths.append(above)
        for child in children:
            walk(child, above)

    walk(plan, [])
    return paths


@pytest.mark.parametrize("form", ["survivors", "judged"])
def test_rows_with_the_guarding_value_go_past_the_join(spark, form, tmp_path):
    frame(spark, [row(), row(tpep_dropoff_datetime=None, taxi_type="fhv"), row(taxi_type="fhv")]).write.parquet(str(tmp_path / "t"))
    held = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.read.parquet(str(tmp_path / "t"))
        made = getattr(r.RuleSet(df, r.trip_rules()), form)()
        paths = _scans(made._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", held)
    straight = [p for p in paths if not any("Join" in name for name, _ in p)]
    joined = [p for p in paths if any("Join" in name for name, _ in p)]
    assert len(straight) == 1 and len(joined) == 2
    # all rows but those without the value: one exchange, the one that removes copies
    assert sum(name == "Exchange" for name, _ in straight[0]) == 1
    # what enters the join on the rows' side lacks the value
    assert any("isnull(tpep_dropoff_datetime" in text for _, text in joined[0])
    assert made.count() == {"survivors": 2, "judged": 3}[form]
