from pyspark.sql import functions as F

from orebelt.functions import names, values
from orebelt.operators.shape import conform, dedup_by_key, union_by_name


def test_snake_names_suffix_collisions():
    assert names.snake_names(["a b", "a-b", "A_B", "PULocationID", " x "]) == ["a_b", "a_b_2", "a_b_3", "pulocationid", "x"]


def test_rename_keeps_both_columns_of_a_collision(spark):
    df = names.with_snake_names(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))
    assert df.first().asDict() == {"a_b": 1, "a_b_2": 2}


def test_resolution_ignores_case_and_keeps_spelling():
    assert names.find_column(["Airport_fee", "x"], ["missing", "airport_fee"]) == "Airport_fee"
    assert names.find_column(["x"], ["y"]) is None


def test_conform_never_blanks_a_column_that_differs_by_case(spark):
    df = spark.createDataFrame([("1.5", "bad")], "Airport_fee string, n string")
    row = conform(df, {"airport_fee": "double", "n": "int", "absent": "double"}).first()
    assert (row.airport_fee, row.n, row.absent) == (1.5, None, None)


def test_conform_without_cast_when_type_fits(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert "cast" not in conform(df, {"a": "int"})._jdf.queryExecution().analyzed().toString().lower()


def test_first_value_over_candidates(spark):
    df = spark.createDataFrame([(None, 2), (1, 3)], "a int, b int")
    value = names.resolve_first_value(df, ["zz", "A", "b"], "int")
    assert [r[0] for r in df.select(value).collect()] == [2, 1]


def test_month_key_fallbacks(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (timestamp_ntz'2024-03-09 10:00:00', 2020, 1), (NULL, 2023, 7), (NULL, 1800, 7), (NULL, 2023, 13),"
        " (NULL, NULL, NULL) AS t(ts, y, m)"
    )
    keys = [r[0] for r in df.select(values.month_key(F.col("ts"), F.col("y"), F.col("m"))).collect()]
    assert keys == ["2024-03", "2023-07", "SIN_FECHA", "SIN_FECHA", "SIN_FECHA"]


def test_small_value_helpers(spark):
    df = spark.sql("SELECT '  ' AS blank, ' x ' AS text, 0 AS zero, 5 AS five, CAST(NULL AS INT) AS none")
    row = df.select(
        values.blank_to_null(F.col("blank")).alias("a"),
        values.blank_to_null(F.col("text")).alias("b"),
        values.or_sentinel(F.col("none")).alias("c"),
        values.ratio(F.col("five"), F.col("zero"), 0.0).alias("d"),
        values.ratio(F.col("five"), F.col("zero")).alias("e"),
        values.hour_key(F.lit(24), F.lit(None).cast("timestamp_ntz")).alias("f"),
        values.label_of(F.col("five"), {1: "one"}, F.lit("other")).alias("g"),
    ).first()
    assert tuple(row) == (None, "x", -1, 0.0, None, -1, "other")


def test_json_fields_tolerate_broken_text(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("{oops",), (None,)], "t string")
    parsed = df.select(values.json_fields(F.col("t"), "a int").alias("j")).select("j.a")
    assert [r.a for r in parsed.collect()] == [1, None, None]


def test_union_by_name_handles_order_and_gaps(spark):
    left = spark.createDataFrame([(1, "x")], "a int, b string")
    right = spark.createDataFrame([("y", 2, 0.5)], "b string, a int, c double")
    rows = {tuple(r) for r in union_by_name([left, right]).collect()}
    assert rows == {(1, "x", None), (2, "y", 0.5)}


def test_key_dedup_is_the_same_for_any_partitioning(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id % 13 AS a", "id AS b", "IF(id % 5 = 0, NULL, id) AS c")
    kept = [
        sorted(map(tuple, dedup_by_key(df.repartition(n), ["k"], [-F.col("a")]).collect()), key=str) for n in (1, 8)
    ]
    assert kept[0] == kept[1] and len(kept[0]) == 7
    assert {row[1] for row in kept[0]} == {12}


def test_key_dedup_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (1, 5)], "k int, v int")
    assert {tuple(r) for r in dedup_by_key(df, ["k"]).collect()} == {(None, 1), (1, 5)}


def test_durations_do_not_depend_on_the_session_zone(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (timestamp_ntz'1996-04-07 01:30:00', timestamp_ntz'1996-04-07 03:30:00'), "
        "(timestamp_ntz'1996-04-07 02:30:00', timestamp_ntz'1996-04-05 02:29:59'), (NULL, timestamp_ntz'1996-04-07 03:30:00') AS t(a, b)"
    )
    seconds = df.select(values.elapsed_seconds(F.col("a"), F.col("b")))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert [r[0] for r in seconds.collect()] == [7200, -172801, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
