import shutil
from functools import reduce

import pytest
from pyspark.sql import functions as F

from orebelt.operators import incremental as inc
from orebelt.operators import star
from orebelt.operators.canonical import canonicalise, lineage
from orebelt.operators.shape import require_unique
from orebelt.contract import HIGH_VOLUME_SOURCES
from orebelt.plans import star_refresh
from orebelt.sources.commits import CommitConflict
from orebelt.plans.star_refresh import StarStore, full_fact, published_counts
from orebelt.streaming.refresh import file_stream, stream_contributions

TRIPS = """SELECT * FROM VALUES
 ('green_2023', 'green', 2023, timestamp_ntz'2023-05-01 07:00:00', 1, 2, 1, 1, NULL, NULL, ' 1 ', NULL, 10.0D, 2.0D),
 ('green_2023', 'green', 2023, timestamp_ntz'2023-05-01 07:30:00', 1, 2, 1, 1, NULL, NULL, '1', NULL, NULL, 3.0D),
 ('fhv_2023', 'fhv', 2023, NULL, NULL, 9, 42, 7, 5, 1, ' ', 'B01', 4.0D, NULL),
 ('fhv_2023', NULL, 2023, timestamp_ntz'2023-06-01 23:00:00', 3, 9, NULL, 99, 1, 0, NULL, NULL, 4.0D, 1.0D)
 AS t(source_id, tipo_dataset, anio, pickup_datetime, pickup_location_id, dropoff_location_id, payment_type, ratecode_id, trip_type,
      shared_ride_flag, vendor_id, dispatching_base_num, monto_total, distancia_millas)"""
ZONES = "SELECT * FROM VALUES (1, 'Queens', 'Astoria', 'Boro'), (9, 'Bronx', NULL, 'Boro') AS z(LocationID, Borough, Zone, service_zone)"


def rows(df, *names):
    return {tuple(r) for r in df.select(*names).collect()}


def test_fact_sentinels_and_averages(spark):
    fact = full_fact(spark.sql(TRIPS))
    got = {(r.time_id, r.hora_id, r.tipo_dataset, r.pickup_location_id, r.provider_key): r for r in fact.collect()}
    two = got[("2023-05", 7, "green", 1, "green|1")]
    assert (two.cantidad_viajes, two.total_monto_total, two.promedio_monto_total, two.promedio_distancia_millas) == (2, 10.0, 10.0, 2.5)
    undated = got[("SIN_FECHA", -1, "fhv", -1, "fhv|B01")]
    assert undated.promedio_distancia_millas is None and undated.total_distancia_millas == 0.0
    assert ("2023-06", 23, "desconocido", 3, "desconocido|NO_INFO") in got


def test_dimensions(spark):
    fact = full_fact(spark.sql(TRIPS))
    dims = star.dimensions(fact, spark.sql(ZONES))
    assert rows(dims["dim_tiempo"], "time_id", "nombre_mes", "trimestre", "etiqueta_mes", "orden_mes") == {
        ("2023-05", "Mayo", 2, "Mayo 2023", 202305), ("2023-06", "Junio", 2, "Junio 2023", 202306), ("SIN_FECHA", "Sin fecha", -1, "Sin fecha", -1)
    }
    assert rows(dims["dim_hora"], "hora_id", "hora", "franja_horaria") == {(7, 7, "Manana"), (-1, None, "Sin hora"), (23, 23, "Noche")}
    assert rows(dims["dim_pago"], "payment_type", "forma_pago") == {(1, "Credit card"), (42, "Codigo 42"), (-1, "No informado / No aplica")}
    assert rows(dims["dim_zona_pickup"], "pickup_location_id", "pickup_zone") == {(1, "Astoria"), (-1, "No informado"), (3, "No informado")}
    assert (9, "Bronx", "No informado") in rows(dims["dim_zona_dropoff"], "dropoff_location_id", "dropoff_borough", "dropoff_zone")
    assert rows(dims["dim_proveedor"], "provider_key", "tipo_proveedor", "proveedor") == {
        ("green|1", "Vendor TLC", "Creative Mobile Technologies, LLC"),
        ("fhv|B01", "Base FHV", "Base B01"),
        ("desconocido|NO_INFO", "Vendor TLC", "No informado"),
    }
    checked = star.key_check(dims, fact).collect()
    assert len(checked) == 10 and all(r.rows == r.distinct_keys and r.orphan_keys == 0 for r in checked)
    joined = star.star_join(fact, dims)
    assert joined.count() == fact.count() and "forma_pago" in joined.columns


def test_repeated_dimension_key_raises(spark):
    with pytest.raises(ValueError, match="repeats key"):
        require_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"], "dim")


def prints(df):
    return df.groupBy("source_id").agg(F.sha2(F.concat_ws("|", F.count(F.lit(1)), F.sum("monto_total")), 256).alias("fingerprint"))


def fact_rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_refresh_equals_full_build_after_add_change_remove_and_empty(spark, tmp_path):
    store = StarStore(f"{tmp_path}/star")
    lookup = spark.sql(ZONES)
    trips = spark.sql(TRIPS)
    tables = store.publish_if_needed(spark, trips, prints(trips), lookup)
    assert fact_rows(store.fact(spark)) == fact_rows(full_fact(trips))
    counts = {r.table: r.rows for r in published_counts(tables).collect()}
    assert counts["fact_viajes_agregados"] == 3 and counts["dim_hora"] == 3

    assert store.publish_if_needed(spark, trips, prints(trips), lookup) is None
    assert store.publish_if_needed(spark, trips, prints(trips), lookup, force_rebuild=True) is not None

    changed = trips.withColumn("monto_total", F.when(F.col("source_id") == "green_2023", 99.0).otherwise(F.col("monto_total")))
    changed = changed.unionByName(changed.where("source_id = 'fhv_2023'").withColumn("source_id", F.lit("fhv_2024")))
    assert store.refresh(spark, changed, prints(changed))
    assert fact_rows(store.fact(spark)) == fact_rows(full_fact(changed))

    fewer = changed.where("source_id <> 'green_2023'")
    assert store.refresh(spark, fewer, prints(fewer))
    assert fact_rows(store.fact(spark)) == fact_rows(full_fact(fewer))

    emptied = spark.createDataFrame([("fhv_2023", "empty"), ("fhv_2024", "empty")], "source_id string, fingerprint string")
    assert store.refresh(spark, fewer.limit(0), emptied)
    assert store.fact(spark).count() == 0
    assert not store.refresh(spark, fewer.limit(0), emptied)


def test_only_batches_in_force_are_read_and_kept(spark, tmp_path):
    store = StarStore(f"{tmp_path}/star")
    trips, lookup = spark.sql(TRIPS), spark.sql(ZONES)
    assert store.publish_if_needed(spark, trips, prints(trips), lookup)
    first, version = store.batches(spark), store.current(spark)
    again = trips.withColumn("monto_total", F.lit(7.0))
    lost = store.stage(star.star_input(again.withColumn("version", F.lit("x")), carry=("source_id", "version")))  # a crash before the commit
    assert fact_rows(store.fact(spark)) == fact_rows(full_fact(trips))
    assert store.publish_if_needed(spark, again, prints(again), lookup)
    now = store.batches(spark)
    assert len(now) == 1 and now != first
    read = {f.split("/contributions/")[1].split("/")[0] for f in store.contributions(spark).inputFiles() if "/contributions/" in f}
    assert read == set(now)
    gone = store.vacuum(spark, grace_seconds=-60)
    assert {p.split("/")[-1] for p in gone} == {*first, lost, version}
    assert fact_rows(store.fact(spark)) == fact_rows(full_fact(again))
    assert fact_rows(store.published(spark)["fact_viajes_agregados"]) == fact_rows(store.fact(spark).select(*store.published(spark)["fact_viajes_agregados"].columns))


def test_failed_check_publishes_nothing(spark, tmp_path, monkeypatch):
    store = StarStore(f"{tmp_path}/star")
    trips, lookup = spark.sql(TRIPS), spark.sql(ZONES)
    store.publish_if_needed(spark, trips, prints(trips), lookup)
    version = store.current(spark)
    recorded = spark.read.parquet(f"{store.published_path}/versions").where(F.col("version") == version)
    assert recorded.count() == 11 and recorded.where("table = 'dim_hora'").first().rows == 3

    def fail(*_):
        raise ValueError("repeats key")

    monkeypatch.setattr("orebelt.plans.star_refresh.require_unique", fail)
    with pytest.raises(ValueError, match="repeats key"):
        store.publish(spark, lookup)
    assert store.current(spark) == version
    assert store.published(spark)["dim_hora"].count() == 3


def test_type_and_year_fall_back_to_the_source(spark, tmp_path):
    store = StarStore(f"{tmp_path}/star")
    trips = spark.sql(TRIPS).withColumns({"source_type": F.split("source_id", "_")[0], "source_year": F.split("source_id", "_")[1]})
    store.refresh(spark, trips, prints(trips), dataset=F.col("source_type"), year=F.col("source_year"))
    assert {r.tipo_dataset for r in store.fact(spark).collect()} == {"green", "fhv"}


def test_source_classes(spark):
    schema = "source_id string, fingerprint string"
    now = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", "4")], schema)
    was = spark.createDataFrame([("a", "1"), ("b", "9"), ("d", "4"), ("e", "5")], schema)
    staged = was.where("source_id <> 'd'").select("source_id")
    got = {r.source_id: r.change for r in inc.compare_sources(now, was, staged).collect()}
    assert got == {"a": "unchanged", "b": "changed", "c": "new", "d": "staging_missing", "e": "gone"}
    forced = {r.source_id: r.change for r in inc.compare_sources(now, was, staged, force=True).collect()}
    assert forced == {"a": "forced", "b": "forced", "c": "new", "d": "forced", "e": "gone"}


def test_fingerprint_sees_any_file_change_but_not_order(spark):
    files = spark.sql(
        "SELECT 's' AS source_id, CONCAT('p', id) AS path, id AS size_bytes, timestamp'2024-01-01 00:00:00' AS modified_at FROM range(20)"
    )
    base = inc.source_fingerprints(files.repartition(1)).first()
    assert base.part_files == 20 and base.fingerprint == inc.source_fingerprints(files.repartition(7)).first().fingerprint
    touched = files.withColumn("modified_at", F.when(F.col("path") == "p3", F.timestamp_micros(F.lit(1))).otherwise(F.col("modified_at")))
    swapped = files.withColumn("size_bytes", F.when(F.col("path") == "p3", 4).when(F.col("path") == "p4", 3).otherwise(F.col("size_bytes")))
    assert len({base.fingerprint, inc.source_fingerprints(touched).first().fingerprint, inc.source_fingerprints(swapped).first().fingerprint}) == 3


def test_stream_adds_only_new_files_and_replays_safely(spark, tmp_path):
    source, store = f"{tmp_path}/in", StarStore(f"{tmp_path}/star")
    trips = spark.sql(TRIPS).drop("source_id")
    trips.where("tipo_dataset = 'green'").coalesce(1).write.mode("append").parquet(source)

    def run():
        stream_contributions(file_stream(spark, trips.schema, source), store, f"{tmp_path}/checkpoint").awaitTermination()

    run()
    first = store.fact(spark)
    assert first.agg(F.sum("cantidad_viajes")).first()[0] == 2
    trips.where("tipo_dataset = 'fhv' OR tipo_dataset IS NULL").coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    assert fact_rows(store.fact(spark)) == fact_rows(full_fact(trips))
    replay = f"{tmp_path}/checkpoint2"
    stream_contributions(file_stream(spark, trips.schema, source), store, replay).awaitTermination()
    assert fact_rows(store.fact(spark)) == fact_rows(full_fact(trips))


def test_stream_of_14_files_stays_on_few_batches(spark, tmp_path):
    """One micro-batch a file; batches in force grow with the logarithm of their number."""
    source, store, fanout = tmp_path / "in", StarStore(f"{tmp_path}/star"), 2
    trips = spark.sql(TRIPS).drop("source_id").coalesce(1)
    trips.write.parquet(f"{tmp_path}/one")
    part = next((tmp_path / "one").glob("*.parquet"))
    source.mkdir()
    for n in range(14):
        shutil.copy(part, source / f"f{n:03d}.parquet")
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        stream = file_stream(spark, trips.schema, str(source), files_per_trigger=1)
        stream_contributions(stream, store, f"{tmp_path}/checkpoint", fanout=fanout).awaitTermination()
        whole = spark.read.parquet(str(source))
        assert fact_rows(store.fact(spark)) == fact_rows(full_fact(whole))
        assert store.manifest(spark).count() == 14
        assert len(store.batches(spark)) <= (fanout - 1) * 4  # 2 ** 4 > 14
        assert len([f for f in store.commits.read(spark).inputFiles() if "/manifest/seq=" in f]) <= 64
        store.vacuum(spark, grace_seconds=-60)
        assert fact_rows(store.fact(spark)) == fact_rows(full_fact(whole))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)


def test_compaction_leaves_replaced_versions_behind(spark, tmp_path):
    store, trips = StarStore(f"{tmp_path}/star"), spark.sql(TRIPS).where("source_id = 'green_2023'")

    def sources(last, amount):
        parts = [trips.withColumns({"source_id": F.lit(f"s{n}"), "monto_total": F.lit(amount if n == 2 else float(n))}) for n in range(1, last + 1)]
        return reduce(lambda a, b: a.unionByName(b), parts)

    for last in range(1, 5):
        now = sources(last, 2.0 if last < 4 else 99.0)  # the fourth refresh also replaces s2
        store.refresh(spark, now, prints(now))
    assert len(store.batches(spark)) == 3 and store.compact(spark, fanout=4) == []
    made = store.compact(spark, fanout=3)
    assert made == store.batches(spark) and made[0].startswith("b-1-")
    held = spark.read.parquet(f"{store.contributions_path}/{made[0]}")
    assert held.count() == held.select("source_id").distinct().count() == 4
    assert fact_rows(store.fact(spark)) == fact_rows(full_fact(now))
    assert not store.refresh(spark, now, prints(now))
    assert len(store.vacuum(spark, grace_seconds=-60)) == 4  # the batches before; no commit is covered by a checkpoint


def test_overtaken_writers_fail_and_hide_nothing(spark, tmp_path, monkeypatch):
    store, trips, lookup = StarStore(f"{tmp_path}/star"), spark.sql(TRIPS), spark.sql(ZONES)
    green, fhv = trips.where("source_id = 'green_2023'"), trips.where("source_id <> 'green_2023'")
    stage = StarStore.stage

    def overtaken(self, prepared):
        monkeypatch.setattr(StarStore, "stage", stage)
        store.refresh(spark, green, prints(green))
        return stage(self, prepared)

    monkeypatch.setattr(StarStore, "stage", overtaken)
    with pytest.raises(CommitConflict):
        store.refresh(spark, fhv, prints(fhv))
    assert fact_rows(store.fact(spark)) == fact_rows(full_fact(green))

    check = star_refresh.require_unique

    def published_meanwhile(*arguments):
        monkeypatch.setattr(star_refresh, "require_unique", check)
        store.publish(spark, lookup)
        return check(*arguments)

    monkeypatch.setattr(star_refresh, "require_unique", published_meanwhile)
    with pytest.raises(CommitConflict):
        store.publish(spark, lookup)
    assert store.publications.last(spark) == 1


def test_canonical_types_and_lineage(spark):
    raw = spark.sql(
        "SELECT 7 AS VendorID, '2024-01-07 10:00:00' AS tpep_pickup_datetime, timestamp_ntz'2024-01-07 10:01:30' AS tpep_dropoff_datetime, "
        "'x' AS Airport_fee, 3 AS `pu locationid`, 'N' AS store_and_fwd_flag, 'drop me' AS other"
    )
    got = canonicalise(raw, "yellow", 2024)
    row = got.first()
    assert dict(got.dtypes)["vendor_id"] == "string" and row.vendor_id == "7"
    assert (row.duracion_segundos, row.duracion_minutos, row.pickup_day_of_week, row.airport_fee) == (90, 1.5, 1, None)
    assert row.pickup_location_id == 3 and row.store_and_fwd_flag == "N" and "other" not in got.columns
    traced = {r.canonical: (r.source, r.created) for r in lineage(spark, raw, "yellow").collect()}
    assert traced["vendor_id"] == ("vendorid", True) and traced["airport_fee"] == ("airport_fee", False) and traced["peajes"] == (None, True)


def test_high_volume_candidates(spark):
    raw = spark.sql("SELECT 4.5D AS trip_miles, 'Y' AS shared_request_flag, 20.0D AS base_passenger_fare")
    strict = canonicalise(raw, "fhvhv", 2024).first()
    assert (strict.distancia_millas, strict.shared_ride_flag, strict.monto_base, strict.monto_total) == (None, None, 20.0, 20.0)
    full = canonicalise(raw, "fhvhv", 2024, HIGH_VOLUME_SOURCES).first()
    assert (full.distancia_millas, full.shared_ride_flag) == (4.5, 1)


def test_rows_are_shuffled_once_for_a_batch_and_without_their_version(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(StarStore, "_write", lambda self, frame, level: made.append(frame) or "b-0-none")
    monkeypatch.setattr(StarStore, "commit", lambda *args: 1)
    trips = spark.sql("SELECT 'green' AS tipo_dataset, 2024 AS anio, 'a' AS source_id")
    prints = spark.sql("SELECT 'a' AS source_id, 'f' AS fingerprint")
    assert StarStore(str(tmp_path)).refresh(spark, trips, prints)
    plan = made[0]._jdf.queryExecution().analyzed().toString()
    aggregate = next(line for line in plan.splitlines() if "Aggregate [" in line)
    assert "source_id" in aggregate.split("], [")[0] and "version" not in aggregate.split("], [")[0]


def test_only_months_of_several_sources_are_merged(spark, tmp_path, monkeypatch):
    store = StarStore(f"{tmp_path}/star")
    trips = spark.sql(TRIPS)
    shared = trips.where("pickup_datetime IS NULL").withColumn("source_id", F.lit("fhv_2024"))  # undated trips of two sources
    untyped = trips.where("tipo_dataset IS NULL").withColumns({"source_id": F.lit("fhv_2024"), "ratecode_id": F.lit(1)})
    merged, merge = [], star.merge_contributions
    monkeypatch.setattr(star, "merge_contributions", lambda frame: merged.append(frame) or merge(frame))
    for now in (trips, trips.unionByName(shared), trips.unionByName(shared).unionByName(untyped)):
        store.refresh(spark, now, prints(now), dataset=F.lit(None).cast("string"))
        whole = merge(star.fact_contribution(star.star_input(now, F.lit(None).cast("string"))))
        fact = store.fact(spark)
        assert fact.columns == whole.columns and fact_rows(fact) == fact_rows(whole)
    assert [frame.count() for frame in merged] == [2, 4]


def test_grouping_scans_are_small_and_batches_are_not(spark, tmp_path, monkeypatch):
    key, sizes, write = "spark.sql.files.maxPartitionBytes", [], StarStore._write
    held = spark.conf.get(key)
    monkeypatch.setattr(StarStore, "_write", lambda self, frame, level: sizes.append(spark.conf.get(key)) or write(self, frame, level))
    store, trips = StarStore(f"{tmp_path}/star"), spark.sql(TRIPS)
    for kept in ("green_2023", "fhv_2023"):
        now = trips.where(F.col("source_id") >= kept)
        store.refresh(spark, now, prints(now))
    store.compact(spark, 2)
    assert sizes == [f"{16 << 20}b", f"{16 << 20}b", held] and spark.conf.get(key) == held
    spark.conf.set(key, "1m")
    try:
        store.refresh(spark, trips, prints(trips), force=True)
        assert sizes[-1] == "1m"
    finally:
        spark.conf.set(key, held)


def test_one_source_shuffles_no_stored_trips(spark, monkeypatch):
    from suite import incremental, trips

    stored, write = [], incremental.overwrite_partitions
    monkeypatch.setattr(incremental, "overwrite_partitions", lambda df, *rest: stored.append(df) or write(df, *rest))
    data = "/root/testdata/sf0.001"
    got = incremental.one_source(spark, data)
    plan = stored[0]._jdf.queryExecution().analyzed().toString()
    assert "RebalancePartitions" not in plan and not {"dropoff_datetime", "store_and_fwd_flag"} & set(stored[0].columns)
    assert got.count() == trips.fact(spark, data).count()


def test_a_merge_that_fills_the_next_level_takes_it_along(spark, tmp_path, monkeypatch):
    store, trips = StarStore(f"{tmp_path}/star"), spark.sql(TRIPS).where("source_id = 'green_2023'")
    levels, write = [], StarStore._write
    monkeypatch.setattr(StarStore, "_write", lambda self, frame, level: levels.append(level) or write(self, frame, level))
    for last in range(1, 5):
        parts = [trips.withColumns({"source_id": F.lit(f"s{n}"), "monto_total": F.lit(float(n))}) for n in range(1, last + 1)]
        now = reduce(lambda a, b: a.unionByName(b), parts)
        store.refresh(spark, now, prints(now))
        store.compact(spark, fanout=2)
    assert levels == [0, 0, 1, 0, 0, 2]  # two merges of the fourth refresh are one
    assert len(store.batches(spark)) == 1 and store.manifest(spark).count() == 4
    assert fact_rows(store.fact(spark)) == fact_rows(full_fact(now))
