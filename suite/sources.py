"""Scans and sinks: tables are written to the scratch folder in a form and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from orebelt.operators import schema as s
from orebelt.operators.incremental import source_id
from orebelt.plans.bronze import load_bronze_files
from orebelt.session import scratch_path
from orebelt.sources import files, sinks, tables, versions
from suite import trips as t
from suite.registry import query, with_ctes

_TRIP_OUT = "taxi_type, file_year, file_month, count(*) AS trips, round(sum(fare_amount), 4) AS fare"


def _trip_counts(df, *by):
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("trips"), F.round(F.sum("fare_amount"), 4).alias("fare"))


@query("src_parquet_single", "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY 1")
def parquet_single(spark, sf_dir):
    return tables.read_parquet(spark, f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "src_parquet_multi",
    "SELECT coalesce(c_nationkey, s_nationkey) AS nation, count(c_custkey) AS customers, count(s_suppkey) AS suppliers "
    "FROM customer FULL JOIN supplier ON false GROUP BY 1",
)
def parquet_multi(spark, sf_dir):
    """Two tables with different columns read as one."""
    both = tables.read_parquet(spark, f"{sf_dir}/customer.parquet", f"{sf_dir}/supplier.parquet")
    return both.groupBy(F.coalesce("c_nationkey", "s_nationkey").alias("nation")).agg(
        F.count("c_custkey").alias("customers"), F.count("s_suppkey").alias("suppliers")
    )


def _bronze(spark, sf_dir):
    """Trips as Hive partitions by type, year and month."""
    path = scratch_path(spark, "bronze")
    raw = t.raw_trips(spark, sf_dir).withColumnsRenamed(
        {"taxi_type": "tipo_dataset", "file_year": "anio", "file_month": "mes"}
    )
    sinks.load_bronze(raw.hint("rebalance", "tipo_dataset", "anio", "mes"), path)
    return path


@query(
    "src_bronze_load",
    with_ctes(
        t.TRIPS,
        "m AS (SELECT taxi_type, file_year, ((file_month - 1) // 3 * 3 + 1)::INT AS file_month, count(*) AS n FROM trips GROUP BY 1, 2, 3)",
        select="""SELECT taxi_type AS tipo_dataset, file_year AS anio, file_month AS mes, 'loaded' AS bronze_status, NULL AS reason, n::BIGINT AS records, n::BIGINT AS stored FROM m
UNION ALL SELECT 'green', 1990, 1, 'skipped_invalid', 'missing file', NULL, NULL UNION ALL SELECT 'green', 1990, 2, 'skipped_invalid', 'wrong extension', NULL, NULL""",
    ),
)
def bronze_load(spark, sf_dir):
    """Files of a quarter and two bad ones through validation into bronze; audit beside what is stored."""
    keys = ["tipo_dataset", "anio", "mes"]
    raw, text, base = scratch_path(spark, "raw"), scratch_path(spark, "text"), scratch_path(spark, "bronze")
    trips = t.raw_trips(spark, sf_dir).withColumnsRenamed({"taxi_type": "tipo_dataset", "file_year": "anio", "file_month": "mes"})
    trips = trips.withColumn("mes", F.expr("CAST((mes - 1) DIV 3 * 3 + 1 AS INT)"))
    trips.repartition(*keys).write.partitionBy(*keys).parquet(raw)
    spark.range(1).select(F.lit("no table")).coalesce(1).write.text(text)
    place = [F.regexp_extract("path", f"{k}=([^/]+)", 1).cast("string" if k == "tipo_dataset" else "int").alias(k) for k in keys]
    catalog = files.file_inventory(spark, raw, "*.parquet").select("path", *place)
    odd = files.file_inventory(spark, text, "*.txt").select("path", F.lit("green").alias("tipo_dataset"), F.lit(1990).alias("anio"), F.lit(2).alias("mes"))
    gone = spark.createDataFrame([(f"{raw}/none.parquet", "green", 1990, 1)], odd.schema)
    audit = load_bronze_files(spark, catalog.unionByName(odd).unionByName(gone), base)
    stored = spark.read.parquet(base).groupBy(*keys).agg(F.count(F.lit(1)).alias("stored"))
    per_month = audit.groupBy(*keys, "bronze_status", "reason").agg(F.sum("records").alias("records"))
    return per_month.join(stored, keys, "left")


@query(
    "src_partitioned_scan",
    with_ctes(t.TRIPS, select=f"SELECT {_TRIP_OUT} FROM trips WHERE taxi_type IN ('green', 'fhv') AND file_year = 1998 GROUP BY 1, 2, 3"),
)
def partitioned_scan(spark, sf_dir):
    """Bronze partitions written, then read with filters that prune directories."""
    found = tables.read_trips(spark, _bronze(spark, sf_dir), ["green", "fhv"], [1998])
    named = found.withColumnsRenamed({"tipo_dataset": "taxi_type", "anio": "file_year", "mes": "file_month"})
    return _trip_counts(named, "taxi_type", "file_year", "file_month")


@query(
    "src_source_identity",
    with_ctes(t.TRIPS, select="SELECT taxi_type AS source_type, file_year AS source_year, count(*) AS trips FROM trips GROUP BY 1, 2"),
)
def source_identity(spark, sf_dir):
    """Type and year recovered from the names of canonical dataset folders."""
    path = scratch_path(spark, "datasets")
    canonical = t.canonical(spark, sf_dir).withColumn("name", F.concat("tipo_dataset", F.lit("_"), "anio", F.lit(".parquet")))
    canonical.select("pickup_datetime", "name").hint("rebalance", "name").write.partitionBy("name").parquet(path)
    found = tables.with_source_identity(spark.read.parquet(path))
    return found.groupBy("source_type", "source_year").agg(F.count(F.lit(1)).alias("trips"))


@query("src_zone_csv", with_ctes(t.ZONES, select="SELECT * FROM zones"))
def zone_csv(spark, sf_dir):
    """Zone lookup as CSV, read with its fixed schema and cached as Parquet."""
    base = scratch_path(spark, "lookup")
    named = t.zones(spark, sf_dir).toDF("LocationID", "Borough", "Zone", "service_zone")
    named.write.option("header", True).csv(f"{base}/csv")
    return tables.cache_zone_lookup(spark, f"{base}/csv", f"{base}/parquet")


@query(
    "cat_lookup_validation",
    with_ctes(t.ZONES, select="SELECT count(*) AS records, 'valid' AS validation_status, NULL::VARCHAR AS validation_error FROM zones"),
)
def lookup_validation(spark, sf_dir):
    return tables.lookup_issues(t.zones(spark, sf_dir).withColumnsRenamed({"locationid": "LocationID"}))


@query("src_event_log", "SELECT event_type, count(*) AS events, round(sum(value), 4) AS value FROM events GROUP BY 1")
def event_log(spark, sf_dir):
    """Events appended as JSON lines and read back with the strict event schema."""
    path = scratch_path(spark, "log")
    events = t.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.col("event_id").alias("event_seq"),
        F.col("ts").cast("timestamp").alias("occurred_at"),
        F.col("user_id").cast("string").alias("pipeline_id"),
        F.struct(F.col("value").alias("duration_seconds")).alias("payload"),
    )
    sinks.append_events(events, path)
    return tables.read_event_log(spark, path).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.round(F.sum("payload.duration_seconds"), 4).alias("value")
    )


@query("src_json_documents", "SELECT c_mktsegment AS segment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1")
def json_documents(spark, sf_dir):
    """Report rows written as JSON documents and read back."""
    path = scratch_path(spark, "report")
    report = t.table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )
    sinks.write_report(report, path)
    return spark.read.schema(report.schema).json(path)


@query("snk_json_text", """SELECT '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '","s_nationkey":' || s_nationkey || '}' AS document FROM supplier""")
def json_text(spark, sf_dir):
    return sinks.as_document(t.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey"))


@query("src_typed_view", "SELECT o_orderkey::VARCHAR AS o_orderkey, o_totalprice::BIGINT AS o_totalprice, o_orderstatus FROM (SELECT o_orderkey, trunc(o_totalprice) AS o_totalprice, o_orderstatus FROM orders)")
def typed_view(spark, sf_dir):
    """View columns cast to declared types."""
    view = tables.read_typed(spark, f"{sf_dir}/orders.parquet", {"o_orderkey": "string", "o_totalprice": "bigint"})
    return view.select("o_orderkey", "o_totalprice", "o_orderstatus")


@query(
    "snk_partition_overwrite",
    with_ctes(t.TRIPS, select=f"SELECT {_TRIP_OUT.replace('file_month, ', '')} FROM trips GROUP BY 1, 2"),
)
def partition_overwrite(spark, sf_dir):
    """All partitions written, some written again: nothing doubles, nothing is lost."""
    path, scope = scratch_path(spark, "silver"), ["taxi_type", "file_year"]
    trips = t.raw_trips(spark, sf_dir).select(*scope, "fare_amount").hint("rebalance", *scope)
    sinks.overwrite_partitions(trips, path, scope)
    sinks.overwrite_partitions(trips.where("file_year >= 1999"), path, scope)
    return _trip_counts(spark.read.parquet(path), *scope)


@query("snk_versioned_publish", with_ctes(*t.STAR, select="SELECT time_id, sum(cantidad_viajes)::BIGINT AS viajes FROM fact GROUP BY 1"))
def versioned_publish(spark, sf_dir):
    """A second version replaces the first through the pointer."""
    base = scratch_path(spark, "published")
    facts = t.fact(spark, sf_dir).select("time_id", "cantidad_viajes")
    versions.publish_version(facts.where("cantidad_viajes > 1"), base)
    versions.publish_version(facts, base)
    return versions.read_current(spark, base).groupBy("time_id").agg(F.sum("cantidad_viajes").alias("viajes"))


@query("snk_fact_by_month", with_ctes(*t.STAR, select="SELECT time_id, count(*) AS rows FROM fact GROUP BY 1"))
def fact_by_month(spark, sf_dir):
    path = scratch_path(spark, "fact")
    sinks.write_by_month(t.fact(spark, sf_dir), path)
    stored = spark.read.parquet(path)
    return stored.groupBy(F.col("time_id").cast("string").alias("time_id")).agg(F.count(F.lit(1)).alias("rows"))


_NAMES = tuple(
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
)


@query(
    "src_file_inventory",
    " UNION ALL ".join(f"SELECT '{n}.parquet' AS file, count(*) AS records, 'valid' AS validation_status FROM {n}" for n in _NAMES),
)
def file_inventory(spark, sf_dir):
    """The files of the given tables: listed, hashed, signature checked, counted, validated."""
    listed = files.file_inventory(spark, sf_dir, "*.parquet").where(files.table_of(F.col("path"), _NAMES) != "")
    return files.validate_tables(files.probe_files(listed, 8), _NAMES)


@query(
    "src_row_counts",
    "SELECT 'orders.parquet' AS file, count(*) AS records FROM orders UNION ALL SELECT 'customer.parquet', count(*) FROM customer",
)
def row_counts(spark, sf_dir):
    """Rows per table of a scan over two tables, counted by file."""
    both = tables.read_parquet(spark, f"{sf_dir}/orders.parquet", f"{sf_dir}/customer.parquet")
    counted = files.row_counts_by_file(both).withColumn("file", files.table_of(F.col("path"), _NAMES))
    return counted.groupBy("file").agg(F.sum("records").alias("records"))


@query(
    "src_schema_per_period",
    with_ctes(
        t.TRIPS,
        select="""SELECT taxi_type AS dataset, file_year AS year, file_month AS month, unnest(['fare_amount', 'trip_type', 'SR_Flag']) AS "column",
  unnest(['double', 'int', 'int']) AS dtype FROM (SELECT DISTINCT taxi_type, file_year, file_month FROM trips)""",
    ),
)
def schema_per_period(spark, sf_dir):
    """Schemas of stored months, read from the file footers inside tasks."""
    path = scratch_path(spark, "months")
    names = {"taxi_type": "tipo_dataset", "file_year": "anio", "month": "mes"}
    trips = t.raw_trips(spark, sf_dir).select(
        "taxi_type", "file_year", F.format_string("%02d", "file_month").alias("month"), "fare_amount", "trip_type", "SR_Flag"
    ).withColumnsRenamed(names)
    sinks.overwrite_partitions(trips.hint("rebalance", *names.values()), path, list(names.values()))
    probed = files.probe_files(files.file_inventory(spark, path, "*.parquet"), 8, hashes=False)
    return s.snapshot_of_files(files.schemas_by_file(probed))


@query("inc_source_id", "SELECT c_custkey, 'customer_' || lpad(c_custkey::VARCHAR, 9, '0') || '_' || substr(sha1('dir/' || c_name || '.parquet'), 1, 8) AS source_id FROM customer")
def source_ids(spark, sf_dir):
    path = F.concat(F.lit("dir/"), "c_name", F.lit(".parquet"))
    return t.table(spark, sf_dir, "customer").select("c_custkey", source_id(path).alias("source_id"))


@query("snk_overwrite", "SELECT n_regionkey AS region, count(*) AS nations FROM nation GROUP BY 1")
def overwritten(spark, sf_dir):
    """A table replaced whole by another with fewer columns."""
    path = scratch_path(spark, "table")
    sinks.overwrite(t.table(spark, sf_dir, "customer"), path)
    sinks.overwrite(t.table(spark, sf_dir, "nation"), path)
    return spark.read.parquet(path).groupBy(F.col("n_regionkey").alias("region")).agg(F.count(F.lit(1)).alias("nations"))


@query("snk_dimension", "SELECT c_nationkey AS nation, count(*) AS customers, 1::BIGINT AS files FROM customer GROUP BY 1")
def dimension(spark, sf_dir):
    """A dimension as a single file."""
    path = scratch_path(spark, "dimension")
    customers = t.table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("customers"))
    sinks.write_dimension(customers, path)
    stored = spark.read.parquet(path)
    return stored.withColumn("files", F.lit(len(stored.inputFiles())).cast("long"))
