"""Fingerprints, change detection, replaceable contributions, streaming refresh."""

from __future__ import annotations

from pyspark.sql import functions as F

from orebelt.operators import incremental as inc
from orebelt.operators.canonical import canonicalise
from orebelt.operators.star import INPUT_COLUMNS
from orebelt.plans.row_index import RowIndex
from orebelt.plans.star_refresh import StarStore
from orebelt.sources.sinks import overwrite_partitions
from orebelt.session import scratch_path
from orebelt.streaming.refresh import file_stream, stream_contributions
from suite import trips as t
from suite.registry import query, rounded, with_ctes

_ORDER = ("pickup_month", "pickup_hour", "pickup_location_id", "payment_type")
_DIGEST = "sha256(o_orderkey || '|' || o_custkey || '|' || epoch_us(o_orderdate))"


def _finger(name: str, where: str = "") -> str:
    words = ", ".join(
        f"sum(('0x' || substr({_DIGEST}, {16 * i + 1}, 16))::UBIGINT::HUGEINT)::VARCHAR AS w{i}" for i in range(4)
    )
    return (
        f"{name} AS (SELECT source_id, sha256(part_files || '|' || total_bytes || '|' || w0 || '|' || w1 || '|' || w2 || '|' || w3) AS fingerprint, "
        "part_files, total_bytes, latest_modified FROM (SELECT c_mktsegment || '_' || c_nationkey AS source_id, count(*) AS part_files, "
        f"sum(o_custkey)::BIGINT AS total_bytes, max(o_orderdate) AS latest_modified, {words} "
        f"FROM orders JOIN customer ON o_custkey = c_custkey {where} GROUP BY 1))"
    )


def _fingerprints(spark, sf_dir, before=None):
    """Orders as files of sources; a source is a market segment and nation."""
    orders, customer = t.table(spark, sf_dir, "orders"), t.table(spark, sf_dir, "customer")
    if before:
        orders = orders.where(F.col("o_orderdate") < F.lit(before).cast("timestamp_ntz"))
    files = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.concat_ws("_", "c_mktsegment", "c_nationkey").alias("source_id"),
        F.col("o_orderkey").cast("string").alias("path"),
        F.col("o_custkey").alias("size_bytes"),
        F.timestamp_micros(
            F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("o_orderdate"))
        ).alias("modified_at"),
    )
    return inc.source_fingerprints(files)


@query("inc_source_fingerprints", with_ctes(_finger("f"), select="SELECT * REPLACE (epoch_us(latest_modified) AS latest_modified) FROM f"))
def fingerprints(spark, sf_dir):
    prints = _fingerprints(spark, sf_dir)
    return prints.withColumn("latest_modified", F.unix_micros("latest_modified"))


@query(
    "inc_changed_sources",
    with_ctes(
        _finger("was", "WHERE o_orderdate < TIMESTAMP '1995-01-20'"),
        _finger("now"),
        select="""SELECT coalesce(now.source_id, was.source_id) AS source_id, now.fingerprint, was.fingerprint AS previous_fingerprint,
  CASE WHEN now.fingerprint IS NULL THEN 'gone' WHEN was.fingerprint IS NULL THEN 'new' WHEN now.fingerprint <> was.fingerprint THEN 'changed'
       ELSE 'unchanged' END AS change FROM now FULL JOIN was ON now.source_id = was.source_id""",
    ),
)
def changed_sources(spark, sf_dir):
    """Sources now against the state early in the first month."""
    return inc.compare_sources(_fingerprints(spark, sf_dir), _fingerprints(spark, sf_dir, "1995-01-20"))


@query(
    "inc_pending",
    with_ctes(
        t.TRIPS,
        select="""SELECT DISTINCT taxi_type, file_year, file_month FROM trips EXCEPT
SELECT DISTINCT taxi_type, file_year, file_month FROM trips WHERE ehail_fee IS NOT NULL OR trip_type IS NOT NULL""",
    ),
)
def pending(spark, sf_dir):
    """Months not processed yet; months with typed trips count as processed."""
    raw, keys = t.raw_trips(spark, sf_dir), ["taxi_type", "file_year", "file_month"]
    done = raw.where("ehail_fee IS NOT NULL OR trip_type IS NOT NULL")
    return inc.pending(raw.select(*keys).distinct(), done, keys)


@query(
    "inc_pending_months",
    with_ctes(
        t.TRIPS,
        "a AS (SELECT DISTINCT taxi_type AS dataset, file_year AS year, file_month AS month FROM trips)",
        "d AS (SELECT DISTINCT taxi_type AS dataset, file_year AS year, file_month AS month FROM trips WHERE file_month < 7)",
        "p AS (SELECT DISTINCT taxi_type AS dataset, file_year AS year FROM trips WHERE trip_type IS NOT NULL)",
        select="""SELECT * FROM a WHERE (dataset, year) IN (SELECT (dataset, year) FROM p) AND (dataset, year) IN
    (SELECT (dataset, year) FROM (SELECT * FROM a EXCEPT SELECT * FROM d))
UNION ALL SELECT * FROM (SELECT * FROM a EXCEPT SELECT * FROM d) WHERE (dataset, year) NOT IN (SELECT (dataset, year) FROM p)""",
    ),
)
def pending_months(spark, sf_dir):
    """Months to profile; a year that has a profile is redone as a whole."""
    raw = t.raw_trips(spark, sf_dir).select(
        F.col("taxi_type").alias("dataset"), F.col("file_year").alias("year"), F.col("file_month").alias("month"), "trip_type"
    )
    months = raw.select("dataset", "year", "month").distinct()
    profiled = raw.where("trip_type IS NOT NULL").select("dataset", "year").distinct()
    return inc.pending_months(months, months.where("month < 7"), profiled)


@query(
    "inc_latest_state",
    """SELECT user_id, event_type, round(value, 6) AS value, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def latest_state(spark, sf_dir):
    """Last entry per user of the event table."""
    log = t.table(spark, sf_dir, "events").select("user_id", "event_type", "value", "event_id")
    return rounded(inc.latest_state(log, "user_id", "event_id"))


def _sources(spark, sf_dir):
    """Trips as a table partitioned by source, in the canonical columns that a refresh reads.

    It is written by the tasks that join the trips: bringing each source together would shuffle
    all of them once more. In the order of a few fact keys rows compress better, here and where
    they are shuffled for their contributions.
    """
    raw = t.dealt_trips(spark, sf_dir, 4 * t.PER_TASK)
    trips = canonicalise(raw, F.col("taxi_type"), F.col("file_year"))
    read = [c for c in trips.columns if c in INPUT_COLUMNS]
    trips = trips.select(*read, F.concat_ws("_", "tipo_dataset", "anio").alias("source_id"))
    path = scratch_path(spark, "canonical")
    overwrite_partitions(trips.sortWithinPartitions("source_id", *_ORDER), path, ["source_id"], "zstd")
    return spark.read.parquet(path)


def _prints(trips):
    """Fingerprint of a source from its contents: rows and time span."""
    return trips.groupBy("source_id").agg(
        F.sha2(F.concat_ws("|", F.count(F.lit(1)), F.min("pickup_datetime"), F.max("pickup_datetime")), 256).alias("fingerprint")
    )


@query("inc_equals_full", with_ctes(*t.STAR, select=f"SELECT {t.FACT_OUT} FROM fact"))
def equals_full(spark, sf_dir):
    """Two refreshes, the second with changed, new and vanished sources; equals a full build.

    The first state has half of each year's trips and one source that is gone later.
    """
    store = StarStore(scratch_path(spark, "star"))
    trips = _sources(spark, sf_dir)
    early = trips.where("pickup_month <= 6 AND anio < 2000").withColumn(
        "source_id", F.when(F.col("anio") == 1995, "vanishing").otherwise(F.col("source_id"))
    )
    store.refresh(spark, early, _prints(early))
    store.refresh(spark, trips, _prints(trips))
    return rounded(store.fact(spark), 6, **t.FACT_DIGITS)


@query("inc_one_source", with_ctes(*t.STAR, select=f"SELECT {t.FACT_OUT} FROM fact"))
def one_source(spark, sf_dir):
    """Refresh of the single source that changed, read from a table partitioned by source."""
    store = StarStore(scratch_path(spark, "star"))
    trips = _sources(spark, sf_dir)
    before = trips.where("source_id <> 'green_1997' OR pickup_month <= 6")
    store.refresh(spark, before, _prints(before))
    store.refresh(spark, trips, _prints(trips))
    return rounded(store.fact(spark), 6, **t.FACT_DIGITS)


@query("inc_compacted", with_ctes(*t.STAR, select=f"SELECT {t.FACT_OUT} FROM fact"))
def compacted(spark, sf_dir):
    """One refresh for each further year, merged two by two; the fact comes from few batches."""
    store = StarStore(scratch_path(spark, "star"))
    trips = _sources(spark, sf_dir)
    years = sorted(row[0] for row in trips.select("anio").distinct().collect())
    for last in (*years[1::2], years[-1]):
        until = trips.where(F.col("anio") <= last)
        if store.refresh(spark, until, _prints(until)):
            store.compact(spark, fanout=2)
    return rounded(store.fact(spark), 6, **t.FACT_DIGITS)


@query("str_contribution_refresh", with_ctes(*t.STAR, select=f"SELECT {t.FACT_OUT} FROM fact"))
def streamed(spark, sf_dir):
    """Line items arrive as a file stream; contributions are kept per file."""
    store = StarStore(scratch_path(spark, "stream-star"))
    lines = t.table(spark, sf_dir, "lineitem")
    arriving = file_stream(spark, lines.schema, f"{sf_dir}/lineitem*.parquet")
    identity = ("source_id", "version")

    def to_canonical(batch):
        raw = t.lines_to_trips(batch, batch.sparkSession, sf_dir, carry=identity)
        return canonicalise(raw, F.col("taxi_type"), F.col("file_year"), carry=identity)

    stream_contributions(arriving, store, scratch_path(spark, "stream-checkpoint"), to_canonical).awaitTermination()
    return rounded(store.fact(spark), 6, **t.FACT_DIGITS)


@query(
    "inc_rows_across_years",
    """SELECT CAST(min(year(o_orderdate)) AS VARCHAR) AS source, o_custkey, o_orderpriority
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY o_custkey, o_orderpriority""",
)
def rows_across_years(spark, sf_dir):
    """Customer and priority of orders, loaded year by year; each pair stays with its first year."""
    orders = t.table(spark, sf_dir, "orders").where("o_orderdate is not null")
    index, kept = RowIndex(scratch_path(spark, "row_index")), None
    years = [r[0] for r in orders.select(F.year("o_orderdate").alias("y")).distinct().orderBy("y").collect()]
    for year in years:
        rows = orders.where(F.year("o_orderdate") == year).select("o_custkey", "o_orderpriority")
        fresh = index.keep_new(rows, str(year)).select(F.lit(str(year)).alias("source"), "o_custkey", "o_orderpriority")
        kept = fresh if kept is None else kept.unionByName(fresh)
        index.table.compact(spark, 4)
    return kept
