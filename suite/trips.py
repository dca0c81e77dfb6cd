"""Trip tables derived from the order tables, in Spark and in SQL.

A line item is a trip: its order gives the pickup time, customer and supplier nations
the zones. Arithmetic on keys spreads missing values, out-of-range values, several
dataset types and repeated records over the whole table; nothing is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.operators.canonical import canonicalise
from orebelt.operators.rules import trip_rules
from orebelt.operators.star import fact_contribution, merge_contributions, star_input
from orebelt.session import materialize

#: Trips that one task groups; with all columns some 400 bytes each, twice while groups are merged.
PER_TASK = 250_000
DATES = ("1996-01-01", "2001-01-01")
RULES = trip_rules(date_range=DATES)
SCOPE = ("taxi_type", "file_year")
TYPES = ("fhv", "fhvhv", "green", "yellow")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# name, Spark expression, DuckDB expression where it differs
_TAXI = "case l_orderkey % 4 when 0 then 'fhv' when 1 then 'fhvhv' when 2 then 'green' else 'yellow' end"
_FARE = "(case when l_partkey % 97 = 0 then -1 else 1 end * l_extendedprice / 100)"
_COLUMNS = (
    ("taxi_type", _TAXI, None),
    ("file_year", "cast(year(o_orderdate) as int)", None),
    ("file_month", "cast(month(o_orderdate) as int)", None),
    (
        "VendorID",
        "case when l_orderkey % 4 >= 2 then case when l_suppkey % 8 = 0 then ' ' "
        "else cast(l_suppkey % 8 as string) end end",
        None,
    ),
    (
        "tpep_pickup_datetime",
        "case when l_partkey % 211 <> 0 then "
        "o_orderdate + make_dt_interval(0, cast((l_orderkey + 5 * l_linenumber) % 24 as int)) end",
        "case when l_partkey % 211 <> 0 then o_orderdate + to_hours((l_orderkey + 5 * l_linenumber) % 24) end",
    ),
    (
        "tpep_dropoff_datetime",
        "case when l_linenumber <> 6 and l_partkey % 211 <> 0 "
        "and not (l_orderkey % 4 = 0 and year(o_orderdate) = 1999) then "
        "o_orderdate + make_dt_interval(0, cast((l_orderkey + 5 * l_linenumber) % 24 as int), "
        "cast(l_partkey % 1600 as int)) end",
        "case when l_linenumber <> 6 and l_partkey % 211 <> 0 "
        "and not (l_orderkey % 4 = 0 and year(o_orderdate) = 1999) then "
        "o_orderdate + to_hours((l_orderkey + 5 * l_linenumber) % 24) + to_minutes(l_partkey % 1600) end",
    ),
    (
        "passenger_count",
        "case when l_linenumber <> 7 then cast(l_linenumber + case when l_partkey % 53 = 0 then 5 else 0 end as int) end",
        None,
    ),
    ("trip_distance", "(l_quantity - 1) / 10", None),
    ("RatecodeID", "cast(l_linenumber as int)", None),
    ("store_and_fwd_flag", "l_returnflag", None),
    ("PULocationID", "c_nationkey", None),
    ("DOLocationID", "s_nationkey", None),
    (
        "payment_type",
        "case when l_linenumber <> 5 then cast(cast(substring(o_orderpriority, 1, 1) as int) "
        "+ case when l_partkey % 40 = 0 then 5 else 0 end as int) end",
        None,
    ),
    ("fare_amount", _FARE, None),
    ("extra", "l_tax", None),
    ("mta_tax", "cast(0.5 as double)", None),
    ("tip_amount", f"{_FARE} * l_discount", None),
    ("tolls_amount", f"{_FARE} * l_tax", None),
    ("total_amount", f"case when l_partkey % 61 <> 0 then {_FARE} * (1 + l_tax) end", None),
    ("congestion_surcharge", "case when l_orderkey % 4 <> 0 then cast(2.5 as double) end", None),
    ("Airport_fee", "case when month(o_orderdate) >= 7 then l_discount end", None),
    ("ehail_fee", "cast(null as double)", None),
    ("trip_type", "case when l_orderkey % 4 = 2 then cast(1 + l_linenumber % 3 as int) end", None),
    ("SR_Flag", "case when l_orderkey % 4 = 0 then cast(l_linenumber % 2 as int) end", None),
    (
        "dispatching_base_num",
        "case when l_orderkey % 4 < 2 then concat('B', lpad(cast(l_suppkey % 40 as string), 5, '0')) end",
        None,
    ),
)
RAW_COLUMNS = tuple(name for name, _, _ in _COLUMNS)
# Each tenth order's records arrive twice.
_COPIES = "case when l_orderkey % 10 = 0 then 2 else 1 end"


def lines_to_trips(lines: DataFrame, spark: SparkSession, sf_dir: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Raw trips of the given line items, in the source layout."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    placed = orders.join(customer, orders.o_custkey == customer.c_custkey)
    joined = lines.join(placed, lines.l_orderkey == placed.o_orderkey).join(
        supplier, lines.l_suppkey == supplier.s_suppkey
    )
    columns = [F.expr(spark_sql).alias(name) for name, spark_sql, _ in _COLUMNS]
    copies = F.explode(F.sequence(F.lit(1), F.expr(_COPIES)))
    return joined.select(*carry, *columns, copies.alias("_copy")).drop("_copy")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips in the source layout: mixed types, drifting values, repeated records."""
    return lines_to_trips(table(spark, sf_dir, "lineitem"), spark, sf_dir)


def dealt_trips(spark: SparkSession, sf_dir: str, per_task: int = PER_TASK) -> DataFrame:
    """The same, each joined in a task of a bounded number of trips, for flows that group or sort them
    where they are joined: adaptive execution merges tasks by bytes, and few bytes are many trips."""
    lines = table(spark, sf_dir, "lineitem").repartition(tasks(spark, sf_dir, per_task), "l_orderkey")
    return lines_to_trips(lines, spark, sf_dir)


def tasks(spark: SparkSession, sf_dir: str, per_task: int = PER_TASK) -> int:
    """Number of tasks that hold some ``per_task`` trips each; rows are counted in the files' footers."""
    rows = table(spark, sf_dir, "lineitem").count() * 11 // 10
    return max(spark.sparkContext.defaultParallelism, -(-rows // per_task))


def stored_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a table, for flows that scan their input more than once: joined once, and each
    scan reads only the columns it needs, in tasks of a bounded number of bytes."""
    return materialize(raw_trips(spark, sf_dir), "raw-trips")


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips in the canonical layout, not cleaned."""
    return canonicalise(raw_trips(spark, sf_dir), F.col("taxi_type"), F.col("file_year"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup: nations without the first three, so that some zones are unknown."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey).where("n_nationkey >= 3")
    return joined.select(
        F.col("n_nationkey").alias("locationid"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.concat(F.lit("S"), F.col("n_regionkey").cast("string")).alias("service_zone"),
    )


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact table of all trips."""
    return merge_contributions(fact_contribution(star_input(canonical(spark, sf_dir))))


# --- The same in SQL -------------------------------------------------------

TRIPS = (
    "trips AS (SELECT * EXCLUDE (_copy) FROM (SELECT "
    + ", ".join(f'{(duck or both).replace(" as string", " as varchar")} AS "{name}"' for name, both, duck in _COLUMNS)
    + f", unnest(range({_COPIES})) AS _copy FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey))"
)

ZONES = (
    "zones AS (SELECT n_nationkey AS locationid, r_name AS borough, n_name AS zone, "
    "'S' || n_regionkey AS service_zone FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey >= 3)"
)


def canon_cte(source: str = "trips", name: str = "canon") -> str:
    return f"""{name} AS (SELECT taxi_type AS tipo_dataset, file_year AS anio,
  tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
  "PULocationID" AS pickup_location_id, "DOLocationID" AS dropoff_location_id, trip_distance AS distancia_millas,
  date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS duracion_segundos,
  date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60.0::DOUBLE AS duracion_minutos,
  fare_amount AS monto_base, total_amount AS monto_total, tip_amount AS propina, tolls_amount AS peajes,
  extra, mta_tax, NULL::DOUBLE AS improvement_surcharge, congestion_surcharge, "Airport_fee" AS airport_fee,
  NULL::DOUBLE AS cbd_congestion_fee, ehail_fee, payment_type, passenger_count::DOUBLE AS passenger_count,
  "VendorID" AS vendor_id, "RatecodeID" AS ratecode_id, trip_type, "SR_Flag" AS shared_ride_flag,
  tpep_pickup_datetime::DATE AS pickup_date, hour(tpep_pickup_datetime)::INT AS pickup_hour,
  (dayofweek(tpep_pickup_datetime) + 1)::INT AS pickup_day_of_week, month(tpep_pickup_datetime)::INT AS pickup_month,
  store_and_fwd_flag, dispatching_base_num FROM {source})"""


PREP = """prep AS (SELECT *,
  CASE WHEN pickup_datetime IS NOT NULL THEN strftime(pickup_datetime, '%Y-%m')
       WHEN anio BETWEEN 1900 AND 2200 AND pickup_month BETWEEN 1 AND 12
         THEN lpad(anio::VARCHAR, 4, '0') || '-' || lpad(pickup_month::VARCHAR, 2, '0')
       ELSE 'SIN_FECHA' END AS time_id,
  coalesce(pickup_hour, -1) AS hora_id,
  coalesce(pickup_location_id, -1) AS k_pu, coalesce(dropoff_location_id, -1) AS k_do,
  coalesce(payment_type, -1) AS k_pay, coalesce(ratecode_id, -1) AS k_rate,
  coalesce(trip_type, -1) AS k_trip, coalesce(shared_ride_flag, -1) AS k_shared,
  coalesce(nullif(trim(vendor_id), ''), nullif(trim(dispatching_base_num), ''), 'NO_INFO') AS provider_id FROM canon)"""

TOTALS = {
    "total_pasajeros": "passenger_count",
    "total_distancia_millas": "distancia_millas",
    "total_duracion_minutos": "duracion_minutos",
    "total_monto_base": "monto_base",
    "total_monto_total": "monto_total",
    "total_propina": "propina",
    "total_peajes": "peajes",
    "total_extra": "extra",
    "total_mta_tax": "mta_tax",
    "total_improvement_surcharge": "improvement_surcharge",
    "total_congestion_surcharge": "congestion_surcharge",
    "total_airport_fee": "airport_fee",
    "total_cbd_congestion_fee": "cbd_congestion_fee",
    "total_ehail_fee": "ehail_fee",
}
AVERAGES = {
    "promedio_distancia_millas": ("total_distancia_millas", "distancia_millas"),
    "promedio_duracion_minutos": ("total_duracion_minutos", "duracion_minutos"),
    "promedio_monto_total": ("total_monto_total", "monto_total"),
    "promedio_propina": ("total_propina", "propina"),
}
KEYS = (
    "time_id", "hora_id", "tipo_dataset", "pickup_location_id", "dropoff_location_id", "payment_type",
    "ratecode_id", "trip_type", "shared_ride_flag", "provider_key",
)

FACT = (
    "sums AS (SELECT time_id, hora_id, tipo_dataset, k_pu AS pickup_location_id, k_do AS dropoff_location_id, "
    "k_pay AS payment_type, k_rate AS ratecode_id, k_trip AS trip_type, k_shared AS shared_ride_flag, "
    "tipo_dataset || '|' || provider_id AS provider_key, count(*) AS cantidad_viajes, "
    + ", ".join(f"sum(coalesce({source}, 0)) AS {total}" for total, source in TOTALS.items())
    + ", "
    + ", ".join(f"count({source}) AS n_{source}" for _, source in AVERAGES.values())
    + " FROM prep GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10),\n"
    "fact AS (SELECT * EXCLUDE ("
    + ", ".join(f"n_{source}" for _, source in AVERAGES.values())
    + "), "
    + ", ".join(
        f"CASE WHEN n_{source} > 0 THEN {total} / n_{source} END AS {name}" for name, (total, source) in AVERAGES.items()
    )
    + " FROM sums)"
)

STAR = (TRIPS, canon_cte(), PREP, FACT)

FACT_OUT = (
    ", ".join(KEYS)
    + ", cantidad_viajes, "
    + ", ".join(f"round({t}, 6) AS {t}" for t in TOTALS)
    + ", "
    + ", ".join(f"round({a}, 9) AS {a}" for a in AVERAGES)
)
FACT_DIGITS = {a: 9 for a in AVERAGES}
