"""Names, casts, canonical layout, dates, predicates, sorts, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from orebelt.contract import CANONICAL_FIELDS
from orebelt.functions import values as v
from orebelt.functions.names import resolve, resolve_first_value, with_snake_names
from orebelt.operators import reports
from orebelt.operators.canonical import lineage
from orebelt.operators.enrich import with_trip_parts
from orebelt.operators.shape import bernoulli_sample, conform, keep_ordered, union_by_name
from suite import trips as t
from suite.registry import query, rounded, with_ctes

_PU, _DO = "tpep_pickup_datetime", "tpep_dropoff_datetime"


@query(
    "can_trips",
    with_ctes(
        t.TRIPS,
        t.canon_cte(),
        select="SELECT * REPLACE (pickup_date::VARCHAR AS pickup_date, round(duracion_minutos, 6) AS duracion_minutos, "
        + ", ".join(f"round({c}, 6) AS {c}" for c in ("distancia_millas", "monto_base", "monto_total", "propina", "peajes"))
        + ") FROM canon",
    ),
)
def canonical(spark, sf_dir):
    """Canonical layout of every trip."""
    return rounded(t.canonical(spark, sf_dir).withColumn("pickup_date", F.col("pickup_date").cast("string")))


# Canonical column and the source name, in snake case, that feeds it in the derived trips.
_LINEAGE = {
    "pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime", "pickup_location_id": "pulocationid",
    "dropoff_location_id": "dolocationid", "distancia_millas": "trip_distance", "monto_base": "fare_amount", "monto_total": "total_amount",
    "propina": "tip_amount", "peajes": "tolls_amount", "extra": "extra", "mta_tax": "mta_tax", "improvement_surcharge": None,
    "congestion_surcharge": "congestion_surcharge", "airport_fee": "airport_fee", "cbd_congestion_fee": None, "ehail_fee": "ehail_fee",
    "payment_type": "payment_type", "passenger_count": "passenger_count", "vendor_id": "vendorid", "ratecode_id": "ratecodeid",
    "trip_type": "trip_type", "shared_ride_flag": "sr_flag",
}


@query(
    "can_lineage",
    with_ctes(
        t.TRIPS,
        t.canon_cte(),
        select="SELECT canonical, source, source IS NULL OR source <> canonical AS created, filled FROM (SELECT "
        + ", ".join(f"count({c}) AS {c}" for c in _LINEAGE)
        + f" FROM canon) UNPIVOT (filled FOR canonical IN ({', '.join(_LINEAGE)})) JOIN (VALUES "
        + ", ".join(f"('{c}', {'NULL' if source is None else repr(source)})" for c, source in _LINEAGE.items())
        + ") AS m(name, source) ON name = canonical",
    ),
)
def can_lineage(spark, sf_dir):
    """Source of every canonical column and how many values it delivered."""
    raw = t.raw_trips(spark, sf_dir)
    names = [f.name for f in CANONICAL_FIELDS]
    filled = t.canonical(spark, sf_dir).agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "canonical", "filled")
    return lineage(spark, raw, "trips").join(filled, "canonical").select("canonical", "source", "created", "filled")


@query(
    "prj_snake_names",
    with_ctes(
        t.TRIPS,
        select="""SELECT "VendorID" AS vendorid, "PULocationID" AS pulocationid, "Airport_fee" AS airport_fee,
  count(*) AS trips FROM trips GROUP BY 1, 2, 3""",
    ),
)
def snake(spark, sf_dir):
    """snake_case names; two source spellings that meet get a suffix elsewhere in tests."""
    return (
        with_snake_names(t.raw_trips(spark, sf_dir))
        .groupBy("vendorid", "pulocationid", "airport_fee")
        .agg(F.count(F.lit(1)).alias("trips"))
    )


@query(
    "prj_conform_schema",
    with_ctes(
        t.TRIPS,
        select="""SELECT "PULocationID"::BIGINT AS pulocationid, round("Airport_fee", 6) AS airport_fee,
  try_cast(trim("VendorID") AS INTEGER) AS vendorid, NULL::DOUBLE AS tip_percent, count(*) AS trips FROM trips GROUP BY ALL""",
    ),
)
def conformed(spark, sf_dir):
    """Cast, case-insensitive match and NULL for the absent column in one projection."""
    schema = {"pulocationid": "bigint", "airport_fee": "double", "vendorid": "int", "tip_percent": "double"}
    return rounded(conform(t.raw_trips(spark, sf_dir), schema).groupBy(*schema).agg(F.count(F.lit(1)).alias("trips")))


@query(
    "prj_first_candidate",
    with_ctes(
        t.TRIPS,
        select="""SELECT trip_type AS first_existing, coalesce(trip_type, "SR_Flag", "RatecodeID") AS first_value,
  count(*) AS trips FROM trips GROUP BY ALL""",
    ),
)
def candidates(spark, sf_dir):
    """First existing column against row-wise first value over the candidates."""
    raw = t.raw_trips(spark, sf_dir)
    names = ("missing_one", "trip_type", "sr_flag", "ratecodeid")
    picked = raw.select(
        resolve(raw, names, "int")[0].alias("first_existing"), resolve_first_value(raw, names, "int").alias("first_value")
    )
    return picked.groupBy("first_existing", "first_value").agg(F.count(F.lit(1)).alias("trips"))


@query(
    "prj_keys_and_sentinels",
    with_ctes(
        *t.STAR[:3],
        select="""SELECT time_id, hora_id, k_trip AS trip_type, k_shared AS shared_ride_flag,
  tipo_dataset || '|' || provider_id AS provider_key, count(*) AS trips FROM prep GROUP BY ALL""",
    ),
)
def keys(spark, sf_dir):
    """Month, hour and code keys with sentinels; composite provider key."""
    c = t.canonical(spark, sf_dir)
    provider = F.coalesce(v.blank_to_null(F.col("vendor_id")), v.blank_to_null(F.col("dispatching_base_num")), F.lit("NO_INFO"))
    return (
        c.select(
            v.month_key(F.col("pickup_datetime"), F.col("anio"), F.col("pickup_month")).alias("time_id"),
            v.hour_key(F.col("pickup_hour"), F.col("pickup_datetime")).alias("hora_id"),
            v.or_sentinel(F.col("trip_type")).alias("trip_type"),
            v.or_sentinel(F.col("shared_ride_flag")).alias("shared_ride_flag"),
            F.concat_ws("|", "tipo_dataset", provider).alias("provider_key"),
        )
        .groupBy("time_id", "hora_id", "trip_type", "shared_ride_flag", "provider_key")
        .agg(F.count(F.lit(1)).alias("trips"))
    )


@query(
    "prj_trip_parts",
    with_ctes(
        t.TRIPS,
        select=f"""SELECT hour({_PU})::INT AS pickup_hour, (dayofweek({_PU}) + 1)::INT AS pickup_day, month({_PU})::INT AS pickup_month,
  year({_PU})::INT AS pickup_year, count(*) AS trips, round(sum(date_diff('second', {_PU}, {_DO}) / 60.0), 4) AS minutes
FROM trips GROUP BY 1, 2, 3, 4""",
    ),
)
def parts(spark, sf_dir):
    derived = with_trip_parts(t.raw_trips(spark, sf_dir))
    return derived.groupBy("pickup_hour", "pickup_day", "pickup_month", "pickup_year").agg(
        F.count(F.lit(1)).alias("trips"), F.round(F.sum("trip_duration_minutes"), 4).alias("minutes")
    )


@query(
    "flt_predicates",
    with_ctes(
        t.TRIPS,
        select=f"""SELECT taxi_type, count(*) FILTER ({_PU} IS NOT NULL) AS dated, count(*) FILTER (fare_amount >= 0) AS not_negative,
  count(*) FILTER (trip_distance BETWEEN 0.1 AND 500) AS in_range,
  count(*) FILTER (payment_type BETWEEN 1 AND 6 OR payment_type IS NULL) AS known_or_null,
  count(*) FILTER (date_diff('second', {_PU}, {_DO}) <= 86400) AS within_a_day,
  count(*) FILTER ({_PU} >= TIMESTAMP '1996-01-01' AND {_PU} < TIMESTAMP '2001-01-01') AS in_period,
  count(*) FILTER (year({_PU}) < 1996 OR year({_PU}) > 2000) AS outside_years,
  count(*) FILTER (strftime({_PU}, '%Y-%m') ~ '^[0-9]{{4}}-(0[1-9]|1[0-2])$') AS month_like,
  count(*) FILTER (store_and_fwd_flag IN ('A', 'N')) AS flagged FROM trips GROUP BY 1""",
    ),
)
def predicates(spark, sf_dir):
    """One pass over all filter forms as conditional counts."""
    pu, do = F.col(_PU), F.col(_DO)
    low, high = (F.lit(d).cast("timestamp_ntz") for d in t.DATES)
    tests = {
        "dated": pu.isNotNull(),
        "not_negative": F.col("fare_amount") >= 0,
        "in_range": F.col("trip_distance").between(0.1, 500),
        "known_or_null": F.col("payment_type").between(1, 6) | F.col("payment_type").isNull(),
        "within_a_day": v.elapsed_seconds(pu, do) <= 86400,
        "in_period": (pu >= low) & (pu < high),
        "outside_years": (F.year(pu) < 1996) | (F.year(pu) > 2000),
        "month_like": F.date_format(pu, "yyyy-MM").rlike(r"^\d{4}-(0[1-9]|1[0-2])$"),
        "flagged": F.col("store_and_fwd_flag").isin("A", "N"),
    }
    return t.raw_trips(spark, sf_dir).groupBy("taxi_type").agg(*[F.count_if(c).alias(n) for n, c in tests.items()])


@query(
    "flt_year_range",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' AND o_orderstatus = 'F'",
)
def year_range(spark, sf_dir):
    """Range and equality on raw columns, both pushed to the scan."""
    orders = t.table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    in_range = (day >= F.lit("1996-01-01").cast("timestamp_ntz")) & (day < F.lit("1998-01-01").cast("timestamp_ntz"))
    return orders.where(in_range & (F.col("o_orderstatus") == "F")).select("o_orderkey", "o_orderstatus")


@query(
    "set_union_by_name",
    """SELECT kind, nation, count(*) AS members, round(sum(balance), 2) AS balance, count(segment) AS segments FROM (
  SELECT 'customer' AS kind, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer
  UNION ALL SELECT 'supplier', s_nationkey, s_acctbal, NULL FROM supplier) GROUP BY 1, 2""",
)
def union(spark, sf_dir):
    """Catalogs with different columns and order united by name."""
    customers = t.table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind")
    )
    return union_by_name([customers, suppliers]).groupBy("kind", "nation").agg(
        F.count(F.lit(1)).alias("members"),
        F.round(F.sum("balance"), 2).alias("balance"),
        F.count("segment").alias("segments"),
    )


@query("set_distinct_keys", with_ctes(t.TRIPS, select="""SELECT DISTINCT taxi_type, "PULocationID", payment_type FROM trips"""))
def distinct_keys(spark, sf_dir):
    return t.raw_trips(spark, sf_dir).select("taxi_type", "PULocationID", "payment_type").distinct()


@query(
    "srt_top_10",
    "SELECT l_partkey, count(*) AS lines FROM lineitem GROUP BY 1 ORDER BY lines DESC, l_partkey LIMIT 10",
)
def top_10(spark, sf_dir):
    counts = t.table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("lines"))
    return counts.orderBy(F.desc("lines"), "l_partkey").limit(10)


@query(
    "srt_mixed_null_order",
    with_ctes(
        t.TRIPS,
        select="""SELECT taxi_type, trip_type, "SR_Flag", count(*) AS trips FROM trips GROUP BY 1, 2, 3
ORDER BY trip_type ASC NULLS FIRST, "SR_Flag" DESC NULLS LAST, taxi_type""",
    ),
)
def mixed_order(spark, sf_dir):
    grouped = t.raw_trips(spark, sf_dir).groupBy("taxi_type", "trip_type", "SR_Flag").agg(F.count(F.lit(1)).alias("trips"))
    return grouped.orderBy(F.asc_nulls_first("trip_type"), F.desc_nulls_last("SR_Flag"), "taxi_type")


@query("srt_sample")
def sample(spark, sf_dir):
    """Bernoulli sample of a tenth of a whole table."""
    lines = t.table(spark, sf_dir, "lineitem")
    return bernoulli_sample(lines).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("sampled"))


@query(
    "win_growth",
    """WITH y AS (SELECT c_mktsegment AS segment, year(o_orderdate)::INT AS year, count(*) AS orders
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT segment, arg_min(orders, year) AS first_value, arg_max(orders, year) AS last_value,
  round((arg_max(orders, year) - arg_min(orders, year)) / arg_min(orders, year) * 100, 6) AS growth_pct FROM y GROUP BY 1""",
)
def growth(spark, sf_dir):
    orders, customer = t.table(spark, sf_dir, "orders"), t.table(spark, sf_dir, "customer")
    yearly = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .groupBy(F.col("c_mktsegment").alias("segment"), F.year("o_orderdate").alias("year"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    return rounded(reports.growth(yearly, ["segment"], "year", "orders"))


@query(
    "prj_ordered_columns",
    with_ctes(
        t.TRIPS,
        select="""SELECT "PULocationID" AS pulocationid, "Airport_fee" AS airport_fee, count(*) AS trips FROM trips GROUP BY 1, 2""",
    ),
)
def ordered(spark, sf_dir):
    """Keep list in canonical order; absent names are skipped."""
    kept = keep_ordered(t.raw_trips(spark, sf_dir), ["pulocationid", "absent"], ["airport_fee"])
    return kept.groupBy("pulocationid", "airport_fee").agg(F.count(F.lit(1)).alias("trips"))


@query(
    "fn_scalar_functions",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'high' ELSE 'low' END AS band, coalesce(nullif(o_orderstatus, 'O'), '-') AS status,
  greatest(o_totalprice, 200000) AS at_least, length(trim(o_orderpriority)) AS size, o_orderstatus || '|' || o_orderpriority AS pair,
  substr(o_orderpriority, 3, 4) AS part, o_orderpriority ~ '^[12]' AS urgent, regexp_extract(o_orderpriority, '([A-Z]+)', 1) AS word,
  strftime(o_orderdate, '%Y-%m') AS month, (dayofweek(o_orderdate) + 1)::INT AS weekday,
  ceil(month(o_orderdate) / 3.0)::BIGINT AS quarter, abs(o_totalprice - 200000) AS distance, round(ln(1 + o_totalprice), 9) AS log_price,
  round_even(o_totalprice / 1000, 1) AS thousands, try_cast(o_orderpriority AS INTEGER) AS not_a_number FROM orders""",
)
def scalars(spark, sf_dir):
    """The scalar functions in use, one column each."""
    price, text, day = F.col("o_totalprice"), F.col("o_orderpriority"), F.col("o_orderdate")
    return t.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(price > 300000, "high").otherwise("low").alias("band"),
        F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("O")), F.lit("-")).alias("status"),
        F.greatest(price, F.lit(200000.0)).alias("at_least"),
        F.length(F.trim(text)).cast("long").alias("size"),
        F.concat_ws("|", "o_orderstatus", text).alias("pair"),
        F.substring(text, 3, 4).alias("part"),
        text.rlike("^[12]").alias("urgent"),
        F.regexp_extract(text, "([A-Z]+)", 1).alias("word"),
        F.date_format(day, "yyyy-MM").alias("month"),
        F.dayofweek(day).alias("weekday"),
        F.ceil(F.month(day) / F.lit(3.0)).alias("quarter"),
        F.abs(price - 200000).alias("distance"),
        F.round(F.log1p(price), 9).alias("log_price"),
        F.bround(price / 1000, 1).alias("thousands"),
        text.try_cast("int").alias("not_a_number"),
    )
