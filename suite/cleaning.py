"""Cleaning rules over derived trips. The SQL applies the rules one after another."""

from __future__ import annotations

from pyspark.sql import functions as F

from orebelt.operators import reports, rules
from orebelt.operators.enrich import with_zones
from orebelt.operators.shape import dedup_by_key, dedup_rows, duplicate_keys
from orebelt.plans.silver import canonical_trips, silver_trips
from orebelt.plans.star_refresh import full_fact
from suite import trips as t
from suite.registry import query, rounded, with_ctes

_PU, _DO = "tpep_pickup_datetime", "tpep_dropoff_datetime"
_YG = "taxi_type IN ('yellow', 'green')"
# rule, dimension, condition to stay (NULL counts as false)
STEPS = (
    ("pickup_datetime_present", "completitud", f"{_PU} IS NOT NULL"),
    ("dropoff_datetime_present", "completitud", f"NOT ({_YG} AND {_DO} IS NULL)"),
    ("monto_total_present", "completitud", f"NOT ({_YG} AND total_amount IS NULL)"),
    ("unique_rows", "unicidad", None),
    ("fare_not_negative", "exactitud", "fare_amount >= 0"),
    ("tip_not_negative", "exactitud", "tip_amount >= 0"),
    ("tolls_not_negative", "exactitud", "tolls_amount >= 0"),
    ("distance_in_range", "razonabilidad", "trip_distance BETWEEN 0.1 AND 500"),
    ("passengers_in_range", "razonabilidad", "passenger_count BETWEEN 0 AND 6"),
    (
        "duration_in_range",
        "razonabilidad",
        f"coalesce(date_diff('second', {_PU}, {_DO}) <= 86400, false) OR (taxi_type, file_year) NOT IN "
        f"(SELECT (taxi_type, file_year) FROM s9 WHERE {_DO} IS NOT NULL)",
    ),
    ("payment_known", "validez", "payment_type BETWEEN 1 AND 6 OR payment_type IS NULL"),
    ("pickup_zone_known", "validez", '"PULocationID" BETWEEN 1 AND 263 OR "PULocationID" IS NULL'),
    ("dropoff_zone_known", "validez", '"DOLocationID" BETWEEN 1 AND 263 OR "DOLocationID" IS NULL'),
    ("pickup_in_period", "oportunidad", f"{_PU} >= TIMESTAMP '1996-01-01' AND {_PU} < TIMESTAMP '2001-01-01'"),
)


def _chain() -> list[str]:
    ctes = ["s0 AS (SELECT * FROM trips)"]
    for i, (_, _, keep) in enumerate(STEPS, start=1):
        body = f"SELECT DISTINCT * FROM s{i - 1}" if keep is None else f"SELECT * FROM s{i - 1} WHERE {keep}"
        ctes.append(f"s{i} AS MATERIALIZED ({body})")
    return ctes


CHAIN = (t.TRIPS, *_chain())
LAST = f"s{len(STEPS)}"

_COUNTS = "counts AS (" + " UNION ALL ".join(
    f"SELECT taxi_type, file_year, {i} AS rule_order, '{dimension}' AS dimension, '{rule}' AS rule, "
    f"(SELECT count(*) FROM s{i - 1} p WHERE p.taxi_type = b.taxi_type AND p.file_year = b.file_year) - "
    f"(SELECT count(*) FROM s{i} p WHERE p.taxi_type = b.taxi_type AND p.file_year = b.file_year) AS removed, original "
    "FROM (SELECT taxi_type, file_year, count(*) AS original FROM s0 GROUP BY 1, 2) b"
    for i, (rule, dimension, _) in enumerate(STEPS, start=1)
) + ")"
_DIMENSIONS = tuple(dict.fromkeys(dimension for _, dimension, _ in STEPS))
_SUMMARY = (
    "summary AS (SELECT taxi_type, file_year, max(original) AS original, sum(removed)::BIGINT AS removed, "
    "(max(original) - sum(removed))::BIGINT AS final, round_even(sum(removed) / max(original) * 100, 2) AS removed_pct, "
    "100 - round_even(sum(removed) / max(original) * 100, 2) AS quality_score, "
    + ", ".join(f"sum(CASE WHEN dimension = '{d}' THEN removed ELSE 0 END)::BIGINT AS removed_{d}" for d in _DIMENSIONS)
    + " FROM counts GROUP BY 1, 2)"
)
_REPORT = (*CHAIN, _COUNTS, _SUMMARY)


@query(
    "cln_rule_counts",
    with_ctes(
        *CHAIN,
        _COUNTS,
        select="SELECT taxi_type, file_year, rule_order, dimension, rule, removed, original, "
        f"CASE WHEN rule IN ('dropoff_datetime_present', 'monto_total_present') AND NOT {_YG} THEN 'not_applicable' "
        f"WHEN rule = 'duration_in_range' AND (taxi_type, file_year) NOT IN (SELECT (taxi_type, file_year) FROM s9 WHERE {_DO} IS NOT NULL) "
        "THEN 'not_applicable' ELSE 'applied' END AS status FROM counts",
    ),
)
def rule_counts(spark, sf_dir):
    return rules.cleaning_counts(t.dealt_trips(spark, sf_dir), t.RULES, tasks=t.tasks(spark, sf_dir))


@query(
    "cln_summary",
    with_ctes(
        *_REPORT,
        select="SELECT * REPLACE (round(removed_pct, 2) AS removed_pct, round(quality_score, 2) AS quality_score) FROM summary",
    ),
)
def summary(spark, sf_dir):
    counts = rules.cleaning_counts(t.dealt_trips(spark, sf_dir), t.RULES, tasks=t.tasks(spark, sf_dir))
    return rounded(rules.cleaning_summary(counts), 2)




@query(
    "cln_first_failure",
    with_ctes(
        *CHAIN,
        "q AS ("
        + " UNION ALL ".join(
            f"SELECT '{rule}' AS rule, taxi_type, file_month, count(*) AS records FROM s{i - 1} WHERE NOT coalesce({keep}, false) GROUP BY 2, 3"
            for i, (rule, _, keep) in enumerate(STEPS, start=1)
            if keep is not None
        )
        + " UNION ALL SELECT 'unique_rows', taxi_type, file_month, (sum(n) - count(*))::BIGINT FROM "
        "(SELECT *, count(*) AS n FROM s3 GROUP BY ALL) GROUP BY 2, 3 HAVING sum(n) > count(*))",
        select="SELECT * FROM q",
    ),
)
def first_failure(spark, sf_dir):
    rejected = rules.quarantine(t.stored_trips(spark, sf_dir), t.RULES, tasks=t.tasks(spark, sf_dir))
    return rejected.groupBy("rule", "taxi_type", "file_month").agg(F.sum("records").alias("records"))


_CLEAN_OUT = (
    "taxi_type, file_year, count(*) AS trips, min({pu}) AS first_pickup, max({pu}) AS last_pickup, "
    "round(sum(fare_amount), 4) AS fare, round(sum(trip_distance), 4) AS distance"
).format(pu=_PU)


@query("cln_clean_rows", with_ctes(*CHAIN, select=f"SELECT {_CLEAN_OUT} FROM {LAST} GROUP BY 1, 2"))
def clean_rows(spark, sf_dir):
    kept = rules.clean(t.stored_trips(spark, sf_dir), t.RULES)
    return kept.groupBy(*t.SCOPE).agg(
        F.count(F.lit(1)).alias("trips"),
        F.min(_PU).alias("first_pickup"),
        F.max(_PU).alias("last_pickup"),
        F.round(F.sum("fare_amount"), 4).alias("fare"),
        F.round(F.sum("trip_distance"), 4).alias("distance"),
    )


_FLAGSHIP = (*CHAIN, t.canon_cte(LAST), t.PREP, t.FACT)


@query("flagship_clean_star", with_ctes(*_FLAGSHIP, select=f"SELECT {t.FACT_OUT} FROM fact"))
def flagship(spark, sf_dir):
    """Raw trips through cleaning and the canonical layout to the published fact."""
    silver = silver_trips(t.stored_trips(spark, sf_dir), rules=t.RULES)
    return rounded(full_fact(canonical_trips(silver)), 6, **t.FACT_DIGITS)


@query(
    "cln_silver_enriched",
    with_ctes(
        *CHAIN,
        t.ZONES,
        select=f"""SELECT pz.borough AS pickup_borough, dz.zone AS dropoff_zone,
  (dayofweek({_PU}) + 1)::INT AS pickup_day, count(*) AS trips,
  round(avg(date_diff('second', {_PU}, {_DO}) / 60.0), 6) AS mean_minutes
FROM {LAST} LEFT JOIN zones pz ON "PULocationID" = pz.locationid LEFT JOIN zones dz ON "DOLocationID" = dz.locationid
GROUP BY 1, 2, 3""",
    ),
)
def silver_enriched(spark, sf_dir):
    silver = silver_trips(t.stored_trips(spark, sf_dir), t.zones(spark, sf_dir), rules=t.RULES)
    return silver.groupBy("pickup_borough", "dropoff_zone", "pickup_day").agg(
        F.count(F.lit(1)).alias("trips"), F.round(F.avg("trip_duration_minutes"), 6).alias("mean_minutes")
    )


@query(
    "cln_light_counts",
    with_ctes(
        t.TRIPS,
        f"""v AS (SELECT *, CASE WHEN {_PU} IS NULL THEN 'missing'
  WHEN NOT ({_PU} >= TIMESTAMP '1996-01-01' AND {_PU} < TIMESTAMP '2001-01-01') THEN 'undated' ELSE 'kept' END AS verdict FROM trips)""",
        "k AS (SELECT taxi_type, file_year, count(*) AS final FROM (SELECT DISTINCT taxi_type, file_year, "
        f"""{_PU}, "PULocationID", "DOLocationID" FROM v WHERE verdict = 'kept') GROUP BY 1, 2)""",
        select="""SELECT v.taxi_type, v.file_year, count(*) AS original,
  count(*) FILTER (verdict = 'missing') AS removed_missing, count(*) FILTER (verdict = 'undated') AS removed_undated,
  count(*) FILTER (verdict = 'kept') - coalesce(max(final), 0) AS removed_duplicate, coalesce(max(final), 0) AS final,
  round(100 - (count(*) - coalesce(max(final), 0)) / count(*) * 100, 6) AS quality_score
FROM v LEFT JOIN k ON v.taxi_type = k.taxi_type AND v.file_year = k.file_year GROUP BY 1, 2""",
    ),
)
def light_counts(spark, sf_dir):
    return rounded(rules.light_counts(t.raw_trips(spark, sf_dir), date_range=t.DATES))


_ORDERED = ", ".join(
    f'"{c}" NULLS FIRST' for c in t.RAW_COLUMNS if c not in (_PU, "PULocationID", "DOLocationID")
)


@query(
    "cln_light_rows",
    with_ctes(
        t.TRIPS,
        f"""r AS (SELECT *, row_number() OVER (PARTITION BY {_PU}, "PULocationID", "DOLocationID" ORDER BY {_ORDERED}) AS rn
  FROM trips WHERE {_PU} >= TIMESTAMP '1996-01-01' AND {_PU} < TIMESTAMP '2001-01-01')""",
        select=f"""SELECT {_PU}, "PULocationID", "DOLocationID", taxi_type, "RatecodeID", round(fare_amount, 6) AS fare_amount
FROM r WHERE rn = 1""",
    ),
)
def light_rows(spark, sf_dir):
    kept = rules.light_clean(t.raw_trips(spark, sf_dir), date_range=t.DATES)
    return rounded(kept.select(_PU, "PULocationID", "DOLocationID", "taxi_type", "RatecodeID", "fare_amount"))


@query(
    "cln_key_dedup",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey,
    l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1""",
)
def key_dedup(spark, sf_dir):
    newest = (-F.unix_micros(F.col("l_shipdate").cast("timestamp"))).alias("newest")
    kept = dedup_by_key(t.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [newest])
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


@query("set_row_dedup", with_ctes(t.TRIPS, select="SELECT taxi_type, count(*) AS trips FROM (SELECT DISTINCT * FROM trips) GROUP BY 1"))
def row_dedup(spark, sf_dir):
    return dedup_rows(t.raw_trips(spark, sf_dir)).groupBy("taxi_type").agg(F.count(F.lit(1)).alias("trips"))


@query(
    "set_duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicates(spark, sf_dir):
    return duplicate_keys(t.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "jn_zone_lookup",
    with_ctes(
        t.TRIPS,
        t.ZONES,
        select="""SELECT taxi_type, pz.zone AS pickup_zone, pz.borough AS pickup_borough, pz.service_zone AS pickup_service_zone,
  dz.zone AS dropoff_zone, dz.borough AS dropoff_borough, dz.service_zone AS dropoff_service_zone, count(*) AS trips
FROM trips LEFT JOIN zones pz ON "PULocationID" = pz.locationid LEFT JOIN zones dz ON "DOLocationID" = dz.locationid
GROUP BY ALL""",
    ),
)
def zone_lookup(spark, sf_dir):
    enriched = with_zones(t.raw_trips(spark, sf_dir), t.zones(spark, sf_dir))
    names = [f"{end}_{part}" for end in ("pickup", "dropoff") for part in ("zone", "borough", "service_zone")]
    return enriched.groupBy("taxi_type", *names).agg(F.count(F.lit(1)).alias("trips"))


@query(
    "rpt_cleaning_totals",
    with_ctes(
        *_REPORT,
        select="""SELECT sum(original)::BIGINT AS original, sum(removed)::BIGINT AS removed, sum(final)::BIGINT AS final,
  round(sum(removed) / sum(original) * 100, 6) AS removed_pct, round(sum(final) / sum(original) * 100, 6) AS quality_pct FROM summary""",
    ),
)
def cleaning_totals(spark, sf_dir):
    counts = rules.cleaning_counts(t.dealt_trips(spark, sf_dir), t.RULES, tasks=t.tasks(spark, sf_dir))
    return rounded(reports.cleaning_totals(rules.cleaning_summary(counts)))


@query(
    "rpt_cleaning_effectiveness",
    with_ctes(
        *_REPORT,
        select="""SELECT dimension, sum(removed)::BIGINT AS removed,
  round(sum(removed) / (SELECT sum(removed) FROM counts) * 100, 6) AS share_pct FROM counts GROUP BY 1""",
    ),
)
def cleaning_effectiveness(spark, sf_dir):
    counts = rules.cleaning_counts(t.dealt_trips(spark, sf_dir), t.RULES, tasks=t.tasks(spark, sf_dir))
    return rounded(reports.cleaning_effectiveness(counts))


@query(
    "rpt_cleaning_best_worst",
    with_ctes(
        *_REPORT,
        "q AS (SELECT taxi_type, 100 - avg(removed_pct) AS quality FROM summary GROUP BY 1)",
        select="""SELECT (SELECT taxi_type FROM q ORDER BY quality DESC, taxi_type LIMIT 1) AS best,
  round((SELECT max(quality) FROM q), 6) AS best_value,
  (SELECT taxi_type FROM q ORDER BY quality, taxi_type LIMIT 1) AS worst, round((SELECT min(quality) FROM q), 6) AS worst_value""",
    ),
)
def cleaning_best_worst(spark, sf_dir):
    counts = rules.cleaning_counts(t.dealt_trips(spark, sf_dir), t.RULES, tasks=t.tasks(spark, sf_dir))
    by_type = reports.cleaning_by_type(rules.cleaning_summary(counts))
    return rounded(reports.best_and_worst(by_type, "taxi_type", "quality"))
