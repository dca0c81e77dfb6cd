"""Schema drift over schemas observed in the data: a column exists in a month if it holds a value."""

from __future__ import annotations

from pyspark.sql import functions as F

from orebelt.operators import schema as s
from orebelt.session import materialize
from suite import trips as t
from suite.registry import query, rounded, with_ctes

_COLUMNS = {
    "VendorID": "string",
    "tpep_pickup_datetime": "timestamp_ntz",
    "trip_distance": "double",
    "RatecodeID": "int",
    "PULocationID": "int",
    "DOLocationID": "int",
    "payment_type": "int",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "total_amount": "double",
    "store_and_fwd_flag": "string",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "congestion_surcharge": "double",
    "Airport_fee": "double",
    "ehail_fee": "double",
    "trip_type": "int",
    "SR_Flag": "int",
    "dispatching_base_num": "string",
}


def snapshot(spark, sf_dir):
    """Observed schema per month; the passenger type widens where large values occur."""
    trips = t.raw_trips(spark, sf_dir).select(
        F.col("taxi_type").alias("dataset"), F.col("file_year").alias("year"), F.col("file_month").alias("month"),
        "passenger_count", *_COLUMNS,
    )
    period = ["dataset", "year", "month"]
    seen = s.observed_schema(trips, period, list(_COLUMNS))
    widened = trips.groupBy(*period).agg(F.max("passenger_count").alias("_max")).select(
        *period,
        F.lit("passenger_count").alias("column"),
        F.when(F.col("_max") >= 10, "bigint").otherwise("int").alias("dtype"),
    )
    return materialize(seen.unionByName(widened), "schema-snapshot")


_SNAP = "snap AS MATERIALIZED (" + " UNION ALL ".join(
    f"SELECT taxi_type AS dataset, file_year AS year, file_month AS month, '{c}' AS \"column\", '{d}' AS dtype FROM trips "
    f'GROUP BY 1, 2, 3 HAVING count("{c}") > 0'
    for c, d in _COLUMNS.items()
) + (
    " UNION ALL SELECT taxi_type, file_year, file_month, 'passenger_count', "
    "CASE WHEN max(passenger_count) >= 10 THEN 'bigint' ELSE 'int' END FROM trips GROUP BY 1, 2, 3)"
)


def _drift(name: str, keyed: str, link_keys: str) -> str:
    return f"""{name}_keyed AS ({keyed}),
{name}_links AS (SELECT *, lag(period) OVER (PARTITION BY {link_keys} ORDER BY period) AS prev
  FROM (SELECT DISTINCT {link_keys}, period FROM {name}_keyed)),
{name}_old AS (SELECT l.dataset, l.prev, l.period, k."column", k.dtype FROM {name}_links l JOIN {name}_keyed k
  ON k.dataset = l.dataset AND k.period = l.prev),
{name}_cur AS (SELECT l.dataset, l.prev, l.period, k."column", k.dtype FROM {name}_links l JOIN {name}_keyed k
  ON k.dataset = l.dataset AND k.period = l.period WHERE l.prev IS NOT NULL),
{name} AS (SELECT dataset, prev AS from_period, period AS to_period, "column",
    CASE WHEN o.dtype IS NULL THEN 'new' WHEN c.dtype IS NULL THEN 'removed' ELSE 'type' END AS change,
    o.dtype AS previous_type, c.dtype AS current_type
  FROM {name}_old o FULL JOIN {name}_cur c USING (dataset, prev, period, "column") WHERE o.dtype IS DISTINCT FROM c.dtype)"""


_MONTHLY = _drift(
    "monthly",
    "SELECT *, lpad(year::VARCHAR, 4, '0') || '-' || lpad(month::VARCHAR, 2, '0') AS period FROM snap",
    "dataset, year",
)
_YEARLY = _drift(
    "yearly",
    "SELECT *, year::VARCHAR AS period FROM snap WHERE (dataset, year, month) IN (SELECT (dataset, year, min(month)) FROM snap GROUP BY dataset, year)",
    "dataset",
)
_BASE = (t.TRIPS, _SNAP)
_BOTH = (*_BASE, _MONTHLY, _YEARLY)
_UNIFIED = """uni AS (SELECT dataset, "column", CASE WHEN bool_or(dtype = 'bigint') THEN 'bigint'
  WHEN bool_or(dtype = 'timestamp_ntz') THEN 'timestamp' ELSE max(dtype) END AS dtype FROM snap GROUP BY 1, 2)"""
_ALL = (*_BASE, _UNIFIED)


@query("sch_snapshot", with_ctes(*_BASE, select="SELECT * FROM snap"))
def snapshot_query(spark, sf_dir):
    return snapshot(spark, sf_dir)


@query("sch_drift", with_ctes(*_BASE, _MONTHLY, select="SELECT * FROM monthly"))
def drift(spark, sf_dir):
    """New, removed and retyped columns between adjacent months."""
    return s.drift_by_month(snapshot(spark, sf_dir))


@query("sch_drift_year", with_ctes(*_BASE, _YEARLY, select="SELECT * FROM yearly"))
def drift_year(spark, sf_dir):
    return s.drift_by_year(snapshot(spark, sf_dir))


@query("sch_unified", with_ctes(*_ALL, select="SELECT * FROM uni"))
def unified(spark, sf_dir):
    """One schema per dataset at the widest observed types."""
    return s.unified_schema(snapshot(spark, sf_dir))


@query(
    "sch_unified_from_drift",
    with_ctes(
        *_ALL,
        _MONTHLY,
        select="""SELECT dataset, "column", CASE WHEN (dataset, "column") IN (SELECT (dataset, "column") FROM monthly WHERE change <> 'type')
  THEN 'string' ELSE dtype END AS dtype FROM uni""",
    ),
)
def unified_from_drift(spark, sf_dir):
    """Parity form: columns named in the drift report become text."""
    snap = snapshot(spark, sf_dir)
    return s.unified_schema_from_drift(s.unified_schema(snap), s.drift_by_month(snap))


_SUMMARY = """summ AS (SELECT dataset, count(DISTINCT year) AS years, count(DISTINCT (year, month)) AS months,
  coalesce((SELECT count(DISTINCT to_period) FROM yearly y WHERE y.dataset = snap.dataset), 0) AS yearly_changes,
  coalesce((SELECT count(DISTINCT to_period) FROM monthly m WHERE m.dataset = snap.dataset), 0) AS monthly_changes FROM snap GROUP BY 1)"""


def _summary(spark, sf_dir):
    snap = snapshot(spark, sf_dir)
    return s.drift_summary(snap, s.drift_by_year(snap), s.drift_by_month(snap))


@query("sch_drift_summary", with_ctes(*_BOTH, _SUMMARY, select="SELECT *, yearly_changes + monthly_changes AS total_changes FROM summ"))
def drift_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


@query(
    "sch_stability",
    with_ctes(
        *_BOTH,
        _SUMMARY,
        "st AS (SELECT dataset, greatest(0.0::DOUBLE, 100 - yearly_changes / (years - 1) * 50) AS a, "
        "greatest(0.0::DOUBLE, 100 - monthly_changes / (months - 1) * 30) AS b FROM summ)",
        select="SELECT dataset, round(a, 6) AS year_stability, round(b, 6) AS month_stability, round((a + b) / 2, 6) AS stability FROM st",
    ),
)
def stability(spark, sf_dir):
    return rounded(s.schema_stability(_summary(spark, sf_dir)))


@query(
    "sch_transitions",
    with_ctes(
        *_BASE,
        _MONTHLY,
        select="""SELECT dataset, "column", previous_type, current_type, from_period || '→' || to_period AS transition FROM monthly WHERE change = 'type'""",
    ),
)
def transitions(spark, sf_dir):
    return s.transitions(s.drift_by_month(snapshot(spark, sf_dir)))


@query(
    "sch_most_changed",
    with_ctes(*_BASE, _MONTHLY, select='SELECT "column", count(*) AS changes FROM monthly GROUP BY 1 ORDER BY changes DESC, "column" LIMIT 10'),
)
def most_changed(spark, sf_dir):
    return s.most_changed_columns(s.drift_by_month(snapshot(spark, sf_dir)))


_COMMON = """com AS (SELECT "column", count(DISTINCT dataset) AS used_by, CASE WHEN count(DISTINCT dataset) = 4 THEN 'common'
  WHEN count(DISTINCT dataset) = 1 THEN 'unique' ELSE 'shared' END AS commonality FROM uni GROUP BY 1)"""


@query("sch_commonality", with_ctes(*_ALL, _COMMON, select="SELECT * FROM com"))
def commonality(spark, sf_dir):
    return s.column_commonality(s.unified_schema(snapshot(spark, sf_dir)))


@query(
    "sch_commonality_counts",
    with_ctes(
        *_ALL,
        _COMMON,
        select="""SELECT dataset, count(*) FILTER (commonality = 'common') AS common_columns, count(*) FILTER (commonality = 'shared') AS shared_columns,
  count(*) FILTER (commonality = 'unique') AS unique_columns FROM uni JOIN com USING ("column") GROUP BY 1""",
    ),
)
def commonality_counts(spark, sf_dir):
    return s.commonality_counts(materialize(s.unified_schema(snapshot(spark, sf_dir)), "unified"))


@query(
    "sch_membership",
    with_ctes(
        *_ALL,
        select='SELECT "column", ' + ", ".join(f"max(CASE WHEN dataset = '{d}' THEN 1 ELSE 0 END) AS {d}" for d in t.TYPES) + " FROM uni GROUP BY 1",
    ),
)
def membership(spark, sf_dir):
    return s.membership(s.unified_schema(snapshot(spark, sf_dir)), t.TYPES)


@query(
    "sch_jaccard",
    with_ctes(
        *_ALL,
        select="""SELECT a.dataset AS left_dataset, b.dataset AS right_dataset,
  (SELECT count(*) FROM uni x JOIN uni y USING ("column") WHERE x.dataset = a.dataset AND y.dataset = b.dataset) AS shared_columns,
  round((SELECT count(*) FROM uni x JOIN uni y USING ("column") WHERE x.dataset = a.dataset AND y.dataset = b.dataset)
    / (SELECT count(DISTINCT "column") FROM uni x WHERE x.dataset IN (a.dataset, b.dataset)) * 100, 6) AS similarity_pct
FROM (SELECT DISTINCT dataset FROM uni) a, (SELECT DISTINCT dataset FROM uni) b""",
    ),
)
def jaccard(spark, sf_dir):
    return rounded(s.schema_similarity(s.unified_schema(snapshot(spark, sf_dir)), t.TYPES))


@query(
    "sch_problems",
    with_ctes(
        *_BASE,
        select="""SELECT dataset, count(*) AS columns, 0::BIGINT AS missing_types, count(*) - count(DISTINCT "column") AS duplicates,
  count(DISTINCT CASE WHEN dtype = 'timestamp_ntz' THEN dtype END) AS invalid_types FROM snap GROUP BY 1""",
    ),
)
def problems(spark, sf_dir):
    """Checks over the raw snapshot, where every month repeats the columns."""
    return s.schema_problems(snapshot(spark, sf_dir))


@query(
    "sch_type_classes",
    with_ctes(
        *_ALL,
        select="""SELECT dataset, count(*) AS columns, count(*) FILTER (dtype = 'string') AS string_columns,
  count(*) FILTER (dtype IN ('int', 'bigint', 'double')) AS numeric_columns, count(*) FILTER (dtype LIKE 'timestamp%') AS timestamp_columns FROM uni GROUP BY 1""",
    ),
)
def type_classes(spark, sf_dir):
    return s.type_class_counts(s.unified_schema(snapshot(spark, sf_dir)))
