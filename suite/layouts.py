"""Four dataset types, each in columns of its own, united by name and cleaned together.

The SQL works on the types one by one where their columns differ, so a rule, a canonical
column or a score that takes another type's column shows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebelt.contract import QUALITY_THRESHOLDS, QUALITY_WEIGHTS
from orebelt.operators import quality as q
from orebelt.operators import rules
from orebelt.plans.silver import canonical_trips, silver_trips
from suite import trips as t
from suite.cleaning import STEPS
from suite.registry import query, rounded, with_ctes

# Derived column to the type's own name, for the columns a type has.
_METERED = {
    c: c
    for c in (
        "VendorID", "passenger_count", "trip_distance", "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID", "payment_type",
        "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "total_amount", "congestion_surcharge",
    )
}
_HIRED = {"tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime", "PULocationID": "PULocationID", "DOLocationID": "DOLocationID"}
OWN = {
    "yellow": {**_METERED, "tpep_pickup_datetime": "tpep_pickup_datetime", "tpep_dropoff_datetime": "tpep_dropoff_datetime", "Airport_fee": "airport_fee"},
    "green": {**_METERED, "tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime", "trip_type": "trip_type", "ehail_fee": "ehail_fee"},
    "fhv": {**_HIRED, "SR_Flag": "SR_Flag"},
    "fhvhv": {
        **_HIRED, "dispatching_base_num": "dispatching_base_num", "trip_distance": "trip_miles", "fare_amount": "base_passenger_fare",
        "tip_amount": "tips", "tolls_amount": "tolls", "congestion_surcharge": "congestion_surcharge", "Airport_fee": "airport_fee",
    },
}
LAYOUTS = {dataset: tuple(own.values()) for dataset, own in OWN.items()}
_SCOPE = ("taxi_type", "file_year", "file_month")


def united(trips: DataFrame) -> DataFrame:
    """All trips, those of each type in its own columns only."""
    parts = [
        trips.where(F.col("taxi_type") == dataset).select(*_SCOPE, *[F.col(c).alias(name) for c, name in own.items()])
        for dataset, own in OWN.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# The same in SQL: one set of columns, empty where a type lacks the column. The fare of
# high-volume trips is their total too; their distance is not taken over by default.
_RAW = [c for c in t.RAW_COLUMNS if c not in _SCOPE]
_HAS = {c: [d for d, own in OWN.items() if c in own] for c in _RAW}
_LISTED = {c: "(" + ", ".join(f"'{d}'" for d in has) + ")" for c, has in _HAS.items() if has}
_CLEARED = (
    "own AS (SELECT "
    + ", ".join(_SCOPE)
    + ", "
    + ", ".join(
        f"CASE WHEN taxi_type IN {_LISTED[c]} THEN \"{c}\" END AS \"{c}\"" if c in _LISTED else f'NULL AS "{c}"' for c in _RAW
    )
    + " FROM trips)"
)
_TAKEN = "all_types AS (SELECT * REPLACE (CASE WHEN taxi_type = 'fhvhv' THEN fare_amount ELSE total_amount END AS total_amount) FROM own)"
_FEW = {
    "fare_not_negative": "('yellow', 'green', 'fhvhv')",
    "tip_not_negative": "('yellow', 'green', 'fhvhv')",
    "tolls_not_negative": "('yellow', 'green', 'fhvhv')",
    "distance_in_range": "('yellow', 'green')",
    "passengers_in_range": "('yellow', 'green')",
    "payment_known": "('yellow', 'green')",
}


def _steps() -> list[str]:
    ctes = ["s0 AS (SELECT * FROM all_types)"]
    for i, (rule, _, keep) in enumerate(STEPS, start=1):
        where = f"taxi_type NOT IN {_FEW[rule]} OR coalesce({keep}, false)" if rule in _FEW else keep
        body = f"SELECT DISTINCT * FROM s{i - 1}" if keep is None else f"SELECT * FROM s{i - 1} WHERE {where}"
        ctes.append(f"s{i} AS MATERIALIZED ({body})")
    return ctes


_APPLIES = {
    **{rule: f"taxi_type IN {few}" for rule, few in _FEW.items()},
    "dropoff_datetime_present": "taxi_type IN ('yellow', 'green')",
    "monto_total_present": "taxi_type IN ('yellow', 'green')",
    "duration_in_range": "(taxi_type, file_year) IN (SELECT (taxi_type, file_year) FROM s9 WHERE tpep_dropoff_datetime IS NOT NULL)",
}
_CHAIN = (t.TRIPS, _CLEARED, _TAKEN, *_steps())
_COUNTS = " UNION ALL ".join(
    f"SELECT taxi_type, file_year, {i} AS rule_order, '{rule}' AS rule, CASE WHEN {_APPLIES.get(rule, 'true')} THEN 'applied' ELSE 'not_applicable' END AS status, "
    f"(SELECT count(*) FROM s{i - 1} p WHERE p.taxi_type = b.taxi_type AND p.file_year = b.file_year) - "
    f"(SELECT count(*) FROM s{i} p WHERE p.taxi_type = b.taxi_type AND p.file_year = b.file_year) AS removed "
    "FROM (SELECT DISTINCT taxi_type, file_year FROM s0) b"
    for i, (rule, _, _) in enumerate(STEPS, start=1)
)


@query("lay_rule_counts", with_ctes(*_CHAIN, select=_COUNTS))
def lay_rule_counts(spark, sf_dir):
    """Removed records and status of every rule for each type in its own columns."""
    counts = rules.cleaning_counts(united(t.dealt_trips(spark, sf_dir)), t.RULES, layouts=LAYOUTS, tasks=t.tasks(spark, sf_dir))
    return counts.select("taxi_type", "file_year", "rule_order", "rule", "status", "removed")


_CANON = (*_CHAIN, t.canon_cte(f"s{len(STEPS)}").replace("trip_distance AS", "CASE WHEN taxi_type <> 'fhvhv' THEN trip_distance END AS"))
_AMOUNTS = ("distancia_millas", "monto_base", "monto_total", "propina", "peajes")
_OUT = (
    "tipo_dataset", "anio", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id", "duracion_segundos", *_AMOUNTS,
    "payment_type", "passenger_count", "vendor_id", "ratecode_id", "trip_type", "shared_ride_flag", "airport_fee", "congestion_surcharge",
)


@query(
    "lay_clean_canonical",
    with_ctes(
        *_CANON,
        select=f"SELECT {', '.join(f'round({c}, 6) AS {c}' if c in _AMOUNTS else c for c in _OUT)} FROM canon",
    ),
)
def lay_clean_canonical(spark, sf_dir):
    """Every clean trip of all types, row by row, in the canonical layout."""
    silver = silver_trips(united(t.stored_trips(spark, sf_dir)), rules=t.RULES, layouts=LAYOUTS)
    return rounded(canonical_trips(silver).select(*_OUT))


def _scores_sql() -> list[str]:
    parts = []
    for dataset, own in OWN.items():
        cells = [*_SCOPE, *own]
        nulls = " + ".join(f'(count(*) - count("{c}"))' for c in cells)
        share = {
            "total_amount": "total_amount BETWEEN 0 AND 1000", "trip_distance": "trip_distance BETWEEN 0.1 AND 500",
            "payment_type": "payment_type BETWEEN 1 AND 6 OR payment_type IS NULL",
            "PULocationID": '"PULocationID" BETWEEN 1 AND 263 OR "PULocationID" IS NULL', "DOLocationID": '"DOLocationID" BETWEEN 1 AND 263 OR "DOLocationID" IS NULL',
        }
        # checks look at the plain names, which high-volume trips do not have for amounts
        has = lambda c: c in own and own[c].lower() == c.lower()  # noqa: E731, B023
        rate = lambda names: "least(" + ", ".join(["1.0", *[f"count(*) FILTER (WHERE {share[c]}) / count(*)" for c in names if has(c)]]) + ")"  # noqa: E731, B023
        parts.append(
            f"SELECT taxi_type, file_year, count(*) AS records, 1.0 - ({nulls}) / (count(*) * {len(cells)}.0) AS completitud, "
            f"{rate(('total_amount', 'trip_distance'))} AS precision, count(DISTINCT (tpep_pickup_datetime, tpep_dropoff_datetime)) / count(*) AS unicidad, "
            f"{rate(('payment_type', 'PULocationID', 'DOLocationID'))} AS validez, 1.0 AS consistencia FROM own WHERE taxi_type = '{dataset}' GROUP BY 1, 2"
        )
    weighted = " + ".join(f"{w} * round({d}, 6)" for d, w in QUALITY_WEIGHTS.items())
    return [
        t.TRIPS,
        _CLEARED,
        "scored AS (" + " UNION ALL ".join(parts) + ")",
        f"wide AS (SELECT *, {weighted} AS overall FROM scored)",
        "long AS (" + " UNION ALL ".join(f"SELECT taxi_type, file_year, records, '{d}' AS dimension, {d}::DOUBLE AS score FROM wide" for d in QUALITY_THRESHOLDS) + ")",
    ]


@query("lay_quality", with_ctes(*_scores_sql(), select="SELECT taxi_type, file_year, records, dimension, round(score, 6) AS score FROM long"))
def lay_quality(spark, sf_dir):
    """Scores of each type over the columns it has."""
    keys = ("pickup_datetime", "dropoff_datetime", "tpep_pickup_datetime", "tpep_dropoff_datetime", "lpep_pickup_datetime", "lpep_dropoff_datetime")
    scope = {dataset: (*_SCOPE, *own) for dataset, own in LAYOUTS.items()}
    measures = q.quality_measures(united(t.raw_trips(spark, sf_dir)), t.SCOPE, keys=keys, layouts=scope)
    return rounded(q.quality_scores(measures, t.SCOPE).select("taxi_type", "file_year", "records", "dimension", "score"))
