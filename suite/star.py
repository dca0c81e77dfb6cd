"""Star schema: fact, dimensions, checks, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from orebelt import contract
from orebelt.operators import star
from orebelt.operators.star import DIMENSION_KEYS
from orebelt.session import materialize
from suite import trips as t
from suite.registry import query, rounded, with_ctes

def _case(key: str, labels: dict, fallback: str) -> str:
    arms = " ".join(
        f"WHEN {code!r} THEN '{text}'" if isinstance(code, str) else f"WHEN {code} THEN '{text}'"
        for code, text in labels.items()
    )
    return f"CASE {key} {arms} ELSE {fallback} END"


@query(
    "star_contribution",
    with_ctes(
        *t.STAR,
        select="SELECT " + ", ".join(t.KEYS) + ", cantidad_viajes, "
        + ", ".join(f"round({x}, 6) AS {x}" for x in t.TOTALS)
        + ", " + ", ".join(f"n_{s} AS _count_{s}" for _, s in t.AVERAGES.values())
        + " FROM sums",
    ),
)
def contribution(spark, sf_dir):
    return rounded(star.fact_contribution(star.star_input(t.canonical(spark, sf_dir))))


@query("star_fact", with_ctes(*t.STAR, select=f"SELECT {t.FACT_OUT} FROM fact"))
def fact(spark, sf_dir):
    return rounded(t.fact(spark, sf_dir), 6, **t.FACT_DIGITS)


_MONTHS = _case("mes", contract.MONTH_NAMES, "NULL")
_DIM_TIME = f"""dim_tiempo AS (SELECT time_id, CASE WHEN ok THEN (time_id || '-01')::DATE END AS fecha_inicio_mes,
  anio, mes, CASE WHEN ok THEN {_MONTHS} ELSE 'Sin fecha' END AS nombre_mes,
  CASE WHEN ok THEN ceil(mes / 3.0)::INT ELSE -1 END AS trimestre,
  CASE WHEN ok THEN ({_MONTHS}) || ' ' || anio ELSE 'Sin fecha' END AS etiqueta_mes,
  CASE WHEN ok THEN anio * 100 + mes ELSE -1 END AS orden_mes
FROM (SELECT time_id, ok, CASE WHEN ok THEN substr(time_id, 1, 4)::INT ELSE -1 END AS anio,
        CASE WHEN ok THEN substr(time_id, 6, 2)::INT ELSE -1 END AS mes
      FROM (SELECT DISTINCT time_id, time_id <> 'SIN_FECHA' AS ok FROM fact)))"""


@query(
    "star_dim_time",
    with_ctes(*t.STAR, _DIM_TIME, select="SELECT * REPLACE (fecha_inicio_mes::VARCHAR AS fecha_inicio_mes) FROM dim_tiempo"),
)
def dim_time(spark, sf_dir):
    return star.dim_time(t.fact(spark, sf_dir)).withColumn("fecha_inicio_mes", F.col("fecha_inicio_mes").cast("string"))


@query(
    "star_dim_hour",
    with_ctes(
        *t.STAR,
        select="""SELECT DISTINCT hora_id, CASE WHEN hora_id >= 0 THEN hora_id END AS hora,
  CASE WHEN hora_id = -1 THEN 'Sin hora' WHEN hora_id <= 5 THEN 'Madrugada' WHEN hora_id <= 11 THEN 'Manana'
       WHEN hora_id <= 17 THEN 'Tarde' ELSE 'Noche' END AS franja_horaria FROM fact""",
    ),
)
def dim_hour(spark, sf_dir):
    return star.dim_hour(t.fact(spark, sf_dir))


for _name, _key, _labels, _column, _prefix, _build in (
    ("star_dim_taxi_type", "tipo_dataset", contract.TAXI_LABELS, "tipo_taxi", "Tipo", star.dim_taxi_type),
    ("star_dim_payment", "payment_type", contract.PAYMENT_LABELS, "forma_pago", "Codigo", star.dim_payment),
    ("star_dim_ratecode", "ratecode_id", contract.RATECODE_LABELS, "ratecode", "Codigo", star.dim_ratecode),
    ("star_dim_trip_type", "trip_type", contract.TRIP_TYPE_LABELS, "tipo_viaje", "Codigo", star.dim_trip_type),
    ("star_dim_shared_ride", "shared_ride_flag", contract.SHARED_RIDE_LABELS, "viaje_compartido", "Codigo", star.dim_shared_ride),
):
    _label = _case(_key, _labels, f"'{_prefix} ' || {_key}")
    query(_name, with_ctes(*t.STAR, select=f"SELECT DISTINCT {_key}, {_label} AS {_column} FROM fact"))(
        lambda spark, sf_dir, build=_build: build(t.fact(spark, sf_dir))
    )

for _role in ("pickup", "dropoff"):
    query(
        f"star_dim_zone_{_role}",
        with_ctes(
            *t.STAR,
            t.ZONES,
            select=f"SELECT {_role}_location_id, "
            + ", ".join(
                f"coalesce({part}, 'No informado') AS {_role}_{part}" for part in ("borough", "zone", "service_zone")
            )
            + f" FROM (SELECT DISTINCT {_role}_location_id FROM fact) LEFT JOIN zones ON {_role}_location_id = locationid",
        ),
    )(lambda spark, sf_dir, role=_role: star.dim_zone(t.fact(spark, sf_dir), t.zones(spark, sf_dir), role))


@query(
    "star_dim_provider",
    with_ctes(
        *t.STAR,
        select=f"""SELECT DISTINCT tipo_dataset || '|' || provider_id AS provider_key, provider_id, tipo_dataset,
  CASE WHEN tipo_dataset = 'fhv' THEN 'Base FHV' ELSE 'Vendor TLC' END AS tipo_proveedor,
  CASE WHEN provider_id = 'NO_INFO' THEN 'No informado' ELSE {_case('provider_id', contract.VENDOR_LABELS,
    "CASE WHEN tipo_dataset = 'fhv' THEN 'Base ' ELSE 'Vendor ' END || provider_id")} END AS proveedor FROM prep""",
    ),
)
def dim_provider(spark, sf_dir):
    return star.dim_provider(t.fact(spark, sf_dir))


@query(
    "star_ref_check",
    with_ctes(
        *t.STAR,
        t.ZONES,
        select="""SELECT pickup_location_id, sum(cantidad_viajes)::BIGINT AS trips FROM fact
WHERE pickup_location_id NOT IN (SELECT locationid FROM zones) GROUP BY 1""",
    ),
)
def ref_check(spark, sf_dir):
    """Trips whose pickup zone has no lookup row."""
    facts = t.fact(spark, sf_dir)
    known = t.zones(spark, sf_dir).select(F.col("locationid").alias("pickup_location_id"))
    trips = facts.groupBy("pickup_location_id").agg(F.sum("cantidad_viajes").alias("trips"))
    return trips.join(star.orphans(trips, known, "pickup_location_id"), "pickup_location_id", "left_semi")


@query(
    "star_key_check",
    with_ctes(
        *t.STAR,
        select=" UNION ALL ".join(
            f"SELECT '{name}' AS dimension, count(DISTINCT {key}) AS rows, count(DISTINCT {key}) AS distinct_keys, "
            "0::BIGINT AS orphan_keys FROM fact"
            for name, key in DIMENSION_KEYS.items()
        ),
    ),
)
def key_check(spark, sf_dir):
    """All ten dimensions of the stored fact: unique keys, no orphans."""
    facts = materialize(t.fact(spark, sf_dir), "fact")
    dims = star.dimensions(facts, t.zones(spark, sf_dir))
    return star.key_check(dims, facts)


@query(
    "star_join_report",
    with_ctes(
        *t.STAR,
        _DIM_TIME,
        t.ZONES,
        select=f"""SELECT anio, trimestre, coalesce(borough, 'No informado') AS pickup_borough,
  {_case('payment_type', contract.PAYMENT_LABELS, "'Codigo ' || payment_type")} AS forma_pago,
  sum(cantidad_viajes)::BIGINT AS viajes, round(sum(total_monto_total), 6) AS monto
FROM fact JOIN dim_tiempo USING (time_id) LEFT JOIN zones ON pickup_location_id = locationid GROUP BY 1, 2, 3, 4""",
    ),
)
def join_report(spark, sf_dir):
    """Fact with three dimensions, grouped by their attributes."""
    facts = materialize(t.fact(spark, sf_dir), "fact")
    dims = {
        "dim_tiempo": star.dim_time(facts),
        "dim_zona_pickup": star.dim_zone(facts, t.zones(spark, sf_dir), "pickup"),
        "dim_pago": star.dim_payment(facts),
    }
    joined = star.star_join(facts, dims)
    return joined.groupBy("anio", "trimestre", "pickup_borough", "forma_pago").agg(
        F.sum("cantidad_viajes").alias("viajes"), F.round(F.sum("total_monto_total"), 6).alias("monto")
    )
