"""Model features, metrics, result tables and the three fitted models."""

from __future__ import annotations

from pyspark.sql import functions as F

from orebelt.operators import models as m
from orebelt.operators import star
from orebelt.plans import demand_models
from orebelt.session import materialize
from suite import trips as t
from suite.registry import query, rounded, with_ctes
from suite.star import _DIM_TIME

CONFIG = demand_models.ModelConfig(first_year=1996, last_year=2000, test_year=2000)
_RANGE = f"anio BETWEEN {CONFIG.first_year} AND {CONFIG.last_year}"
_BASE = (*t.STAR, _DIM_TIME, f"mf AS (SELECT * FROM fact JOIN dim_tiempo USING (time_id) WHERE {_RANGE})")
_SERIES = """ser AS (SELECT time_id, fecha_inicio_mes, anio, mes, trimestre, orden_mes, tipo_dataset, pickup_location_id,
  sum(cantidad_viajes)::DOUBLE AS viajes_reales FROM mf GROUP BY 1, 2, 3, 4, 5, 6, 7, 8)"""
_W = "OVER (PARTITION BY tipo_dataset, pickup_location_id ORDER BY orden_mes"
_LAGS = f"""lags AS (SELECT *, lag(viajes_reales, 1) {_W}) AS viajes_lag_1, lag(viajes_reales, 2) {_W}) AS viajes_lag_2,
  lag(viajes_reales, 3) {_W}) AS viajes_lag_3, avg(viajes_reales) {_W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS media_movil_3 FROM ser)"""


def _fact(spark, sf_dir):
    """Fact rows of the modelling years; written once, since features read it repeatedly."""
    facts = materialize(t.fact(spark, sf_dir), "fact")
    return demand_models.model_fact(facts, star.dim_time(facts), CONFIG)


def _text_date(df):
    return df.withColumn("fecha_inicio_mes", F.col("fecha_inicio_mes").cast("string"))


@query(
    "flt_excluded_months",
    with_ctes(*t.STAR, _DIM_TIME, select=f"SELECT time_id, anio, mes FROM dim_tiempo WHERE NOT ({_RANGE})"),
)
def excluded(spark, sf_dir):
    return m.excluded_months(star.dim_time(t.fact(spark, sf_dir)), CONFIG.first_year, CONFIG.last_year)


@query(
    "jn_valid_months",
    with_ctes(*_BASE, select="SELECT anio, trimestre, count(*) AS rows, sum(cantidad_viajes)::BIGINT AS viajes FROM mf GROUP BY 1, 2"),
)
def valid(spark, sf_dir):
    """Fact limited through the time dimension."""
    return _fact(spark, sf_dir).groupBy("anio", "trimestre").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("cantidad_viajes").alias("viajes")
    )


@query(
    "agg_monthly_series",
    with_ctes(*_BASE, _SERIES, select="SELECT * REPLACE (fecha_inicio_mes::VARCHAR AS fecha_inicio_mes) FROM ser"),
)
def monthly_series(spark, sf_dir):
    return _text_date(m.monthly_series(_fact(spark, sf_dir)))


@query(
    "win_lag_features",
    with_ctes(
        *_BASE,
        _SERIES,
        _LAGS,
        select="SELECT * REPLACE (fecha_inicio_mes::VARCHAR AS fecha_inicio_mes, round(media_movil_3, 6) AS media_movil_3) FROM lags WHERE viajes_lag_3 IS NOT NULL",
    ),
)
def lag_features(spark, sf_dir):
    return rounded(_text_date(m.lag_features(m.monthly_series(_fact(spark, sf_dir)))))


@query(
    "win_dense_months",
    with_ctes(
        *_BASE,
        _SERIES,
        """cal AS (SELECT tipo_dataset, pickup_location_id, unnest(generate_series(min(fecha_inicio_mes), max(fecha_inicio_mes), INTERVAL 1 MONTH))::DATE AS d
  FROM ser GROUP BY 1, 2)""",
        select="""SELECT strftime(d, '%Y-%m') AS time_id, cal.tipo_dataset, cal.pickup_location_id, (year(d) * 100 + month(d))::INT AS orden_mes,
  coalesce(viajes_reales, 0.0) AS viajes_reales FROM cal LEFT JOIN ser ON ser.fecha_inicio_mes = d AND ser.tipo_dataset = cal.tipo_dataset
  AND ser.pickup_location_id = cal.pickup_location_id""",
    ),
)
def dense(spark, sf_dir):
    """Series with a row for every month between a zone's first and last."""
    series = m.densify_months(m.monthly_series(_fact(spark, sf_dir)))
    return series.select("time_id", "tipo_dataset", "pickup_location_id", "orden_mes", "viajes_reales")


_PROFILE = """zp AS (SELECT tipo_dataset, pickup_location_id, sum(cantidad_viajes)::DOUBLE AS cantidad_viajes, sum(total_monto_total) AS ingreso_total,
  sum(total_distancia_millas) AS distancia_total, sum(total_duracion_minutos) AS duracion_total, count(DISTINCT time_id) AS meses_con_datos FROM mf GROUP BY 1, 2)"""


@query(
    "agg_zone_profile",
    with_ctes(
        *_BASE,
        _PROFILE,
        select="""SELECT tipo_dataset, pickup_location_id, cantidad_viajes, round(ingreso_total, 6) AS ingreso_total, round(distancia_total, 6) AS distancia_total,
  round(duracion_total, 6) AS duracion_total, meses_con_datos, round(cantidad_viajes / meses_con_datos, 6) AS viajes_por_mes,
  round(ingreso_total / cantidad_viajes + 3.7e-8, 6) AS ticket_promedio, round(distancia_total / cantidad_viajes + 3.7e-8, 6) AS distancia_promedio,
  round(duracion_total / cantidad_viajes + 3.7e-8, 6) AS duracion_promedio, round(ln(1 + cantidad_viajes), 6) AS log_cantidad_viajes,
  round(ln(1 + greatest(ingreso_total, 0)), 6) AS log_ingreso_total FROM zp""",
    ),
)
def zone_profile(spark, sf_dir):
    return rounded(m.zone_profiles(_fact(spark, sf_dir)), 6, means=("ticket_promedio", "distancia_promedio", "duracion_promedio"))


_HOURLY = """hd AS MATERIALIZED (SELECT time_id, anio, mes, trimestre, hora_id, tipo_dataset, pickup_location_id, sum(cantidad_viajes)::DOUBLE AS cantidad_viajes
  FROM mf WHERE hora_id BETWEEN 0 AND 23 AND pickup_location_id >= 0 GROUP BY 1, 2, 3, 4, 5, 6, 7)"""
_LIMITS = f"""lim AS (SELECT low, CASE WHEN high <= low THEN low + 1 ELSE high END AS high FROM (SELECT quantile_disc(cantidad_viajes, 0.33) AS low,
  quantile_disc(cantidad_viajes, 0.66) AS high FROM hd WHERE anio < {CONFIG.test_year}))"""


@query("agg_hourly_demand", with_ctes(*_BASE, _HOURLY, select="SELECT * FROM hd"))
def hourly(spark, sf_dir):
    return m.hourly_demand(_fact(spark, sf_dir))


@query(
    "agg_quantile_classes",
    with_ctes(
        *_BASE,
        _HOURLY,
        _LIMITS,
        select="""SELECT tipo_dataset, anio, CASE WHEN cantidad_viajes <= low THEN 0.0 WHEN cantidad_viajes <= high THEN 1.0 ELSE 2.0 END::DOUBLE AS clase_demanda_id,
  count(*) AS rows, max(low) AS umbral_bajo, max(high) AS umbral_alto FROM hd, lim GROUP BY 1, 2, 3""",
    ),
)
def quantile_classes(spark, sf_dir):
    """Classes from quantiles of the training years."""
    demand = materialize(m.hourly_demand(_fact(spark, sf_dir)), "hourly-demand")
    limits = m.demand_thresholds(demand, CONFIG.test_year, relative_error=0.0001)
    low, high = (limits.select(c).scalar() for c in ("umbral_bajo", "umbral_alto"))
    return m.demand_classes(demand, low, high).groupBy("tipo_dataset", "anio", "clase_demanda_id").agg(
        F.count(F.lit(1)).alias("rows"), F.max(low).alias("umbral_bajo"), F.max(high).alias("umbral_alto")
    )


@query("agg_exact_class_limits", with_ctes(*_BASE, _HOURLY, _LIMITS, select="SELECT low AS umbral_bajo, high AS umbral_alto FROM lim"))
def exact_class_limits(spark, sf_dir):
    """Class limits by exact selection, no accuracy to set."""
    demand = materialize(m.hourly_demand(_fact(spark, sf_dir)), "hourly-demand")
    return m.demand_thresholds(demand, CONFIG.test_year, relative_error=0)


_SHARES = (0.0, 0.01, 0.33, 0.5, 0.66, 0.999, 1.0)


@query(
    "agg_exact_quantiles",
    " UNION ALL ".join(f"SELECT {s}::DOUBLE AS share, quantile_disc(l_extendedprice, {s})::DOUBLE AS value FROM lineitem" for s in _SHARES),
)
def exact_quantiles(spark, sf_dir):
    """Exact quantiles of all line prices."""
    found = m.exact_quantiles(t.table(spark, sf_dir, "lineitem"), "l_extendedprice", _SHARES)
    return spark.createDataFrame(list(zip(_SHARES, found, strict=True)), "share double, value double")


@query(
    "ml_regression_metrics",
    with_ctes(
        *_BASE,
        _SERIES,
        _LAGS,
        select="""SELECT round(sqrt(avg((viajes_reales - viajes_lag_1) ** 2)), 6) AS rmse, round(avg(abs(viajes_reales - viajes_lag_1)), 6) AS mae,
  round(1 - sum((viajes_reales - viajes_lag_1) ** 2) / (var_pop(viajes_reales) * count(*)), 6) AS r2 FROM lags WHERE viajes_lag_3 IS NOT NULL""",
    ),
)
def regression_metrics(spark, sf_dir):
    """Metrics of the forecast that repeats last month."""
    features = m.lag_features(m.monthly_series(_fact(spark, sf_dir)))
    return rounded(m.regression_metrics(features, "viajes_reales", "viajes_lag_1"))


_GUESS = """g AS (SELECT CASE WHEN cantidad_viajes <= low THEN 0 WHEN cantidad_viajes <= high THEN 1 ELSE 2 END AS t,
  (mes + hora_id) % 3 AS p FROM hd, lim)"""


@query(
    "ml_class_metrics",
    with_ctes(
        *_BASE,
        _HOURLY,
        _LIMITS,
        _GUESS,
        "c AS (SELECT t AS k, count(*) AS n, count(*) FILTER (t = p) AS hit FROM g GROUP BY 1)",
        "q AS (SELECT p AS k, count(*) AS m FROM g GROUP BY 1)",
        select="""SELECT round((SELECT count(*) FILTER (t = p) / count(*) FROM g), 6) AS accuracy,
  round(sum(2.0 * hit / (n + coalesce(m, 0)) * n) / sum(n), 6) AS f1 FROM c LEFT JOIN q USING (k)""",
    ),
)
def class_metrics(spark, sf_dir):
    """Metrics of a guess from month and hour."""
    demand = materialize(m.hourly_demand(_fact(spark, sf_dir)), "hourly-demand")
    limits = m.demand_thresholds(demand, CONFIG.test_year, relative_error=0.0001)
    low, high = (limits.select(c).scalar() for c in ("umbral_bajo", "umbral_alto"))
    guessed = m.demand_classes(demand, low, high).withColumn("guess", ((F.col("mes") + F.col("hora_id")) % 3).cast("double"))
    return rounded(m.class_metrics(guessed, "clase_demanda_id", "guess"))


@query(
    "ml_forecast_errors",
    with_ctes(
        *_BASE,
        _SERIES,
        _LAGS,
        select="""SELECT time_id, tipo_dataset, pickup_location_id, viajes_reales, greatest(viajes_lag_1 - 5, 0.0) AS viajes_predichos,
  abs(viajes_reales - greatest(viajes_lag_1 - 5, 0.0)) AS error_absoluto,
  round(CASE WHEN viajes_reales > 0 THEN abs(viajes_reales - greatest(viajes_lag_1 - 5, 0.0)) / viajes_reales * 100 END, 6) AS error_porcentual
FROM lags WHERE viajes_lag_3 IS NOT NULL""",
    ),
)
def forecast_errors(spark, sf_dir):
    """Published error columns for a shifted repeat of last month."""
    features = m.lag_features(m.monthly_series(_fact(spark, sf_dir)))
    guessed = features.withColumn("viajes_predichos", F.col("viajes_lag_1") - 5)
    table = m.forecast_table(guessed, {"rmse": None, "mae": None, "r2": None}, "last month", F.current_timestamp())
    return rounded(table.select("time_id", "tipo_dataset", "pickup_location_id", "viajes_reales", "viajes_predichos", "error_absoluto", "error_porcentual"))


@query(
    "ml_output_check",
    with_ctes(*t.STAR, _DIM_TIME, select=f"SELECT time_id, anio FROM dim_tiempo WHERE NOT ({_RANGE})"),
)
def output_check(spark, sf_dir):
    """Months outside the valid years, found in results that were not filtered."""
    facts = materialize(t.fact(spark, sf_dir), "fact")
    return m.output_problems(facts, star.dim_time(facts), CONFIG.first_year, CONFIG.last_year)


@query("ml_forecast")
def forecast(spark, sf_dir):
    return demand_models.forecast_demand(_fact(spark, sf_dir), CONFIG)


@query("ml_segments")
def segments(spark, sf_dir):
    return demand_models.segment_zones(_fact(spark, sf_dir), CONFIG)


@query("ml_classes")
def classes(spark, sf_dir):
    return demand_models.classify_demand(_fact(spark, sf_dir), CONFIG)
