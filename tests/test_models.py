import math

import pytest

from orebelt.operators import models as m
from orebelt.plans.demand_models import ModelConfig, check_outputs

SERIES = (
    "SELECT CONCAT('2023-0', id) AS time_id, make_date(2023, CAST(id AS INT), 1) AS fecha_inicio_mes, 2023 AS anio, CAST(id AS INT) AS mes, "
    "1 AS trimestre, 202300 + CAST(id AS INT) AS orden_mes, 'green' AS tipo_dataset, 5 AS pickup_location_id, CAST(id AS DOUBLE) AS viajes_reales "
    "FROM range(1, 8) WHERE id <> 4"
)


def test_lags_are_by_row_and_dense_lags_by_month(spark):
    series = spark.sql(SERIES)
    by_row = {r.mes: (r.viajes_lag_1, r.viajes_lag_3, r.media_movil_3) for r in m.lag_features(series).collect()}
    assert by_row[5] == (3.0, 1.0, 2.0) and set(by_row) == {5, 6, 7}
    dense = {r.mes: (r.viajes_lag_1, r.viajes_lag_3) for r in m.lag_features(m.densify_months(series)).collect()}
    assert dense[5] == (0.0, 2.0) and set(dense) == {4, 5, 6, 7}


def test_equal_thresholds_are_widened(spark):
    demand = spark.sql("SELECT 2023 AS anio, 2.0D AS cantidad_viajes FROM range(9)")
    assert tuple(m.demand_thresholds(demand, 2024).first()) == (2.0, 3.0)


def test_metrics_of_known_values(spark):
    df = spark.sql("SELECT * FROM VALUES (1.0D, 1.0D), (2.0D, 4.0D), (3.0D, 3.0D) AS t(y, p)")
    got = m.regression_metrics(df, "y", "p").first()
    assert got.rmse == pytest.approx((4 / 3) ** 0.5) and got.mae == pytest.approx(2 / 3) and got.r2 == pytest.approx(-1.0)
    perfect = m.class_metrics(df.selectExpr("y", "y AS p"), "y", "p").first()
    assert (perfect.accuracy, perfect.f1) == (1.0, 1.0)


def test_config_needs_training_years():
    with pytest.raises(ValueError):
        ModelConfig(first_year=2024, test_year=2024, last_year=2025)


def test_output_checks(spark):
    dims = spark.sql("SELECT '2024-01' AS time_id, 2024 AS anio")
    good = spark.sql("SELECT '2024-01' AS time_id")
    config = ModelConfig(2023, 2025, 2025)
    check_outputs({"fact_pronostico_demanda": good}, dims, config)
    with pytest.raises(ValueError, match="invalid month"):
        check_outputs({"fact_pronostico_demanda": spark.sql("SELECT '2030-01' AS time_id")}, dims, config)
    with pytest.raises(ValueError, match="no rows"):
        check_outputs({"x": good.limit(0)}, dims, config)


@pytest.mark.parametrize("values", [
    "CAST(id AS DOUBLE)", "CAST(id % 7 AS DOUBLE)", "IF(id < 19000, 5.0D, id * 1.0D)", "POW(2.0D, id % 600 - 300)", "-1.0D / (id + 1)",
    "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 5 = 0 THEN DOUBLE('NaN') ELSE id * id * 1.0D END",
])
def test_exact_quantiles_by_selection(spark, values):
    df = spark.range(20_000).selectExpr(f"{values} AS v")
    plain = sorted(r.v for r in df.where("v IS NOT NULL AND NOT isnan(v)").collect())
    shares = (0.0, 0.0001, 0.33, 0.5, 0.66, 0.95, 1.0)
    want = [plain[max(1, math.ceil(s * len(plain))) - 1] for s in shares]
    assert m.exact_quantiles(df, "v", shares) == want


def test_exact_quantiles_of_nothing(spark):
    assert m.exact_quantiles(spark.range(0), "id", (0.5,)) == [None]
    assert m.exact_quantiles(spark.range(1), "id", (0.5, 1.0)) == [0.0, 0.0]
