"""Fit and publish the three demand models on the published fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebelt.operators import models
from orebelt.session import materialize


@dataclass(frozen=True)
class ModelConfig:
    """Years, sizes and seed of the model runs."""

    first_year: int = 2023
    last_year: int = 2025
    test_year: int = 2025
    clusters: int = 4
    seed: int = 42
    forecast_trees: int = 80
    forecast_depth: int = 10
    class_trees: int = 80
    class_depth: int = 12
    subsample: float = 0.8

    def __post_init__(self):
        if not self.first_year < self.test_year <= self.last_year:
            raise ValueError("test_year must leave at least one training year inside the range")


def _require_rows(name: str, *frames: DataFrame) -> None:
    if any(frame.isEmpty() for frame in frames):
        raise RuntimeError(f"{name} needs training and test rows")


def _type_encoding() -> list:
    return [
        StringIndexer(inputCol="tipo_dataset", outputCol="tipo_dataset_idx", handleInvalid="keep"),
        OneHotEncoder(inputCols=["tipo_dataset_idx"], outputCols=["tipo_dataset_vec"], handleInvalid="keep"),
    ]


def _assembler(inputs: list[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="skip")


def model_fact(fact: DataFrame, dim_time: DataFrame, config: ModelConfig) -> DataFrame:
    """Fact rows of the modelling years."""
    return models.fact_in_months(fact, models.valid_months(dim_time, config.first_year, config.last_year))


def forecast_demand(fact: DataFrame, config: ModelConfig, dense: bool = False) -> DataFrame:
    """Monthly demand forecast per dataset type and zone for the test years.

    ``fact`` is limited to the modelling years. Features are written once, because
    fitting reads them several times.
    """
    series = models.monthly_series(fact)
    features = models.lag_features(models.densify_months(series) if dense else series)
    train, test = models.split_years(materialize(features, "forecast-features"), config.test_year)
    _require_rows("the forecast", train, test)
    regressor = RandomForestRegressor(
        featuresCol="features",
        labelCol="viajes_reales",
        predictionCol="viajes_predichos",
        numTrees=config.forecast_trees,
        maxDepth=config.forecast_depth,
        subsamplingRate=config.subsample,
        seed=config.seed,
    )
    inputs = [
        "orden_mes", "mes", "trimestre", "pickup_location_id",
        "viajes_lag_1", "viajes_lag_2", "viajes_lag_3", "media_movil_3", "tipo_dataset_vec",
    ]
    fitted = Pipeline(stages=[*_type_encoding(), _assembler(inputs), regressor]).fit(train)
    kept = ("time_id", "tipo_dataset", "pickup_location_id", "viajes_reales", "viajes_predichos")
    predicted = materialize(fitted.transform(test).select(*kept), "forecast")
    metrics = models.regression_metrics(predicted, "viajes_reales", "viajes_predichos").first().asDict()
    return models.forecast_table(predicted, metrics, "RandomForestRegressor con rezagos", F.current_timestamp())


def segment_zones(fact: DataFrame, config: ModelConfig) -> DataFrame:
    """Zones grouped by volume, income, distance and duration."""
    profiles = materialize(models.zone_profiles(fact), "zone-profiles")
    if len(profiles.take(config.clusters)) < config.clusters:
        raise RuntimeError(f"segmentation needs at least {config.clusters} zone profiles")
    inputs = [
        "log_cantidad_viajes", "log_ingreso_total", "viajes_por_mes",
        "ticket_promedio", "distancia_promedio", "duracion_promedio",
    ]
    scaler = StandardScaler(inputCol="unscaled", outputCol="scaled", withStd=True, withMean=True)
    kmeans = KMeans(k=config.clusters, seed=config.seed, featuresCol="scaled", predictionCol="cluster_id")
    clustered = Pipeline(stages=[_assembler(inputs, "unscaled"), scaler, kmeans]).fit(profiles).transform(profiles)
    silhouette = ClusteringEvaluator(
        featuresCol="scaled", predictionCol="cluster_id", metricName="silhouette"
    ).evaluate(clustered)
    return models.segment_table(clustered, float(silhouette), f"KMeans k={config.clusters}", F.current_timestamp())


def classify_demand(fact: DataFrame, config: ModelConfig, relative_error: float = 0.01) -> DataFrame:
    """Hourly demand class per month, dataset type and zone for the test years."""
    demand = materialize(models.hourly_demand(fact), "hourly-demand")
    low, high = models.demand_thresholds(demand, config.test_year, relative_error=relative_error).first()
    if low is None:
        raise RuntimeError("classification needs training rows")
    train, test = models.split_years(models.demand_classes(demand, F.lit(low), F.lit(high)), config.test_year)
    _require_rows("classification", train, test)
    classifier = RandomForestClassifier(
        featuresCol="features",
        labelCol="clase_demanda_id",
        predictionCol="clase_predicha_id",
        probabilityCol="probability",
        numTrees=config.class_trees,
        maxDepth=config.class_depth,
        subsamplingRate=config.subsample,
        seed=config.seed,
    )
    inputs = ["mes", "trimestre", "hora_id", "pickup_location_id", "tipo_dataset_vec"]
    fitted = Pipeline(stages=[*_type_encoding(), _assembler(inputs), classifier]).fit(train)
    kept = (
        "time_id", "hora_id", "tipo_dataset", "pickup_location_id",
        "cantidad_viajes", "clase_demanda_id", "clase_predicha_id",
    )
    scored = fitted.transform(test).select(*kept, vector_to_array("probability").alias("probability"))
    predicted = materialize(scored, "classes")
    metrics = models.class_metrics(predicted, "clase_demanda_id", "clase_predicha_id").first().asDict()
    return models.class_table(
        predicted, F.col("probability"), metrics, low, high, "RandomForestClassifier", F.current_timestamp()
    )


def check_outputs(tables: dict[str, DataFrame], dim_time: DataFrame, config: ModelConfig) -> None:
    """Raise when a result is empty or the forecast leaves the valid years."""
    for name, table in tables.items():
        if table.isEmpty():
            raise ValueError(f"{name} has no rows")
    if "fact_pronostico_demanda" in tables:
        forecast = tables["fact_pronostico_demanda"]
        wrong = models.output_problems(forecast, dim_time, config.first_year, config.last_year).take(1)
        if wrong:
            raise ValueError(f"forecast has an invalid month: {wrong[0].asDict()}")
