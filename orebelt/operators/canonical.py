"""Canonical trip table: resolve, cast, derive, order in one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.contract import CANONICAL_EXTRAS, CANONICAL_FIELDS, CANONICAL_ORDER
from orebelt.functions.names import find_column, resolve, resolve_first_value, snake_name, with_snake_names
from orebelt.functions.values import elapsed_seconds
from orebelt.operators.shape import keep_ordered

Candidates = Mapping[str, tuple[str, ...]]


def _sources(extra: Candidates | None) -> dict[str, tuple[str, ...]]:
    more = extra or {}
    return {f.name: (f.name, *f.sources, *more.get(f.name, ())) for f in CANONICAL_FIELDS}


def canonicalise(
    df: DataFrame,
    dataset: str | Column,
    year: int | Column,
    extra_sources: Candidates | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Source layout to canonical layout.

    ``dataset`` and ``year`` are literals for one source or columns of the frame.
    A canonical column always gets its canonical type, also when the source
    already carries the canonical name. ``extra_sources`` adds candidates,
    ``carry`` keeps further columns such as ``source_id``.
    """
    named = with_snake_names(df)
    candidates = _sources(extra_sources)
    resolved = {f.name: _flag_aware(named, f.name, candidates[f.name], f.dtype) for f in CANONICAL_FIELDS}
    begin, end = resolved["pickup_datetime"], resolved["dropoff_datetime"]
    seconds = _existing(named, "duracion_segundos", "bigint", elapsed_seconds(begin, end))
    derived = {
        "tipo_dataset": _existing(named, "tipo_dataset", "string", _as_column(named, dataset)),
        "anio": _existing(named, "anio", "int", _as_column(named, year).cast("int")),
        "duracion_segundos": seconds,
        "duracion_minutos": _existing(named, "duracion_minutos", "double", seconds / F.lit(60.0)),
        "pickup_date": _existing(named, "pickup_date", "date", F.to_date(begin)),
        "pickup_hour": _existing(named, "pickup_hour", "int", F.hour(begin)),
        "pickup_day_of_week": _existing(named, "pickup_day_of_week", "int", F.dayofweek(begin)),
        "pickup_month": _existing(named, "pickup_month", "int", F.month(begin)),
    }
    columns = {**resolved, **derived}
    extras = [c for c in CANONICAL_EXTRAS if c in named.columns]
    return named.select(*carry, *[columns[name].alias(name) for name in CANONICAL_ORDER], *extras)


def _flag_aware(df: DataFrame, name: str, candidates: tuple[str, ...], dtype: str) -> Column:
    source = resolve(df, candidates, dtype)[1]
    value = resolve_first_value(df, candidates, dtype)  # types of different layouts may share a frame
    if name == "shared_ride_flag" and source and df.schema[source].dataType.simpleString() == "string":
        letter = F.upper(F.trim(F.col(source)))
        return F.when(letter == "Y", 1).when(letter == "N", 0).otherwise(value).cast(dtype)
    return value


def _existing(df: DataFrame, name: str, dtype: str, fallback: Column) -> Column:
    return resolve(df, [name], dtype)[0] if name in df.columns else fallback


def _as_column(df: DataFrame, value: str | int | Column) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str) and snake_name(value) in df.columns:
        return F.col(snake_name(value))
    return F.lit(value)


def lineage(spark: SparkSession, df: DataFrame, dataset: str, extra_sources: Candidates | None = None) -> DataFrame:
    """Which source column feeds each canonical column; NULL where it is created empty."""
    columns = with_snake_names(df).columns
    candidates = _sources(extra_sources)
    rows = [(dataset, f.name, find_column(columns, candidates[f.name])) for f in CANONICAL_FIELDS]
    sourced = spark.createDataFrame(rows, "dataset string, canonical string, source string")
    return sourced.withColumn("created", ~F.col("canonical").isin(columns))


def prune_to_canonical(df: DataFrame) -> DataFrame:
    """Canonical columns and known extras only, in canonical order."""
    return keep_ordered(df, CANONICAL_ORDER, CANONICAL_EXTRAS)
