"""Bronze to silver: consolidate, unify, clean, enrich, derive, canonicalise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebelt.operators.canonical import canonicalise
from orebelt.operators.enrich import with_trip_parts, with_zones
from orebelt.operators.rules import Rule, clean, light_clean, trip_rules
from orebelt.operators.shape import conform
from orebelt.sources.sinks import overwrite_partitions


def silver_trips(
    raw: DataFrame,
    lookup: DataFrame | None = None,
    schema: Mapping[str, str] | None = None,
    rules: Sequence[Rule] | None = None,
    light: bool = False,
    layouts: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Cleaned and enriched trips of any number of dataset types and years.

    ``raw`` carries ``taxi_type`` and ``file_year``. ``light`` takes the reduced
    cleaning for the largest sources. ``layouts`` (such as ``contract.SOURCE_SCHEMAS``)
    says which columns each type has of its own where they differ.
    """
    shaped = raw if schema is None else conform(raw, {**schema, "taxi_type": "string", "file_year": "int"})
    cleaned = light_clean(shaped) if light else clean(shaped, trip_rules() if rules is None else rules, layouts=layouts)
    enriched = cleaned if lookup is None else with_zones(cleaned, lookup)
    return with_trip_parts(enriched)


def canonical_trips(silver: DataFrame) -> DataFrame:
    """Silver trips in the canonical layout."""
    return canonicalise(silver, F.col("taxi_type"), F.col("file_year"))


def write_silver(silver: DataFrame, path: str) -> None:
    """One partitioned table for all types and years; a rerun replaces its own partitions."""
    scope = ["taxi_type", "file_year"]
    overwrite_partitions(silver.hint("rebalance", *scope), path, scope)
