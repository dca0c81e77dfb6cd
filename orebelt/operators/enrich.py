"""Zone lookup joins and trip date parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebelt.functions.values import elapsed_minutes
from orebelt.operators.rules import bind_roles

_PARTS = ("zone", "borough", "service_zone")


def with_zones(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Zone, borough and service zone for both trip ends.

    The lookup plays two roles in two left joins, whose strategy is left to the planner.
    """
    roles = bind_roles(df)
    side = lookup.select("locationid", *_PARTS)
    for end in ("pickup", "dropoff"):
        column = roles.get(f"{end}_location_id")
        if column is None:
            continue
        named = side.select(F.col("locationid").alias("_zone_key"), *[F.col(p).alias(f"{end}_{p}") for p in _PARTS])
        df = df.join(named, column == F.col("_zone_key"), "left").drop("_zone_key")
    return df


def with_trip_parts(df: DataFrame, dataset: str | None = None) -> DataFrame:
    """Hour, weekday (1 = Sunday), month, year, date and minutes of a trip."""
    roles = bind_roles(df)
    parts = []
    if "pickup_datetime" in roles:
        begin = roles["pickup_datetime"]
        parts += [
            F.hour(begin).alias("pickup_hour"),
            F.dayofweek(begin).alias("pickup_day"),
            F.month(begin).alias("pickup_month"),
            F.year(begin).alias("pickup_year"),
            F.to_date(begin).alias("pickup_date"),
        ]
        if "dropoff_datetime" in roles:
            parts.append(elapsed_minutes(begin, roles["dropoff_datetime"]).alias("trip_duration_minutes"))
    if dataset is not None:
        parts.append(F.lit(dataset).alias("taxi_type"))
    return df.select("*", *parts)
