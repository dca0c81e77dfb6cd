"""Registry of queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with SQL over the same tables where SQL can say it."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return add


# Means of decimal amounts can sit exactly between two rounded values, where the order of
# a float sum decides; this moves them off that point on both sides of a comparison.
OFF_TIE = 3.7e-8


def rounded(df: DataFrame, digits: int = 6, means: tuple[str, ...] = (), **special: int) -> DataFrame:
    """Doubles rounded, so that the order of float sums does not show in comparisons."""

    def value(name: str):
        column = F.col(f"`{name}`")
        return column + OFF_TIE if name in means else column

    columns = [
        F.round(value(f.name), special.get(f.name, digits)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*columns)


def with_ctes(*ctes: str, select: str) -> str:
    """``WITH a AS (…), b AS (…) SELECT …`` from named parts."""
    return "WITH " + ",\n".join(ctes) + "\n" + select
