"""Column names: normalisation and case-insensitive resolution."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """Column reference that is safe for dots, spaces and backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def snake_name(name: str) -> str:
    """Lower snake_case form of a column name."""
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def snake_names(names: Iterable[str]) -> list[str]:
    """snake_case names with ``_2``, ``_3`` … for those that collide."""
    taken: set[str] = set()
    result = []
    for base in map(snake_name, names):
        options = (base if n == 1 else f"{base}_{n}" for n in range(1, len(taken) + 2))
        chosen = next(option for option in options if option not in taken)
        taken.add(chosen)
        result.append(chosen)
    return result


def with_snake_names(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case in one projection."""
    renamed = snake_names(df.columns)
    if renamed == df.columns:
        return df
    return df.toDF(*renamed)


def with_lower_names(df: DataFrame) -> DataFrame:
    """Lower-case names, blanks to underscores (lookup tables)."""
    return df.toDF(*[name.lower().replace(" ", "_") for name in df.columns])


def find_column(columns: Iterable[str], candidates: Iterable[str]) -> str | None:
    """First candidate present among the columns, compared without case.

    The answer is the column's own spelling, so a later ``col()`` never
    depends on the session's case setting.
    """
    present = {name.lower(): name for name in columns}
    return next((present[c.lower()] for c in candidates if c.lower() in present), None)


def typed(df: DataFrame, name: str, dtype: str) -> Column:
    """Column as ``dtype``; no cast where the type already fits, so scans can prune on it."""
    actual = df.schema[name].dataType.simpleString()
    if actual == dtype or {actual, dtype} == {"timestamp", "timestamp_ntz"} and dtype == "timestamp":
        return quoted(name)
    return quoted(name).try_cast(dtype)


def belongs(layouts: Mapping[str, Iterable[str]], candidates: Iterable[str]) -> list[str]:
    """Dataset types whose own layout has one of the candidates, spelt any way."""
    wanted = {snake_name(c) for c in candidates}
    return [dataset for dataset, columns in layouts.items() if wanted & {snake_name(c) for c in columns}]


def resolve(df: DataFrame, candidates: Iterable[str], dtype: str) -> tuple[Column, str | None]:
    """Expression for the first existing candidate, or a typed NULL, with its source name."""
    source = find_column(df.columns, candidates)
    if source is None:
        return F.lit(None).cast(dtype), None
    return typed(df, source, dtype), source


def resolve_first_value(df: DataFrame, candidates: Iterable[str], dtype: str) -> Column:
    """Row-wise first non-null value over all candidates that exist."""
    present = [found for c in candidates if (found := find_column(df.columns, [c]))]
    if not present:
        return F.lit(None).cast(dtype)
    return F.coalesce(*[typed(df, name, dtype) for name in dict.fromkeys(present)])
