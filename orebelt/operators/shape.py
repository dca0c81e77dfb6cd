"""Schema shaping, union and deduplication."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebelt.functions.names import find_column, quoted, resolve


def conform(df: DataFrame, schema: Mapping[str, str], keep_rest: bool = False) -> DataFrame:
    """Cast to a target schema, typed NULL for absent columns, in one projection.

    Columns are matched without case, so a spelling change never blanks data.
    """
    shaped = [resolve(df, [name], dtype)[0].alias(name) for name, dtype in schema.items()]
    if keep_rest:
        known = {name.lower() for name in schema}
        shaped += [quoted(name) for name in df.columns if name.lower() not in known]
    return df.select(*shaped)


def keep_ordered(df: DataFrame, order: Iterable[str], extras: Iterable[str] = ()) -> DataFrame:
    """Only the named columns that exist, in the given order."""
    found = [(name, find_column(df.columns, [name])) for name in dict.fromkeys([*order, *extras])]
    return df.select(*[quoted(actual).alias(name) for name, actual in found if actual])


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames whose columns differ in order or presence."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def count_copies(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Distinct rows and their number as ``_copies``.

    With ``tasks``, rows are dealt by a digest to that many tasks, which adaptive execution does
    not merge, and grouped there by all columns without a further shuffle.
    """
    every, copies = [quoted(c) for c in df.columns], F.count(F.lit(1)).alias("_copies")
    if tasks is None:
        return df.groupBy(*every).agg(copies)
    dealt = df.withColumn("_digest", F.xxhash64(*every)).repartition(tasks, "_digest")
    return dealt.groupBy("_digest", *every).agg(copies).drop("_digest")


def dedup_rows(df: DataFrame) -> DataFrame:
    """One copy of every distinct row. Copies are merged before the shuffle."""
    return df.dropDuplicates()


def dedup_by_key(df: DataFrame, keys: Sequence[str], prefer: Sequence[Column] = ()) -> DataFrame:
    """One whole row per key: the smallest by ``prefer``, then by all other columns.

    Expressed as a ``min`` over a struct, not as ``row_number``: the minimum is
    taken map-side first, so a key that holds a third of all rows never meets
    in one task, and the kept row does not depend on the partitioning.
    """
    rest = [name for name in df.columns if name not in keys]
    ranked = F.struct(*[c.alias(f"_rank{i}") for i, c in enumerate(prefer)], *[quoted(n) for n in rest])
    kept = df.groupBy(*[quoted(k) for k in keys]).agg(F.min(ranked).alias("_kept"))
    columns = [quoted(n) if n in keys else F.col("_kept").getField(n).alias(n) for n in df.columns]
    return kept.select(*columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def require_unique(df: DataFrame, keys: Sequence[str], name: str) -> None:
    """Raise when a table has a repeated key. Runs one job."""
    clash = duplicate_keys(df, keys).take(1)
    if clash:
        raise ValueError(f"{name} repeats key {clash[0].asDict()}")


def bernoulli_sample(df: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Each row with the given probability, whatever the number of rows; repeatable by seed."""
    return df.sample(fraction=fraction, seed=seed)
