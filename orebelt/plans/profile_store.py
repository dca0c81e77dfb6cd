"""Profiles of any span of months from stored monthly states.

A state is written once per month and dataset; a refresh scans only months that have none yet,
or those asked for. Yearly profiles are merges of stored states and read no record.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.operators.incremental import pending
from orebelt.operators.profile import merge_states, profile_scores, profile_states
from orebelt.session import materialize
from orebelt.sources.sinks import exists, overwrite_partitions


@dataclass(frozen=True)
class ProfileStore:
    """Monthly profile states below a path, partitioned by ``scope`` and ``month``."""

    path: str
    scope: tuple[str, ...] = ("taxi_type", "file_year")
    month: str = "file_month"

    @property
    def _keys(self) -> list[str]:
        return [*self.scope, self.month]

    def states(self, spark: SparkSession) -> DataFrame | None:
        """Stored states; None before the first refresh."""
        return spark.read.parquet(self.path) if exists(spark, self.path) else None

    def refresh(self, spark: SparkSession, records: DataFrame, columns: Sequence[str] | None = None, force: bool = False, available: DataFrame | None = None) -> DataFrame:
        """Profile the months without a state, or all, and return them.

        ``available`` lists the months there are, such as a file catalog; without it they are
        taken from the key columns. Where those are partition columns of ``records``, files of
        other years and months than the pending ones are not opened. Every month is replaced
        whole, so a repeated refresh changes nothing.
        """
        months = (records if available is None else available).select(*self._keys).distinct()
        held = self.states(spark)
        if held is not None:
            months = pending(months, held, self._keys, force)
        months = materialize(months, "pending-months")
        # a few types, years and month numbers, as literals that prune partitions; the join is exact
        values = months.agg(*[F.collect_set(k).alias(k) for k in self._keys]).first()
        if all(values):
            fresh = records
            for key in self._keys:
                fresh = fresh.where(F.col(key).isin(values[key]))
            fresh = fresh.join(months, self._keys, "left_semi")
            overwrite_partitions(profile_states(fresh, self._keys, columns), self.path, self._keys)
        return months

    def profile(self, spark: SparkSession, by: Sequence[str] | None = None, where: str | None = None) -> DataFrame | None:
        """Profile per ``by`` (the scope, unless given) over the stored months, or some of them."""
        held = self.states(spark)
        if held is None:
            return None
        by = self.scope if by is None else by
        return merge_states(held if where is None else held.where(where), by, [k for k in self._keys if k not in by])

    def trend(self, spark: SparkSession, policy: str = "initial") -> DataFrame | None:
        """Per scope, in order: months stored, records and quality score."""
        merged, held = self.profile(spark), self.states(spark)
        if merged is None:
            return None
        months = held.select(*self._keys).distinct().groupBy(*self.scope).agg(F.count(F.lit(1)).alias("months"))
        scores = profile_scores(merged, self.scope, policy)
        return scores.join(months, list(self.scope)).select(*self.scope, "months", "records", "quality_score").orderBy(*self.scope)
