"""Tables whose rows merge: written as small deltas, read as one merge.

Fit for states that merge in any order and grouping and where merging a delta twice changes
nothing, such as folds by minimum and maximum. A delta is a folder of rows and a numbered commit that names
it. Deltas of one level are merged into one of the next as in :mod:`orebelt.plans.star_refresh`,
so a read opens a number of deltas logarithmic in the writes.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.sources.commits import CommitLog
from orebelt.sources.sinks import delete, modified_at

_COMMITS = "delta string, level int, active boolean"


@dataclass(frozen=True)
class MergedTable:
    """Deltas below a root; ``merge`` turns rows of many deltas into one row per key."""

    root: str
    merge: Callable[[DataFrame], DataFrame]

    @property
    def commits(self) -> CommitLog:
        return CommitLog(f"{self.root}/commits", _COMMITS, "delta")

    def _path(self, delta: str) -> str:
        return f"{self.root}/deltas/{delta}"

    def _write(self, rows: DataFrame) -> str:
        delta = f"d-{uuid.uuid4().hex}"
        rows.write.parquet(self._path(delta))
        return delta

    def add(self, rows: DataFrame, after: int | None = None) -> None:
        """Commit rows, already merged among themselves, as a delta.

        With ``after``, the last commit they were derived from, fails if there is a later one.
        """
        delta = self._write(rows)
        self.commits.append(rows.sparkSession.range(1).select(F.lit(delta).alias("delta"), F.lit(0).alias("level"), F.lit(True).alias("active")), after)

    def deltas(self, spark: SparkSession) -> dict[str, int]:
        """Deltas in force and their levels."""
        return {row["delta"]: row["level"] for row in self.commits.state(spark).where("active").collect()}

    def read(self, spark: SparkSession) -> DataFrame | None:
        """All rows merged; None before the first delta."""
        paths = [self._path(delta) for delta in self.deltas(spark)]
        return self.merge(spark.read.parquet(*paths)) if paths else None

    def compact(self, spark: SparkSession, fanout: int = 8) -> None:
        """Merge deltas level by level until no level has ``fanout`` of them.

        Fails with ``CommitConflict``, changing nothing, if another writer commits meanwhile.
        """
        while True:
            base, levels = self.commits.last(spark), {}
            for delta, level in self.deltas(spark).items():
                levels.setdefault(level, []).append(delta)
            full = next((level for level in sorted(levels) if len(levels[level]) >= fanout), None)
            if full is None:
                self.commits.checkpoint(spark)
                return
            made = self._write(self.merge(spark.read.parquet(*[self._path(d) for d in levels[full]])))
            rows = [(made, full + 1, True), *[(d, full, False) for d in levels[full]]]
            self.commits.append(spark.createDataFrame(rows, _COMMITS), base)

    def vacuum(self, spark: SparkSession, grace_seconds: float = 7 * 86400) -> list[str]:
        """Delete deltas out of force and commits a checkpoint covers, where older than the grace period."""
        held, limit = self.deltas(spark), time.time() - grace_seconds
        old = self.commits.trim(spark, limit)
        for name, at in modified_at(spark, f"{self.root}/deltas"):
            if name not in held and at <= limit:
                delete(spark, self._path(name))
                old.append(self._path(name))
        return old
