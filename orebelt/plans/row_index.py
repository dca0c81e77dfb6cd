"""Rows deduplicated across refreshes, without reading the rows of former ones.

The index holds a digest of 128 bits for every different row kept so far and the source that
brought it. A new source is reduced to its different rows, whose digests pick the known ones out
of the index: the join's small side is the new source, so Spark can filter the index scan with
it at run time. Only digests of rows that are really new are added, as one delta of a
:class:`~orebelt.sources.merged.MergedTable`, which compacts them by levels.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.session import materialize
from orebelt.sources.merged import MergedTable

_DIGEST = ["_h1", "_h2"]


def with_digest(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``rows`` with two 64-bit hashes of their values; a null is a value of its own place."""
    values = [part for c in columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return rows.withColumn("_h1", F.xxhash64(F.lit(1), *values)).withColumn("_h2", F.xxhash64(F.lit(2), *values))


@dataclass(frozen=True)
class RowIndex:
    """Digests of all rows kept, below a root in the shared folder."""

    root: str

    @property
    def table(self) -> MergedTable:
        return MergedTable(self.root, lambda digests: digests.distinct())

    def keep_new(self, rows: DataFrame, source: str) -> DataFrame:
        """Different rows of ``source`` that no other source brought before; their digests are committed.

        Columns hold no maps and are the same in every call, in order and type. A source that is
        loaded again gets the rows it got before, whoever came in between, and the index does not
        change by it; rows it has gained are new unless another source has them. Fails with ``CommitConflict``,
        adding nothing, if another writer commits meanwhile, so that two sources loaded at once
        do not both keep a row. An empty source commits nothing.
        """
        spark, columns, table = rows.sparkSession, rows.columns, self.table
        base = table.commits.last(spark)
        digested = materialize(with_digest(rows, columns).dropDuplicates(_DIGEST), "digested")
        known = table.read(spark)
        mine = digested.select(*_DIGEST)
        if known is None:
            fresh, added = digested, mine
        else:
            met = materialize(known.join(mine, _DIGEST, "left_semi"), "met")
            fresh = digested.join(met.where(F.col("source") != source), _DIGEST, "left_anti")
            added = mine.join(met, _DIGEST, "left_anti")
        added = materialize(added.withColumn("source", F.lit(source)), "added")
        if not added.isEmpty():
            table.add(added, base)
        return fresh.select(*[F.col(f"`{c}`") for c in columns])

    def size(self, spark: SparkSession) -> int:
        """Number of different rows in the index."""
        known = self.table.read(spark)
        return 0 if known is None else known.count()
