"""Tables published as whole versions, each recorded by a numbered commit."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.sources.commits import CommitLog

_SCHEMA = "version string, published_at timestamp"


def _log(base: str) -> CommitLog:
    return CommitLog(f"{base}/versions", _SCHEMA)


def publish_version(df: DataFrame, base: str, partition_by: Sequence[str] = (), after: int | None = None) -> str:
    """Write a new version directory, then record it by the next commit.

    Readers take the last commit's version, so they see the old table or the new one, never a
    half-written one; no data is moved or overwritten. ``after`` is the commit the new version
    was derived from: if another writer has published since, this one fails and changes nothing.
    """
    version = f"{base}/v-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(version)
    record = df.sparkSession.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("published_at"))
    _log(base).append(record, after)
    return version


def last_commit(spark: SparkSession, base: str) -> int:
    """Number of the last publication, 0 before the first."""
    return _log(base).last(spark)


def read_current(spark: SparkSession, base: str) -> DataFrame:
    """The version published last."""
    latest = _log(base).read(spark).agg(F.max_by("version", "seq")).first()[0]
    return spark.read.parquet(latest)
