"""Incremental state: source identity, fingerprints, change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORDS = range(4)


def source_id(path: Column) -> Column:
    """Readable, collision-safe id of a source path: slug of its name and a short hash."""
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    slug = F.lower(F.regexp_replace(F.regexp_replace(stem, "[^a-zA-Z0-9]+", "_"), "^_+|_+$", ""))
    return F.concat(slug, F.lit("_"), F.substring(F.sha1(path), 1, 8))


def file_digest(*parts: Column) -> Column:
    """SHA-256 of one file's identity (path, size, time)."""
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)


def source_fingerprints(files: DataFrame, by: Sequence[str] = ("source_id",)) -> DataFrame:
    """One fingerprint per source over its files.

    Needs ``path, size_bytes, modified_at``. File digests are combined as sums of
    their four 64-bit words. Sums merge in any order with constant state, so no
    source's file list is ever gathered in one place.
    """
    digest = file_digest(F.col("path"), F.col("size_bytes"), F.unix_micros("modified_at"))
    words = [
        F.sum(F.conv(F.substring("_digest", 16 * i + 1, 16), 16, 10).cast("decimal(20,0)")).alias(f"_w{i}")
        for i in _WORDS
    ]
    merged = (
        files.select(*by, "size_bytes", "modified_at", digest.alias("_digest"))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("part_files"),
            F.sum("size_bytes").alias("total_bytes"),
            F.max("modified_at").alias("latest_modified"),
            *words,
        )
    )
    identity = F.concat_ws("|", *[F.col(c).cast("string") for c in ("part_files", "total_bytes", *[f"_w{i}" for i in _WORDS])])
    return merged.select(*by, F.sha2(identity, 256).alias("fingerprint"), "part_files", "total_bytes", "latest_modified")


def pending(available: DataFrame, processed: DataFrame, keys: Sequence[str], force: bool = False) -> DataFrame:
    """Units of work not yet recorded as done."""
    if force:
        return available
    return available.join(processed.select(*keys).distinct(), list(keys), "left_anti")


def pending_months(available: DataFrame, processed: DataFrame, profiled: DataFrame, force: bool = False) -> DataFrame:
    """Months to profile: the new ones, or all months of a year that already has a profile
    and gained new ones, because the yearly profile is then rebuilt as a whole."""
    scope = ["dataset", "year"]
    fresh = pending(available, processed, [*scope, "month"], force)
    rebuilt = fresh.select(*scope).distinct().join(profiled.select(*scope), scope, "left_semi")
    whole = available.join(rebuilt, scope, "left_semi")
    return whole.unionByName(fresh.join(rebuilt, scope, "left_anti"))


def compare_sources(current: DataFrame, state: DataFrame, staged: DataFrame | None = None, force: bool = False) -> DataFrame:
    """Change class per source: new, changed, staging_missing, forced, unchanged or gone.

    ``current`` and ``state`` have ``source_id, fingerprint``; ``staged`` lists the
    sources whose contribution exists.
    """
    now = current.select("source_id", F.col("fingerprint").alias("fingerprint"))
    was = state.select("source_id", F.col("fingerprint").alias("previous_fingerprint"))
    joined = now.join(was, "source_id", "full_outer")
    if staged is None:
        joined = joined.withColumn("_staged", F.lit(True))
    else:
        joined = joined.join(staged.select("source_id", F.lit(True).alias("_staged")).distinct(), "source_id", "left")
    change = (
        F.when(F.col("fingerprint").isNull(), "gone")
        .when(F.col("previous_fingerprint").isNull(), "new")
        .when(F.lit(force), "forced")
        .when(~F.col("fingerprint").eqNullSafe(F.col("previous_fingerprint")), "changed")
        .when(F.col("_staged").isNull(), "staging_missing")
        .otherwise("unchanged")
    )
    return joined.select("source_id", "fingerprint", "previous_fingerprint", change.alias("change"))


def latest_state(log: DataFrame, key: str = "source_id", order: str = "recorded_at") -> DataFrame:
    """Last entry per key of an append-only state table."""
    rest = [c for c in log.columns if c != key]
    newest = log.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_last"))
    return newest.select(key, "_last.*").select(*log.columns)
