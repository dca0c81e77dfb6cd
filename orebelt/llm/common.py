"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Runs of anything but space and the five ASCII control blanks.
BLANK_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    return F.translate(text, _UPPER, _UPPER.lower())


def words(text: Column, pattern: str) -> Column:
    """All matches of a pattern in order; none for a null text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def run_hash(tokens: Column, width: int, first: Column | int = 0) -> Column:
    """XXH64 of the ``width`` tokens from ``first`` on (what lies beyond the end is left out).

    Single elements are read: a slice would copy the whole list for each run.
    """
    return F.xxhash64(*[F.get(tokens, F.lit(first) + j if isinstance(first, int) else first + j) for j in range(width)])


def window_hashes(tokens: Column, width: int) -> Column:
    """Hash of each run of ``width`` tokens; a shorter, non-empty list is one run."""
    last = F.greatest(F.size(tokens) - F.lit(width), F.lit(0))
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: run_hash(tokens, width, i))
    return F.when(F.size(tokens) > 0, runs).otherwise(F.array().cast("array<bigint>"))


def quality_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling weight of labelled documents: good ones twice as likely, poor ones half."""
    labels = table(spark, sf_dir, "labels")
    return labels.select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).alias("quality"))
