"""Report tables over cleaning summaries, profiles and quality scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebelt import contract
from orebelt.functions.values import ratio


def group_stats(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Size and mean of a value per group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.avg(value).alias(f"mean_{value}"))


def best_and_worst(df: DataFrame, label: str, value: str) -> DataFrame:
    """Label with the highest and the lowest value, ties by label."""
    return df.agg(
        F.min_by(label, F.struct(-F.col(value), F.col(label))).alias("best"),
        F.max(value).alias("best_value"),
        F.min_by(label, F.struct(F.col(value), F.col(label))).alias("worst"),
        F.min(value).alias("worst_value"),
    )


def growth(df: DataFrame, by: Sequence[str], period: str, value: str) -> DataFrame:
    """Value in the first and last period and the change in percent."""
    ends = df.groupBy(*by).agg(
        F.min_by(value, period).alias("first_value"), F.max_by(value, period).alias("last_value")
    )
    first, last = F.col("first_value"), F.col("last_value")
    change = F.when(first > 0, (last - first) / first * 100).otherwise(F.lit(0.0))
    return ends.select("*", change.alias("growth_pct"))


def dataset_summary(scores: DataFrame, by: Sequence[str] = ("dataset",)) -> DataFrame:
    """Years, months, records in millions and mean score per dataset, largest first."""
    return (
        scores.groupBy(*by)
        .agg(
            F.count_distinct("year").alias("years"),
            F.sum("months").alias("months"),
            (F.sum("records") / F.lit(1_000_000.0)).alias("records_millions"),
            F.avg("quality_score").alias("quality"),
        )
        .where(F.col("records_millions") > 0)
        .orderBy(F.desc("records_millions"), *by)
    )


def cleaning_totals(summary: DataFrame) -> DataFrame:
    """Global records, removed share and quality over all datasets and years."""
    totals = summary.agg(*[F.sum(c).alias(c) for c in ("original", "removed", "final")])
    original = F.col("original")
    return totals.select(
        "*",
        (ratio(F.col("removed"), original) * 100).alias("removed_pct"),
        (ratio(F.col("final"), original) * 100).alias("quality_pct"),
    )


def cleaning_effectiveness(counts: DataFrame) -> DataFrame:
    """Removed records per cleaning dimension and their share of all removals."""
    removed = F.sum("removed")
    sums = [
        F.coalesce(F.sum(F.when(F.col("dimension") == d, F.col("removed"))), F.lit(0)).alias(d)
        for d in contract.CLEANING_DIMENSIONS
    ]
    wide = counts.agg(removed.alias("_total"), *sums)
    entries = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("removed")) for d in contract.CLEANING_DIMENSIONS]
    )
    return wide.select("_total", F.inline(entries)).select(
        "dimension", "removed", (ratio(F.col("removed"), F.col("_total"), 0.0) * 100).alias("share_pct")
    )


def cleaning_by_type(summary: DataFrame, dataset: str = "taxi_type") -> DataFrame:
    """Mean quality (100 − mean removed %) per dataset type."""
    return summary.groupBy(dataset).agg((100 - F.avg("removed_pct")).alias("quality"))


def quality_pivot(scores: DataFrame, dataset: str = "taxi_type") -> DataFrame:
    """Mean score in percent, datasets by dimensions."""
    dimensions = list(contract.QUALITY_WEIGHTS)
    return scores.groupBy(dataset).pivot("dimension", dimensions).agg(F.avg(F.col("score") * 100))


def quality_by_dimension(scores: DataFrame) -> DataFrame:
    """Mean score in percent per dimension, best first."""
    named = scores.where(F.col("dimension") != "overall")
    return named.groupBy("dimension").agg(F.avg(F.col("score") * 100).alias("mean_score")).orderBy(
        F.desc("mean_score"), "dimension"
    )


def issue_counts(issues: DataFrame, dataset: str = "taxi_type") -> DataFrame:
    """Issues per dataset type and per dimension named by the issue text."""
    word = F.regexp_extract("issue", "([A-Za-z]+)", 1)
    by_type = issues.groupBy(F.col(dataset).alias("item")).agg(F.count(F.lit(1)).alias("issues"))
    by_dimension = issues.groupBy(word.alias("item")).agg(F.count(F.lit(1)).alias("issues"))
    return by_type.select(F.lit("type").alias("kind"), "item", "issues").unionByName(
        by_dimension.select(F.lit("dimension").alias("kind"), "item", "issues")
    )


def final_vs_initial(final: DataFrame, initial: DataFrame, improvement: DataFrame, by: Sequence[str]) -> DataFrame:
    """Scores before and after cleaning with the mean null improvement."""
    gain = improvement.groupBy(*by).agg(F.avg("improvement_pct").alias("mean_improvement"))
    before = initial.select(*by, F.col("quality_score").alias("initial_score"))
    after = final.select(*by, F.col("quality_score").alias("final_score"), "records")
    return after.join(before, list(by), "left").join(gain, list(by), "left")
