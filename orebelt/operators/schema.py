"""Schema snapshots, drift between periods, unified schemas and their reports.

Schemas are long tables: ``dataset, year, month, column, dtype``. A table has one
row per column and period, so it stays small however large the data is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orebelt.contract import SOURCE_SCHEMAS, TYPE_WIDTH

def snapshot_of_files(schemas: DataFrame) -> DataFrame:
    """Schema per (dataset, year, month) from per-file schemas of Hive-partitioned files.

    Files of one month that disagree count at their widest type.
    """
    part = {"dataset": "tipo_dataset", "year": "anio", "month": "mes"}
    period = [F.regexp_extract("path", f"/{key}=([^/]+)/", 1).alias(name) for name, key in part.items()]
    located = schemas.select(*period, "column", "dtype").where(F.col("dataset") != "")
    typed = located.withColumns({c: F.col(c).cast("int") for c in ("year", "month")})
    return widest_types(typed, ["dataset", "year", "month", "column"])


def observed_schema(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Columns that hold any value per scope, with their declared type."""
    filled = df.groupBy(*by).agg(*[F.count(F.col(c)).alias(f"_n_{c}") for c in columns])
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
            F.col(f"_n_{c}").alias("_filled"),
        )
        for c in columns
    ]
    return filled.select(*by, F.inline(F.array(*entries))).where(F.col("_filled") > 0).drop("_filled")


def _compare(snapshot: DataFrame, links: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New, removed and retyped columns for every pair of adjacent periods.

    Each column row is sent to the comparison it is the earlier side of and to the
    one it is the later side of; grouping by comparison and column then shows which
    side is missing. No full outer join, and no pairing of columns.
    """
    sides = F.array(
        F.struct(F.col("previous").alias("from_period"), F.col("period").alias("to_period"), F.lit(1).alias("side")),
        F.struct(F.col("period").alias("from_period"), F.col("following").alias("to_period"), F.lit(0).alias("side")),
    )
    spread = (
        snapshot.join(links, [*keys, "period"])
        .select(*keys, "column", "dtype", F.inline(sides))
        .where(F.col("from_period").isNotNull() & F.col("to_period").isNotNull())
    )
    both = spread.groupBy(*keys, "from_period", "to_period", "column").agg(
        F.max(F.when(F.col("side") == 0, F.col("dtype"))).alias("previous_type"),
        F.max(F.when(F.col("side") == 1, F.col("dtype"))).alias("current_type"),
    )
    change = (
        F.when(F.col("previous_type").isNull(), "new")
        .when(F.col("current_type").isNull(), "removed")
        .when(F.col("previous_type") != F.col("current_type"), "type")
    )
    return both.select(*keys, "from_period", "to_period", "column", change.alias("change"), "previous_type", "current_type").where(
        F.col("change").isNotNull()
    )


def _links(snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy("period")
    periods = snapshot.select(*keys, "period").distinct()
    return periods.select(
        *keys, "period", F.lag("period").over(order).alias("previous"), F.lead("period").over(order).alias("following")
    )


def drift_by_month(snapshot: DataFrame) -> DataFrame:
    """Changes between adjacent available months of the same year."""
    keyed = snapshot.withColumn("period", F.format_string("%04d-%02d", "year", "month")).drop("month")
    return _compare(keyed, _links(keyed, ["dataset", "year"]), ["dataset", "year"]).drop("year")


def drift_by_year(snapshot: DataFrame) -> DataFrame:
    """Changes between adjacent available years, each seen through its first month."""
    first = snapshot.groupBy("dataset", "year").agg(F.min("month").alias("month"))
    keyed = snapshot.join(first, ["dataset", "year", "month"]).select(
        "dataset", F.col("year").cast("string").alias("period"), "column", "dtype"
    )
    return _compare(keyed, _links(keyed, ["dataset"]), ["dataset"])


def type_class(dtype: Column) -> Column:
    """Type name without precision: ``decimal(10,2)`` to ``decimal``."""
    base = F.regexp_extract(F.lower(dtype), "^[a-z]+", 0)
    return F.when(base.startswith("timestamp"), "timestamp").otherwise(base)


def width_rank(dtype: Column) -> Column:
    """Position in the width order, 0 is widest; unknown types come last."""
    pairs = [F.lit(item) for rank, name in enumerate(TYPE_WIDTH) for item in (name, rank)]
    return F.coalesce(F.element_at(F.create_map(*pairs), type_class(dtype)), F.lit(99))


def widest_types(types: DataFrame, by: Sequence[str], dtype: str = "dtype") -> DataFrame:
    """Widest type per group; among decimals the one with most digits, kept verbatim."""
    value = F.col(dtype)
    digits = F.coalesce(F.regexp_extract(value, r"\((\d+)", 1).try_cast("int"), F.lit(0))
    kept = F.when(type_class(value) == "decimal", value).otherwise(type_class(value))
    return types.groupBy(*by).agg(F.min_by(kept, F.struct(width_rank(value), -digits, kept)).alias("dtype"))


def default_schemas(spark: SparkSession) -> DataFrame:
    """Known columns of every dataset type as a long table."""
    rows = [(dataset, c, t) for dataset, schema in SOURCE_SCHEMAS.items() for c, t in schema.items()]
    return spark.createDataFrame(rows, "dataset string, column string, dtype string")


def unified_schema(snapshot: DataFrame, defaults: DataFrame | None = None) -> DataFrame:
    """One schema per dataset: known and observed columns at their widest type, by name.

    Spellings that differ by case only are one column; a known spelling wins.
    """
    observed = snapshot.select("dataset", "column", "dtype", F.lit(1).alias("_late")).distinct()
    if defaults is not None:
        observed = observed.unionByName(defaults.select("dataset", "column", "dtype", F.lit(0).alias("_late")))
    keyed = observed.withColumn("_key", F.lower("column"))
    names = keyed.groupBy("dataset", "_key").agg(F.min_by("column", F.struct("_late", "column")).alias("column"))
    return (
        widest_types(keyed, ["dataset", "_key"])
        .join(names, ["dataset", "_key"])
        .select("dataset", "column", "dtype")
        .orderBy("dataset", "column")
    )


def unified_schema_from_drift(defaults: DataFrame, drift: DataFrame) -> DataFrame:
    """Parity form of :func:`unified_schema` that only sees a drift report.

    A column reported as new or removed counts as text in addition to its known
    type, and text is widest, so it ends up as text.
    """
    reported = drift.where(F.col("change").isin("new", "removed")).select(
        "dataset", "column", F.lit("string").alias("dtype")
    )
    pooled = defaults.select("dataset", "column", "dtype").unionByName(reported.distinct())
    return widest_types(pooled, ["dataset", "column"]).orderBy("dataset", "column")


def as_mapping(schema: DataFrame, dataset: str) -> dict[str, str]:
    """Unified schema of one dataset as a name-to-type mapping for ``conform``."""
    rows = schema.where(F.col("dataset") == dataset).orderBy("column").collect()
    return {row["column"]: row["dtype"] for row in rows}


def drift_summary(snapshot: DataFrame, yearly: DataFrame, monthly: DataFrame) -> DataFrame:
    """Changed transitions per dataset, by year and by month, with the periods compared."""
    base = snapshot.groupBy("dataset").agg(
        F.count_distinct("year").alias("years"), F.count_distinct("year", "month").alias("months")
    )

    def changed(drift: DataFrame, name: str) -> DataFrame:
        return drift.groupBy("dataset").agg(F.count_distinct("from_period", "to_period").alias(name))

    joined = base.join(changed(yearly, "yearly_changes"), "dataset", "left").join(
        changed(monthly, "monthly_changes"), "dataset", "left"
    )
    filled = joined.fillna(0, ["yearly_changes", "monthly_changes"])
    return filled.withColumn("total_changes", F.col("yearly_changes") + F.col("monthly_changes"))


def schema_stability(summary: DataFrame) -> DataFrame:
    """Stability 0–100 by year and month, and their mean."""

    def stability(changes: str, periods: str, weight: float) -> Column:
        loss = F.col(changes) / (F.col(periods) - 1) * weight
        return F.when(F.col(periods) > 1, F.greatest(F.lit(0.0), 100.0 - loss)).otherwise(F.lit(100.0))

    by_year = stability("yearly_changes", "years", 50)
    by_month = stability("monthly_changes", "months", 30)
    return summary.select(
        "dataset",
        by_year.alias("year_stability"),
        by_month.alias("month_stability"),
        ((by_year + by_month) / 2).alias("stability"),
    )


def transitions(drift: DataFrame) -> DataFrame:
    """Type changes as readable transitions."""
    return drift.where(F.col("change") == "type").select(
        "dataset",
        "column",
        "previous_type",
        "current_type",
        F.concat_ws("→", "from_period", "to_period").alias("transition"),
    )


def most_changed_columns(drift: DataFrame, n: int = 10) -> DataFrame:
    """Columns with the most changes, ties by name."""
    counted = drift.groupBy("column").agg(F.count(F.lit(1)).alias("changes"))
    return counted.orderBy(F.desc("changes"), "column").limit(n)


def column_commonality(schema: DataFrame) -> DataFrame:
    """Columns as common to all datasets, shared by some, or unique to one."""
    datasets = schema.agg(F.count_distinct("dataset")).scalar()
    used = schema.groupBy("column").agg(F.count_distinct("dataset").alias("used_by"))
    label = F.when(F.col("used_by") == datasets, "common").when(F.col("used_by") == 1, "unique").otherwise("shared")
    return used.select("column", "used_by", label.alias("commonality"))


def commonality_counts(schema: DataFrame) -> DataFrame:
    """Common, shared and unique columns per dataset."""
    kind = F.col("commonality")
    return (
        schema.select("dataset", "column")
        .distinct()
        .join(column_commonality(schema), "column")
        .groupBy("dataset")
        .agg(
            F.count_if(kind == "common").alias("common_columns"),
            F.count_if(kind == "shared").alias("shared_columns"),
            F.count_if(kind == "unique").alias("unique_columns"),
        )
    )


def membership(schema: DataFrame, datasets: Sequence[str]) -> DataFrame:
    """Column × dataset matrix of 0 and 1."""
    cells = [F.max(F.when(F.col("dataset") == d, 1).otherwise(0)).alias(d) for d in datasets]
    return schema.groupBy("column").agg(*cells)


def schema_similarity(schema: DataFrame, datasets: Sequence[str]) -> DataFrame:
    """Jaccard similarity in percent for every ordered pair of the named datasets.

    Intersections and unions are counted over the membership matrix in one
    aggregate, so no pairs of columns or rows are ever formed.
    """
    pairs = [(a, b) for a in datasets for b in datasets]
    has = {d: F.col(f"`{d}`") == 1 for d in datasets}
    counts = [
        column
        for i, (a, b) in enumerate(pairs)
        for column in (
            F.count_if(has[a] & has[b]).alias(f"_both{i}"),
            F.count_if(has[a] | has[b]).alias(f"_any{i}"),
        )
    ]
    entries = [
        F.struct(
            F.lit(a).alias("left_dataset"),
            F.lit(b).alias("right_dataset"),
            F.col(f"_both{i}").alias("shared_columns"),
            F.when(F.col(f"_any{i}") > 0, F.col(f"_both{i}") / F.col(f"_any{i}") * 100).alias("similarity_pct"),
        )
        for i, (a, b) in enumerate(pairs)
    ]
    return membership(schema, datasets).agg(*counts).select(F.inline(F.array(*entries)))


def schema_problems(schema: DataFrame) -> DataFrame:
    """Per dataset: columns, missing types, duplicate names, distinct unknown types."""
    dtype = F.col("dtype")
    missing = dtype.isNull() | dtype.isin("", "unknown")
    known = F.regexp_extract(F.lower(dtype), r"^[^(]*", 0).isin(*TYPE_WIDTH)
    return schema.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("columns"),
        F.count_if(missing).alias("missing_types"),
        (F.count(F.lit(1)) - F.count_distinct("column")).alias("duplicates"),
        F.count_distinct(F.when(~known, dtype)).alias("invalid_types"),
    )


def type_class_counts(schema: DataFrame) -> DataFrame:
    """Text, numeric and timestamp columns per dataset."""
    dtype = F.lower("dtype")
    return schema.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("columns"),
        F.count_if(dtype.contains("string")).alias("string_columns"),
        F.count_if(dtype.rlike("int|double|float")).alias("numeric_columns"),
        F.count_if(dtype.contains("timestamp")).alias("timestamp_columns"),
    )
