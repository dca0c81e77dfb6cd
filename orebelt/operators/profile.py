"""Column profiles as long tables.

Two passes with small shuffles. The first computes counts, nulls and moments of all
columns in one aggregate per scope. The second counts distinct values: cells are
turned into (column, value) rows and merged map-side, which grows linearly with
the number of columns; a multi-column ``count_distinct`` would expand every row
by a full-width copy per column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebelt.contract import PROFILED_NUMERIC_TYPES
from orebelt.functions.names import quoted


def column_profile(
    df: DataFrame,
    by: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    exact_distinct: bool = True,
    relative_error: float = 0.05,
) -> DataFrame:
    """Profile per scope and column.

    Columns: scope, ``column, dtype, n, nulls, null_pct, distinct, distinct_pct,
    min, max, mean, stddev``. NULL counts as one distinct value. Moments exist for
    double, float, int and bigint only. ``exact_distinct=False`` uses mergeable
    sketches in the first pass and skips the second.
    """
    names = list(columns) if columns is not None else [c for c in df.columns if c not in by]
    moments = _moments(df, by, names, exact_distinct, relative_error)
    if exact_distinct:
        distinct = _distinct_counts(df, by, names)
        on = [moments[c].eqNullSafe(distinct[c]) for c in by] + [moments["column"] == distinct["column"]]
        moments = moments.join(distinct, on, "left").select(
            *[moments[c] for c in moments.columns if c != "distinct"], distinct["distinct"]
        )
    n = F.col("n")
    return moments.select(
        *by,
        "column",
        "dtype",
        "n",
        "nulls",
        _percent(F.col("nulls"), n).alias("null_pct"),
        "distinct",
        _percent(F.col("distinct"), n).alias("distinct_pct"),
        "min",
        "max",
        "mean",
        "stddev",
    )


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def _moments(
    df: DataFrame, by: Sequence[str], names: Sequence[str], exact_distinct: bool, relative_error: float
) -> DataFrame:
    sums = [F.count(F.lit(1)).alias("n")]
    entries = []
    for i, name in enumerate(names):
        value, dtype = quoted(name), df.schema[name].dataType.simpleString()
        sums.append(F.count(value).alias(f"_c{i}"))
        numeric = dtype in PROFILED_NUMERIC_TYPES
        if numeric:
            number = value.cast("double")
            sums += [
                F.min(number).alias(f"_lo{i}"),
                F.max(number).alias(f"_hi{i}"),
                F.avg(number).alias(f"_mu{i}"),
                F.stddev(number).alias(f"_sd{i}"),
            ]
        if not exact_distinct:
            sums.append(F.approx_count_distinct(value, relative_error).alias(f"_d{i}"))
        nulls = F.col("n") - F.col(f"_c{i}")
        approx = F.lit(None).cast("long") if exact_distinct else F.col(f"_d{i}") + (nulls > 0).cast("long")
        stats = [
            (F.col(f"_{key}{i}") if numeric else F.lit(None).cast("double")).alias(alias)
            for key, alias in (("lo", "min"), ("hi", "max"), ("mu", "mean"), ("sd", "stddev"))
        ]
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(dtype).alias("dtype"),
                nulls.alias("nulls"),
                approx.alias("distinct"),
                *stats,
            )
        )
    wide = df.groupBy(*by).agg(*sums)
    return wide.select(*by, "n", F.inline(F.array(*entries)))


def _distinct_counts(df: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One frame per class of types: its cells are narrow rows, and it scans its own columns only."""
    classes: dict[str, list[Column]] = {}
    for i, name in enumerate(names):
        kind, value = _cell(df, name)
        classes.setdefault(kind, []).append(F.struct(F.lit(i).alias("_i"), value.alias("_v")))
    labels = F.array(*[F.lit(name) for name in names])
    counts = []
    for cells in classes.values():
        values = df.select(*by, F.inline(F.array(*cells))).distinct()
        counts.append(values.groupBy(*by, "_i").agg(F.count(F.lit(1)).alias("distinct")))
    return reduce(DataFrame.unionAll, counts).select(*by, F.get(labels, F.col("_i")).alias("column"), "distinct")


def _cell(df: DataFrame, name: str) -> tuple[str, Column]:
    """A value in the type of its class; classes keep values exact without text casts."""
    value, kind = quoted(name), df.schema[name].dataType
    if isinstance(kind, T.BooleanType | T.ByteType | T.ShortType | T.IntegerType | T.LongType):
        return "whole", value.cast("long")
    if isinstance(kind, T.DateType):
        return "whole", F.unix_date(value).cast("long")
    if isinstance(kind, T.TimestampType):
        return "whole", F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        return "moment", value
    if isinstance(kind, T.FloatType | T.DoubleType):
        return "number", value.cast("double")
    if isinstance(kind, T.StringType):
        return "text", value
    return "text", F.when(value.isNotNull(), F.to_json(F.struct(value)))


def profile_scores(profile: DataFrame, by: Sequence[str], policy: str = "initial") -> DataFrame:
    """Score per scope, 0–100.

    ``initial``: −5 above 30 % nulls, −2 above 15 %, −10 for a column that is one
    distinct value in one row. ``final``: −5 above 10 % nulls, −10 per constant column.
    """
    null_pct, constant = F.col("null_pct"), F.col("distinct") == 1
    if policy == "initial":
        penalty = F.when(null_pct > 30, 5).when(null_pct > 15, 2).otherwise(0)
        penalty = penalty + F.when(constant & (F.col("distinct_pct") == 100), 10).otherwise(0)
    elif policy == "final":
        penalty = F.when(null_pct > 10, 5).otherwise(0) + F.when(constant, 10).otherwise(0)
    else:
        raise ValueError(f"unknown scoring policy {policy!r}")
    score = F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.lit(100.0) - F.sum(penalty)))
    return profile.groupBy(*by).agg(
        F.max("n").alias("records"), F.count(F.lit(1)).alias("columns"), score.alias("quality_score")
    )


def profile_issues(profile: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per finding of the final profile: many nulls, or a constant column."""
    nulls = F.when(
        F.col("null_pct") > 10, F.format_string("Alto %% de nulos en %s: %.1f%%", F.col("column"), F.col("null_pct"))
    )
    constant = F.when(F.col("distinct") == 1, F.concat(F.lit("Columna constante: "), F.col("column")))
    found = F.filter(F.array(nulls, constant), lambda issue: issue.isNotNull())
    return profile.select(*by, "column", F.explode(found).alias("issue"))


def merge_profiles(monthly: DataFrame, by: Sequence[str], month: str, exact: bool = False) -> DataFrame:
    """Monthly profiles to one profile per scope and column.

    By default means and deviations are averaged over months without weights, as in
    stored yearly profiles; ``exact=True`` combines them from counts, means and
    squared deviations and equals those of a profile over all rows. Distinct counts of
    months do not merge and are averaged either way: see :func:`merge_states`.
    """
    totals = (
        monthly.select(*by, month, "n").distinct().groupBy(*by).agg(F.sum("n").alias("records"))
    )
    filled = F.col("n") - F.col("nulls")
    sums = [
        F.min_by("dtype", month).alias("dtype"),
        F.sum("nulls").alias("nulls"),
        F.avg("distinct").alias("distinct_avg"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
    ]
    if exact:
        monthly = _centred(monthly.withColumn("_w", F.when(F.col("mean").isNotNull(), filled)), [*by, "column"])
        spread = F.coalesce("stddev", F.lit(0.0)) ** 2 * (F.col("_w") - 1) + F.col("_off")
        weight = F.sum("_w")
        sums += [F.first("_centre").alias("mean"), F.when(weight > 1, F.sqrt(F.sum(spread) / (weight - 1))).alias("stddev")]
        shape = ["mean", "stddev"]
    else:
        sums += [F.avg("mean").alias("mean"), F.avg("stddev").alias("stddev")]
        shape = ["mean", "stddev"]
    merged = monthly.groupBy(*by, "column").agg(*sums)
    return merged.join(totals, list(by)).select(
        *by,
        "column",
        "dtype",
        "records",
        "nulls",
        _percent(F.col("nulls"), F.col("records")).alias("null_pct"),
        "distinct_avg",
        "min",
        "max",
        *shape,
    )


def _centred(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts with the mean of their group and what their own mean being off it adds to the squared
    deviations: the rule of Chan et al., which subtracts no two large sums."""
    centre = parts.groupBy(*keys).agg((F.sum(F.col("mean") * F.col("_w")) / F.nullif(F.sum("_w"), F.lit(0))).alias("_centre"))
    named = centre.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_centre")
    joined = parts.join(named, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return joined.withColumn("_off", F.col("_w") * (F.col("mean") - F.col("_centre")) ** 2).select(*parts.columns, "_centre", "_off")


#: Buckets of a distinct sketch as a power of two: a standard error of about 0.8 %.
SKETCH_BITS = 14


def profile_states(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Mergeable profile per scope and column: counts, extremes, mean, squared deviations and a
    distinct sketch. One scan and one shuffle of a row per task and scope."""
    names = list(columns) if columns is not None else [c for c in df.columns if c not in by]
    sums, entries = [F.count(F.lit(1)).alias("n")], []
    for i, name in enumerate(names):
        value, dtype = quoted(name), df.schema[name].dataType.simpleString()
        sums += [F.count(value).alias(f"_c{i}"), F.hll_sketch_agg(_sketched(df, name), F.lit(SKETCH_BITS)).alias(f"_h{i}")]
        numeric = dtype in PROFILED_NUMERIC_TYPES
        number = value.cast("double")
        if numeric:
            sums += [F.min(number).alias(f"_lo{i}"), F.max(number).alias(f"_hi{i}"), F.avg(number).alias(f"_mu{i}"), F.var_pop(number).alias(f"_va{i}")]
        nothing = F.lit(None).cast("double")
        entries.append(
            F.struct(
                F.lit(name).alias("column"), F.lit(dtype).alias("dtype"), F.col(f"_c{i}").alias("filled"),
                *[(F.col(f"_{key}{i}") if numeric else nothing).alias(alias) for key, alias in (("lo", "min"), ("hi", "max"), ("mu", "mean"))],
                (F.col(f"_va{i}") * F.col(f"_c{i}") if numeric else nothing).alias("m2"), F.col(f"_h{i}").alias("sketch"),
            )
        )
    return df.groupBy(*by).agg(*sums).select(*by, "n", F.inline(F.array(*entries)))


def _sketched(df: DataFrame, name: str) -> Column:
    """A value as the sketch takes it; equal values stay equal and no two become one."""
    value, kind = quoted(name), df.schema[name].dataType
    if isinstance(kind, T.ByteType | T.ShortType | T.IntegerType | T.LongType):
        return value.cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.FloatType | T.DoubleType):
        return (value + F.lit(0.0)).cast("string")  # minus zero is zero
    if isinstance(kind, T.StringType | T.BooleanType | T.DateType | T.TimestampNTZType | T.DecimalType):
        return value.cast("string")
    return F.when(value.isNotNull(), F.to_json(F.struct(value)))


def merge_states(states: DataFrame, by: Sequence[str], period: Sequence[str] = ()) -> DataFrame:
    """States of finer scopes as one profile per ``by`` and column, as :func:`column_profile` has it.

    Everything but ``distinct`` equals a profile over all rows; ``distinct`` is the estimate of the
    united sketches. A column that changes its type keeps that of the first ``period``.
    """
    if not by:
        return merge_states(states.withColumn("_all", F.lit(0)), ["_all"], period).drop("_all")
    keys = [*by, "column"]
    scopes = states.select(*by, *period, "n").distinct().groupBy(*by).agg(F.sum("n").alias("n"))
    parts = _centred(states.withColumn("_w", F.when(F.col("mean").isNotNull(), F.col("filled"))), keys)
    weight = F.sum("_w")
    first = F.min_by("dtype", F.struct(*period)) if period else F.min("dtype")
    merged = parts.groupBy(*keys).agg(
        first.alias("dtype"), F.sum("filled").alias("filled"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("_distinct"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.first("_centre").alias("mean"),
        F.when(weight > 1, F.sqrt(F.sum(F.col("m2") + F.col("_off")) / (weight - 1))).alias("stddev"),
    )
    total = scopes.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(by)], "n")
    merged = merged.join(total, [F.col(c).eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate(by)])
    n, nulls = F.col("n"), F.col("n") - F.col("filled")
    distinct = F.col("_distinct") + (nulls > 0).cast("long")
    return merged.select(
        *keys, "dtype", "n", nulls.alias("nulls"), _percent(nulls, n).alias("null_pct"), distinct.alias("distinct"),
        _percent(distinct, n).alias("distinct_pct"), "min", "max", "mean", "stddev",
    )


def null_improvement(initial: DataFrame, final: DataFrame, by: Sequence[str]) -> DataFrame:
    """Change of the null share per column between two profiles, columns matched without case."""
    left = initial.select(*by, F.lower("column").alias("_column"), F.col("null_pct").alias("initial_null_pct"))
    right = final.select(*by, F.lower("column").alias("_column"), "column", F.col("null_pct").alias("final_null_pct"))
    change = F.col("initial_null_pct") - F.col("final_null_pct")
    return right.join(left, [*by, "_column"]).select(
        *by, "column", "initial_null_pct", "final_null_pct", change.alias("improvement_pct"), (change > 0).alias("improved")
    )


def column_usefulness(profile: DataFrame, by: Sequence[str]) -> DataFrame:
    """Class of every column: all_null, constant, high_null, zero_null or useful."""
    null_pct = F.col("null_pct")
    label = (
        F.when(null_pct == 100, "all_null")
        .when(F.col("distinct") == 1, "constant")
        .when(null_pct > 50, "high_null")
        .when(null_pct == 0, "zero_null")
        .otherwise("useful")
    )
    return profile.select(*by, "column", "null_pct", "distinct", label.alias("usefulness"))


def usefulness_scores(classes: DataFrame, by: Sequence[str]) -> DataFrame:
    """Banded score from the share of useful columns, less penalties for poor ones."""
    kind = F.col("usefulness")
    counts = classes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("columns"),
        F.count_if(kind.isin("zero_null", "useful")).alias("useful_columns"),
        F.count_if(kind == "zero_null").alias("zero_null_columns"),
        F.count_if(kind == "constant").alias("constant_columns"),
        F.count_if(kind.isin("all_null", "high_null")).alias("high_null_columns"),
    )
    share = F.col("useful_columns") / F.col("columns") * 100
    band = F.when(share >= 80, 90).when(share >= 60, 80).when(share >= 40, 70).when(share >= 20, 60).otherwise(50)
    score = (
        band
        - F.least(F.lit(10), F.col("constant_columns") * 2)
        - F.least(F.lit(15.0), F.col("high_null_columns") * 1.5)
    )
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(100.0), score))
    return counts.select("*", share.alias("useful_pct"), F.round(bounded, 1).alias("quality_score"))


def profile_dimensions(profile: DataFrame, by: Sequence[str]) -> DataFrame:
    """Dimension scores read off a profile; two of them are fixed at 85."""
    type_share = profile.groupBy(*by, "dtype").agg(F.count(F.lit(1)).alias("uses"))
    modal = type_share.groupBy(*by).agg((F.max("uses") / F.sum("uses") * 100).alias("consistencia"))
    rest = profile.groupBy(*by).agg(
        (100 - F.avg("null_pct")).alias("completitud"),
        F.when(F.max(F.lower("column").contains("id")), 90.0).otherwise(70.0).alias("integridad"),
    )
    fixed = F.lit(85.0)
    joined = rest.join(modal, list(by)).select(
        *by, "completitud", fixed.alias("precision"), "consistencia", fixed.alias("validez"), "integridad"
    )
    names = ("completitud", "precision", "consistencia", "validez", "integridad")
    total = reduce(Column.__add__, [F.col(c) for c in names])
    return joined.select("*", (total / len(names)).alias("overall"))


def column_quality_stats(profile: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean, median, lowest and highest column quality (100 − null %)."""
    quality = 100 - F.col("null_pct")
    return profile.groupBy(*by).agg(
        F.avg(quality).alias("mean_quality"),
        F.median(quality).alias("median_quality"),
        F.min(quality).alias("min_quality"),
        F.max(quality).alias("max_quality"),
    )
