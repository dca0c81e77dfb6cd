"""Quality dimensions of a dataset, scored per scope in one aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebelt import contract
from orebelt.functions.names import find_column, quoted
from orebelt.functions.values import share_of

KEY_CANDIDATES = ("pickup_datetime", "dropoff_datetime", "taxi_type", "pulocationid", "dolocationid")


def quality_measures(
    df: DataFrame,
    scope: Sequence[str],
    keys: Sequence[str] = KEY_CANDIDATES,
    columns: Sequence[str] | None = None,
    layouts: Mapping[str, Sequence[str]] | None = None,
    dataset: str = "taxi_type",
) -> DataFrame:
    """Raw counts behind all dimensions, one row per scope.

    Rows are first merged per key (map-side, then by shuffle), carrying sums of
    the checks; the number of merged rows is the distinct key count. One scan,
    one shuffle of keys, no repeated filters. ``layouts`` gives the columns of each
    type of ``dataset`` where the frame unites several: cells, columns and checks then
    count only for types that have the column.
    """
    names = list(columns) if columns is not None else df.columns

    def own(column: str) -> Column:
        """Whether the row's type has the column; all have it where layouts are not given."""
        if layouts is None or not any(find_column(own_columns, [column]) for own_columns in layouts.values()):
            return F.lit(True)
        return F.col(dataset).isin(*[d for d, own_columns in layouts.items() if find_column(own_columns, [column])])

    def counted_columns(chosen: Sequence[str]) -> Column:
        return reduce(Column.__add__, [own(c).cast("int") for c in chosen], F.lit(0))

    null_cells = reduce(Column.__add__, [(own(c) & quoted(c).isNull()).cast("long") for c in names])
    checks = {n: (d, F.when(own(find_column(df.columns, [n.removeprefix("ok_")])), check)) for n, (d, check) in _checks(df).items()}
    accepted = [c for c in names if _accepted(df.schema[c].dataType.simpleString())]
    found = [c for c in (find_column(df.columns, [k]) for k in keys) if c]
    prepared = df.select(
        *[quoted(c).alias(f"_scope{i}") for i, c in enumerate(scope)],
        *[quoted(c).alias(f"_key{i}") for i, c in enumerate(found)],
        null_cells.alias("null_cells"),
        counted_columns(names).alias("total_columns"),
        counted_columns(accepted).alias("accepted_columns"),
        *[check.alias(name) for name, (_, check) in checks.items()],
    )
    counted = [F.sum(name).alias(name) for name in ("null_cells", *checks)]
    counted += [F.max(name).alias(name) for name in ("total_columns", "accepted_columns")]
    groups = [f"_scope{i}" for i in range(len(scope))]
    per_key = prepared.groupBy(*groups, *[f"_key{i}" for i in range(len(found))]).agg(
        F.count(F.lit(1)).alias("records"), *counted
    )
    return per_key.groupBy(*groups).agg(
        F.sum("records").alias("records"),
        (F.count(F.lit(1)) if found else F.sum("records")).alias("unique_records"),
        *counted,
    ).select(
        *[F.col(g).alias(c) for g, c in zip(groups, scope)],
        "records",
        "unique_records",
        "null_cells",
        "total_columns",
        "accepted_columns",
        *checks,
    )


def _checks(df: DataFrame) -> dict[str, tuple[str, Column]]:
    """Range checks for the columns that exist: name to (dimension, 0/1 expression)."""
    wanted = (
        ("precision", "total_amount", contract.TOTAL_AMOUNT_RANGE, False),
        ("precision", "trip_distance", contract.DISTANCE_RANGE, False),
        ("validez", "payment_type", contract.PAYMENT_RANGE, True),
        ("validez", "pulocationid", contract.LOCATION_RANGE, True),
        ("validez", "dolocationid", contract.LOCATION_RANGE, True),
    )
    checks = {}
    for dimension, candidate, (lower, upper), null_passes in wanted:
        column = find_column(df.columns, [candidate])
        if column:
            value = quoted(column)
            ok = share_of(value, lower, upper)
            checks[f"ok_{candidate}"] = (dimension, F.when(value.isNull(), 1).otherwise(ok) if null_passes else ok)
    return checks


def _accepted(dtype: str) -> bool:
    return dtype.split("(")[0].lower() in contract.ACCEPTED_TYPES


def quality_scores(measures: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Long table of dimension scores per scope, with the weighted overall score."""
    records = F.col("records")

    def lowest(dimension_checks: list[str]) -> Column:
        if not dimension_checks:
            return F.lit(1.0)
        shares = [F.col(c) / records for c in dimension_checks]
        # a check on a column that a type lacks is null and left out
        return F.coalesce(shares[0] if len(shares) == 1 else F.least(*shares), F.lit(1.0))

    present = set(measures.columns)
    precision = [c for c in ("ok_total_amount", "ok_trip_distance") if c in present]
    validity = [c for c in ("ok_payment_type", "ok_pulocationid", "ok_dolocationid") if c in present]
    scores = {
        "completitud": 1.0 - F.col("null_cells") / (records * F.col("total_columns")),
        "precision": lowest(precision),
        "unicidad": F.col("unique_records") / records,
        "validez": lowest(validity),
        "consistencia": F.col("accepted_columns") / F.col("total_columns"),
    }
    stored = {name: F.round(score, 6) for name, score in scores.items()}
    weighted = reduce(
        Column.__add__, [stored[name] * F.lit(weight) for name, weight in contract.QUALITY_WEIGHTS.items()]
    )
    entries = [
        F.struct(
            F.lit(name).alias("dimension"),
            score.alias("score"),
            F.lit(contract.QUALITY_THRESHOLDS[name]).alias("threshold"),
        )
        for name, score in {**scores, "overall": weighted}.items()
    ]
    return (
        measures.where(records > 0)
        .select(*scope, "records", F.inline(F.array(*entries)))
        .withColumn("passed", F.col("score") >= F.col("threshold"))
    )


def rule_results(scores: DataFrame, dataset: str, year: str) -> DataFrame:
    """Audit form of the scores: evaluated and failed records, rates and status.

    The failed count rounds half to even, and the status compares failure rates, so it
    can differ from ``passed`` at the boundary; both are kept.
    """
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))
    failed = F.bround(F.col("records") * (1.0 - bounded), 0).cast("long")
    rate = F.when(F.col("records") > 0, failed / F.col("records")).otherwise(F.lit(0.0))
    allowed = 1.0 - F.col("threshold")
    kind = F.col(dataset)
    return scores.select(
        F.concat(F.lit("silver_cleaned_"), kind, F.lit("_"), F.col(year)).alias("dataset_name"),
        F.concat(
            F.lit("DQ_"), F.upper(kind), F.lit("_"), F.col(year), F.lit("_"), F.upper("dimension")
        ).alias("rule_id"),
        F.concat(F.initcap("dimension"), F.lit(" de "), kind, F.lit(" "), F.col(year)).alias("rule_name"),
        kind.alias("taxi_type"),
        F.col(year).alias("year"),
        "dimension",
        bounded.alias("score"),
        "threshold",
        "passed",
        F.col("records").alias("records_evaluated"),
        failed.alias("records_failed"),
        rate.alias("failure_rate"),
        allowed.alias("allowed_failure_rate"),
        F.when(rate <= allowed, "PASSED").otherwise("FAILED").alias("status"),
    )


def invalid_rule_results(results: DataFrame) -> DataFrame:
    """Rule results whose counts or rates are outside their domain."""
    evaluated, failed = F.col("records_evaluated"), F.col("records_failed")
    problem = (
        F.when(evaluated < 0, "records_evaluated is negative")
        .when(failed < 0, "records_failed is negative")
        .when(failed > evaluated, "records_failed exceeds records_evaluated")
        .when(~F.col("allowed_failure_rate").between(0, 1), "allowed_failure_rate outside 0–1")
    )
    return results.select("*", problem.alias("problem")).where(F.col("problem").isNotNull())


def quality_issues(scores: DataFrame, scope: Sequence[str]) -> DataFrame:
    """One text per failed dimension."""
    text = F.format_string("%s baja: %.2f%%", F.initcap("dimension"), F.col("score") * 100)
    failed = scores.where(~F.col("passed") & (F.col("dimension") != "overall"))
    return failed.select(*scope, "dimension", text.alias("issue"))
