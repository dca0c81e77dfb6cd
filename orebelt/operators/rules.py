"""Ordered cleaning rules with first-failure attribution in one aggregate.

A record is charged to the first rule it fails. Record rules look at one row, so
they commute with duplicate removal: rows are grouped once by all columns, each
distinct row is judged once, and its number of copies settles the accounting.

* A group that fails a rule placed before uniqueness charges all its copies there.
* Any other group charges ``copies - 1`` to uniqueness and its one remaining row
  to the first later rule it fails, if any.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebelt import contract
from orebelt.functions.names import belongs, find_column, quoted, typed
from orebelt.functions.values import elapsed_seconds
from orebelt.operators.shape import count_copies, dedup_by_key, dedup_rows

UNIQUE_ROWS = "unique_rows"


@dataclass(frozen=True)
class Rule:
    """One cleaning rule.

    ``roles`` name canonical columns; each is bound to the first candidate source
    column present. ``test`` gets the bound columns. ``null_passes`` decides rows
    for which the test is NULL. ``datasets`` limits the rule to some types. With
    ``only_if_any``, the rule counts within a scope only if the named role has a
    value in some row that reached the rule.
    """

    rule_id: str
    dimension: str
    roles: tuple[str, ...]
    test: Callable[..., Column] | None
    null_passes: bool = False
    datasets: tuple[str, ...] | None = None
    only_if_any: str | None = None


def _not_null(value: Column) -> Column:
    return value.isNotNull()


def _at_least_zero(value: Column) -> Column:
    return value >= 0


def _within(lower: float, upper: float) -> Callable[[Column], Column]:
    return lambda value: value.between(lower, upper)


def _lasts_at_most(seconds: int) -> Callable[[Column, Column], Column]:
    return lambda begin, end: elapsed_seconds(begin, end) <= seconds


def _dated(start: str, end: str, closed_midnight: bool = False) -> Callable[[Column], Column]:
    """From ``start`` to before ``end``; with ``closed_midnight`` up to the last day's first moment."""

    def within(moment: Column) -> Column:
        stop = F.lit(end).cast("timestamp_ntz")
        before = moment <= stop - F.expr("INTERVAL 1 DAY") if closed_midnight else moment < stop
        return (moment >= F.lit(start).cast("timestamp_ntz")) & before

    return within


def trip_rules(
    date_range: tuple[str, str] = contract.DATE_RANGE,
    critical: Mapping[str, tuple[str, ...]] = contract.CRITICAL_ROLES,
    reject_negative_duration: bool = False,
    closed_midnight: bool = False,
) -> tuple[Rule, ...]:
    """The standard trip rules in order. Dates form a half-open range; ``closed_midnight`` ends it
    at midnight of the last day, that moment included, as a range between two dates does."""
    needed: dict[str, tuple[str, ...]] = {}
    for dataset, roles in critical.items():
        for role in roles:
            needed[role] = (*needed.get(role, ()), dataset)
    completeness = tuple(
        Rule(f"{role}_present", "completitud", (role,), _not_null, datasets=datasets)
        for role, datasets in needed.items()
    )
    rules = (
        *completeness,
        Rule(UNIQUE_ROWS, "unicidad", (), None),
        Rule("fare_not_negative", "exactitud", ("monto_base",), _at_least_zero),
        Rule("tip_not_negative", "exactitud", ("propina",), _at_least_zero),
        Rule("tolls_not_negative", "exactitud", ("peajes",), _at_least_zero),
        Rule("distance_in_range", "razonabilidad", ("distancia_millas",), _within(*contract.DISTANCE_RANGE)),
        Rule("passengers_in_range", "razonabilidad", ("passenger_count",), _within(*contract.PASSENGER_RANGE)),
        Rule(
            "duration_in_range",
            "razonabilidad",
            ("pickup_datetime", "dropoff_datetime"),
            _lasts_at_most(contract.MAX_TRIP_SECONDS),
            only_if_any="dropoff_datetime",
        ),
        Rule("payment_known", "validez", ("payment_type",), _within(*contract.PAYMENT_RANGE), True),
        Rule("pickup_zone_known", "validez", ("pickup_location_id",), _within(*contract.LOCATION_RANGE), True),
        Rule("dropoff_zone_known", "validez", ("dropoff_location_id",), _within(*contract.LOCATION_RANGE), True),
        Rule("pickup_in_period", "oportunidad", ("pickup_datetime",), _dated(*date_range, closed_midnight)),
    )
    if reject_negative_duration:
        order = next(i for i, rule in enumerate(rules) if rule.rule_id == "duration_in_range")
        extra = replace(
            rules[order],
            rule_id="duration_not_negative",
            test=lambda begin, end: elapsed_seconds(begin, end) >= 0,
            null_passes=True,
            only_if_any=None,
        )
        rules = (*rules[: order + 1], extra, *rules[order + 1 :])
    return rules


def role_candidates(extra: Mapping[str, tuple[str, ...]] | None = None) -> dict[str, tuple[str, ...]]:
    """Names under which each canonical role may stand."""
    more = extra or {}
    return {f.name: (f.name, *f.sources, *more.get(f.name, ())) for f in contract.CANONICAL_FIELDS}


#: Integer roles meet as doubles, so that a fraction does not pass for the integer below it.
_MEETING_TYPES = {f.name: "double" if f.dtype == "int" else f.dtype for f in contract.CANONICAL_FIELDS}


def bind_roles(df: DataFrame, extra: Mapping[str, tuple[str, ...]] | None = None) -> dict[str, Column]:
    """Canonical role to its value, for the roles the frame has.

    A frame that unites layouts has a role under several names; a row's value is the first
    that is not null, since a row has values only in its own layout's columns.
    """
    bound = {}
    for role, candidates in role_candidates(extra).items():
        present = dict.fromkeys(found for c in candidates if (found := find_column(df.columns, [c])))
        if present:
            columns = [quoted(c) for c in present]
            if len({df.schema[c].dataType for c in present}) > 1:
                # columns of different types meet in the role's own; what does not fit is no value
                columns = [typed(df, c, _MEETING_TYPES[role]) for c in present]
            bound[role] = columns[0] if len(columns) == 1 else F.coalesce(*columns)
    return bound


class RuleSet:
    """Rules bound to one frame's columns and scopes (dataset type and year).

    ``layouts`` gives the columns of each dataset type where the frame unites several, such as
    ``contract.SOURCE_SCHEMAS``; a rule on a column that a type lacks does not apply to it.
    Without it every type has all columns of the frame. ``tasks`` is the number of tasks that
    rows are dealt to whole before equal ones are grouped, so that one task's groups do not grow
    with the table; without it, rows are grouped where they lie and then merged.
    """

    def __init__(
        self,
        df: DataFrame,
        rules: Sequence[Rule],
        dataset: str = "taxi_type",
        year: str = "file_year",
        extra_roles: Mapping[str, tuple[str, ...]] | None = None,
        layouts: Mapping[str, Sequence[str]] | None = None,
        tasks: int | None = None,
    ):
        self.df = df
        self.rules = tuple(rules)
        self.tasks = tasks
        self.dataset = dataset
        self.scope = (dataset, year)
        self.roles = bind_roles(df, extra_roles)
        self.limits = self._limits(layouts, role_candidates(extra_roles))
        self.applicable = tuple(
            rule
            for rule in self.rules
            if rule.test is None or (all(role in self.roles for role in rule.roles) and self.limits[rule] != [])
        )
        cut = next((i for i, r in enumerate(self.applicable) if r.test is None), len(self.applicable))
        self.before = self.applicable[:cut]
        self.after = self.applicable[cut + 1 :]
        self.has_unique = cut < len(self.applicable)
        self.guarded = next((r for r in self.after if r.only_if_any), None)
        self._hits = {r: F.when(self.violates(r), F.lit(self.position(r))) for r in (*self.before, *self.after)}

    def _limits(self, layouts, candidates) -> dict[Rule, list[str] | None]:
        """Dataset types a rule applies to: those it names, whose layouts have all its roles; None: all."""
        limits: dict[Rule, list[str] | None] = {}
        for rule in self.rules:
            limit = None if rule.datasets is None else list(rule.datasets)
            for role in rule.roles if layouts is not None else ():
                has = belongs(layouts, candidates[role])
                limit = has if limit is None else [d for d in limit if d in has]
            limits[rule] = limit
        return limits

    def violates(self, rule: Rule) -> Column:
        passed = F.coalesce(rule.test(*[self.roles[r] for r in rule.roles]), F.lit(rule.null_passes))
        failed = ~passed
        if self.limits[rule] is not None:
            failed = F.col(self.dataset).isin(*self.limits[rule]) & failed
        return failed

    def first_failure(self, rules: Sequence[Rule]) -> Column:
        """Position of the first rule the row fails, NULL if none."""
        if not rules:
            return F.lit(None).cast("int")
        return F.coalesce(*[self._hits[rule] for rule in rules])

    def position(self, rule: Rule) -> int:
        """Place of a rule in the order, from 1."""
        return self.rules.index(rule) + 1

    def rule_at(self, position: Column) -> Column:
        """Id of the rule at a position."""
        return F.get(F.array(*[F.lit(rule.rule_id) for rule in self.rules]), position - 1)

    def groups(self) -> DataFrame:
        """Distinct rows with copies and first failures, with and without the guarded rule."""
        distinct = count_copies(self.df, self.tasks)
        if not self.has_unique:
            distinct = self.df.select("*", F.lit(1).cast("long").alias("_copies"))
        unguarded = [rule for rule in self.after if rule is not self.guarded]
        return distinct.select(
            "*",
            self.first_failure(self.before).alias("_before"),
            self.first_failure(self.after).alias("_after_on"),
            self.first_failure(unguarded).alias("_after_off"),
            self._reaches_guard().alias("_guard_seen"),
        )

    def _reaches_guard(self) -> Column:
        """True for rows that get as far as the guarded rule and hold the guarding value."""
        if self.guarded is None:
            return F.lit(False)
        earlier = [*self.before, *self.after[: self.after.index(self.guarded)]]
        return self.first_failure(earlier).isNull() & self.roles[self.guarded.only_if_any].isNotNull()

    def counts(self) -> DataFrame:
        """Removed records per scope and rule, one row each, in rule order.

        One shuffle of distinct rows. They are then merged per scope and verdict, which
        leaves a handful of rows to spread over the rules.
        """
        verdict = ("_before", "_after_on", "_after_off", "_guard_seen")
        per_verdict = (
            self.groups()
            .groupBy(*self.scope, *verdict)
            .agg(F.sum("_copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
        )
        survived = F.col("_before").isNull()
        sums = [F.sum("_copies").alias("_original"), F.max("_guard_seen").alias("_guard_on")]
        for rule in self.before:
            hit = F.col("_before") == self.position(rule)
            sums.append(_sum_when(hit, F.col("_copies")).alias(rule.rule_id))
        if self.has_unique:
            sums.append(_sum_when(survived, F.col("_copies") - F.col("_rows")).alias(UNIQUE_ROWS))
        for rule in self.after:
            for mode in ("on", "off"):
                hit = survived & (F.col(f"_after_{mode}") == self.position(rule))
                sums.append(_sum_when(hit, F.col("_rows")).alias(f"{rule.rule_id}|{mode}"))
        wide = per_verdict.groupBy(*self.scope).agg(*sums)

        def removed(rule: Rule) -> Column:
            if rule not in self.applicable:
                return F.lit(0).cast("long")
            if rule.test is None or rule in self.before:
                return F.col(rule.rule_id)
            on, off = F.col(f"`{rule.rule_id}|on`"), F.col(f"`{rule.rule_id}|off`")
            return F.when(F.col("_guard_on"), on).otherwise(off)

        def status(rule: Rule) -> Column:
            if rule not in self.applicable:
                return F.lit("not_applicable")
            limit = self.limits[rule]
            limited = F.lit(True) if limit is None else F.col(self.dataset).isin(*limit)
            if rule is self.guarded:
                limited = limited & F.col("_guard_on")
            return F.when(limited, "applied").otherwise("not_applicable")

        entries = [
            F.struct(
                F.lit(i).alias("rule_order"),
                F.lit(rule.dimension).alias("dimension"),
                F.lit(rule.rule_id).alias("rule"),
                status(rule).alias("status"),
                removed(rule).alias("removed"),
            )
            for i, rule in enumerate(self.rules, start=1)
        ]
        return wide.select(*self.scope, F.col("_original").alias("original"), F.inline(F.array(*entries)))

    def _open_scopes(self) -> tuple[DataFrame, list[Column]]:
        """Scopes in which the guarded rule counts, and the join to them."""
        seen = self.df.where(self._reaches_guard()).select(
            *[F.col(c).alias(f"_s{i}") for i, c in enumerate(self.scope)]
        )
        same = [F.col(c).eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate(self.scope)]
        return seen.distinct(), same

    def survivors(self) -> DataFrame:
        """Distinct rows that pass every rule; rejected rows never reach the shuffle.

        A row that holds the guarding value opens its own scope, so its fate is settled where
        it is read. Only rows without the value depend on the rest of their scope: they alone
        are joined to the open scopes, and the others go past the join.
        """
        firm = [rule for rule in (*self.before, *self.after) if rule is not self.guarded]
        rows = self.df.where(self.first_failure(firm).isNull())
        if self.guarded is not None:
            has_value = self.roles[self.guarded.only_if_any].isNotNull()
            scopes, same = self._open_scopes()
            fails = self.violates(self.guarded)
            # a row the rule passes stays in any scope, one that holds the value fails in its own
            rows = rows.where(~fails).unionAll(rows.where(fails & ~has_value).join(scopes, same, "left_anti"))
        return dedup_rows(rows) if self.has_unique else rows

    def judged(self) -> DataFrame:
        """Distinct rows with the rule that rejects them; NULL for rows that stay.

        Rows that the guarded rule does not decide, and rows that hold the guarding value, go
        past the join to the open scopes.
        """
        groups = self.groups()
        verdict = groups.withColumn("_after", F.col("_after_on"))
        if self.guarded is not None:
            hangs = self.roles[self.guarded.only_if_any].isNull() & ~F.col("_after_on").eqNullSafe(F.col("_after_off"))
            scopes, same = self._open_scopes()
            joined = groups.where(hangs).join(scopes.withColumn("_guard_on", F.lit(True)), same, "left")
            after = F.when(F.col("_guard_on"), F.col("_after_on")).otherwise(F.col("_after_off"))
            verdict = verdict.where(~hangs).unionAll(joined.select(*groups.columns, after.alias("_after")))
        return verdict.select(
            *[quoted(c) for c in self.df.columns],
            "_copies",
            self.rule_at(F.coalesce(F.col("_before"), F.col("_after"))).alias("_rule"),
            F.col("_before").isNotNull().alias("_all_copies"),
        )


def _sum_when(condition: Column, amount: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0)).cast("long")


def cleaning_counts(df: DataFrame, rules: Sequence[Rule], **scope) -> DataFrame:
    """Long rule report: scope, rule order, dimension, rule, status, removed, original."""
    return RuleSet(df, rules, **scope).counts()


def cleaning_summary(counts: DataFrame, scope: Sequence[str] = ("taxi_type", "file_year")) -> DataFrame:
    """Per scope: removed per dimension, total removed, final, removed % and score."""
    by_dimension = [
        _sum_when(F.col("dimension") == d, F.col("removed")).alias(f"removed_{d}")
        for d in contract.CLEANING_DIMENSIONS
    ]
    totals = counts.groupBy(*scope).agg(
        F.max("original").alias("original"), F.sum("removed").alias("removed"), *by_dimension
    )
    percent = F.bround(
        F.when(F.col("original") > 0, F.col("removed") / F.col("original") * 100).otherwise(F.lit(0.0)), 2
    )
    return totals.select(
        *scope,
        "original",
        "removed",
        (F.col("original") - F.col("removed")).alias("final"),
        percent.alias("removed_pct"),
        (F.lit(100.0) - percent).alias("quality_score"),
        *[f"removed_{d}" for d in contract.CLEANING_DIMENSIONS],
    )


def clean(df: DataFrame, rules: Sequence[Rule], **scope) -> DataFrame:
    """Distinct rows that pass every rule."""
    return RuleSet(df, rules, **scope).survivors()


def quarantine(df: DataFrame, rules: Sequence[Rule], **scope) -> DataFrame:
    """Rejected rows with the rule that took them and the number of copies it took.

    Surplus copies of a row appear once under the uniqueness rule.
    """
    judged = RuleSet(df, rules, **scope).judged()
    surplus = F.struct(F.lit(UNIQUE_ROWS).alias("rule"), (F.col("_copies") - 1).alias("records"))
    rejected = F.struct(
        F.col("_rule").alias("rule"),
        F.when(F.col("_all_copies"), F.col("_copies")).otherwise(F.lit(1)).alias("records"),
    )
    charges = F.filter(
        F.array(rejected, F.when(~F.col("_all_copies"), surplus)),
        lambda c: c.getField("rule").isNotNull() & (c.getField("records") > 0),
    )
    return judged.select(*[quoted(c) for c in df.columns], F.inline(charges))


def light_clean(
    df: DataFrame,
    keys: Sequence[str] = ("pickup_datetime", "pickup_location_id", "dropoff_location_id"),
    date_range: tuple[str, str] = contract.DATE_RANGE,
) -> DataFrame:
    """Reduced cleaning for the largest sources: dated rows, one per key."""
    roles = bind_roles(df)
    moment = roles["pickup_datetime"]
    dated = df.where(moment.isNotNull() & _dated(*date_range)(moment))
    names = [f"_k{i}" for i, k in enumerate(keys) if k in roles]
    keyed = dated.withColumns({f"_k{i}": roles[k] for i, k in enumerate(keys) if k in roles})
    return dedup_by_key(keyed, names).drop(*names)


def light_counts(
    df: DataFrame,
    keys: Sequence[str] = ("pickup_datetime", "pickup_location_id", "dropoff_location_id"),
    date_range: tuple[str, str] = contract.DATE_RANGE,
    scope: Sequence[str] = ("taxi_type", "file_year"),
) -> DataFrame:
    """Accounting of :func:`light_clean` per scope, without building the rows."""
    roles = bind_roles(df)
    moment = roles["pickup_datetime"]
    verdict = F.when(moment.isNull(), "missing").when(~_dated(*date_range)(moment), "undated").otherwise("kept")
    key_columns = [roles[k].alias(f"_k{i}") for i, k in enumerate(keys) if k in roles]
    names = [f"_k{i}" for i in range(len(key_columns))]
    per_key = (
        df.select(*scope, verdict.alias("_verdict"), *key_columns)
        .groupBy(*scope, "_verdict", *names)
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    kept = F.col("_verdict") == "kept"
    totals = per_key.groupBy(*scope).agg(
        F.sum("_rows").alias("original"),
        _sum_when(F.col("_verdict") == "missing", F.col("_rows")).alias("removed_missing"),
        _sum_when(F.col("_verdict") == "undated", F.col("_rows")).alias("removed_undated"),
        _sum_when(kept, F.col("_rows") - 1).alias("removed_duplicate"),
        _sum_when(kept, F.lit(1)).alias("final"),
    )
    removed = F.col("original") - F.col("final")
    score = F.when(F.col("original") > 0, 100 - removed / F.col("original") * 100).otherwise(F.lit(0.0))
    return totals.select("*", score.alias("quality_score"))
