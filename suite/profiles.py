"""Column profiles, profile scores and quality dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from orebelt.contract import QUALITY_THRESHOLDS, QUALITY_WEIGHTS
from orebelt.operators import profile as p
from orebelt.operators import quality as q
from orebelt.operators import reports, rules
from orebelt.plans.profile_store import ProfileStore
from orebelt.session import materialize, scratch_path
from orebelt.sources.sinks import overwrite_partitions
from suite import trips as t
from suite.cleaning import CHAIN, LAST
from suite.registry import query, rounded, with_ctes

MONTH = ("taxi_type", "file_year", "file_month")
COLUMNS = {
    "VendorID": "string",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "int",
    "trip_distance": "double",
    "RatecodeID": "int",
    "store_and_fwd_flag": "string",
    "PULocationID": "int",
    "DOLocationID": "int",
    "payment_type": "int",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "Airport_fee": "double",
    "ehail_fee": "double",
    "trip_type": "int",
    "SR_Flag": "int",
    "dispatching_base_num": "string",
}


def profile_sql(scope: tuple[str, ...], source: str = "trips", columns=COLUMNS) -> str:
    parts = []
    for name, dtype in columns.items():
        numeric = dtype in ("int", "double")
        stats = (
            f'min("{name}")::DOUBLE AS min, max("{name}")::DOUBLE AS max, avg("{name}") AS mean, stddev_samp("{name}") AS stddev'
            if numeric
            else "NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean, NULL::DOUBLE AS stddev"
        )
        parts.append(
            f"SELECT {', '.join(scope)}, '{name}' AS \"column\", '{dtype}' AS dtype, count(*) AS n, "
            f'count(*) - count("{name}") AS nulls, (count(*) - count("{name}")) / count(*) * 100 AS null_pct, '
            f'count(DISTINCT "{name}") + max(CASE WHEN "{name}" IS NULL THEN 1 ELSE 0 END) AS "distinct", '
            f'(count(DISTINCT "{name}") + max(CASE WHEN "{name}" IS NULL THEN 1 ELSE 0 END)) / count(*) * 100 AS distinct_pct, '
            f"{stats} FROM {source} GROUP BY {', '.join(scope)}"
        )
    return " UNION ALL ".join(parts)


MONTHLY = (t.TRIPS, f"prof AS MATERIALIZED ({profile_sql(MONTH)})")
YEARLY = (t.TRIPS, f"prof AS MATERIALIZED ({profile_sql(t.SCOPE)})")
FINAL = (*CHAIN, f"prof AS MATERIALIZED ({profile_sql(t.SCOPE, LAST)})")
_OUT = (
    'n, nulls, round(null_pct, 6) AS null_pct, "distinct", round(distinct_pct, 6) AS distinct_pct, '
    "round(min, 6) AS min, round(max, 6) AS max, round(mean + 3.7e-8, 6) AS mean, round(stddev, 6) AS stddev"
)


def cleaned_trips(raw):
    """Clean trips as a table, since a profile scans its input more than once."""
    return materialize(rules.clean(raw, t.RULES), "cleaned-trips")


def profiled(df, by):
    return p.column_profile(df, by, list(COLUMNS))


@query("prf_columns", with_ctes(*MONTHLY, select=f'SELECT taxi_type, file_year, file_month, "column", dtype, {_OUT} FROM prof'))
def columns(spark, sf_dir):
    """Monthly profile of sixteen columns."""
    return rounded(profiled(t.stored_trips(spark, sf_dir), MONTH), means=("mean",))


@query("prf_columns_approx")
def columns_approx(spark, sf_dir):
    """The same with mergeable distinct sketches, one pass."""
    return p.column_profile(t.raw_trips(spark, sf_dir), MONTH, list(COLUMNS), exact_distinct=False)


def _scores_sql(policy: str, scope: tuple[str, ...]) -> str:
    penalty = (
        "CASE WHEN null_pct > 30 THEN 5 WHEN null_pct > 15 THEN 2 ELSE 0 END "
        '+ CASE WHEN "distinct" = 1 AND distinct_pct = 100 THEN 10 ELSE 0 END'
        if policy == "initial"
        else 'CASE WHEN null_pct > 10 THEN 5 ELSE 0 END + CASE WHEN "distinct" = 1 THEN 10 ELSE 0 END'
    )
    return (
        f"SELECT {', '.join(scope)}, max(n) AS records, count(*) AS columns, "
        f"greatest(0.0, least(100.0, 100.0 - sum({penalty})))::DOUBLE AS quality_score FROM prof GROUP BY {', '.join(scope)}"
    )


@query("prf_initial_scores", with_ctes(*MONTHLY, select=_scores_sql("initial", MONTH)))
def initial_scores(spark, sf_dir):
    return p.profile_scores(profiled(t.stored_trips(spark, sf_dir), MONTH), MONTH)


@query("prf_final_scores", with_ctes(*FINAL, select=_scores_sql("final", t.SCOPE)))
def final_scores(spark, sf_dir):
    cleaned = cleaned_trips(t.stored_trips(spark, sf_dir))
    return p.profile_scores(profiled(cleaned, t.SCOPE), t.SCOPE, "final")


@query(
    "prf_final_issues",
    with_ctes(
        *FINAL,
        select="""SELECT taxi_type, file_year, "column",
  'Alto % de nulos en ' || "column" || ': ' || printf('%.1f', null_pct) || '%' AS issue FROM prof WHERE null_pct > 10
UNION ALL SELECT taxi_type, file_year, "column", 'Columna constante: ' || "column" FROM prof WHERE "distinct" = 1""",
    ),
)
def final_issues(spark, sf_dir):
    cleaned = cleaned_trips(t.stored_trips(spark, sf_dir))
    return p.profile_issues(profiled(cleaned, t.SCOPE), t.SCOPE)


_TOTALS = "tot AS (SELECT taxi_type, file_year, sum(n) AS records FROM (SELECT DISTINCT taxi_type, file_year, file_month, n FROM prof) GROUP BY 1, 2)"


@query(
    "prf_merge_year",
    with_ctes(
        *MONTHLY,
        _TOTALS,
        select="""SELECT taxi_type, file_year, "column", dtype, max(records)::BIGINT AS records, sum(nulls)::BIGINT AS nulls,
  round(sum(nulls) / max(records) * 100, 6) AS null_pct, round(avg("distinct"), 6) AS distinct_avg,
  round(min(min), 6) AS min, round(max(max), 6) AS max, round(avg(mean), 6) AS mean, round(avg(stddev), 6) AS stddev
FROM prof JOIN tot USING (taxi_type, file_year) GROUP BY 1, 2, 3, 4""",
    ),
)
def merge_year(spark, sf_dir):
    """Monthly profiles merged without weights, as in stored yearly profiles."""
    return rounded(p.merge_profiles(profiled(t.stored_trips(spark, sf_dir), MONTH), t.SCOPE, "file_month"))


@query(
    "prf_merge_year_exact",
    with_ctes(
        *YEARLY,
        select='SELECT taxi_type, file_year, "column", dtype, n AS records, nulls, round(null_pct, 6) AS null_pct, '
        "round(min, 6) AS min, round(max, 6) AS max, round(mean + 3.7e-8, 6) AS mean, round(stddev, 5) AS stddev FROM prof",
    ),
)
def merge_year_exact(spark, sf_dir):
    """Exact merge of monthly profiles; the SQL profiles all rows of the year at once."""
    merged = p.merge_profiles(profiled(t.stored_trips(spark, sf_dir), MONTH), t.SCOPE, "file_month", exact=True)
    return rounded(merged.drop("distinct_avg"), 6, means=("mean",), stddev=5)


def _stored(spark, sf_dir):
    """Profile states of the first half of each year, then of the months that are left."""
    path, store = scratch_path(spark, "raw-by-month"), ProfileStore(scratch_path(spark, "profile-states"))
    raw = t.raw_trips(spark, sf_dir)
    overwrite_partitions(raw.select(*MONTH, *COLUMNS).hint("rebalance", *MONTH), path, MONTH)
    records = spark.read.parquet(path)
    store.refresh(spark, records.where("file_month <= 6"), list(COLUMNS))
    store.refresh(spark, records, list(COLUMNS))
    return store


@query(
    "prf_incremental_year",
    with_ctes(
        *YEARLY,
        select='SELECT taxi_type, file_year, "column", dtype, n, nulls, round(null_pct, 6) AS null_pct, round(min, 6) AS min, '
        "round(max, 6) AS max, round(mean + 3.7e-8, 6) AS mean, round(stddev, 6) AS stddev FROM prof",
    ),
)
def incremental_year(spark, sf_dir):
    """Yearly profiles from monthly states stored in two refreshes; the SQL profiles all rows at once."""
    merged = _stored(spark, sf_dir).profile(spark).drop("distinct", "distinct_pct")  # estimates: see the tests
    return rounded(merged, means=("mean",))


@query(
    "prf_yearly_trend",
    with_ctes(
        *YEARLY,
        "mon AS (SELECT taxi_type, file_year, count(DISTINCT file_month) AS months FROM trips GROUP BY 1, 2)",
        f"sc AS ({_scores_sql('initial', t.SCOPE)})",
        select="SELECT taxi_type, file_year, months, records, quality_score FROM sc JOIN mon USING (taxi_type, file_year)",
    ),
)
def yearly_trend(spark, sf_dir):
    """Records, quality score and months of every type and year, from stored states."""
    return _stored(spark, sf_dir).trend(spark)


_CLASS = (
    "cls AS (SELECT *, CASE WHEN null_pct = 100 THEN 'all_null' WHEN \"distinct\" = 1 THEN 'constant' "
    "WHEN null_pct > 50 THEN 'high_null' WHEN null_pct = 0 THEN 'zero_null' ELSE 'useful' END AS usefulness FROM prof)"
)


@query(
    "prf_usefulness",
    with_ctes(
        *YEARLY,
        _CLASS,
        select='SELECT taxi_type, file_year, "column", round(null_pct, 6) AS null_pct, "distinct", usefulness FROM cls',
    ),
)
def usefulness(spark, sf_dir):
    return rounded(p.column_usefulness(profiled(t.stored_trips(spark, sf_dir), t.SCOPE), t.SCOPE))


@query(
    "prf_usefulness_scores",
    with_ctes(
        *YEARLY,
        _CLASS,
        """cnt AS (SELECT taxi_type, file_year, count(*) AS columns, count(*) FILTER (usefulness IN ('zero_null', 'useful')) AS useful_columns,
  count(*) FILTER (usefulness = 'zero_null') AS zero_null_columns, count(*) FILTER (usefulness = 'constant') AS constant_columns,
  count(*) FILTER (usefulness IN ('all_null', 'high_null')) AS high_null_columns FROM cls GROUP BY 1, 2)""",
        select="""SELECT *, round(useful_columns / columns * 100, 6) AS useful_pct, round(greatest(0, least(100,
  CASE WHEN useful_columns / columns >= 0.8 THEN 90 WHEN useful_columns / columns >= 0.6 THEN 80 WHEN useful_columns / columns >= 0.4 THEN 70
       WHEN useful_columns / columns >= 0.2 THEN 60 ELSE 50 END
  - least(10, constant_columns * 2) - least(15, high_null_columns * 1.5)))::DOUBLE, 1) AS quality_score FROM cnt""",
    ),
)
def usefulness_scores(spark, sf_dir):
    classes = p.column_usefulness(profiled(t.stored_trips(spark, sf_dir), t.SCOPE), t.SCOPE)
    return rounded(p.usefulness_scores(classes, t.SCOPE))


@query(
    "prf_improvement",
    with_ctes(
        *CHAIN,
        f"a AS ({profile_sql(t.SCOPE)})",
        f"b AS ({profile_sql(t.SCOPE, LAST)})",
        select="""SELECT taxi_type, file_year, b."column", round(a.null_pct, 6) AS initial_null_pct, round(b.null_pct, 6) AS final_null_pct,
  round(a.null_pct - b.null_pct, 6) AS improvement_pct, a.null_pct > b.null_pct AS improved
FROM b JOIN a USING (taxi_type, file_year, "column")""",
    ),
)
def improvement(spark, sf_dir):
    raw = t.stored_trips(spark, sf_dir)
    before, after = profiled(raw, t.SCOPE), profiled(cleaned_trips(raw), t.SCOPE)
    return rounded(p.null_improvement(before, after, t.SCOPE))


@query(
    "prf_final_vs_initial",
    with_ctes(
        *CHAIN,
        f"a AS ({profile_sql(t.SCOPE)})",
        f"b AS ({profile_sql(t.SCOPE, LAST)})",
        f"sa AS ({_scores_sql('initial', t.SCOPE).replace('FROM prof', 'FROM a')})",
        f"sb AS ({_scores_sql('final', t.SCOPE).replace('FROM prof', 'FROM b')})",
        """g AS (SELECT taxi_type, file_year, avg(a.null_pct - b.null_pct) AS gain FROM b JOIN a USING (taxi_type, file_year, "column") GROUP BY 1, 2)""",
        select="""SELECT taxi_type, file_year, sb.quality_score AS final_score, sb.records, sa.quality_score AS initial_score,
  round(gain, 6) AS mean_improvement FROM sb LEFT JOIN sa USING (taxi_type, file_year) LEFT JOIN g USING (taxi_type, file_year)""",
    ),
)
def final_vs_initial(spark, sf_dir):
    raw = t.stored_trips(spark, sf_dir)
    before, after = profiled(raw, t.SCOPE), profiled(cleaned_trips(raw), t.SCOPE)
    gain = p.null_improvement(before, after, t.SCOPE)
    return rounded(
        reports.final_vs_initial(
            p.profile_scores(after, t.SCOPE, "final"), p.profile_scores(before, t.SCOPE), gain, t.SCOPE
        )
    )


@query(
    "prf_dimension_scores",
    with_ctes(
        *YEARLY,
        """d AS (SELECT taxi_type, file_year, 100 - avg(null_pct) AS completitud, 85.0::DOUBLE AS "precision",
  max(uses) / count(*) * 100 AS consistencia, 85.0::DOUBLE AS validez,
  CASE WHEN bool_or(contains(lower("column"), 'id')) THEN 90.0 ELSE 70.0 END::DOUBLE AS integridad
  FROM (SELECT *, count(*) OVER (PARTITION BY taxi_type, file_year, dtype) AS uses FROM prof) GROUP BY 1, 2)""",
        select="""SELECT taxi_type, file_year, round(completitud, 6) AS completitud, "precision", round(consistencia, 6) AS consistencia,
  validez, integridad, round((completitud + "precision" + consistencia + validez + integridad) / 5, 6) AS overall FROM d""",
    ),
)
def dimension_scores(spark, sf_dir):
    return rounded(p.profile_dimensions(profiled(t.stored_trips(spark, sf_dir), t.SCOPE), t.SCOPE))


@query(
    "prf_column_quality",
    with_ctes(
        *YEARLY,
        select="""SELECT taxi_type, file_year, round(avg(100 - null_pct), 6) AS mean_quality, round(median(100 - null_pct), 6) AS median_quality,
  round(min(100 - null_pct), 6) AS min_quality, round(max(100 - null_pct), 6) AS max_quality FROM prof GROUP BY 1, 2""",
    ),
)
def column_quality(spark, sf_dir):
    return rounded(p.column_quality_stats(profiled(t.stored_trips(spark, sf_dir), t.SCOPE), t.SCOPE))


@query(
    "prf_lookup",
    with_ctes(
        t.ZONES,
        "prof AS ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", '{d}' AS dtype, count(*) AS n, count(*) - count({c}) AS nulls, "
            f"count(DISTINCT {c}) AS \"distinct\", {'min(locationid)::DOUBLE' if d == 'int' else 'NULL::DOUBLE'} AS min, "
            f"{'max(locationid)::DOUBLE' if d == 'int' else 'NULL::DOUBLE'} AS max FROM zones"
            for c, d in (("locationid", "int"), ("borough", "string"), ("zone", "string"), ("service_zone", "string"))
        )
        + ")",
        select="SELECT * FROM prof",
    ),
)
def lookup_profile(spark, sf_dir):
    """Profile of the zone lookup."""
    return p.column_profile(t.zones(spark, sf_dir)).select("column", "dtype", "n", "nulls", "distinct", "min", "max")


@query(
    "prf_dataset_summary",
    with_ctes(
        *MONTHLY,
        f"sc AS ({_scores_sql('initial', MONTH)})",
        "yr AS (SELECT taxi_type, file_year AS year, count(*) AS months, sum(records) AS records, avg(quality_score) AS quality_score FROM sc GROUP BY 1, 2)",
        select="""SELECT taxi_type AS dataset, count(DISTINCT year) AS years, sum(months)::BIGINT AS months,
  round(sum(records) / 1000000.0, 6) AS records_millions, round(avg(quality_score), 6) AS quality FROM yr GROUP BY 1""",
    ),
)
def dataset_summary(spark, sf_dir):
    """Yearly scores summed up per dataset."""
    monthly = p.profile_scores(profiled(t.stored_trips(spark, sf_dir), MONTH), MONTH)
    yearly = monthly.groupBy(F.col("taxi_type").alias("dataset"), F.col("file_year").alias("year")).agg(
        F.count(F.lit(1)).alias("months"), F.sum("records").alias("records"), F.avg("quality_score").alias("quality_score")
    )
    return rounded(reports.dataset_summary(yearly))


_KEYS = ("taxi_type", "tpep_pickup_datetime", "PULocationID", "DOLocationID")
_CELLS = " + ".join(f'CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END' for c in t.RAW_COLUMNS)
_N = len(t.RAW_COLUMNS)
MEASURES = (
    t.TRIPS,
    f"""m AS MATERIALIZED (SELECT taxi_type, file_year, count(*) AS records, sum({_CELLS})::BIGINT AS null_cells,
  (SELECT count(*) FROM (SELECT DISTINCT {", ".join(f'k."{c}"' for c in _KEYS)} FROM trips k
     WHERE k.taxi_type = trips.taxi_type AND k.file_year = trips.file_year)) AS unique_records,
  count(*) FILTER (total_amount BETWEEN 0 AND 1000) AS a1, count(*) FILTER (trip_distance BETWEEN 0.1 AND 500) AS a2,
  count(*) FILTER (payment_type IS NULL OR payment_type BETWEEN 1 AND 6) AS v1,
  count(*) FILTER ("PULocationID" IS NULL OR "PULocationID" BETWEEN 1 AND 263) AS v2,
  count(*) FILTER ("DOLocationID" IS NULL OR "DOLocationID" BETWEEN 1 AND 263) AS v3 FROM trips GROUP BY 1, 2)""",
    f"""raw AS (SELECT taxi_type, file_year, records, 1.0::DOUBLE - null_cells / (records * {_N}) AS completitud,
  least(a1 / records, a2 / records) AS "precision", unique_records / records AS unicidad,
  least(v1 / records, v2 / records, v3 / records) AS validez, 1.0::DOUBLE AS consistencia FROM m)""",
    "wide AS (SELECT *, "
    + " + ".join(f'round("{d}", 6) * {w}::DOUBLE' for d, w in QUALITY_WEIGHTS.items())
    + " AS overall FROM raw)",
    "dq AS (" + " UNION ALL ".join(
        f"SELECT taxi_type, file_year, records, '{d}' AS dimension, \"{d}\" AS score, {x}::DOUBLE AS threshold, "
        f"\"{d}\" >= {x}::DOUBLE AS passed FROM wide"
        for d, x in QUALITY_THRESHOLDS.items()
    ) + ")",
)


def scored(spark, sf_dir):
    measures = q.quality_measures(t.raw_trips(spark, sf_dir), t.SCOPE, keys=_KEYS)
    return q.quality_scores(measures, t.SCOPE)


@query("dq_scores", with_ctes(*MEASURES, select="SELECT * REPLACE (round(score, 6) AS score) FROM dq"))
def dq_scores(spark, sf_dir):
    return rounded(scored(spark, sf_dir))


@query(
    "dq_rules",
    with_ctes(
        *MEASURES,
        """r AS (SELECT *, round_even(records * (1.0::DOUBLE - greatest(0, least(1, score))), 0)::BIGINT AS bad,
  1.0::DOUBLE - threshold AS allowed FROM dq)""",
        select="""SELECT 'silver_cleaned_' || taxi_type || '_' || file_year AS dataset_name,
  'DQ_' || upper(taxi_type) || '_' || file_year || '_' || upper(dimension) AS rule_id,
  upper(dimension[1]) || dimension[2:] || ' de ' || taxi_type || ' ' || file_year AS rule_name,
  taxi_type, file_year AS year, dimension, round(greatest(0, least(1, score)), 6) AS score, threshold, passed,
  records AS records_evaluated, bad AS records_failed, round(bad / records, 6) AS failure_rate,
  round(allowed, 6) AS allowed_failure_rate, CASE WHEN bad / records <= allowed THEN 'PASSED' ELSE 'FAILED' END AS status FROM r""",
    ),
)
def dq_rules(spark, sf_dir):
    return rounded(q.rule_results(scored(spark, sf_dir), "taxi_type", "file_year"))


@query(
    "dq_issues",
    with_ctes(
        *MEASURES,
        select="""SELECT taxi_type, file_year, dimension, upper(dimension[1]) || dimension[2:] || ' baja: ' || printf('%.2f', score * 100) || '%' AS issue
FROM dq WHERE NOT passed AND dimension <> 'overall'""",
    ),
)
def dq_issues(spark, sf_dir):
    return q.quality_issues(scored(spark, sf_dir), t.SCOPE)


@query(
    "dq_invalid_rules",
    with_ctes(
        *MEASURES,
        select="SELECT 'DQ_' || upper(taxi_type) || '_' || file_year || '_' || upper(dimension) AS rule_id, "
        "CASE dimension WHEN 'completitud' THEN 'records_evaluated is negative' WHEN 'precision' THEN 'records_failed is negative' "
        "WHEN 'unicidad' THEN 'records_failed exceeds records_evaluated' ELSE 'allowed_failure_rate outside 0–1' END AS problem "
        "FROM dq WHERE dimension IN ('completitud', 'precision', 'unicidad', 'validez')",
    ),
)
def dq_invalid(spark, sf_dir):
    """Rule results outside their domain: good ones, and each spoilt in one of four ways."""
    results = q.rule_results(scored(spark, sf_dir), "taxi_type", "file_year")
    of = lambda dimension: F.col("dimension") == dimension
    spoilt = results.withColumns(
        {
            "records_failed": F.when(of("precision"), -1).when(of("unicidad"), F.col("records_evaluated") + 1).otherwise(F.col("records_failed")),
            "records_evaluated": F.when(of("completitud"), -1).otherwise(F.col("records_evaluated")),
            "allowed_failure_rate": F.when(of("validez"), 1.5).otherwise(F.col("allowed_failure_rate")),
        }
    )
    return q.invalid_rule_results(results.unionByName(spoilt)).select("rule_id", "problem")


@query(
    "dq_pivot",
    with_ctes(
        *MEASURES,
        select="SELECT taxi_type, "
        + ", ".join(f"round(avg(CASE WHEN dimension = '{d}' THEN score * 100 END), 6) AS \"{d}\"" for d in QUALITY_WEIGHTS)
        + " FROM dq GROUP BY 1",
    ),
)
def dq_pivot(spark, sf_dir):
    return rounded(reports.quality_pivot(scored(spark, sf_dir)))


@query(
    "dq_by_dimension",
    with_ctes(
        *MEASURES,
        select="SELECT dimension, round(avg(score * 100), 6) AS mean_score FROM dq WHERE dimension <> 'overall' GROUP BY 1",
    ),
)
def dq_by_dimension(spark, sf_dir):
    return rounded(reports.quality_by_dimension(scored(spark, sf_dir)))


@query(
    "dq_issue_counts",
    with_ctes(
        *MEASURES,
        "i AS (SELECT taxi_type, upper(dimension[1]) || dimension[2:] AS word FROM dq WHERE NOT passed AND dimension <> 'overall')",
        select="""SELECT 'type' AS kind, taxi_type AS item, count(*) AS issues FROM i GROUP BY 2
UNION ALL SELECT 'dimension', word, count(*) FROM i GROUP BY 2""",
    ),
)
def dq_issue_counts(spark, sf_dir):
    return reports.issue_counts(q.quality_issues(scored(spark, sf_dir), t.SCOPE))


@query(
    "dq_best_worst",
    with_ctes(
        *MEASURES,
        "o AS (SELECT taxi_type || ' ' || file_year AS dataset, score FROM dq WHERE dimension = 'overall')",
        select="""SELECT (SELECT dataset FROM o ORDER BY score DESC, dataset LIMIT 1) AS best, round((SELECT max(score) FROM o), 6) AS best_value,
  (SELECT dataset FROM o ORDER BY score, dataset LIMIT 1) AS worst, round((SELECT min(score) FROM o), 6) AS worst_value""",
    ),
)
def dq_best_worst(spark, sf_dir):
    overall = scored(spark, sf_dir).where("dimension = 'overall'")
    named = overall.select(F.concat_ws(" ", "taxi_type", "file_year").alias("dataset"), "score")
    return rounded(reports.best_and_worst(named, "dataset", "score"))


@query(
    "dq_group_stats",
    with_ctes(*MEASURES, select="SELECT taxi_type, count(*) AS rows, round(avg(score), 6) AS mean_score FROM dq WHERE dimension = 'overall' GROUP BY 1"),
)
def dq_group_stats(spark, sf_dir):
    overall = scored(spark, sf_dir).where("dimension = 'overall'")
    return rounded(reports.group_stats(overall, ["taxi_type"], "score"))
