"""Expected periods, coverage, reconciliation, artifact changes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from orebelt.operators import catalog as c
from orebelt.session import materialize
from suite import trips as t
from suite.registry import query, with_ctes

_UNTIL = dt.date(2001, 10, 15)
_EXPECTED = f"""expected AS (SELECT d AS dataset, y::INT AS year, m::INT AS month FROM (VALUES {", ".join(f"('{d}')" for d in t.TYPES)}) v(d),
  range(1995, 2002) r(y), range(1, 13) s(m) WHERE y * 12 + m <= 2001 * 12 + 10)"""
_ACTUAL = "actual AS (SELECT DISTINCT taxi_type AS dataset, file_year AS year, file_month AS month FROM trips)"


def _expected(spark):
    return c.expected_periods(spark, 1995, 2001, t.TYPES, until=_UNTIL)


def _actual(spark, sf_dir):
    return t.raw_trips(spark, sf_dir).select(
        F.col("taxi_type").alias("dataset"), F.col("file_year").alias("year"), F.col("file_month").alias("month")
    )


@query(
    "cat_expected_vs_actual",
    with_ctes(
        t.TRIPS,
        _EXPECTED,
        select="""SELECT e.dataset, e.year, e.month, count(x.file_year) AS trips FROM expected e LEFT JOIN trips x
  ON x.taxi_type = e.dataset AND x.file_year = e.year AND x.file_month = e.month GROUP BY 1, 2, 3""",
    ),
)
def expected_vs_actual(spark, sf_dir):
    """Expected calendar with the trips found in each period."""
    found = _actual(spark, sf_dir).groupBy(*c.PERIOD).agg(F.count(F.lit(1)).alias("trips"))
    return _expected(spark).join(found, list(c.PERIOD), "left").fillna(0, ["trips"])


@query(
    "jn_anti_coverage",
    with_ctes(t.TRIPS, _EXPECTED, _ACTUAL, select="SELECT * FROM expected EXCEPT SELECT * FROM actual"),
)
def coverage(spark, sf_dir):
    """Expected periods without a single trip."""
    return c.missing_periods(_expected(spark), _actual(spark, sf_dir))


_FILES = """files AS (SELECT taxi_type AS dataset, file_year AS year, file_month AS month, count(*) AS n, sum(l)::BIGINT AS size_bytes
  FROM (SELECT *, length(store_and_fwd_flag) * 100 AS l FROM trips) GROUP BY 1, 2, 3)"""


def _files(spark, sf_dir):
    trips = t.raw_trips(spark, sf_dir)
    return trips.groupBy(
        F.col("taxi_type").alias("dataset"), F.col("file_year").alias("year"), F.col("file_month").alias("month")
    ).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("store_and_fwd_flag") * 100).cast("long").alias("size_bytes")
    )


@query(
    "cat_summary",
    with_ctes(t.TRIPS, _FILES, select="SELECT year, dataset, count(*) AS files, sum(size_bytes)::BIGINT AS bytes FROM files GROUP BY 1, 2"),
)
def summary(spark, sf_dir):
    return c.catalog_summary(_files(spark, sf_dir))


@query(
    "cat_file_catalog",
    with_ctes(
        t.TRIPS,
        _ACTUAL,
        select="""SELECT *, dataset || '_tripdata_' || lpad(year::VARCHAR, 4, '0') || '-' || lpad(month::VARCHAR, 2, '0') || '.parquet' AS file_name,
  'lake/tipo_dataset=' || dataset || '/anio=' || year || '/mes=' || lpad(month::VARCHAR, 2, '0') || '/' || dataset || '_tripdata_'
    || lpad(year::VARCHAR, 4, '0') || '-' || lpad(month::VARCHAR, 2, '0') || '.parquet' AS path FROM actual""",
    ),
)
def file_catalog(spark, sf_dir):
    return c.file_catalog(_actual(spark, sf_dir).distinct(), "lake/")


@query(
    "cat_reconcile",
    with_ctes(
        t.TRIPS,
        _FILES,
        "r AS (SELECT 'catalog' AS stage, count(*) AS records FROM files UNION ALL SELECT 'downloaded', count(*) FROM files WHERE n % 7 <> 0 "
        "UNION ALL SELECT 'validated', count(*) FROM files UNION ALL SELECT 'loaded', count(*) FROM files WHERE n % 5 <> 0)",
        select="SELECT *, records = (SELECT count(*) FROM files) AS complete FROM r",
    ),
)
def reconcile(spark, sf_dir):
    """Counts of the four stages; some files are marked as failed by their row count."""
    files = materialize(_files(spark, sf_dir), "files")
    return c.reconcile(
        files,
        files.select(F.when(F.col("n") % 7 == 0, "failed").when(F.col("n") % 2 == 0, "downloaded").otherwise("skipped_existing").alias("status")),
        files.select(F.lit("valid").alias("validation_status")),
        files.select(F.when(F.col("n") % 5 == 0, "failed").otherwise("loaded").alias("bronze_status")),
    )


_INVENTORY = """inv AS (SELECT 'lake/' || c_mktsegment || '/' || c_custkey || '.PARQUET' AS path, count(*) AS size_bytes,
  max(o_orderdate) AS modified_at, md5(sum(o_orderkey)::VARCHAR) AS sha256 FROM orders JOIN customer ON o_custkey = c_custkey {where} GROUP BY c_mktsegment, c_custkey)"""


def _inventory(spark, sf_dir, before=None):
    """One file per customer, its size and content taken from the customer's orders."""
    orders, customer = t.table(spark, sf_dir, "orders"), t.table(spark, sf_dir, "customer")
    if before:
        orders = orders.where(F.col("o_orderdate") < F.lit(before).cast("timestamp_ntz"))
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return joined.groupBy(F.concat(F.lit("lake/"), "c_mktsegment", F.lit("/"), "c_custkey", F.lit(".PARQUET")).alias("path")).agg(
        F.count(F.lit(1)).alias("size_bytes"),
        F.max("o_orderdate").alias("modified_at"),
        F.md5(F.sum("o_orderkey").cast("string")).alias("sha256"),
    )


@query(
    "jn_changed_artifacts",
    with_ctes(
        _INVENTORY.format(where="WHERE o_orderdate < TIMESTAMP '1996-06-01'").replace("inv AS", "old AS"),
        _INVENTORY.format(where=""),
        select="""SELECT inv.path, CASE WHEN old.path IS NULL THEN 'CREATED' ELSE 'MODIFIED' END AS change_type, inv.size_bytes, '.parquet' AS extension, inv.sha256
FROM inv LEFT JOIN old ON old.path = inv.path WHERE old.path IS NULL OR (old.size_bytes, old.modified_at, old.sha256) <> (inv.size_bytes, inv.modified_at, inv.sha256)""",
    ),
)
def changed_artifacts(spark, sf_dir):
    """Files created or modified between two states of the order table."""
    return c.changed_artifacts(_inventory(spark, sf_dir, "1996-06-01"), _inventory(spark, sf_dir))


@query(
    "cat_required_outputs",
    with_ctes(
        _INVENTORY.format(where=""),
        "rule(root, pattern, regex, minimum_files) AS (VALUES ('lake/BUILDING', '1*.PARQUET', 'lake/BUILDING/(.*/)?1[^/]*[.]PARQUET', 3), "
        "('lake', '**/*[05].PARQUET', 'lake/(.*/)?[^/]*[05][.]PARQUET', 1), ('lake/', 'BUILDING/*.PARQUET', 'lake/BUILDING/[^/]*[.]PARQUET', 100000), "
        "('BUILDING', '?.PARQUET', '(.*/)?BUILDING/(.*/)?[^/][.]PARQUET', 2), ('nowhere', '*', 'nowhere/.*', 1))",
        select="""SELECT root, pattern, minimum_files::BIGINT AS minimum_files, count(path) AS actual_files, count(path) >= minimum_files AS passed
FROM rule LEFT JOIN (SELECT DISTINCT path FROM inv) ON regexp_full_match(path, regex) GROUP BY root, pattern, minimum_files""",
    ),
)
def required_outputs(spark, sf_dir):
    """Five rules over all files at once, one of them without a file."""
    rules = [
        ("lake/BUILDING", "1*.PARQUET", 3), ("lake", "**/*[05].PARQUET", 1), ("lake/", "BUILDING/*.PARQUET", 100000),
        ("BUILDING", "?.PARQUET", 2), ("nowhere", "*", 1),
    ]
    rules = spark.createDataFrame(rules, "root string, pattern string, minimum_files long")
    return c.required_outputs(_inventory(spark, sf_dir), rules)
