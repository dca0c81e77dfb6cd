"""Expected files, coverage, reconciliation and artifact changes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.contract import TAXI_TYPES
from orebelt.operators.shape import union_by_name

PERIOD = ("dataset", "year", "month")


def expected_periods(
    spark: SparkSession,
    first_year: int,
    last_year: int,
    datasets: Iterable[str] = TAXI_TYPES,
    until: dt.date | None = None,
) -> DataFrame:
    """Every (dataset, year, month) that should exist, none after ``until``.

    Sized by the calendar, built by exploding sequences.
    """
    limit = until or dt.date.today()
    months = (
        spark.range(first_year, last_year + 1)
        .select(F.col("id").cast("int").alias("year"), F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
        .where(F.col("year") * 12 + F.col("month") <= limit.year * 12 + limit.month)
    )
    return months.select(F.explode(F.array(*[F.lit(d) for d in datasets])).alias("dataset"), "year", "month")


def file_catalog(periods: DataFrame, root: str) -> DataFrame:
    """File name and path each expected period is stored under."""
    name = F.concat("dataset", F.lit("_tripdata_"), F.format_string("%04d-%02d", "year", "month"), F.lit(".parquet"))
    folder = F.format_string("tipo_dataset=%s/anio=%d/mes=%02d", "dataset", "year", "month")
    return periods.select(
        *PERIOD, name.alias("file_name"), F.concat_ws("/", F.lit(root.rstrip("/")), folder, name).alias("path")
    )


def missing_periods(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected periods without data."""
    return expected.join(actual.select(*PERIOD).distinct(), list(PERIOD), "left_anti")


def require_coverage(expected: DataFrame, actual: DataFrame, strict: bool = True) -> DataFrame:
    """Missing periods; raises on the first one in strict mode. Runs one job then."""
    missing = missing_periods(expected, actual)
    if strict and (gap := missing.take(1)):
        raise RuntimeError(f"incomplete coverage, first gap: {gap[0].asDict()}")
    return missing


def catalog_summary(catalog: DataFrame, by: Sequence[str] = ("year", "dataset")) -> DataFrame:
    """Files per group, and bytes where sizes are known."""
    sums = [F.count(F.lit(1)).alias("files")]
    if "size_bytes" in catalog.columns:
        sums.append(F.sum("size_bytes").alias("bytes"))
    return catalog.groupBy(*by).agg(*sums)


def reconcile(catalog: DataFrame, downloaded: DataFrame, validated: DataFrame, loaded: DataFrame) -> DataFrame:
    """Counts of the four stages side by side and whether they agree with the catalog."""
    reached = {
        "catalog": catalog,
        "downloaded": downloaded.where(F.col("status").isin("downloaded", "skipped_existing")),
        "validated": validated.where(F.col("validation_status") == "valid"),
        "loaded": loaded.where(F.col("bronze_status") == "loaded"),
    }
    counted = [
        frame.agg(F.count(F.lit(1)).alias("records")).select(F.lit(stage).alias("stage"), "records")
        for stage, frame in reached.items()
    ]
    expected = catalog.agg(F.count(F.lit(1))).scalar()
    return union_by_name(counted).select("stage", "records", (F.col("records") == expected).alias("complete"))


def glob_pattern(glob: Column) -> Column:
    """Regular expression of a glob: ``*`` and ``?`` stay within a folder, ``**`` crosses folders
    (``**/`` also matches none), ``[...]`` and ``[!...]`` are sets; all else stands for itself."""
    steps = (
        (r"([.+^$(){}|\\])", r"\\$1"), (r"\[!", "[^"), (r"\*\*/", "\u0001"), (r"\*\*", "\u0002"),
        (r"\*", "[^/]*"), (r"\?", "[^/]"), ("\u0001", "(?:.*/)?"), ("\u0002", ".*"),
    )
    for found, put in steps:
        glob = F.regexp_replace(glob, found, put)
    return F.concat(F.lit("^"), glob, F.lit("$"))


def required_outputs(inventory: DataFrame, rules: DataFrame) -> DataFrame:
    """Every rule of ``root, pattern, minimum_files`` with the files that match it, in one pass.

    A root is one folder or several in a row, anywhere in a path; a scheme and outer slashes are
    left aside. A pattern with a slash is matched
    with the path below the root, any other with the file name at any depth. Each file is
    dealt to the rules whose root it lies below by a join on its folders; rules without a file
    count 0. Rows that repeat a rule are one rule.
    """
    rules = rules.select("root", "pattern", F.col("minimum_files").cast("long").alias("minimum_files")).distinct()
    compiled = rules.select("*", F.regexp_replace("root", r"^\w+:/+|^/+|/+$", "").alias("_root"), glob_pattern(F.col("pattern")).alias("_regex"), F.col("pattern").contains("/").alias("_deep"))
    parts = F.split("path", "/")
    # each run of folders that ends above the file, with what is left of the path below it
    runs = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.size(parts) - 1),
            lambda end: F.transform(
                F.sequence(F.lit(1), end),
                lambda start: F.struct(
                    F.array_join(F.slice(parts, start, end - start + 1), "/").alias("_root"),
                    F.array_join(F.slice(parts, end + 1, F.size(parts)), "/").alias("_below"),
                ),
            ),
        )
    )
    below = inventory.select("path").distinct().where(F.size(parts) > 1).select("path", F.inline(runs))
    name = F.element_at(F.split("_below", "/"), -1)
    hits = below.join(compiled, "_root").where(F.rlike(F.when(F.col("_deep"), F.col("_below")).otherwise(name), F.col("_regex")))
    counted = hits.groupBy("root", "pattern", "minimum_files").agg(F.count_distinct("path").alias("actual_files"))
    found = F.coalesce("actual_files", F.lit(0).cast("long"))
    return rules.join(counted, ["root", "pattern", "minimum_files"], "left").select(
        "root", "pattern", "minimum_files", found.alias("actual_files"), (found >= F.col("minimum_files")).alias("passed")
    )


def require_outputs(inventory: DataFrame, rules: DataFrame) -> DataFrame:
    """The rules' results; raises with the failed ones if there are any."""
    results = required_outputs(inventory, rules)
    failed = results.where("NOT passed").orderBy("root", "pattern").limit(20).collect()
    if failed:
        raise RuntimeError("missing outputs: " + "; ".join(f"{r.root}/{r.pattern}: {r.actual_files} of {r.minimum_files}" for r in failed))
    return results


def changed_artifacts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files created or modified between two inventories, by size, time and hash."""
    signature = F.struct("size_bytes", "modified_at", "sha256")
    old = before.select("path", signature.alias("_old"))
    new = after.select("path", "size_bytes", "sha256", signature.alias("_new"))
    change = F.when(F.col("_old").isNull(), "CREATED").when(F.col("_old") != F.col("_new"), "MODIFIED")
    extension = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    return (
        new.join(old, "path", "left")
        .select("path", change.alias("change_type"), "size_bytes", extension.alias("extension"), "sha256")
        .where(F.col("change_type").isNotNull())
        .orderBy("path")
    )
