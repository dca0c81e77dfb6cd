"""Table scans: Parquet, zone lookup, JSON documents, audit log."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.contract import TAXI_TYPES, ZONE_COLUMNS, ZONE_SCHEMA
from orebelt.functions.names import with_lower_names
from orebelt.operators.shape import conform


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One or many Parquet paths as one frame, columns matched by name across files."""
    reader = spark.read
    if len(paths) > 1:
        reader = reader.option("mergeSchema", True)
    return reader.parquet(*paths)


def read_trips(
    spark: SparkSession,
    base: str,
    taxi_types: Iterable[str] = (),
    years: Iterable[int] = (),
    months: Iterable[int] = (),
) -> DataFrame:
    """Hive-partitioned trip files; filters on the partition columns prune directories.

    All files of a partition are read, whatever their number or column order.
    """
    trips = spark.read.option("mergeSchema", True).parquet(base)
    wanted = {"tipo_dataset": list(taxi_types), "anio": list(years), "mes": list(months)}
    for column, values in wanted.items():
        if values:
            trips = trips.where(F.col(column).isin(values))
    return trips


def read_period(spark: SparkSession, base: str, taxi_type: str, year: int, month: int) -> DataFrame:
    """One month of one dataset type, with the schema that month was written in."""
    return spark.read.parquet(f"{base}/tipo_dataset={taxi_type}/anio={year}/mes={month:02d}")


def with_source_identity(df: DataFrame) -> DataFrame:
    """Dataset type and year parsed from the name of the file or dataset folder of each row."""
    kinds = "|".join(sorted(TAXI_TYPES, key=len, reverse=True))
    pattern = rf"(?:^|[/=])({kinds})_(\d{{4}})[^/]*(?:/[^/]*)?$"
    path = F.lower("_metadata.file_path")
    kind = F.regexp_extract(path, pattern, 1)
    return df.select(
        "*",
        F.when(kind != "", kind).otherwise(F.lit("desconocido")).alias("source_type"),
        F.regexp_extract(path, pattern, 2).try_cast("int").alias("source_year"),
    )


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with a fixed schema and lower-case names."""
    return with_lower_names(
        spark.read.schema(ZONE_SCHEMA).options(header=True, mode="FAILFAST", enforceSchema=False).csv(path)
    )


def cache_zone_lookup(spark: SparkSession, csv_path: str, parquet_path: str) -> DataFrame:
    """Parquet copy of the lookup, written on first use."""
    try:
        return spark.read.parquet(parquet_path)
    except AnalysisException:
        read_zone_lookup(spark, csv_path).write.parquet(parquet_path)
        return spark.read.parquet(parquet_path)


def lookup_issues(lookup: DataFrame) -> DataFrame:
    """One row: validity of a zone lookup and the first error found."""
    missing = [c for c in ZONE_COLUMNS if c.lower() not in {n.lower() for n in lookup.columns}]
    if missing:
        return lookup.limit(0).agg(
            F.count(F.lit(1)).alias("records"),
            F.lit("invalid").alias("validation_status"),
            F.lit("missing columns: " + ", ".join(missing)).alias("validation_error"),
        )
    per_id = lookup.groupBy("LocationID").agg(F.count(F.lit(1)).alias("uses"))
    totals = per_id.agg(
        F.coalesce(F.sum("uses"), F.lit(0)).alias("records"),
        F.coalesce(F.max("uses"), F.lit(0)).alias("most_uses"),
    )
    error = F.when(F.col("records") == 0, F.lit("no records")).when(
        F.col("most_uses") > 1, F.lit("duplicate LocationID")
    )
    return totals.select(
        "records",
        F.when(error.isNull(), "valid").otherwise("invalid").alias("validation_status"),
        error.alias("validation_error"),
    )


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Append-only JSON-lines audit log; a malformed line fails the read.

    Where the log does not number its events, ``event_seq`` becomes the event's place in its
    file: the byte at which the scan's block begins plus the row within the scan task, which
    grows along the file because a line takes more than a byte.
    """
    from orebelt.operators.audit import EVENT_SCHEMA

    events = spark.read.schema(EVENT_SCHEMA).option("mode", "FAILFAST").json(path)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    place = F.coalesce("event_seq", F.col("_metadata.file_block_start") + row)
    return events.withColumn("event_seq", place)


def read_documents(spark: SparkSession, *paths: str) -> DataFrame:
    """JSON documents (schemas, profiles, reports), one document per file."""
    return spark.read.option("multiLine", True).json(list(paths))


def read_typed(spark: SparkSession, path: str, types: Mapping[str, str]) -> DataFrame:
    """Parquet view cast to declared column types, other columns kept."""
    view = spark.read.parquet(path)
    rest = {name: dtype for name, dtype in view.dtypes if name not in types}
    return conform(view, {**types, **rest})
