"""Table writers. None of them overwrites a path its own plan reads."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a whole Parquet table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], compression: str | None = None) -> None:
    """Replace only the partitions present in the frame; idempotent on replay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path, compression=compression)


def write_dimension(df: DataFrame, path: str) -> None:
    """Small dimension as a single file; what leads to it stays parallel."""
    overwrite(df.repartition(1), path)


def write_by_month(df: DataFrame, path: str, key: str = "time_id") -> None:
    """Fact table in month directories.

    The rebalance hint lets adaptive execution split a month that holds most
    of the rows and merge months that hold few, instead of a fixed file count.
    """
    overwrite(df.hint("rebalance", key), path, [key])


def append(df: DataFrame, path: str) -> None:
    """Append to a log or state table, one write per run."""
    df.write.mode("append").parquet(path)


def append_events(df: DataFrame, path: str) -> None:
    """Append audit events as JSON lines."""
    df.write.mode("append").json(path)


def write_report(df: DataFrame, path: str) -> None:
    """Nested report rows as JSON documents."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def as_document(df: DataFrame, alias: str = "document") -> DataFrame:
    """Each row as one JSON text column."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(alias))


def _folder(spark: SparkSession, path: str):
    """File system and path handle; works for every store that Spark reads."""
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def exists(spark: SparkSession, path: str) -> bool:
    store, handle = _folder(spark, path)
    return store.exists(handle)


def modified_at(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Names below a folder with their modification times in epoch seconds."""
    store, handle = _folder(spark, path)
    if not store.exists(handle):
        return []
    return [(status.getPath().getName(), status.getModificationTime() / 1000) for status in store.listStatus(handle)]


def delete(spark: SparkSession, path: str) -> None:
    store, handle = _folder(spark, path)
    store.delete(handle, True)


def move_exclusively(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder to a path that must not exist; False if it does."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.FileContext.getFileContext(hadoop.Path(source).toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        files.rename(hadoop.Path(source), hadoop.Path(target), no_options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.toString():
            raise
        return False
    return True


def load_bronze(raw: DataFrame, path: str) -> None:
    """Validated raw rows into bronze partitions by type, year and month."""
    overwrite_partitions(raw, path, ["tipo_dataset", "anio", "mes"])
