"""Session factory and shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(app_name: str = "orebelt", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings the library expects.

    Partition counts, memory and the checkpoint folder stay with the cluster.
    Keyword settings use ``__`` for the dots (``spark__driver__memory="8g"``).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; a local run may make its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    own = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch folder that nothing has used before."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_scans(spark: SparkSession, most: int) -> Iterator[None]:
    """Tasks of queries started inside scan at most so many bytes of files; a lower setting stays.

    A task that groups what it scans holds a row for each key it meets, and a compressed file
    of the usual 128 MB has millions: more than a task's memory, so that all of them spill.
    """
    key = "spark.sql.files.maxPartitionBytes"
    held = spark.conf.get(key)
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(held) > most:
        spark.conf.set(key, f"{most}b")
    try:
        yield
    finally:
        spark.conf.set(key, held)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that feeds several actions and read it back.

    The written table cuts the lineage, survives the loss of any executor and,
    unlike a cached frame, keeps column pruning and file statistics.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
