"""File inventory, hashes, footers and validation, spread over tasks by file."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

_PROBE_SCHEMA = (
    "path string, exists boolean, size_bytes long, modified_at timestamp, sha256 string, signature_ok boolean, "
    "records long, columns array<struct<column: string, dtype: string>>, read_error string"
)
_BLOCK = 8 * 1024 * 1024


def file_inventory(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Path, size and modification time of every non-empty file under a root.

    Only the listing is read: the content column is pruned from the scan. Spark's
    listing leaves out empty files; probe a catalog of paths to find those.
    """
    files = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True).load(root)
    return files.select(
        "path",
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


def probe_files(paths: DataFrame, partitions: int | None = None, hashes: bool = True) -> DataFrame:
    """Existence, size, hash, Parquet signature, row count and schema per path.

    ``paths`` has a ``path`` column: a catalog of expected files or an inventory. Each
    task opens its own files: the footer gives rows and schema, and with ``hashes``
    the content is streamed in blocks, so a file's size is not bound by memory.
    ``partitions`` spreads many small files over more tasks. Files that cannot be
    read as Parquet get a ``read_error`` instead of failing the job.
    """
    listed = paths.select("path")
    if partitions:
        listed = listed.repartition(partitions, "path")

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([_probe(path, hashes) for path in batch["path"]], columns=_PROBED, index=batch.index)
            whole = found.astype({"records": "Int64", "size_bytes": "Int64"})
            whole["modified_at"] = pd.to_datetime(whole["modified_at"], utc=True)
            yield pd.concat([batch, whole], axis=1)

    return listed.mapInPandas(probe, _PROBE_SCHEMA)


_PROBED = ["exists", "size_bytes", "modified_at", "sha256", "signature_ok", "records", "columns", "read_error"]


def _probe(path: str, hashes: bool) -> tuple:
    filesystem, inner = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    info = filesystem.get_file_info(inner)
    if info.type != fs.FileType.File:
        return False, None, None, None, False, None, None, None
    with filesystem.open_input_file(inner) as opened:
        signed = info.size >= 8 and opened.read_at(4, 0) == opened.read_at(4, info.size - 4) == b"PAR1"
    digest = _digest(filesystem, inner) if hashes else None
    known = (True, info.size, info.mtime, digest, signed)
    try:
        with filesystem.open_input_file(inner) as opened:
            footer = pq.read_metadata(opened)
        fields = from_arrow_schema(footer.schema.to_arrow_schema(), prefer_timestamp_ntz=True).fields
    except Exception as error:  # noqa: BLE001 - any reader error marks the file, not the job
        return *known, None, None, str(error)
    columns = [{"column": f.name, "dtype": f.dataType.simpleString()} for f in fields]
    return *known, footer.num_rows, columns, None


def _digest(filesystem: fs.FileSystem, path: str) -> str:
    sha = hashlib.sha256()
    with filesystem.open_input_stream(path) as stream:
        while block := stream.read(_BLOCK):
            sha.update(block)
    return sha.hexdigest()


def row_counts_by_file(df: DataFrame) -> DataFrame:
    """Rows per source file of a file-based frame, after any filters."""
    return df.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("records"))


def table_of(path: Column, names: Sequence[str], extension: str = ".parquet") -> Column:
    """File name of the table a path belongs to: a file of that name or any file in a folder of that name."""
    known = "|".join(re.escape(name) for name in names)
    return F.regexp_extract(path, f"^.*/((?:{known}){re.escape(extension)})(?:/.*)?$", 1)


def validate_tables(probed: DataFrame, names: Sequence[str]) -> DataFrame:
    """Records and status per table of one or many files; a table is valid if all its files are."""
    files = validate_files(probed).withColumn("file", table_of(F.col("path"), names)).where("file <> ''")
    status = F.when(F.bool_and(F.col("validation_status") == "valid"), "valid").otherwise("invalid")
    return files.groupBy("file").agg(F.sum("records").alias("records"), status.alias("validation_status"))


def schemas_by_file(probed: DataFrame) -> DataFrame:
    """One row per file and column."""
    return probed.select("path", F.inline("columns"))


def validate_files(probed: DataFrame, extension: str = ".parquet") -> DataFrame:
    """Status and first error of every probed file."""
    error = (
        F.when(~F.col("exists"), F.lit("missing file"))
        .when(F.col("size_bytes") == 0, F.lit("empty file"))
        .when(~F.lower("path").endswith(extension), F.lit("wrong extension"))
        .when(~F.col("signature_ok"), F.lit("bad signature"))
        .when(F.col("read_error").isNotNull(), F.concat(F.lit("not readable: "), "read_error"))
    )
    return probed.select(
        "path",
        "size_bytes",
        F.bround(F.col("size_bytes") / F.lit(1024**3), 4).alias("size_gb"),
        "records",
        "sha256",
        F.when(error.isNull(), "valid").otherwise("invalid").alias("validation_status"),
        error.alias("validation_error"),
    )
