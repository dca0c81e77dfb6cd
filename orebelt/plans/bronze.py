"""Bronze load: valid raw files into partitions, with an audit row for every file.

Files are read in groups of one dataset type and one schema, so that a column keeps the type its
file gives it. Rows are counted while they are written, by an observation; what was written is
compared with what the footers promised, and nothing is read a second time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orebelt.operators.shape import union_by_name
from orebelt.sources.files import probe_files, validate_files
from orebelt.sources.sinks import append, overwrite_partitions

KEYS = ("tipo_dataset", "anio", "mes")
AUDIT_SCHEMA = (
    "path string, tipo_dataset string, anio int, mes int, size_bytes long, records long, sha256 string, "
    "bronze_path string, bronze_status string, reason string"
)
#: Partitions that one write fills.
AT_ONCE = 64
LOADED, SKIPPED, DIFFERS = "loaded", "skipped_invalid", "count_differs"


def load_bronze_files(spark: SparkSession, catalog: DataFrame, base: str, audit_path: str | None = None, extension: str = ".parquet") -> DataFrame:
    """Load the valid files of a catalog (``path, tipo_dataset, anio, mes``); returns the audit.

    A file is valid as :func:`validate_files` has it; others are not opened further and get
    ``skipped_invalid`` with the reason. Files of a group whose written rows do not add up to
    their footers get ``count_differs``, all other valid ones ``loaded``. Partitions of the
    catalog's valid files are replaced, so a repeated load changes nothing. The catalog has a row
    per file, as any listing of files does; it is the only thing the driver sees.
    """
    wanted = catalog.select("path", *KEYS).distinct()
    probed = probe_files(wanted.select("path").distinct())
    checked = validate_files(probed, extension).join(probed.select("path", "columns"), "path").join(wanted, "path")
    rows = [r.asDict(recursive=True) for r in checked.orderBy("path").collect()]
    groups: dict[tuple[str, str], list[dict]] = {}
    for row in rows:
        if row["validation_status"] == "valid":
            groups.setdefault((row["tipo_dataset"], json.dumps(row["columns"])), []).append(row)
    status: dict[str, str] = {}
    written: set[tuple] = set()
    for _, files in sorted(groups.items()):
        # a partition that an earlier group has replaced already takes further files beside them
        for beside in (False, True):
            part = [f for f in files if (tuple(f[k] for k in KEYS) in written) == beside]
            if part:
                done = _write(spark, part, base, beside)
                status |= {f["path"]: LOADED if done == sum(f["records"] for f in part) else DIFFERS for f in part}
        written |= {tuple(f[k] for k in KEYS) for f in files}
    out = [
        (
            r["path"], *[r[k] for k in KEYS], r["size_bytes"], r["records"], r["sha256"],
            "/".join([base, *[f"{k}={r[k]}" for k in KEYS]]) if r["path"] in status else None,
            status.get(r["path"], SKIPPED), r["validation_error"],
        )
        for r in rows
    ]
    audit = spark.createDataFrame(out, AUDIT_SCHEMA)
    if audit_path is not None:
        append(audit.coalesce(1), audit_path)
    return audit


def _write(spark: SparkSession, files: Sequence[dict], base: str, beside: bool) -> int:
    """Write files of one schema into their partitions; returns the rows seen on the way."""
    places: dict[tuple, list[str]] = {}
    for f in files:
        places.setdefault(tuple(f[k] for k in KEYS), []).append(f["path"])
    total, left = 0, sorted(places.items(), key=str)
    schema = spark.read.parquet(files[0]["path"]).schema  # the same for all of the group
    while left:
        some, left = left[:AT_ONCE], left[AT_ONCE:]
        parts = []
        for place, paths in some:
            rows = spark.read.schema(schema).parquet(*paths)
            rows = rows.drop(*[c for c in rows.columns if c.lower() in KEYS])
            parts.append(rows.withColumns({k: F.lit(v).cast("string" if k == KEYS[0] else "int") for k, v in zip(KEYS, place, strict=True)}))
        seen = Observation("bronze")
        counted = union_by_name(parts).hint("rebalance", *KEYS).observe(seen, F.count(F.lit(1)).alias("rows"))
        if beside:
            counted.write.mode("append").partitionBy(*KEYS).parquet(base)
        else:
            overwrite_partitions(counted, base, KEYS)
        total += seen.get["rows"]
    return total
