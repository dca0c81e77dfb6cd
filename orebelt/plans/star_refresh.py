"""Star schema store with replaceable source contributions.

A refresh writes the contributions of all stale sources as one batch directory and then
makes one numbered commit with a row per source: its fingerprint and batch. Readers take only
the batches the manifest names, and of them only the versions in force, so a crash leaves an
unused directory but never a wrong fact, and a source that became empty cannot leave its old
rows behind. A commit states which one it was derived from, so a writer that another has
overtaken fails instead of hiding what the other did; clocks decide nothing.

Batches have levels. ``compact`` merges the versions in force of as many batches of one level as
the fan-out says into one batch of the next, so a fact of n refreshes is read from a number of
batches logarithmic in n, and a contribution is rewritten once a level at most. Batches without a
source in force are deleted by ``vacuum``. A publication is one version directory with the
fact and all dimensions, committed with its row counts after its keys have been checked.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orebelt.contract import FACT_KEYS
from orebelt.operators import star
from orebelt.operators.incremental import compare_sources
from orebelt.operators.shape import require_unique, union_by_name
from orebelt.session import materialize, small_scans
from orebelt.sources.commits import CommitLog
from orebelt.sources.sinks import delete, modified_at

_KEY_TYPES = {
    "time_id": "string", "tipo_dataset": "string", "provider_key": "string",
}
CONTRIBUTION_SCHEMA = ", ".join(
    [f"{k} {_KEY_TYPES.get(k, 'int')}" for k in FACT_KEYS]
    + ["cantidad_viajes long"]
    + [f"{c} double" for c in star.FACT_TOTALS.values()]
    + [f"{c} long" for c in star.COUNTED.values()]
    + ["source_id string", "version string"]
)
MANIFEST_SCHEMA = (
    "source_id string, fingerprint string, batch string, active boolean, contribution_rows long, recorded_at timestamp"
)
PUBLISHED_SCHEMA = "version string, table string, rows long, published_at timestamp"
_VERSION = ("source_id", "version")
_STALE = ("new", "changed", "staging_missing", "forced")
_FACT = "fact_viajes_agregados"
_MONTH = ("time_id", "tipo_dataset")
#: Bytes of stored trips that one task groups: half a million at some 30 bytes, 500 bytes each while grouped.
_GROUPED_BYTES = 16 << 20


@dataclass(frozen=True)
class StarStore:
    """Paths of one star schema below a shared root."""

    root: str

    @property
    def contributions_path(self) -> str:
        return f"{self.root}/contributions"

    @property
    def manifest_path(self) -> str:
        return f"{self.root}/manifest"

    @property
    def published_path(self) -> str:
        return f"{self.root}/published"

    @property
    def commits(self) -> CommitLog:
        return CommitLog(self.manifest_path, MANIFEST_SCHEMA, "source_id")

    @property
    def publications(self) -> CommitLog:
        return CommitLog(f"{self.published_path}/versions", PUBLISHED_SCHEMA)

    def manifest(self, spark: SparkSession) -> DataFrame:
        """Active sources with the version in force and the batch that holds it."""
        return self.commits.state(spark).where("active").drop("seq")

    def batches(self, spark: SparkSession) -> list[str]:
        """Batches with a version in force; their number is logarithmic in that of refreshes
        where :meth:`compact` follows them."""
        held = self.manifest(spark).where("contribution_rows > 0").select("batch").distinct()
        return sorted(row["batch"] for row in held.collect())

    def _batch(self, name: str) -> str:
        return f"{self.contributions_path}/{name}"

    def contributions(self, spark: SparkSession, batches: Sequence[str] | None = None) -> DataFrame:
        """Contributions in force, of all batches or of some: one scan of the batches in force."""
        names = self.batches(spark) if batches is None else batches
        if not names:
            return spark.createDataFrame([], CONTRIBUTION_SCHEMA)
        active = self.manifest(spark).select("batch", "source_id", F.col("fingerprint").alias("version"))
        batch = F.element_at(F.split("_metadata.file_path", "/"), -2)
        held = spark.read.schema(CONTRIBUTION_SCHEMA).parquet(*[self._batch(name) for name in names])
        return held.withColumn("batch", batch).join(active, ["batch", *_VERSION], "left_semi").drop("batch")

    def fact(self, spark: SparkSession) -> DataFrame:
        """Merged fact of the active contributions, not yet published.

        A source has a fact key once, so what it holds of a month and type that no other
        source holds is merged already; only months of several sources are shuffled.
        """
        held = self.contributions(spark)
        spread = held.select(*_MONTH, "source_id").distinct().groupBy(*_MONTH).agg(F.count(F.lit(1)).alias("sources"))
        shared = materialize(spread.where("sources > 1").select(*_MONTH), "shared-months")
        if shared.isEmpty():
            return star.with_averages(held)
        same = reduce(Column.__and__, [held[key].eqNullSafe(shared[key]) for key in _MONTH])
        merged = star.merge_contributions(held.join(shared, same, "left_semi"))
        return star.with_averages(held.join(shared, same, "left_anti")).unionByName(merged)

    def changes(self, spark: SparkSession, fingerprints: DataFrame, force: bool = False) -> DataFrame:
        """Change class of every known source. No contribution is read."""
        state = self.manifest(spark)
        there = [name for name, _ in modified_at(spark, self.contributions_path)]
        staged = state.where(F.col("batch").isin(there) | (F.col("contribution_rows") == 0)).select("source_id")
        return compare_sources(fingerprints, state, staged, force)

    def stage(self, prepared: DataFrame) -> str:
        """Write the contributions of prepared trips as a new batch and return its name.

        ``prepared`` carries ``source_id`` and ``version``, or has been made contributions that do.
        """
        made = prepared if set(star.ADDITIVE) <= set(prepared.columns) else star.fact_contribution(prepared, _VERSION)
        with small_scans(prepared.sparkSession, _GROUPED_BYTES):
            return self._write(made, 0)

    def _write(self, contributions: DataFrame, level: int) -> str:
        """A new batch, written by the tasks that made it: readers take whole batches, so that
        grouping rows by source would be a shuffle of all of them for nothing."""
        batch = f"b-{level}-{uuid.uuid4().hex}"
        contributions.write.parquet(self._batch(batch), compression="zstd")
        return batch

    def staged_versions(self, spark: SparkSession, batch: str) -> DataFrame:
        """Sources of a batch with their version and rows."""
        held = spark.read.schema(CONTRIBUTION_SCHEMA).parquet(self._batch(batch))
        return held.groupBy("source_id", F.col("version").alias("fingerprint")).agg(
            F.count(F.lit(1)).alias("contribution_rows")
        )

    def commit(self, spark: SparkSession, versions: DataFrame, batch: str | None, gone: DataFrame | None = None, after: int | None = None) -> int:
        """One commit of the ``source_id, fingerprint`` pairs of a staged batch and of those ``gone``.

        Pairs of ``versions`` without rows in the batch are sources without contributions.
        ``after`` is the commit that the pairs were derived from.
        """
        rows = versions
        if batch is None:
            rows = rows.withColumn("contribution_rows", F.lit(0).cast("long"))
        elif "contribution_rows" not in rows.columns:
            rows = rows.join(self.staged_versions(spark, batch), ["source_id", "fingerprint"], "left")
        rows = rows.select("source_id", "fingerprint", "contribution_rows", F.lit(batch).cast("string").alias("batch"), F.lit(True).alias("active"))
        if gone is not None:
            left = gone.select("source_id", "fingerprint", F.lit(0).cast("long").alias("contribution_rows"), F.lit(None).cast("string").alias("batch"), F.lit(False).alias("active"))
            rows = rows.unionByName(left)
        return self._record(rows, after)

    def _record(self, rows: DataFrame, after: int | None) -> int:
        counted = F.coalesce("contribution_rows", F.lit(0).cast("long")).alias("contribution_rows")
        rows = rows.select("source_id", "fingerprint", "batch", "active", counted, F.current_timestamp().alias("recorded_at"))
        return self.commits.append(rows, after)

    def compact(self, spark: SparkSession, fanout: int = 8) -> list[str]:
        """Merge batches level by level until no level has ``fanout`` of them; returns new batches.

        A merge that fills the next level takes that level along, so its rows are written once.
        Each merge is one commit that only renames where versions in force are held. Versions
        replaced since a batch was written are left behind. If another writer commits while a
        merge runs, the merge fails with ``CommitConflict``, its batch is never read, and it can
        be started again. The manifest is checkpointed too.
        """
        made = []
        while True:
            base = self.commits.last(spark)
            levels: dict[int, list[str]] = {}
            for name in self.batches(spark):
                levels.setdefault(int(re.match(r"b-(\d+)-", name)[1]), []).append(name)
            full = next((level for level in sorted(levels) if len(levels[level]) >= fanout), None)
            if full is None:
                self.commits.checkpoint(spark)
                return made
            names, level = levels[full], full + 1
            while 1 < fanout <= len(levels.get(level, [])) + 1:
                names, level = names + levels[level], level + 1
            held = self.manifest(spark).where(F.col("batch").isin(names))
            made.append(self._write(self.contributions(spark, names), level))
            self._record(held.withColumn("batch", F.lit(made[-1])), base)

    def refresh(
        self,
        spark: SparkSession,
        canonical: DataFrame,
        fingerprints: DataFrame,
        force: bool = False,
        dataset: str | Column = "desconocido",
        year: int | Column | None = None,
    ) -> bool:
        """Bring contributions in line with the sources in one commit; True when anything changed.

        Fails with ``CommitConflict``, changing nothing, if another writer has committed since
        the sources were compared.

        ``canonical`` has a ``source_id`` column, best a partition column, so that only
        stale sources are read. ``dataset`` and ``year`` fill gaps, as columns such as those
        of ``with_source_identity``.
        """
        base = self.commits.last(spark)
        # One row per source, used by several jobs below.
        changes = materialize(self.changes(spark, fingerprints, force), "source-changes")
        found = {row["change"]: row["count"] for row in changes.groupBy("change").count().collect()}
        if not any(found.get(kind) for kind in (*_STALE, "gone")):
            return False
        stale = changes.where(F.col("change").isin(*_STALE)).select("source_id", "fingerprint")
        gone = changes.where("change = 'gone'").select("source_id", F.col("previous_fingerprint").alias("fingerprint"))
        batch = None
        if any(found.get(kind) for kind in _STALE):
            trips = canonical.join(stale.select("source_id"), "source_id")
            # a source has one version, which joins its contributions and not the rows shuffled for them
            made = star.fact_contribution(star.star_input(trips, dataset, year, carry=["source_id"]), ["source_id"])
            batch = self.stage(made.join(stale.withColumnRenamed("fingerprint", "version"), "source_id"))
        self.commit(spark, stale, batch, gone, base)
        return True

    def vacuum(self, spark: SparkSession, grace_seconds: float = 7 * 86400) -> list[str]:
        """Delete batches without a version in force, publications but the last, and commits that a
        checkpoint covers, where older than the grace period; returns their paths."""
        held = {self._batch(b) for b in self.batches(spark)}
        current = self.current(spark)
        held.add(f"{self.published_path}/{current}")
        limit = time.time() - grace_seconds
        old = self.commits.trim(spark, limit)
        for folder, prefix in ((self.contributions_path, "b-"), (self.published_path, "v-")):
            for name, at in modified_at(spark, folder):
                if name.startswith(prefix) and at <= limit and f"{folder}/{name}" not in held:
                    delete(spark, f"{folder}/{name}")
                    old.append(f"{folder}/{name}")
        return old

    def current(self, spark: SparkSession) -> str | None:
        """The version published last."""
        return self.publications.read(spark).agg(F.max_by("version", "seq")).first()[0]

    def published(self, spark: SparkSession) -> dict[str, DataFrame]:
        """Fact and dimensions of the version published last."""
        return self._tables(spark, self.current(spark))

    def _tables(self, spark: SparkSession, version: str) -> dict[str, DataFrame]:
        base = f"{self.published_path}/{version}"
        fact = spark.read.parquet(f"{base}/{_FACT}").withColumn("time_id", F.col("time_id").cast("string"))
        return {_FACT: fact, **{name: spark.read.parquet(f"{base}/{name}") for name in star.DIMENSION_KEYS}}

    def publish(self, spark: SparkSession, lookup: DataFrame) -> dict[str, DataFrame]:
        """Write the fact and its ten dimensions as one version, check that keys are unique, and
        only then commit the version with its row counts. Fails with ``CommitConflict`` if another
        writer has published meanwhile."""
        base_commit = self.publications.last(spark)
        version = f"v-{uuid.uuid4().hex}"
        base = f"{self.published_path}/{version}"
        self.fact(spark).hint("rebalance", "time_id").write.partitionBy("time_id").parquet(f"{base}/{_FACT}")
        fact = spark.read.parquet(f"{base}/{_FACT}").withColumn("time_id", F.col("time_id").cast("string"))
        for name, dim in star.dimensions(fact, lookup).items():
            dim.repartition(1).write.parquet(f"{base}/{name}")
        tables = self._tables(spark, version)
        for name, key in star.DIMENSION_KEYS.items():
            require_unique(tables[name], [key], name)
        counted = published_counts(tables).select(F.lit(version).alias("version"), "table", "rows", F.current_timestamp().alias("published_at"))
        self.publications.append(counted, base_commit)
        return tables

    def publish_if_needed(
        self,
        spark: SparkSession,
        canonical: DataFrame,
        fingerprints: DataFrame,
        lookup: DataFrame,
        force_reprocess: bool = False,
        force_rebuild: bool = False,
        dataset: str | Column = "desconocido",
        year: int | Column | None = None,
    ) -> dict[str, DataFrame] | None:
        """Refresh, then publish only if a source changed or a rebuild is asked for."""
        changed = self.refresh(spark, canonical, fingerprints, force_reprocess, dataset, year)
        return self.publish(spark, lookup) if changed or force_rebuild else None


def published_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts per published table, for the run record."""
    return union_by_name(
        [
            table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
            for name, table in tables.items()
        ]
    )


def full_fact(canonical: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Fact computed from all trips at once; equals any sequence of refreshes."""
    return star.merge_contributions(star.fact_contribution(star.star_input(canonical, carry=by), by))
