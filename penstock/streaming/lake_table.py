"""A keyed, partitioned, merge-on-read table in plain parquet folders.

::

    log/batch=N/<partition>=P/      rows of one upsert, newest per key
    base/version=V/<partition>=P/   a partition's rows after compaction
    manifest/version=V/             which base version each partition has
    writers/W/B-N/                  writer W's batch B is the table's batch N (``written`` inside: complete)

A folder counts once its job's done mark is there, so a failed or repeated
write is invisible until it is complete, and writing a batch again replaces
it. Compaction folds every batch up to V, rewrites only partitions those
batches touch, and switches readers by adding a manifest; nothing a reader may
be using is overwritten.

A key lives in one partition, and the ordering column is part of the key, so
of two rows of a key the one that arrived later is newer.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penstock.operators import lake
from penstock.operators.keyed import latest_per_key
from penstock.sources import folders

MANIFEST_SCHEMA = "part string, version long"
WRITTEN = "written"


@dataclass
class State:
    """What a reader sees: the base version of each partition and the batches not yet folded in."""

    version: int
    base: dict[str, int]
    batches: list[int]


class LakeTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
                 precombine: str, partition: str, arrival: str = "seq", is_delete: str | None = None,
                 arrival_type: T.DataType = T.LongType()):
        if precombine not in keys:
            raise ValueError("the ordering column must be part of the key")
        self.spark, self.path = spark, path.rstrip("/")
        self.schema, self.keys, self.partition = schema, list(keys), partition
        self.arrival, self.is_delete = arrival, is_delete
        extra = [T.StructField(arrival, arrival_type)]
        if is_delete:
            extra.append(T.StructField(is_delete, T.BooleanType()))
        self.log_schema = T.StructType([*schema.fields, *extra])

    # -- state ---------------------------------------------------------------

    def _numbers(self, folder: str, prefix: str) -> list[int]:
        root = f"{self.path}/{folder}"
        found = [name for name in folders.child_folders(self.spark, root, prefix)
                 if folders.is_done(self.spark, f"{root}/{name}")]
        return sorted(int(name.removeprefix(prefix)) for name in found)

    def versions(self) -> list[int]:
        return self._numbers("manifest", "version=")

    def batches(self) -> list[int]:
        return self._numbers("log", "batch=")

    def state(self, as_of: int | None = None) -> State:
        """The newest state, or the one right after commit ``as_of``."""
        versions = [v for v in self.versions() if as_of is None or v <= as_of]
        version = versions[-1] if versions else -1
        batches = [n for n in self.batches() if n > version and (as_of is None or n <= as_of)]
        return State(version, self._manifest(version), batches)

    def _manifest(self, version: int) -> dict[str, int]:
        """Partition folder name → base version: one row per partition of the table."""
        if version < 0:
            return {}
        rows = self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.path}/manifest/version={version}")
        return {r["part"]: r["version"] for r in rows.toLocalIterator()}

    def _touched(self, batches: Sequence[int]) -> set[str]:
        return {name for n in batches
                for name in folders.child_folders(self.spark, f"{self.path}/log/batch={n}", f"{self.partition}=")}

    # -- frames --------------------------------------------------------------

    def _read(self, folder: str, number: str, paths: list[str], schema: T.StructType) -> DataFrame:
        columns = schema.fieldNames()
        full = T.StructType([*schema.fields, T.StructField(number, T.LongType())])
        if not paths:
            return self.spark.createDataFrame([], full).select(*columns, number)
        reader = self.spark.read.schema(full).option("basePath", f"{self.path}/{folder}")
        return reader.parquet(*paths).select(*columns, number)

    def _base(self, base: dict[str, int]) -> DataFrame:
        paths = [f"{self.path}/base/version={v}/{part}" for part, v in sorted(base.items())]
        return self._read("base", "version", paths, self.schema).drop("version")

    def _log(self, batches: Sequence[int]) -> DataFrame:
        paths = [f"{self.path}/log/batch={n}" for n in batches if self._touched([n])]
        return self._read("log", "batch", paths, self.log_schema)

    def _merged(self, state: State, touched: set[str]) -> DataFrame:
        base = self._base({p: v for p, v in state.base.items() if p in touched})
        return lake.merge_on_read(base, self._log(state.batches), self.keys, ["batch", self.arrival], self.is_delete,
                                  log_has_repeats=len(state.batches) > 1)

    def snapshot(self, as_of: int | None = None) -> DataFrame:
        """The table's rows. Partitions no open batch touches are read as they are, without a merge."""
        state = self.state(as_of)
        touched = self._touched(state.batches)
        untouched = {p: v for p, v in state.base.items() if p not in touched}
        if not touched:
            return self._base(untouched)
        merged = self._merged(state, touched)
        return self._base(untouched).unionByName(merged) if untouched else merged

    # -- changes -------------------------------------------------------------

    def claim(self, writer: str, batch_id: int) -> int | None:
        """The table's number for a writer's batch, or None if the batch is already part of the base.

        A repeated batch gets its former number, so it replaces itself. A
        writer that starts counting anew must come with a new name.
        """
        root = f"{self.path}/writers"
        claims = {tuple(int(x) for x in name.split("-")): w for w in folders.child_folders(self.spark, root)
                  for name in folders.child_folders(self.spark, f"{root}/{w}")}
        version = max(self.versions(), default=-1)
        for (claimed, number), w in claims.items():
            if (w, claimed) != (writer, batch_id):
                continue
            if number > version:
                return number
            claim = f"{root}/{writer}/{batch_id}-{number}"
            if folders.child_folders(self.spark, claim) or number in self.batches():
                return None
            # Begun but never finished before later batches were folded in: it counts as a new one.
            folders.remove(self.spark, claim)
        number = 1 + max([version, *self.batches(), *(n for _, n in claims)])
        folders.make(self.spark, f"{root}/{writer}/{batch_id}-{number}")
        return number

    def upsert(self, rows: DataFrame, batch_id: int, writer: str = "batch") -> bool:
        """Add one batch, newest row per key. The same batch again replaces it, or is skipped once folded in.

        One writer is active at a time; writers may take turns. Returns whether the batch was written.
        """
        number = self.claim(writer, batch_id)
        if number is None:
            return False
        newest = latest_per_key(rows, self.keys, [self.arrival]).select(*self.log_schema.fieldNames())
        self._write(newest, f"log/batch={number}")
        folders.make(self.spark, f"{self.path}/writers/{writer}/{batch_id}-{number}/{WRITTEN}")
        return True

    def _write(self, rows: DataFrame, folder: str) -> None:
        """Rows by partition. Rebalancing gives each partition files of an even size: a batch over many
        partitions does not leave one file per task in each, and a partition with most rows is split."""
        (rows.hint("rebalance", F.col(self.partition))
         .sortWithinPartitions(self.partition, *[k for k in self.keys if k != self.partition])
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(self.partition)
         .parquet(f"{self.path}/{folder}"))

    def compact(self) -> int | None:
        """Fold all open batches into new base versions of the partitions they touch."""
        state = self.state()
        if not state.batches:
            return None
        version = state.batches[-1]
        touched = self._touched(state.batches)
        target = f"base/version={version}"
        self._write(self._merged(state, touched), target)
        written = folders.child_folders(self.spark, f"{self.path}/{target}", f"{self.partition}=")
        current = {p: v for p, v in state.base.items() if p not in touched} | {p: version for p in written}
        self.spark.createDataFrame(sorted(current.items()), MANIFEST_SCHEMA).coalesce(1).write.mode(
            "overwrite").parquet(f"{self.path}/manifest/version={version}")
        return version

    def clean(self, retained: int) -> list[str]:
        """Remove base versions and folded batches that none of the newest ``retained`` commits reads."""
        commits = sorted(set(self.batches()) | set(self.versions()))
        if len(commits) < retained:
            return []
        oldest = commits[-retained]
        folded = max((v for v in self.versions() if v <= oldest), default=-1)
        stale = [f"log/batch={n}" for n in self.batches() if n <= folded]
        found = [(0, part, v) for v in self.versions()
                 for part in folders.child_folders(self.spark, f"{self.path}/base/version={v}", f"{self.partition}=")]
        versions = self.spark.createDataFrame(found, "table_id int, file_group string, commit long")
        cut = self.spark.createDataFrame([(0, oldest)], "table_id int, oldest long")
        stale += [f"base/version={r['commit']}/{r['file_group']}"
                  for r in lake.clean_plan(versions, cut).toLocalIterator()]
        for folder in stale:
            folders.remove(self.spark, f"{self.path}/{folder}")
        return stale

    def archive(self, keep_min: int, keep_max: int) -> list[int]:
        """Move manifests beyond the newest ``keep_min`` to the archive once there are more than ``keep_max``."""
        versions = self.versions()
        commits = self.spark.createDataFrame([(0, v) for v in versions], "table_id int, commit long")
        limits = self.spark.createDataFrame([(0, keep_min, keep_max)], "table_id int, keep_min int, keep_max int")
        old = sorted(r["commit"] for r in lake.archive_plan(commits, limits).toLocalIterator())
        if old:
            paths = [f"{self.path}/manifest/version={v}" for v in old]
            rows = self.spark.read.schema(MANIFEST_SCHEMA).parquet(*paths)
            rows.withColumn("archived_from", F.col("_metadata.file_path")).write.mode("overwrite").parquet(
                f"{self.path}/archive/upto={old[-1]}")
            for path in paths:
                folders.remove(self.spark, path)
            self._forget_claims(old[-1])
        return old

    def _forget_claims(self, before: int) -> None:
        """Drop the numbers of long-folded batches; each writer's last one stays."""
        root = f"{self.path}/writers"
        for writer in folders.child_folders(self.spark, root):
            claims = sorted((int(name.split("-")[1]), name)
                            for name in folders.child_folders(self.spark, f"{root}/{writer}"))
            for number, name in claims[:-1]:
                if number <= before:
                    folders.remove(self.spark, f"{root}/{writer}/{name}")
