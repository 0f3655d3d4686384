"""Shard stores by size-tiered compaction with atomically committed, versioned manifests.

A store is a folder: ``data/`` holds immutable Parquet shards, ``manifest/``
one small table for each version (path, rows, bytes, tier of every live
shard), ``commit/`` one pointer file for each version, with the store's schema,
and ``writing/`` a mark for each write that is not committed yet.  A version
exists once its pointer has been renamed into place; the rename fails if
another writer was first, and then that writer's version is read and the
commit tried again.  Arrivals are appended as they come; compaction merges
shards of like size (a tier spans a factor of ``fanout``) into files of about
the target size, leaving the others alone, so a row is rewritten about
log_fanout(target / arrival) times however long the store lives.

The driver handles one row per shard file at most (of files under half the
target size when it plans); rows and texts move only between executors.  Files
are read and written by Spark, and the few file operations go through Hadoop's
file system API.  The file system has to rename a file atomically without
replacing another (HDFS and local disks do; plain object stores do not).

Defined results: rows are kept as they are, nulls, empty and very long texts
and repeated rows included; an empty arrival commits a version without new
shards; a store without rows is read as an empty frame; any columns are kept,
whatever their names; an arrival with other columns than the store's is an
error.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("n_rows", T.LongType(), False),
        T.StructField("n_bytes", T.LongType(), False),
        T.StructField("tier", T.IntegerType(), False),
    ]
)

#: File names that a compaction may broadcast; a longer plan is joined by shuffle.
BROADCAST_FILES = 50_000


class CommitConflict(RuntimeError):
    """Another writer committed the version first."""


@dataclass(frozen=True)
class ShardStore:
    """A store at ``root``; sizes in bytes."""

    spark: SparkSession
    root: str
    target_bytes: int = 512 << 20
    fanout: int = 4
    smallest: int = 1 << 20
    #: Seconds after which the mark of a write counts as left behind by a writer that died.
    abandoned: int = 86_400

    # -- files

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return jvm, jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(conf), conf

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _list(self, name: str) -> list[tuple[str, int, float]]:
        """Names, sizes and times (seconds) of a folder's files."""
        _, fs, _ = self._fs()
        folder = self._path(name)
        if not fs.exists(folder):
            return []
        return [(s.getPath().getName(), s.getLen(), s.getModificationTime() / 1000) for s in fs.listStatus(folder)]

    def _delete(self, name: str) -> None:
        self._fs()[1].delete(self._path(name), True)

    def _write(self, rows: DataFrame, **options: int) -> str:
        """Writes a folder of shards, marked as being written until ``_publish`` has committed it."""
        name = uuid.uuid4().hex
        self._fs()[1].create(self._path(f"writing/{name}"), False).close()
        rows.write.options(**options).parquet(f"{self.root}/data/{name}")
        return f"data/{name}"

    def _written(self, folder: str) -> None:
        self._delete(f"writing/{folder.rsplit('/', 1)[1]}")

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return sorted(int(n[1:]) for n, *_ in self._list("commit") if n.startswith("v"))

    def _commit(self, version: int, manifest: str, schema: T.StructType) -> None:
        jvm, fs, conf = self._fs()
        draft = self._path(f"commit/.draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps({"manifest": manifest, "schema": schema.jsonValue()}).encode()))
        out.close()
        options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        no_overwrite = self.spark.sparkContext._gateway.new_array(options, 1)
        no_overwrite[0] = options.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), conf)
        try:
            context.rename(context.makeQualified(draft), context.makeQualified(self._path(f"commit/v{version:09d}")), no_overwrite)
        except Exception as error:
            fs.delete(draft, False)
            if version in self.versions():
                raise CommitConflict(f"version {version} exists") from error
            raise

    def _pointer(self, version: int) -> dict:
        stream = self._fs()[1].open(self._path(f"commit/v{version:09d}"))
        text = bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        stream.close()
        return json.loads(text)

    def manifest(self, version: int | None = None) -> DataFrame:
        """The live shards of a version (the latest unless named)."""
        known = self.versions()
        if not known:
            return self.spark.createDataFrame([], MANIFEST)
        pointer = self._pointer(known[-1] if version is None else version)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/{pointer['manifest']}")

    def schema(self, version: int | None = None) -> T.StructType | None:
        """The columns of a version; None of a store without versions."""
        known = self.versions()
        return T.StructType.fromJson(self._pointer(known[-1] if version is None else version)["schema"]) if known else None

    def _fits(self, version: int | None, schema: T.StructType) -> T.StructType:
        """The columns of a version, which have to be those of an arrival; the arrival's own where there is no version."""
        known = schema if version is None else T.StructType.fromJson(self._pointer(version)["schema"])
        shape = lambda fields: sorted((f.name, f.dataType.simpleString()) for f in fields)
        if shape(known) != shape(schema):
            raise ValueError(f"the store has other columns: {known.simpleString()}")
        return known

    def _publish(self, folder: str, schema: T.StructType, removed: list[str], attempts: int = 5) -> int:
        """Commits a version with a folder's shards and without the ``removed`` ones.

        Each attempt holds the columns against those of the version that it
        follows, so of two first writers with different columns one fails.
        """
        added = self._shards(folder)
        for attempt in range(attempts):
            known = self.versions()
            last = known[-1] if known else None
            try:
                schema = self._fits(last, schema)
            except ValueError:
                self._delete(folder)
                self._written(folder)
                raise
            live = self.manifest(last) if known else self.manifest()
            paths = {r["path"] for r in live.select("path").collect()} if removed else set()
            if not paths.issuperset(removed):
                raise CommitConflict("a shard to be replaced is gone")
            if removed:
                gone = self.spark.createDataFrame([(p,) for p in removed], "path string")
                live = live.join(gone, "path", "left_anti")
            name = uuid.uuid4().hex
            live.unionByName(added).coalesce(1).write.parquet(f"{self.root}/manifest/{name}")
            version = (known[-1] if known else 0) + 1
            try:
                self._commit(version, name, schema)
            except CommitConflict:
                if attempt + 1 == attempts:
                    raise
                continue
            self._written(folder)
            return version
        raise AssertionError

    # -- shards

    def tier(self, n_bytes: int) -> int:
        """The size tier of a shard."""
        return max(0, math.floor(math.log(max(n_bytes, 1) / self.smallest, self.fanout)) + 1)

    def _shards(self, folder: str) -> DataFrame:
        """Manifest rows of the files of a folder just written."""
        sizes = [(f"{folder}/{n}", b) for n, b, _ in self._list(folder) if n.endswith(".parquet")]
        if not sizes:
            return self.spark.createDataFrame([], MANIFEST)
        counted = self.spark.read.parquet(*[f"{self.root}/{p}" for p, _ in sizes])
        counts = counted.groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count(F.lit(1)).alias("n_rows"))
        known = self.spark.createDataFrame([(p, p.rsplit("/", 1)[1], b, self.tier(b)) for p, b in sizes], "path string, name string, n_bytes long, tier int")
        return known.join(counts, "name").select("path", "n_rows", "n_bytes", "tier")

    def append(self, rows: DataFrame) -> int:
        """Adds an arrival: each of its partitions with rows becomes a small shard.  Returns the version."""
        known = self.versions()
        self._fits(known[-1] if known else None, rows.schema)  # before anything is written
        return self._publish(self._write(rows), rows.schema, [])

    def plan(self) -> list[list[str]]:
        """Runs of shards to merge: of a tier with ``fanout`` shards or more, up to the target size each."""
        tiers: dict[int, list[tuple[int, str]]] = {}
        for r in self.manifest().where(F.col("n_bytes") < self.target_bytes // 2).collect():  # one row per small file
            tiers.setdefault(r["tier"], []).append((r["n_bytes"], r["path"]))
        runs: list[list[str]] = []
        for shards in tiers.values():
            if len(shards) < self.fanout:
                continue
            run, held = [], 0
            for n, path in sorted(shards):
                if run and held + n > self.target_bytes:
                    runs.append(run)
                    run, held = [], 0
                run.append(path)
                held += n
            runs.append(run)
        return [r for r in runs if len(r) > 1]

    def compact(self) -> int | None:
        """Merges one round of runs and commits; None if there is nothing to merge.

        Every run becomes one file: a row's partition is its run, and a run has
        at most the target size.
        """
        runs = self.plan()
        if not runs:
            return None
        pairs = [(path.rsplit("/", 1)[1], k) for k, run in enumerate(runs) for path in run]
        plan = self.spark.createDataFrame(pairs, "__name string, __run int")
        schema = self.schema()
        rows = self.spark.read.schema(schema).parquet(*[f"{self.root}/{p}" for run in runs for p in run])
        columns = [F.col(f"`{c}`") for c in rows.columns]
        # Shard names are unique (Spark puts a job id in them); the plan has a row per file.
        plan = F.broadcast(plan) if len(pairs) <= BROADCAST_FILES else plan
        tagged = rows.select(*columns, F.col("_metadata.file_name").alias("__name")).join(plan, "__name").drop("__name")
        dealt = tagged.repartitionById(len(runs), F.col("__run")).drop("__run")
        return self._publish(self._write(dealt, maxRecordsPerFile=0), schema, [p for run in runs for p in run])

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version; an empty frame (without columns, if nothing was ever committed) where it has none."""
        schema = self.schema(version) or T.StructType()
        paths = [f"{self.root}/{r['path']}" for r in self.manifest(version).select("path").collect()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def vacuum(self, keep: int = 1) -> int:
        """Forgets all versions but the last ``keep``, and deletes the shards that none of these lists; returns how many.

        Folders are listed before the marks of writing, and these before the
        versions: a folder without a mark has been committed before, so what the
        versions then do not list is dead.  What is being written is left alone.
        """
        folders = [n for n, *_ in self._list("data")]
        drafts = [n for n, _, at in self._list("manifest") if at < time.time() - self.abandoned]
        marks = {n for n, _, at in self._list("writing") if at > time.time() - self.abandoned}
        versions = self.versions()
        live = {r["path"] for v in versions[-keep:] for r in self.manifest(v).select("path").collect()}
        for version in versions[:-keep]:
            manifest = self._pointer(version)["manifest"]
            self._delete(f"commit/v{version:09d}")
            self._delete(f"manifest/{manifest}")
        # Manifests that no version points to, of writers that died before their commit.
        named = {self._pointer(v)["manifest"] for v in versions[-keep:]} if drafts else set()
        for manifest in drafts:
            if manifest not in named:
                self._delete(f"manifest/{manifest}")
        gone = 0
        for folder in folders:
            if folder in marks:
                continue
            files = [n for n, *_ in self._list(f"data/{folder}") if n.endswith(".parquet")]
            dead = [n for n in files if f"data/{folder}/{n}" not in live]
            if len(dead) == len(files):
                self._delete(f"data/{folder}")
            else:
                for n in dead:
                    self._delete(f"data/{folder}/{n}")
            gone += len(dead)
        return gone
