"""State of a stream as a table: what is known of each key, kept as deltas by key bucket that are merged now and then.

A micro-batch writes one delta: the newest of its own rows for each key, in
files by bucket of the key.  A manifest for each version lists what every bucket
is read from: a base and the deltas since.  A bucket is merged into a new base
once its deltas hold as many rows as half its base, or are MOST_DELTAS; so what a
batch writes follows the batch, and a row is rewritten a bounded number of times
for each doubling of its bucket.

A version counts once its manifest is there, which is written last.  A batch that
is run again after a failure starts from the manifest before its own and
overwrites what it had written.  Files that neither of the last two manifests
lists are deleted.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Buckets of a new state, and deltas that a bucket is read from at most.
BUCKETS, MOST_DELTAS = 16, 32


class _Files:
    """The few file operations, through Hadoop's file system."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm, self.folder = spark.sparkContext._jvm, folder
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}".rstrip("/"))

    def names(self, name: str) -> list[str]:
        folder = self.path(name)
        return [s.getPath().getName() for s in self.fs.listStatus(folder)] if self.fs.exists(folder) else []

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        text = bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        stream.close()
        return text

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _manifest(files: _Files, before: int | None = None) -> dict | None:
    """The newest manifest (older than ``before``): ``buckets``, ``keys``, ``newest``, and by bucket its parts as (folder, rows), the base first."""
    known = sorted(int(n[1:]) for n in files.names("manifest") if n.startswith("v") and (before is None or int(n[1:]) < before))
    return json.loads(files.read(f"manifest/v{known[-1]:09d}")) if known else None


def _newest(rows: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), newest).alias("__row"))
    return latest.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*rows.columns)


def _parts(spark: SparkSession, folder: str, known: dict, buckets: Sequence[str] | None = None) -> DataFrame | None:
    paths = [f"{folder}/{p}" for b, parts in known["parts"].items() if buckets is None or b in buckets for p, _ in parts]
    return spark.read.schema(known["schema"]).parquet(*paths) if paths else None


def load_state(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame | None:
    """The newest version (older than ``before``); None of a state that nothing was written to."""
    known = _manifest(_Files(spark, folder), before)
    if known is None:
        return None
    rows = _parts(spark, folder, known)
    return spark.createDataFrame([], known["schema"]) if rows is None else _newest(rows, known["keys"], known["newest"])


def _written(rows: DataFrame, keys: Sequence[str], folder: str, buckets: int) -> dict[str, int]:
    """Writes rows by bucket of their keys; the rows of each bucket."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    placed = rows.withColumn("__bucket", bucket)
    placed.repartition("__bucket").write.mode("overwrite").partitionBy("__bucket").parquet(folder)
    back = rows.sparkSession.read.schema("__bucket int").parquet(folder)
    return {str(r[0]): r[1] for r in back.groupBy("__bucket").count().collect()}  # a row for each bucket


def save_state(rows: DataFrame, keys: Sequence[str], newest: str, folder: str, version: int, buckets: int = BUCKETS) -> None:
    """Writes a version: of the old state and ``rows`` the row of each key that is newest by ``newest``."""
    spark, files = rows.sparkSession, _Files(rows.sparkSession, folder)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    known = _manifest(files, version) or {"buckets": buckets, "keys": list(keys), "newest": newest, "schema": schema, "parts": {}}
    if known["schema"] != schema or known["keys"] != list(keys):
        raise ValueError(f"the state has other columns: {known['schema']}")
    name = f"data/v{version:09d}"
    parts = {b: list(p) for b, p in known["parts"].items()}
    for b, n in _written(_newest(rows, keys, newest), keys, f"{folder}/{name}-delta", known["buckets"]).items():
        parts.setdefault(b, []).append([f"{name}-delta/__bucket={b}", n])
    full = lambda p: len(p) > 1 and (2 * sum(n for _, n in p[1:]) >= p[0][1] or len(p) > MOST_DELTAS)
    due = [b for b, p in parts.items() if full(p)]
    if due:
        merged = _newest(_parts(spark, folder, known | {"parts": parts}, due), keys, newest)
        for b, n in _written(merged, keys, f"{folder}/{name}-base", known["buckets"]).items():
            parts[b] = [[f"{name}-base/__bucket={b}", n]]
    last = _manifest(files, version)
    files.write(f"manifest/v{version:09d}", json.dumps(known | {"parts": parts}))
    live = {p for m in (last, {"parts": parts}) if m for ps in m["parts"].values() for p, _ in ps}
    for folder_name in files.names("data"):
        inner = [n for n in files.names(f"data/{folder_name}") if n.startswith("__bucket=")]
        dead = [n for n in inner if f"data/{folder_name}/{n}" not in live]
        if len(dead) == len(inner):
            files.delete(f"data/{folder_name}")
        else:
            for n in dead:
                files.delete(f"data/{folder_name}/{n}")
    for old in sorted(files.names("manifest"))[:-2]:
        if old.startswith("v"):
            files.delete(f"manifest/{old}")


def keep_state(stream: DataFrame, keys: Sequence[str], newest: str, folder: str, checkpoint: str) -> StreamingQuery:
    """Keeps the state in ``folder`` up to date with what has arrived, then stops; a restart goes on after the last batch."""
    return stream.writeStream.foreachBatch(lambda batch, number: save_state(batch, keys, newest, folder, number)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
