"""Helpers shared by the corpus operators: shared storage, row keys, components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.shared import checkpointed, materialize, shared_dir

__all__ = ["WORD_PATTERN", "connected_components", "drop_path", "give_memory_back", "lean", "lean_group", "materialize", "shared_dir", "slices"]

#: Words are maximal runs of characters other than ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def slices(batch: pa.RecordBatch, texts: tuple[str, ...], size: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of whole rows, each with about ``size`` bytes in its text columns (or with one row)."""
    length = lambda c: pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sum(map(length, texts)))
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(at, to - at)
        at = to


Batches = Iterator[pa.RecordBatch]


def give_memory_back() -> None:
    """Gives what Arrow and the C library hold of freed memory back to the system (where it can be asked to)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A ``mapInArrow`` function that gives freed memory back at its end, as Spark uses workers again."""

    def wrapped(batches: Batches) -> Batches:
        yield from run(batches)
        give_memory_back()

    return wrapped


def lean_group(run: Callable[[pa.Table], pa.Table], size: int = 4 << 20) -> Callable[[pa.Table], pa.Table]:
    """The same for an ``applyInArrow`` function, after groups of so many bytes."""

    def wrapped(table: pa.Table) -> pa.Table:
        large = table.nbytes >= size
        out = run(table)
        if large:
            del table
            give_memory_back()
        return out

    return wrapped


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder with Hadoop's file API, wherever it lives."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _smallest(edges: DataFrame, keep_own: bool) -> DataFrame:
    """``(u, m)``: the smallest neighbour of u (or u itself, if smaller and kept).

    Written out, so that the joins on u below read two plain exchanges, which
    adaptive execution can split when one u is a hub.
    """
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    return checkpointed(low.select("u", F.least("u", "m").alias("m")) if keep_own else low)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph by alternating large-star and small-star.

    ``edges(src, dst)`` may hold either direction, repeats and self loops.
    Returns ``(node, component)`` for every node that appears, ``component``
    being the smallest node of its component.  A hub's edges are reduced by
    partial aggregation and by joins that may be split, never gathered.
    """
    both = edges.select(F.col("src").alias("u"), F.col("dst").alias("v"))
    pairs = checkpointed(
        both.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    previous = None
    for _ in range(max_rounds):
        # Large star: every neighbour larger than u is tied to u's smallest neighbour.
        sym = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _smallest(sym, True)
        larger = sym.where("v > u").join(low, "u")
        large = checkpointed(larger.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # Small star: u and its smaller neighbours are tied to the smallest of them.
        low = _smallest(large, False)
        tied = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = checkpointed(tied.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        state = tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == previous or not state[0]:
            break
        previous = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    found = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    nodes = both.select(F.col("u").alias("node")).union(both.select(F.col("v").alias("node"))).distinct()
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
