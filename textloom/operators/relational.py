"""Joins, set operations, deduplication, completeness and assignments over tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.shared import checkpointed


def missing_keys(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys expected but not there."""
    return expected.select(*keys).distinct().join(actual.select(*keys), list(keys), "left_anti")


def stale_entries(manifest: DataFrame, valid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Manifest rows whose key has become valid."""
    return manifest.join(valid.select(*keys), list(keys), "left_semi")


def pruned_manifest(manifest: DataFrame, valid: DataFrame, keys: Sequence[str], within: Column) -> DataFrame:
    """The manifest without the stale rows inside a range; rows outside it stay."""
    gone = valid.where(within).select(*keys)
    return manifest.join(gone, list(keys), "left_anti")


def upsert(manifest: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows replace those of their key."""
    return manifest.join(new.select(*keys), list(keys), "left_anti").unionByName(new)


def first_wins(layers: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Union of layers; of rows with one key the earliest layer's stays, then the first by ``order``."""
    tagged = [df.withColumn("layer", F.lit(i)) for i, df in enumerate(layers)]
    union = tagged[0]
    for df in tagged[1:]:
        union = union.unionByName(df)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("layer", *order))
    return union.withColumn("rank", rank).where("rank = 1").drop("rank")


def last_wins(layers: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Union of layers; of rows with one key the latest layer's stays."""
    return first_wins(list(reversed(layers)), keys).withColumn("layer", F.lit(len(layers) - 1) - F.col("layer"))


def first_success(candidates: DataFrame, keys: Sequence[str], rank: Sequence[str | Column], succeeded: Column) -> DataFrame:
    """The best-ranked candidate of each key that succeeded."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*rank))
    return candidates.where(succeeded).withColumn("place", place).where("place = 1").drop("place")


def latest_per_group(rows: DataFrame, keys: Sequence[str], newest: Sequence[Column], reason: str = "older_duplicate") -> DataFrame:
    """Every row with ``rank`` in its group, newest first, and ``verdict``: kept, or why it goes."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    return rows.withColumn("rank", place).withColumn("verdict", F.when(F.col("rank") == 1, "kept").otherwise(reason))


def zip_align(left: DataFrame, right: DataFrame, keys: Sequence[str], left_order: Sequence[str], right_order: Sequence[str]) -> DataFrame:
    """Rows of both sides paired by their place in each key, only where both have as many."""
    a = left.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*left_order)))
    b = right.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*right_order)))
    sizes = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_left")).join(b.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_right")), list(keys))
    equal = sizes.where("n_left = n_right").select(*keys)
    return a.join(b, [*keys, "place"]).join(equal, list(keys), "left_semi")


def modulo_assign(rows: DataFrame, index: str, proxies: Sequence[str], per_proxy: int) -> DataFrame:
    """A proxy for every index: the first goes direct, then blocks of ``per_proxy``, from the start again after two rounds one by one."""
    n = F.col(index) - 2
    block = F.floor(n / per_proxy).cast("int")
    full = len(proxies) * per_proxy
    slot = F.when(n < full, block).otherwise((n - full) % len(proxies)).cast("int")
    choice = F.get(F.array(*[F.lit(p) for p in proxies]), slot)
    return rows.withColumn("proxy", F.when(F.col(index) > 1, choice))


def completeness(expected: DataFrame, parts: DataFrame, keys: Sequence[str], part: str) -> DataFrame:
    """Per key: parts expected, parts there, and whether all are.

    Both sides are dealt out together before anything is kept of them, to as many
    tasks as shuffles have: a split of a table, or partitions put together for
    their few compressed bytes, would be millions of parts in the memory of one task.
    """
    names = [*keys, part]
    known = parts.select(*names).dropna(subset=names)  # a part without a key or a number is nobody's
    both = expected.select(*names, F.lit(1).alias("due"), F.lit(0).alias("there")).unionByName(known.withColumns({"due": F.lit(0), "there": F.lit(1)}))
    dealt = both.repartition(int(expected.sparkSession.conf.get("spark.sql.shuffle.partitions")), *names)
    met = dealt.groupBy(*names).agg(F.sum("due").alias("due"), F.max("there").alias("there")).where("due > 0")
    counted = met.groupBy(*keys).agg(F.sum("due").alias("n_expected"), F.sum(F.col("due") * F.col("there")).alias("n_there"))
    typed = [F.col(k).cast(expected.schema[k].dataType).alias(k) for k in keys]
    return counted.select(*typed, "n_expected", "n_there", (F.col("n_there") == F.col("n_expected")).alias("complete"))


def rebuilt(expected: DataFrame, parts: DataFrame, keys: Sequence[str], part: str, text: str, require_complete: bool = True) -> DataFrame:
    """The parts of each key put together in order; keys with gaps only without ``require_complete``."""
    joined = expected.join(parts, [*keys, part], "left")
    ordered = F.array_sort(F.collect_list(F.when(F.col(text).isNotNull(), F.struct(F.col(part), F.col(text).alias("x")))))
    out = joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_expected"), F.count(text).alias("n_there"), F.array_join(F.transform(ordered, lambda p: p["x"]), "\n").alias("text")
    )
    return out.where("n_there = n_expected") if require_complete else out.where("n_there > 0")


def needs_work(source: DataFrame, done: DataFrame, keys: Sequence[str], text_hash: str, stored_hash: str, pending: str) -> DataFrame:
    """Why a part has to be done: missing, changed, pending; a missing stored hash counts as unchanged."""
    joined = source.join(done.withColumn("there", F.lit(True)), list(keys), "left")
    reason = (
        F.when(F.col("there").isNull(), "missing")
        .when(F.col(stored_hash).isNotNull() & (F.col(stored_hash) != F.col(text_hash)), "changed")
        .when(F.coalesce(F.col(pending), F.lit(False)), "pending")
    )
    return joined.withColumn("reason", reason).where("reason is not null")


def closure(edges: DataFrame, child: str, parent: str, longest: int = 1 << 40) -> DataFrame:
    """``node, root, depth``: each child's last ancestor, by pointer doubling until no pointer moves.

    A child has one parent.  A cycle has no last ancestor: its pointers never
    settle, and their depth passes the number of edges, which raises an error.
    Each round is a checkpoint, so the plan does not grow with the depth.
    """
    up = edges.select(F.col(child).alias("node"), F.col(parent).alias("root"), F.lit(1).cast("long").alias("depth"))
    up = checkpointed(up)
    most = min(up.count(), longest)
    while True:
        more = up.select(F.col("node").alias("via"), F.col("root").alias("next"), F.col("depth").alias("more"))
        ahead = up.join(more, up["root"] == more["via"], "left")
        depth = (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
        up = checkpointed(ahead.select("node", F.coalesce("next", "root").alias("root"), depth, F.col("next").isNotNull().alias("moved")))
        moved, deepest = up.agg(F.count_if("moved"), F.max("depth")).first()
        if not moved:
            return up.drop("moved")
        if deepest > most:
            raise ValueError(f"{child} and {parent} form a cycle")
        up = up.drop("moved")


def top_excess(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], allowed: Column) -> DataFrame:
    """Rows beyond the ``allowed`` best of each key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("place", place).where(F.col("place") > allowed)


def reordered(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], current: str) -> DataFrame:
    """Desired place of each row, and whether it has to move."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return rows.withColumn("desired", place).withColumn("status", F.when(F.col("desired") == F.col(current), "ok").otherwise("move"))


def quota_costs(operations: DataFrame, costs: DataFrame, keys: Sequence[str], operation: str, budget: int, unit_cost: int) -> DataFrame:
    """Cost of each account's operations (pages of 50 items each), what is left, and uploads that still fit."""
    priced = operations.join(costs, operation, "left")
    units = F.ceil(F.greatest(F.col("items"), F.lit(1)) / 50) * F.coalesce("unit_cost", F.lit(1))
    spent = priced.groupBy(*keys).agg(F.sum(units).cast("long").alias("spent"))
    left = F.greatest(F.lit(budget) - F.col("spent"), F.lit(0))
    return spent.withColumn("remaining", left.cast("long")).withColumn("uploads_left", F.floor(F.col("remaining") / unit_cost).cast("long"))


def majority(votes: DataFrame, group: str, choice: str, order: str, least: int, share: float) -> DataFrame:
    """The choice that has at least ``least`` votes and ``share`` of its group's; of equals the first seen."""
    counted = votes.groupBy(group, choice).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    best = counted.groupBy(group).agg(
        F.max(F.struct("n", (-F.col("first")).alias("early"), F.col(choice).alias("choice"))).alias("b"), F.sum("n").alias("total")
    )
    return best.where((F.col("b.n") >= least) & (F.col("b.n") >= F.col("total") * F.lit(share))).select(
        group, F.col("b.choice").alias("dominant"), F.col("b.n").alias("votes"), "total"
    )
