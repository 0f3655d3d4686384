"""Ids that drift from the numbers they stand for: change points, and numbers turned into ids.

A source numbers its entries, but pages are found by an id that notices and
repeats use up as well, so ``id - number`` is constant between change points.
Looking an id up is dear (a request, or a read of an indexed source); change
points are therefore searched for and not read off all ids.  Every round looks
up FAN ids inside each open interval of every source at once and keeps the
parts whose ends differ, so a round is one job and the number of rounds follows
the logarithm of the longest interval, however many sources and changes there
are.  All joins of a round are by source and grow with the sources, so none of
their sides goes through the driver as a broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.shared import materialize

from .ranges import asof

#: Ids looked up inside an interval in a round; as often doubled as none of them is known.
FAN = 8

#: Adds ``number`` to rows of keys and ``id``; null, or no row, where the id is not known.
Probe = Callable[[DataFrame], DataFrame]


def table_probe(numbered: DataFrame, keys: Sequence[str], id_: str = "id", number: str = "number") -> Probe:
    """Looks ids up in a table."""
    known = numbered.select(*keys, F.col(id_).cast("long").alias("id"), F.col(number).cast("long").alias("number")).where("number is not null")
    return lambda asked: asked.join(known.hint("merge"), [*keys, "id"])


def drift_segments(bounds: DataFrame, probe: Probe, keys: Sequence[str], low: str = "low", high: str = "high", fan: int = FAN) -> DataFrame:
    """``keys, start, diff``: from number ``start`` on, an id is the number plus ``diff``.

    ``bounds`` has the first and last id of each source; a source whose first or
    last id is not known has no segments, and before its first segment the
    difference is that of its first id.  An interval whose two ends agree is not
    searched, so a drift that is undone between two looked-up ids stays unseen;
    drifts that only grow are all found.  Of unknown ids beside a change the
    first known one behind it counts.
    """
    ends = F.array(F.col(low).cast("long"), F.col(high).cast("long"))
    asked = bounds.select(*keys, F.explode(F.array_distinct(ends)).alias("id"))
    known = probe(asked).where("number is not null").select(*keys, "id", (F.col("id") - F.col("number")).alias("diff"))
    both = known.groupBy(*keys).agg(F.min(F.struct("id", "diff")).alias("a"), F.max(F.struct("id", "diff")).alias("b"))
    whole = bounds.join(both.hint("merge"), list(keys)).where((F.col("a.id") == F.col(low)) & (F.col("b.id") == F.col(high)))
    open_ = materialize(whole.where("a.diff <> b.diff").select(*keys, "a", "b", F.lit(fan).alias("fan")))
    found = None
    while not open_.isEmpty():
        step = F.greatest(F.lit(1), F.ceil((F.col("b.id") - F.col("a.id") - 1) / F.col("fan"))).cast("long")
        cut = open_.withColumn("step", step)
        points = F.when(F.col("b.id") - F.col("a.id") > 1, F.sequence(F.col("a.id") + 1, F.col("b.id") - 1, F.col("step"))).otherwise(F.array().cast("array<bigint>"))
        asked = cut.select(*keys, F.explode(points).alias("id")).distinct()
        looked = probe(asked).where("number is not null").select(*keys, "id", (F.col("id") - F.col("number")).alias("diff"))
        # Intervals of a source share no inner id: what was looked up goes back to its interval.
        inner = cut.select(*keys, "a", F.explode_outer(points).alias("id")).join(looked.hint("merge"), [*keys, "id"], "left")
        seen = inner.groupBy(*keys, "a").agg(F.array_sort(F.collect_list(F.when(F.col("diff").isNotNull(), F.struct("id", "diff")))).alias("seen"))
        cut = cut.join(seen.hint("merge"), [*keys, "a"])
        chain = F.concat(F.array("a"), "seen", F.array("b"))
        parts = F.transform(F.sequence(F.lit(1), F.size("seen") + 1), lambda i: F.struct(F.element_at(chain, i).alias("a"), F.element_at(chain, i + 1).alias("b")))
        wider = F.when(F.size("seen") == 0, F.col("fan") * 2).otherwise(F.lit(fan)).alias("fan")
        split = cut.select(*keys, F.explode(F.filter(parts, lambda p: p["a"]["diff"] != p["b"]["diff"])).alias("p"), wider, (F.col("step") == 1).alias("all"))
        split = materialize(split.select(*keys, "p.a", "p.b", "fan", (F.col("all") | (F.col("p.b.id") - F.col("p.a.id") == 1)).alias("done")))
        ended = split.where("done").select(*keys, (F.col("b.id") - F.col("b.diff")).alias("start"), F.col("b.diff").alias("diff"))
        found = ended if found is None else found.union(ended)
        open_ = split.where("not done").drop("done")
    first = whole.where("a.diff <> 0").select(*keys, (F.col("a.id") - F.col("a.diff")).alias("start"), F.col("a.diff").alias("diff"))
    return first if found is None else found.union(first)


def numbers_to_ids(numbers: DataFrame, segments: DataFrame, keys: Sequence[str], number: str = "number", block: int = 0) -> DataFrame:
    """Adds ``id``: the number plus the difference of its segment, or the number itself before all segments."""
    found = asof(numbers, segments, keys, number, "start", "diff", block)
    return found.withColumn("id", F.col(number) + F.coalesce("diff", F.lit(0))).drop("diff")


def corrected_id(url: Column, name: str, expected: Column, actual: Column) -> Column:
    """An address whose id parameter is moved by what a page's number was off by; null where that is nothing, or no id."""
    here = F.try_parse_url(url, F.lit("QUERY"), F.lit(name)).try_cast("long")
    moved = here + expected.cast("long") - actual.cast("long")
    return F.when((expected != actual) & (moved > 0), F.regexp_replace(url, F.lit(rf"([?&]{name}=)\d+"), F.concat(F.lit("$1"), moved.cast("string"))))
