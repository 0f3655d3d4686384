"""Intervals: overlap joins by hierarchical bins, look-ups, as-of joins and aligned schedules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlapping(rows: DataFrame, start: str, end: str, low: int | None, high: int | None) -> DataFrame:
    """Rows whose closed interval meets [low, high]; unknown bounds always do."""
    found = F.lit(True)
    if low is not None:
        found = found & (F.col(end).isNull() | (F.col(end) >= low))
    if high is not None:
        found = found & (F.col(start).isNull() | (F.col(start) <= high))
    return rows.where(found)


#: Bins of a level in one of the next, as a power of two, and what is added to a point so that 0 is inside a bin at every level.
_FAN_BITS, _SHIFT = 2, 0x1555555555555555


def _bin(point: Column, level: Column, bits: int) -> Column:
    """The bin of ``2 ** (bits + _FAN_BITS * level)`` that holds a point."""
    return F.call_function("shiftright", F.floor(point).cast("long") + _SHIFT, bits + _FAN_BITS * level)


def binned(rows: DataFrame, start: Column, end: Column, width: int) -> DataFrame:
    """Adds ``level`` and ``bin``: the smallest bin that holds the whole closed interval.

    Level 0 has bins of about ``width``, and each further level bins of four of
    the last.  Intervals that are empty or have a null end are left out.
    """
    bits = max(1, round(width)).bit_length() - 1
    last = (62 - bits + _FAN_BITS - 1) // _FAN_BITS
    same = lambda k: _bin(start, k, bits) == _bin(end, k, bits)
    level = F.get(F.filter(F.sequence(F.lit(0), F.lit(last)), same), F.lit(0))
    return rows.where(start <= end).withColumn("level", level).withColumn("bin", _bin(start, F.col("level"), bits))


def _levels(binned_rows: DataFrame) -> list[int]:
    return sorted(r[0] for r in binned_rows.select("level").distinct().collect())  # 31 at most


def _above(binned_rows: DataFrame, levels: list[int], start: str, width: int, own: bool) -> DataFrame:
    """A row for each bin above an interval's own (or from its own on) at the given levels."""
    bits = max(1, round(width)).bit_length() - 1
    higher = (lambda k: k >= F.col("level")) if own else (lambda k: k > F.col("level"))
    at = F.explode(F.filter(F.array(*map(F.lit, levels)).cast("array<int>"), higher)).alias("__level")
    rows = binned_rows.select("*", at)
    return rows.withColumn("bin", _bin(F.col(start), F.col("__level"), bits)).withColumn("level", F.col("__level")).drop("__level")


def overlap_join(left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str], width: int, keys: Sequence[str] = ()) -> DataFrame:
    """Pairs whose closed intervals meet, as equi-joins on hierarchical bins.

    An interval lies in the smallest bin that holds it.  Bins are nested, so of
    two intervals that meet one's bin holds the other's: an interval looks into
    its own bin and those above it, at levels that the other side has at all.  A
    span over everything is therefore one row on its own side and a handful
    when it looks, not one for each bucket that it covers.  ``width`` should be
    about the usual length of a short interval.
    """
    (a, b), (c, d) = left_span, right_span
    x, y = binned(left, F.col(a), F.col(b), width), binned(right, F.col(c), F.col(d), width)
    meet = (F.col(a) <= F.col(d)) & (F.col(c) <= F.col(b))
    up = _above(x, _levels(y), a, width, True).join(y, [*keys, "level", "bin"]).where(meet)
    down = x.join(_above(y, _levels(x), c, width, False), [*keys, "level", "bin"]).where(meet)
    return up.drop("level", "bin").unionByName(down.drop("level", "bin"))


def rule_lookup(rows: DataFrame, point: str, rules: DataFrame, value: str, default: Column, width: int = 64) -> DataFrame:
    """The value of the rule (``start, end``, never overlapping) that holds a point, else the default.

    Rules lie in the smallest bin that holds them; a point looks into the bins
    above it at the levels that rules have, and takes what it finds at most once.
    """
    bits = max(1, round(width)).bit_length() - 1
    spans = binned(rules, F.col("start"), F.col("end"), width)
    spans = spans.select("level", "bin", F.col("start").alias("rule_start"), F.col("end").alias("rule_end"), F.col(value).alias("rule_value"))
    out = rows.withColumn("rule_value", F.lit(None).cast(rules.schema[value].dataType))
    for level in _levels(spans):  # one look-up join for each level, so rows are never multiplied
        here = spans.where(F.col("level") == level).select("bin", "rule_start", "rule_end", F.col("rule_value").alias("__found"))
        inside = (_bin(F.col(point), F.lit(level), bits) == F.col("bin")) & F.col(point).between(F.col("rule_start"), F.col("rule_end"))
        out = out.join(here, inside, "left").withColumn("rule_value", F.coalesce("rule_value", "__found")).drop("bin", "rule_start", "rule_end", "__found")
    return out.withColumn(value, F.coalesce("rule_value", default)).drop("rule_value")


def asof(rows: DataFrame, segments: DataFrame, keys: Sequence[str], at: str, start: str, value: str, block: int = 0) -> DataFrame:
    """The value of the last segment that starts at or before each row, within its keys.

    One sort by key and time over the union of both sides.  With ``block``, time
    is cut into blocks that are sorted apart, each beginning with the value that
    holds at its start, so that a key with very many rows is many tasks.
    """
    names = rows.columns
    a = rows.select(*names, F.col(at).alias("t"), F.lit(1).alias("side"), F.lit(None).cast(segments.schema[value].dataType).alias("v"))
    empty = [F.lit(None).cast(rows.schema[c].dataType).alias(c) if c not in keys else F.col(c) for c in names]
    b = segments.select(*empty, F.col(start).alias("t"), F.lit(0).alias("side"), F.col(value).alias("v"))
    both = a.unionByName(b)
    if not block:
        order = Window.partitionBy(*keys).orderBy("t", "side").rowsBetween(Window.unboundedPreceding, 0)
        return both.withColumn(value, F.last("v", ignorenulls=True).over(order)).where("side = 1").drop("t", "side", "v")
    both = both.withColumn("b", F.floor(F.col("t") / block))
    order = Window.partitionBy(*keys, "b").orderBy("t", "side").rowsBetween(Window.unboundedPreceding, 0)
    last = both.where("side = 0").groupBy(*keys, "b").agg(F.max_by("v", "t").alias("held"))
    blocks = both.select(*keys, "b").distinct().join(last, [*keys, "b"], "left")
    before = Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.withColumn("carried", F.last("held", ignorenulls=True).over(before)).drop("held")
    inner = both.withColumn("inner", F.last("v", ignorenulls=True).over(order)).where("side = 1")
    return inner.join(carried, [*keys, "b"], "left").withColumn(value, F.coalesce("inner", "carried")).drop("t", "side", "v", "b", "inner", "carried")


@dataclass(frozen=True)
class BatchRule:
    """Batches of ``size`` numbers from ``start`` on, up to ``end``."""

    start: int
    end: int
    size: int


def _batch_of(number: Column, rules: Sequence[BatchRule], default: int) -> tuple[Column, Column]:
    """Start and end of the batch that holds a number: aligned to its rule, else to 1."""
    start = F.floor((number - 1) / default) * default + 1
    end = start + default - 1
    for r in rules:
        inside, first = number.between(r.start, r.end), F.floor((number - r.start) / r.size) * r.size + r.start
        start = F.when(inside, first).otherwise(start)
        end = F.when(inside, F.least(F.lit(r.end), first + r.size - 1)).otherwise(end)
    return start, end


def _batches_before(number: Column, rules: Sequence[BatchRule], default: int) -> Column:
    """Batches that begin before a number: rules and the gaps between them are segments of their own."""
    segments, at = [], 1
    for r in sorted(rules, key=lambda r: r.start):
        if r.start > at:
            segments.append(BatchRule(at, r.start - 1, default))
        segments.append(r)
        at = max(at, r.end + 1)
    total = F.lit(0)
    for s in segments:
        total = total + F.when(number > s.start, F.floor((F.least(F.lit(s.end), number - 1) - s.start) / s.size) + 1).otherwise(0)
    return total + F.when(number > at, F.floor((number - 1 - at) / default) + 1).otherwise(0)


def batch_schedule(rows: DataFrame, low: str, high: str, rules: Sequence[BatchRule], default: int) -> DataFrame:
    """The batches that a walk over each row's [low, high] meets: ``start``, ``end`` and ``episode``.

    The walk goes on after the end of each batch, so a batch that reaches past
    its neighbour's start hides it.  Episodes count batches from 1.
    """
    empty = F.array().cast("array<struct<s:bigint,e:bigint>>")

    def step(acc: Column, number: Column) -> Column:
        s, e = _batch_of(number, rules, default)
        more = F.struct((e + 1).cast("long").alias("next"), F.concat(acc["out"], F.array(F.struct(s.cast("long").alias("s"), e.cast("long").alias("e")))).alias("out"))
        return F.when(number < acc["next"], acc).otherwise(more)

    numbers = F.sequence(F.least(low, high).cast("long"), F.greatest(low, high).cast("long"))
    walk = F.aggregate(numbers, F.struct(F.lit(0).cast("long").alias("next"), empty.alias("out")), step, lambda acc: acc["out"])
    met = rows.withColumn("batch", F.explode(walk))
    return (
        met.withColumn("start", F.col("batch.s"))
        .withColumn("end", F.col("batch.e"))
        .withColumn("episode", (_batches_before(F.col("batch.s"), rules, default) + 1).cast("long"))
        .drop("batch")
    )


def fixed_ranges(rows: DataFrame, number: str, size: int) -> DataFrame:
    """Start and end of the aligned range of ``size`` that holds each number."""
    start = (F.floor((F.col(number) - 1) / size) * size + 1).cast("long")
    return rows.withColumn("range_start", start).withColumn("range_end", start + size - 1)
