"""Sequential admission per key, where each decision changes the next one's windows.

These cannot be window frames.  Spark deals events out by key and sorts them by
key and time; a task then streams through its keys, batch by batch, and holds
no more than the usage of one key that still counts.  A key's events are
replayed in one task, so ``keys`` should be as fine as the limits are (key and
model).  Events without a time are left out; a null number of tokens is 1.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

MINUTE, DAY = 60.0, 86_400.0


@dataclass(frozen=True)
class Limits:
    """Requests and tokens a minute, requests a day; 0 is no limit."""

    rpm: int = 0
    tpm: int = 0
    rpd: int = 0


class Windows:
    """Usage that still counts, in order of time."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.minute: deque[tuple[float, int]] = deque()  # (time, requests)
        self.day: deque[tuple[float, int]] = deque()
        self.tokens: deque[tuple[float, int]] = deque()
        self.sums = {"minute": 0, "day": 0, "tokens": 0}

    def add(self, name: str, at: float, n: int) -> None:
        getattr(self, name).append((at, n))
        self.sums[name] += n

    def expire(self, now: float, closed: bool) -> None:
        """Drops what is older than its window; what is exactly that old still counts if ``closed``."""
        for name, span in (("minute", MINUTE), ("tokens", MINUTE), ("day", DAY)):
            held = getattr(self, name)
            while held and (held[0][0] < now - span if closed else held[0][0] <= now - span):
                self.sums[name] -= held.popleft()[1]

    def _free_at(self, name: str, surplus: int, span: float) -> float:
        """When so much has left a window."""
        gone, at = 0, 0.0
        for at, n in getattr(self, name):
            gone += n
            if gone >= surplus:
                break
        return at + span

    def blocked(self, requests: int, tokens: int) -> list[tuple[str, float]]:
        """Limits that a request does not pass, and when each would let it."""
        out, lim = [], self.limits
        if lim.rpm and requests and self.sums["minute"] + 1 > lim.rpm:
            out.append(("rpm", self._free_at("minute", self.sums["minute"] - lim.rpm + 1, MINUTE)))
        if lim.tpm and self.sums["tokens"] and self.sums["tokens"] + tokens > lim.tpm:
            out.append(("tpm", self._free_at("tokens", self.sums["tokens"] + tokens - lim.tpm, MINUTE)))
        if lim.rpd and requests and self.sums["day"] + 1 > lim.rpd:
            out.append(("rpd", self._free_at("day", self.sums["day"] - lim.rpd + 1, DAY)))
        return out

    def take(self, at: float, requests: int, tokens: int) -> None:
        if requests:
            self.add("minute", at, requests)
            self.add("day", at, requests)
        self.add("tokens", at, tokens)


def grant_times(now: float, limits: Limits, history: Sequence[tuple[float, int]], requests: Sequence[tuple[str, int]]) -> dict[str, float]:
    """When each of the waiting requests (id, tokens) is granted, first in first out.

    A window's edge still counts, so a grant comes a millisecond after it.
    """
    windows, at, out = Windows(limits), now, {}
    for t, tokens in sorted(history):
        windows.add("minute", t, 1)
        windows.add("day", t, 1)
        if tokens:
            windows.add("tokens", t, tokens)
    for name, tokens in requests:
        tokens = max(1, tokens)
        windows.expire(at, closed=True)
        while blocked := windows.blocked(1, tokens):
            at = max(at + 0.001, *(t for _, t in blocked))
            windows.expire(at, closed=True)
        out[name] = at
        windows.take(at, 1, tokens)
    return out


Step = Callable[[float, int], tuple]


def replayed(events: DataFrame, keys: Sequence[str], order: str, ident: str, tokens: str | None, start: Callable[[], Step], results: Sequence[T.StructField]) -> DataFrame:
    """``keys, ident`` and what a key's step function, begun by ``start``, gives for each of its events in order."""
    number = F.lit(1) if tokens is None else F.greatest(F.coalesce(F.col(tokens).cast("long"), F.lit(0)), F.lit(1))
    narrow = events.where(F.col(order).isNotNull()).select(*keys, ident, F.col(order).cast("double").alias("__t"), number.cast("long").alias("__n"))
    schema = T.StructType([*narrow.schema.fields[: len(keys) + 1], *results])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, step = None, None
        for batch in batches:
            told = []
            columns = [c.to_pylist() for c in batch.columns]
            for key, t, n in zip(zip(*columns[: len(keys)], strict=True), *columns[-2:], strict=True):
                if step is None or key != here:
                    here, step = key, start()
                told.append(step(t, n))
            values = zip(*told, strict=True) if told else [()] * len(results)
            arrays = [pa.array(v, to_arrow_type(f.dataType)) for v, f in zip(values, results, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *arrays], names=schema.names)

    return narrow.repartition(*keys).sortWithinPartitions(*keys, "__t", ident).mapInArrow(run, schema)


def fifo_eta(requests: DataFrame, keys: Sequence[str], limits: Limits, order: str = "ts", ident: str = "id", tokens: str = "tokens") -> DataFrame:
    """``keys, id, granted_at, waits``: every request queued at its time, granted first in first out."""

    def start() -> Step:
        windows, now = Windows(limits), 0.0

        def step(t: float, n: int) -> tuple[float, float]:
            nonlocal now
            now = max(now, t)
            windows.expire(now, closed=True)
            while blocked := windows.blocked(1, n):
                now = max(now + 0.001, *(x for _, x in blocked))
                windows.expire(now, closed=True)
            windows.take(now, 1, n)
            return now, now - t

        return step

    results = [T.StructField("granted_at", T.DoubleType()), T.StructField("waits", T.DoubleType())]
    return replayed(requests, keys, order, ident, tokens, start, results)


def admission(events: DataFrame, keys: Sequence[str], limits: Limits, order: str = "ts", ident: str = "id", tokens: str = "tokens") -> DataFrame:
    """``keys, id, admitted, wait, reasons``: refused requests take nothing and are told how long to wait.

    Waits are 0.25 s at least (1 s if the day is used up) and have 0.05 s of slack.
    """

    def start() -> Step:
        windows = Windows(limits)

        def step(t: float, n: int) -> tuple[bool, float, str]:
            windows.expire(t, closed=False)
            blocked = windows.blocked(1, n)
            if not blocked:
                windows.take(t, 1, n)
                return True, 0.0, ""
            wait = max(max(1.0 if name == "rpd" else 0.25, free - t + 0.05) for name, free in blocked)
            return False, round(wait, 6), ",".join(name for name, _ in blocked)

        return step

    results = [T.StructField("admitted", T.BooleanType()), T.StructField("wait", T.DoubleType()), T.StructField("reasons", T.StringType())]
    return replayed(events, keys, order, ident, tokens, start, results)


def throttled(events: DataFrame, keys: Sequence[str], seconds: float, order: str = "ts", ident: str = "id") -> DataFrame:
    """``keys, id, picked``: an event is picked if the last picked one is ``seconds`` or more ago."""

    def start() -> Step:
        free = float("-inf")

        def step(t: float, _: int) -> tuple[bool]:
            nonlocal free
            picked = t >= free
            if picked:
                free = t + seconds
            return (picked,)

        return step

    return replayed(events, keys, order, ident, None, start, [T.StructField("picked", T.BooleanType())])


def blacklist(results: DataFrame, proxy: str, at: str, timed_out: str, strikes: int, seconds: float) -> DataFrame:
    """Time-outs in a row of each proxy: every ``strikes``-th bars it for ``seconds``; a success starts again."""
    order = Window.partitionBy(proxy).orderBy(at)
    island = F.sum(F.when(F.col(timed_out), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    counted = results.withColumn("island", island).where(F.col(timed_out))
    nth = F.row_number().over(Window.partitionBy(proxy, "island").orderBy(at))
    barred = counted.withColumn("strike", nth).where(F.col("strike") % strikes == 0)
    return barred.select(proxy, F.col(at).alias("barred_at"), (F.col(at) + F.lit(seconds)).alias("barred_until"))
