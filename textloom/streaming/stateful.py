"""Operators with state of their own: lists of packed rows, timers on event time, and state that goes when the watermark has passed it.

They need the RocksDB state store (``rocksdb_state``).  Results come when the
watermark lets them be final, in append mode, so they depend neither on the
order of arrival within the watermark nor on how arrivals fall into batches.

Every call of a processor and every value of its state is a round trip between
the JVM and Python that costs far more than a row, so a value of a list holds
up to PACKED rows, and rows of many small keys are held and told together.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import repeat
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from textloom.operators.replay import DAY, Limits, Windows

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"

#: Rows in one value of a list of packed rows, and in one frame of results.
PACKED = 10_000

#: Buckets that small keys are held in; a key lies in one, and a checkpoint keeps to the number it began with.
BUCKETS = 1024


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def _named(timed: DataFrame, at: str, ident: str) -> DataFrame:
    """Rows with an ident and a time.

    One expression over the time, as Spark pushes filters on other columns below
    the watermark, which then would not see the rows that only move it.
    """
    return timed.where(F.when(F.col(at).isNotNull(), F.col(ident).isNotNull()).otherwise(False))


def _pack(rows: pa.Table) -> Iterator[tuple[bytes]]:
    """Values of a list of packed rows."""
    for batch in rows.combine_chunks().to_batches(max_chunksize=PACKED):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as out:
            out.write_batch(batch)
        yield (sink.getvalue().to_pybytes(),)


def _packed(frame: pd.DataFrame, schema: pa.Schema) -> list[tuple[bytes]]:
    return list(_pack(pa.Table.from_pandas(frame, schema, preserve_index=False)))


def _unpacked(values: Iterator[tuple[bytes]], schema: pa.Schema) -> pa.Table:
    return pa.concat_tables([schema.empty_table(), *(pa.ipc.open_stream(bytes(v)).read_all() for (v,) in values)])


class BurstProcessor(StatefulProcessor):
    """Holds the events of a block of time until the watermark has passed it, then counts what ends at each and forgets them."""

    def __init__(self, micros: int, block: int, least: int, least_members: int):
        self.micros, self.block, self.least, self.least_members = micros, block, least, least_members

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", "rows binary")
        self.schema = pa.schema([("us", pa.int64()), ("member", pa.string()), ("ident", pa.int64()), ("own", pa.bool_())])

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            self.events.appendList(_packed(pdf, self.schema))
        self.handle.registerTimer((key[0] + 1) * self.block // 1000)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        held = _unpacked(self.events.get(), self.schema).sort_by("us")
        self.events.clear()
        at = held["us"].to_numpy()
        member = held["member"].to_pylist()
        first, behind = np.searchsorted(at, at - self.micros), np.searchsorted(at, at, "right")
        members: Counter[str | None] = Counter()
        out, a, b = [], 0, 0
        for ident, own, low, high in zip(held["ident"].to_pylist(), held["own"].to_pylist(), first.tolist(), behind.tolist(), strict=True):
            while b < high:
                members[member[b]] += 1
                b += 1
            while a < low:
                gone = member[a]
                members[gone] -= 1
                if not members[gone]:
                    del members[gone]
                a += 1
            if own and high - low >= self.least and len(members) - (None in members) >= self.least_members:
                out.append((ident, high - low, len(members) - (None in members)))
        yield pd.DataFrame(out, columns=["ident", "n_events", "n_members"]).astype({"ident": "int64", "n_events": "int32", "n_members": "int32"})

    def close(self) -> None:
        pass


def bursts(events: DataFrame, at: str, member: str, ident: str, seconds: int, least: int, least_members: int, late: str = "1 minute", blocks: int = 4) -> DataFrame:
    """``ident, n_events, n_members`` of events that end a burst: enough events of enough different members in the ``seconds`` up to each.

    Time is cut into blocks of ``blocks`` times that length; a block's state
    holds its events and those of the last ``seconds`` before it, so an event
    goes to two blocks at most, and blocks are keys of their own.  A block is
    told once the watermark has passed its end.  Events without an ident or a
    time only move the watermark; null members are no member.
    """
    micros, block = seconds * 1_000_000, seconds * blocks * 1_000_000
    timed = _named(events.withWatermark(at, late), at, ident)
    us = F.unix_micros(F.col(at))
    own = F.floor(us / block)
    keyed = timed.select(at, us.alias("us"), F.col(member).cast("string").alias("member"), F.col(ident).cast("long").alias("ident"), own.alias("home"))
    keyed = keyed.withColumn("block", F.explode(F.array_distinct(F.array("home", F.floor((F.col("us") + micros) / block)))))
    keyed = keyed.withColumn("own", F.col("home") == F.col("block")).drop("home")
    found = keyed.groupBy("block").transformWithStateInPandas(
        BurstProcessor(micros, block, least, least_members), "ident long, n_events int, n_members int", "append", "EventTime"
    )
    return found.withColumnRenamed("ident", ident)


class AdmissionProcessor(StatefulProcessor):
    """Lets events wait until the watermark has passed them, then decides them in order; usage that no longer counts goes.

    Spark's key is a bucket of keys.  Their events and grants lie in lists of
    packed rows, and all of the bucket's events that the watermark has passed
    are decided in one call, sorted by key and time.
    """

    def __init__(self, limits: Limits, keys: list[str]):
        self.limits, self.keys = limits, keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.granted = handle.getListState("granted", "rows binary")
        self.names = [f"key{i}" for i in range(len(self.keys))]
        keyed = [(k, pa.string()) for k in self.names]
        self.events = pa.schema([*keyed, ("t", pa.float64()), ("ident", pa.int64()), ("n", pa.int64())])
        self.grants = pa.schema([*keyed, ("t", pa.float64()), ("n", pa.int64())])
        self.told: dict[Any, float] = {}  # the watermark up to which this task has told a bucket

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        last = None
        for pdf in rows:
            self.waiting.appendList(_packed(pdf, self.events))
            here = float(pdf["t"].max())
            last = here if last is None else max(last, here)
        if last is not None:
            self.handle.registerTimer(int(last * 1000) + 1)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() / 1000
        if self.told.get(key) == passed:  # by an earlier timer of the same bucket
            return
        self.told[key] = passed
        every = _unpacked(self.waiting.get(), self.events)
        early = pc.less(every["t"], passed)
        ready = every.filter(early).sort_by([(c, "ascending") for c in self.events.names])
        self._put(self.waiting, every.filter(pc.invert(early)))
        usage: dict[tuple, list[tuple[float, int]]] = {}
        for *k, t, n in zip(*(c.to_pylist() for c in _unpacked(self.granted.get(), self.grants).columns), strict=True):
            usage.setdefault(tuple(k), []).append((t, n))
        yield from self._decided(ready, usage, passed)
        left = [(*k, t, n) for k, grants in usage.items() for t, n in grants if t > passed - DAY]
        columns = zip(*left, strict=True) if left else repeat(())
        self._put(self.granted, pa.table([pa.array(v, f.type) for v, f in zip(columns, self.grants)], schema=self.grants))
        if left:
            self.handle.registerTimer(int((max(g[-2] for g in left) + DAY) * 1000) + 1)

    @staticmethod
    def _put(state: Any, rows: pa.Table) -> None:
        state.put(list(_pack(rows))) if rows.num_rows else state.clear()

    def _decided(self, ready: pa.Table, usage: dict[tuple, list[tuple[float, int]]], passed: float) -> Iterator[pd.DataFrame]:
        """Decides events that are sorted by key and time, and leaves in ``usage`` what their keys have then used."""
        here, windows = None, None
        for batch in ready.combine_chunks().to_batches(max_chunksize=PACKED):
            *columns, times, idents, sizes = (c.to_pylist() for c in batch.columns)
            admitted, reasons = [], []
            for key, t, n in zip(zip(*columns, strict=True), times, sizes, strict=True):
                if windows is None or key != here:
                    if windows is not None:
                        usage[here] = self._grants(windows, passed)
                    here, windows = key, Windows(self.limits)
                    for grant, taken in usage.get(key, ()):
                        windows.take(grant, 1, taken)
                windows.expire(t, closed=False)
                blocked = windows.blocked(1, n)
                if not blocked:
                    windows.take(t, 1, n)
                admitted.append(not blocked)
                reasons.append(",".join(name for name, _ in blocked))
            yield pd.DataFrame({**dict(zip(self.keys, columns, strict=True)), "ident": idents, "admitted": admitted, "reasons": reasons})
        if windows is not None:
            usage[here] = self._grants(windows, passed)

    @staticmethod
    def _grants(windows: Windows, passed: float) -> list[tuple[float, int]]:
        """Grants that may still count: those of a day before the watermark, with tokens where these are of the last minute."""
        day, recent = [t for t, _ in windows.day], [n for _, n in windows.tokens]
        sizes = [0] * (len(day) - len(recent)) + recent
        return [(t, n) for t, n in zip(day, sizes, strict=True) if t > passed - DAY]

    def close(self) -> None:
        pass


def admission(
    events: DataFrame, keys: list[str], limits: Limits, at: str, ident: str, tokens: str, late: str = "2 minutes", buckets: int = BUCKETS
) -> DataFrame:
    """``keys, ident, admitted, reasons`` of every event, in the order of their times.

    State is the events that the watermark has not passed and the grants of the
    last day, for each of ``buckets`` buckets of keys; keys that have been idle
    for a day have none once their bucket is told again, and a bucket that has
    been idle for a day has none.  A key's events are decided by one task, as
    they follow from each other, so ``keys`` should be as fine as the limits
    are.  Events without a time or an ident only move the watermark.
    """
    timed = _named(events.withWatermark(at, late), at, ident)
    rows = timed.select(
        *[F.col(k).cast("string").alias(f"key{i}") for i, k in enumerate(keys)],
        at,
        (F.unix_micros(F.col(at)) / 1e6).alias("t"),
        F.col(ident).cast("long").alias("ident"),
        F.greatest(F.coalesce(F.col(tokens).cast("long"), F.lit(1)), F.lit(1)).alias("n"),
    )
    held = rows.withColumn("bucket", F.pmod(F.hash(*[f"key{i}" for i in range(len(keys))]), F.lit(buckets)))
    output = ", ".join([*(f"{k} string" for k in keys), "ident long, admitted boolean, reasons string"])
    return held.groupBy("bucket").transformWithStateInPandas(AdmissionProcessor(limits, keys), output, "append", "EventTime").withColumnRenamed("ident", "id")
