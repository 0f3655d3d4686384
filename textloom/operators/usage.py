"""Usage of keys and models over time: rolling windows, two-phase quotas, bursts, throughput, queues.

All functions take event time as a number (spans in its unit) and ``now`` as
a parameter; none reads the clock.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rolling_usage(events: DataFrame, keys: Sequence[str], at: str, tokens: str, seconds: int, closed: bool = True) -> DataFrame:
    """Requests and tokens in the window that ends at each event.

    ``closed`` counts an event exactly ``seconds`` ago (a snapshot); without it
    that event has just left (an admission test).
    """
    order = Window.partitionBy(*keys).orderBy(at)
    window = order.rangeBetween(-seconds, 0)
    n, t = F.count(F.lit(1)).over(window), F.sum(tokens).over(window)
    if not closed:
        edge = order.rangeBetween(-seconds, -seconds)
        n, t = n - F.count(F.lit(1)).over(edge), t - F.coalesce(F.sum(tokens).over(edge), F.lit(0))
    return events.withColumn("requests", n).withColumn("used_tokens", t)


def usage_at(events: DataFrame, keys: Sequence[str], at: str, tokens: str, now: Column, seconds: int) -> DataFrame:
    """Requests and tokens of each key in the closed window that ends now."""
    live = events.where((F.col(at) >= now - seconds) & (F.col(at) <= now))
    return live.groupBy(*keys).agg(F.count(F.lit(1)).alias("requests"), F.sum(tokens).alias("used_tokens"))


def two_phase(grants: DataFrame, commits: DataFrame, key: str, keys: Sequence[str]) -> DataFrame:
    """Reserved and committed usage: a grant holds its estimate until its commit, a success then its real tokens."""
    joined = grants.join(commits, key, "left")
    done = F.col("committed_at").isNotNull()
    held = F.when(~done, F.col("estimate")).when(F.col("success"), F.col("tokens")).otherwise(0)
    return joined.select(
        *keys, key, F.coalesce("committed_at", "granted_at").alias("effective_at"), F.when(done, "locked").otherwise("freezed").alias("phase"), held.alias("tokens")
    )


def fallback_metric(counts: DataFrame, keys: Sequence[str], metric: str, order: Sequence[str]) -> DataFrame:
    """For each key the metric that comes first in ``order``."""
    rank = F.array_position(F.array(*[F.lit(m) for m in order]), F.col(metric))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("rank"))
    return counts.withColumn("rank", rank).where("rank > 0").withColumn("place", place).where("place = 1").drop("rank", "place")


def bursts(events: DataFrame, at: str, member: str, seconds: int, least: int, least_members: int, block: int, keys: Sequence[str] = ()) -> DataFrame:
    """Events that end a window with enough events of enough different members; times are whole numbers.

    Time is cut into blocks of ``block`` (``seconds`` at least), which are
    counted apart; an event near the end of a block is also seen by the next.
    A member counts from each of its events until the window has left it or its
    next event takes over, so different members are a running sum of comings
    and goings, and no set is built for any row.
    """
    own = F.floor(F.col(at) / block)
    seen = events.withColumn("block", F.explode(F.array_distinct(F.array(own, F.floor((F.col(at) + seconds) / block)))))
    counted = seen.withColumn("n_events", F.count(F.lit(1)).over(Window.partitionBy(*keys, "block").orderBy(at).rangeBetween(-seconds, 0)))
    after = F.lead(at).over(Window.partitionBy(*keys, "block", member).orderBy(at))
    counted = counted.withColumn("__end", F.when(after - F.col(at) <= seconds, after).otherwise(F.col(at) + seconds + 1))
    here = F.col(member).isNotNull().cast("int")
    moves = F.array(
        F.struct(F.col(at).alias("t"), here.alias("sign"), F.lit(True).alias("event")), F.struct(F.col("__end").alias("t"), (-here).alias("sign"), F.lit(False).alias("event"))
    )
    moving = counted.withColumn("__move", F.explode(moves)).withColumn("__t", F.col("__move.t"))
    running = F.sum("__move.sign").over(Window.partitionBy(*keys, "block").orderBy("__t").rangeBetween(Window.unboundedPreceding, 0))
    told = moving.withColumn("n_members", running.cast("int")).where((F.col("block") == own) & F.col("__move.event"))
    return told.where((F.col("n_events") >= least) & (F.col("n_members") >= least_members)).drop("block", "__end", "__move", "__t")


def escalation(hits: DataFrame, keys: Sequence[str], at: str, first: float = 8.0, most: float = 180.0) -> DataFrame:
    """Length of the ban that each hit brings: doubled from hit to hit, up to a limit."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(at))
    return hits.withColumn("ban_seconds", F.least(F.lit(most), F.lit(first) * F.pow(F.lit(2.0), F.least(nth, F.lit(20)) - 1)))


def admitted_by_rate(events: DataFrame, keys: Sequence[str], at: str, per_second: int, tie: str) -> DataFrame:
    """Events among the first ``per_second`` of their second, and the rest, told apart by ``admitted``."""
    slot = F.floor(F.col(at)).cast("long")
    place = F.row_number().over(Window.partitionBy(*keys, "slot").orderBy(at, tie))
    return events.withColumn("slot", slot).withColumn("place", place).withColumn("admitted", F.col("place") <= per_second)


def ramped(events: DataFrame, keys: Sequence[str], at: str, seconds: float, per_second: int, tie: str) -> DataFrame:
    """Events with ``admitted``: in the first ``seconds`` after a key's first event at most ``per_second`` in each second, then all."""
    started = F.min(at).over(Window.partitionBy(*keys))
    slots = admitted_by_rate(events.withColumn("__until", started + seconds), keys, at, per_second, tie)
    return slots.withColumn("admitted", (F.col(at) >= F.col("__until")) | F.col("admitted")).drop("__until", "slot", "place")


def throughput(jobs: DataFrame, at: str, file: str, seconds: int, keys: Sequence[str] = ()) -> DataFrame:
    """Jobs and different files of each tumbling window, and both per minute."""
    start = (F.floor(F.col(at) / seconds) * seconds).cast("long")
    done = jobs.groupBy(*keys, start.alias("window_start")).agg(F.count(F.lit(1)).alias("n_jobs"), F.count_distinct(file).alias("n_files"))
    rate = lambda c: F.round(F.col(c) * 60.0 / seconds, 3)
    return done.withColumn("jobs_per_minute", rate("n_jobs")).withColumn("files_per_minute", rate("n_files"))


def remaining_seconds(remaining: Column, per_minute: Column) -> Column:
    """Time until the rest is done at a rate; null without a rate."""
    return F.when(per_minute > 0, F.ceil(remaining * 60.0 / per_minute).cast("long"))


def cooldown_until(events: DataFrame, keys: Sequence[str], at: str, wait: str, most: float, block: float) -> DataFrame:
    """The latest end of any cool-down so far; waits are capped.

    Time is cut into blocks that are sorted apart; each begins with the latest
    end of those before it, so that a key with very many events is many tasks.
    """
    ends = events.withColumn("until", F.col(at) + F.least(F.col(wait), F.lit(most))).withColumn("__block", F.floor(F.col(at) / block))
    inside = F.max("until").over(Window.partitionBy(*keys, "__block").orderBy(at).rangeBetween(Window.unboundedPreceding, 0))
    latest = ends.groupBy(*keys, "__block").agg(F.max("until").alias("__until"))
    before = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.withColumn("__carried", F.max("__until").over(before)).drop("__until")
    known = ends.withColumn("until", inside).join(carried, [*keys, "__block"], "left")
    return known.withColumn("until", F.greatest("until", "__carried")).drop("__block", "__carried")


def due_jobs(delayed: DataFrame, ready_at: str, now: Column, most: int, tie: str) -> DataFrame:
    """Delayed jobs that are due, oldest first, ``most`` at a time."""
    return delayed.where(F.col(ready_at) <= now).orderBy(ready_at, tie).limit(most)


def stale_jobs(inflight: DataFrame, started_at: str, now: Column, ttl: int, alive: Column) -> DataFrame:
    """Jobs in work whose worker is gone or which take longer than ``ttl`` seconds."""
    return inflight.where((F.col(started_at) < now - ttl) | ~alive)


def enqueue_candidates(candidates: DataFrame, busy: Sequence[DataFrame], retries: DataFrame, key: str, most: int, force: Column) -> DataFrame:
    """Jobs to add: not busy already, and with retries left unless forced (which clears them)."""
    out = candidates
    for rows in busy:
        out = out.join(rows.select(key).distinct(), key, "left_anti")
    out = out.join(retries.select(key, "retries"), key, "left").withColumn("retries", F.when(force, 0).otherwise(F.coalesce("retries", F.lit(0))))
    return out.where(F.col("retries") < most)


def retention(entries: DataFrame, keys: Sequence[str], newest: Sequence[Column], keep: int) -> DataFrame:
    """Entries with ``kept``: the ``keep`` newest of each key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    return entries.withColumn("place", place).withColumn("kept", F.col("place") <= keep)


def newest_state(lines: DataFrame, keys: Sequence[str], order: str, state: Column) -> DataFrame:
    """The state of the newest line that tells one."""
    told = lines.withColumn("state", state).where("state is not null")
    return told.groupBy(*keys).agg(F.max_by("state", order).alias("state"), F.max(order).alias("seen_at"))


def held_state(lines: DataFrame, keys: Sequence[str], order: str, state: Column, failed: Column, now: Column, hold: float, idle: str = "idle") -> DataFrame:
    """The state of each key: ``error`` for ``hold`` after its last failure, else what its newest telling line says, else ``idle``."""
    told = lines.withColumn("__state", state).withColumn("__failed", F.when(failed, F.col(order)))
    newest = F.max_by(F.when(F.col("__state").isNotNull(), F.col("__state")), F.when(F.col("__state").isNotNull(), F.col(order)))
    found = told.groupBy(*keys).agg(newest.alias("__newest"), F.max("__failed").alias("__last"))
    return found.select(*keys, F.when(now - F.col("__last") <= hold, "error").otherwise(F.coalesce("__newest", F.lit(idle))).alias("state"))


# How much a child's state says about its worker.
CHILD_STATES = {
    "error": 4,
    "out-of-quota": 3,
    "waiting-quota": 3,
    "waiting-429": 2,
    "glossary": 2,
    "repair": 2,
    "translate": 1,
    "busy": 1,
}


def worker_states(children: DataFrame, worker: str, state: str, countdown: str, order: str, weights: dict[str, int] | None = None) -> DataFrame:
    """``worker, state, countdown``: the weightiest state of its children, the first in order among equals; of those that wait so, the longest countdown.

    Workers none of whose children has a known state have none.
    """
    weight = F.coalesce(*[F.when(F.col(state) == s, F.lit(n)) for s, n in (weights or CHILD_STATES).items()])
    told = children.withColumn("__w", weight).where("__w is not null")
    best = told.groupBy(worker).agg(F.max_by(state, F.struct("__w", -F.col(order))).alias("__best"))
    waits = told.groupBy(worker, state).agg(F.max(F.coalesce(countdown, F.lit(0.0))).alias("__longest"))
    joined = best.join(waits, [best[worker].eqNullSafe(waits[worker]), best["__best"] == waits[state]])
    return joined.select(best[worker], F.col("__best").alias("state"), F.when(F.col("__best").startswith("waiting-"), F.col("__longest")).alias("countdown"))


#: A key of the usage store: prefix, scope, name of the secret, model, and metric.
USAGE_KEY = r"^([^:]+):([^:]+):([^:]+):([^:]+):((?:api|llm|quota)(?::[a-z0-9]+)+)$"


def usage_key(key: Column | str) -> Column:
    """``struct(prefix, scope, token, model, metric)`` of a key of the usage store; null if it is none."""
    key = F.col(key) if isinstance(key, str) else key
    parts = [F.regexp_extract(key, USAGE_KEY, i + 1).alias(name) for i, name in enumerate(("prefix", "scope", "token", "model", "metric"))]
    return F.when(key.rlike(USAGE_KEY), F.struct(*parts))


def preferred_counts(counts: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """``token, model, metric, n`` summed over scopes: of the ``metrics`` that a scope, token and model have, the first."""
    base = ["scope", "token", "model"]
    rank = F.array_position(F.array(*[F.lit(m) for m in metrics]), F.col("metric"))
    place = F.row_number().over(Window.partitionBy(*base).orderBy("__rank"))
    summed = counts.where(F.col("metric").isin(*metrics)).groupBy(*base, "metric").agg(F.sum("n").alias("n")).withColumn("__rank", rank)
    first = summed.withColumn("__place", place).where("__place = 1")
    return first.groupBy("token", "model").agg(F.sum("n").alias("n"))
