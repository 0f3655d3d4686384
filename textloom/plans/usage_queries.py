"""Queries of usage, quotas, queues and pages, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import drift, replay, usage
from textloom.operators.replay import Limits
from textloom.shared import materialize
from textloom.sources import web

from .registry import query, table
from .relational_queries import with_micros

SECOND = 1_000_000
_EV = "ev AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS us, round(value)::BIGINT AS tokens, props FROM events)"


def quota_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as calls: key is the user, model the type, tokens the rounded value."""
    events = with_micros(table(spark, sf_dir, "events"))
    return events.select("event_id", "user_id", "event_type", "us", F.round("value").cast("long").alias("tokens"), "props")


def _rolling(name: str, seconds: int, edge: str) -> str:
    frame = f"(PARTITION BY user_id, event_type ORDER BY us RANGE BETWEEN {seconds * SECOND - (edge == 'open')} PRECEDING AND CURRENT ROW)"
    return f"WITH {_EV} SELECT event_id, count(*) OVER w AS requests, sum(tokens) OVER w::BIGINT AS used_tokens FROM ev WINDOW w AS {frame}".replace("sum(tokens) OVER w::BIGINT", "(sum(tokens) OVER w)::BIGINT")


@query("rolling_snapshot", _rolling("snapshot", 86_400, "closed"))
def rolling_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests and tokens of the closed day before each call."""
    rolled = usage.rolling_usage(quota_events(spark, sf_dir), ["user_id", "event_type"], "us", "tokens", 86_400 * SECOND)
    return rolled.select("event_id", "requests", "used_tokens")


@query("rolling_admit", _rolling("admit", 3_600, "open"))
def rolling_admit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where what is exactly an hour old has left."""
    rolled = usage.rolling_usage(quota_events(spark, sf_dir), ["user_id", "event_type"], "us", "tokens", 3_600 * SECOND, closed=False)
    return rolled.select("event_id", "requests", "used_tokens")


@query("usage_now", f"WITH {_EV}, m AS (SELECT max(us) AS now FROM ev) SELECT user_id, count(*) AS requests, sum(tokens)::BIGINT AS used_tokens FROM ev, m WHERE us BETWEEN now - {86_400 * SECOND} AND now GROUP BY user_id")
def usage_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage of each key in the day before the last event."""
    events = quota_events(spark, sf_dir)
    now = F.lit(events.agg(F.max("us")).first()[0])
    return usage.usage_at(events, ["user_id"], "us", "tokens", now, 86_400 * SECOND)


@query(
    "two_phase_usage",
    f"WITH {_EV} SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN us + 5000000 ELSE us END AS effective_at, CASE WHEN event_id % 3 <> 0 THEN 'locked' ELSE 'freezed' END AS phase, (CASE WHEN event_id % 3 = 0 THEN 100 WHEN event_id % 5 <> 0 THEN tokens ELSE 0 END)::BIGINT AS tokens FROM ev",
)
def two_phase_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reserved and committed usage."""
    events = quota_events(spark, sf_dir)
    grants = events.select("event_id", F.col("us").alias("granted_at"), F.lit(100).cast("long").alias("estimate"))
    done = events.where("event_id % 3 <> 0").select("event_id", (F.col("us") + 5 * SECOND).alias("committed_at"), (F.col("event_id") % 5 != 0).alias("success"), "tokens")
    return usage.two_phase(grants, done, "event_id", []).select("event_id", "effective_at", "phase", "tokens")


@query(
    "key_model_usage",
    f"WITH {_EV}, c AS (SELECT user_id, event_type, count(*) AS n FROM ev GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY list_position(['purchase', 'click', 'view'], event_type)) AS k FROM c WHERE event_type IN ('purchase', 'click', 'view')) SELECT user_id, event_type, n FROM r WHERE k = 1",
)
def key_model_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: for each key the metric that comes first in the order of preference."""
    counts = quota_events(spark, sf_dir).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return usage.fallback_metric(counts, ["user_id"], "event_type", ["purchase", "click", "view"])


@query("usage_totals", f"WITH {_EV} SELECT user_id, event_type, count(*) AS n, sum(tokens)::BIGINT AS tokens FROM ev GROUP BY ROLLUP (user_id, event_type)")
def usage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: usage by key and model with totals."""
    return quota_events(spark, sf_dir).rollup("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("tokens"))


@query(
    "burst_detect",
    f"WITH {_EV}, e AS (SELECT * FROM ev WHERE event_type = 'error') SELECT event_id, n_events, n_members::INT AS n_members FROM (SELECT a.event_id, count(*) AS n_events, count(DISTINCT b.user_id) AS n_members FROM e a JOIN e b ON b.us BETWEEN a.us - {2400 * SECOND} AND a.us GROUP BY a.event_id) WHERE n_events >= 6 AND n_members >= 3",
)
def burst_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: errors that end a burst over several keys."""
    errors = quota_events(spark, sf_dir).where("event_type = 'error'")
    return usage.bursts(errors, "us", "user_id", 2400 * SECOND, 6, 3, 21_600 * SECOND).select("event_id", "n_events", "n_members")


@query("ban_escalation", f"WITH {_EV} SELECT event_id, least(180.0, 8.0 * pow(2, least(row_number() OVER (PARTITION BY user_id ORDER BY us), 20) - 1))::DOUBLE AS ban_seconds FROM ev WHERE event_type = 'error'")
def ban_escalation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: bans that double from hit to hit."""
    return usage.escalation(quota_events(spark, sf_dir).where("event_type = 'error'"), ["user_id"], "us").select("event_id", "ban_seconds")


@query(
    "rate_slots",
    f"WITH {_EV} SELECT event_id, row_number() OVER (PARTITION BY event_type, us // {600 * SECOND} ORDER BY us, event_id) <= 2 AS admitted FROM ev",
)
def rate_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first calls of each slot are admitted."""
    events = quota_events(spark, sf_dir).withColumn("t", F.col("us") / (600 * SECOND))
    return usage.admitted_by_rate(events, ["event_type"], "t", 2, "event_id").select("event_id", "admitted")


@query(
    "throttled_picks",
    f"""WITH RECURSIVE {_EV}, e AS (SELECT user_id, event_id AS id, us, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS k FROM ev),
n AS (SELECT a.user_id, a.k, min(b.k) AS next FROM e a JOIN e b ON a.user_id = b.user_id AND b.us >= a.us + 600000000 GROUP BY a.user_id, a.k),
p AS (SELECT user_id, 1::BIGINT AS k FROM e GROUP BY user_id UNION ALL SELECT p.user_id, n.next FROM p JOIN n ON p.user_id = n.user_id AND p.k = n.k)
SELECT e.user_id, id, p.k IS NOT NULL AS picked FROM e LEFT JOIN p ON e.user_id = p.user_id AND e.k = p.k""",
)
def throttled_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Picks at least ten minutes apart for each key."""
    events = quota_events(spark, sf_dir).select("user_id", F.col("event_id").alias("id"), (F.col("us") / SECOND).alias("ts"))
    return replay.throttled(events, ["user_id"], 600.0)


@query(
    "throughput",
    f"WITH {_EV} SELECT (us // {3600 * SECOND} * 3600)::BIGINT AS window_start, count(*) AS n_jobs, count(DISTINCT props) AS n_files, round(count(*) * 60.0 / 3600, 3)::DOUBLE AS jobs_per_minute, round(count(DISTINCT props) * 60.0 / 3600, 3)::DOUBLE AS files_per_minute FROM ev GROUP BY 1",
)
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs and files per minute of each hour."""
    events = quota_events(spark, sf_dir).withColumn("t", F.expr(f"us div {SECOND}"))
    return usage.throughput(events, "t", "props", 3600)


@query("status_snapshot", """SELECT o_orderpriority, '{"done":' || count(*) FILTER (o_orderstatus = 'F') || ',"left":' || count(*) FILTER (o_orderstatus <> 'F') || '}' AS status, CASE WHEN count(*) FILTER (o_orderstatus = 'F') > 0 THEN ceil(count(*) FILTER (o_orderstatus <> 'F') * 60.0 / count(*) FILTER (o_orderstatus = 'F')) END::BIGINT AS eta_seconds FROM orders GROUP BY ALL""")
def status_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status line for each queue, and when it will be done."""
    counted = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count_if(F.col("o_orderstatus") != "F").alias("left"))
    return counted.select("o_orderpriority", F.to_json(F.struct("done", "left")).alias("status"), usage.remaining_seconds(F.col("left"), F.col("done")).alias("eta_seconds"))


@query("cooldown_until", f"WITH {_EV} SELECT event_id, max(us + least(tokens * 60, 1800) * {SECOND}) OVER (PARTITION BY event_type ORDER BY us RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until FROM ev")
def cooldown_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest end of any cool-down so far."""
    events = quota_events(spark, sf_dir).withColumn("wait", F.col("tokens") * 60 * SECOND)
    done = usage.cooldown_until(events, ["event_type"], "us", "wait", 1800 * SECOND, 86_400 * SECOND)
    return done.select("event_id", F.col("until").cast("long").alias("until"))


@query("due_jobs", f"WITH {_EV}, m AS (SELECT max(us) // 2 + min(us) // 2 AS now FROM ev) SELECT event_id FROM ev, m WHERE us <= now ORDER BY us, event_id LIMIT 500")
def due_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delayed jobs that are due, oldest first, 500 at a time."""
    events = quota_events(spark, sf_dir)
    now = F.lit(events.agg(F.expr("max(us) div 2 + min(us) div 2")).first()[0])
    return usage.due_jobs(events, "us", now, 500, "event_id").select("event_id")


@query("stale_inflight", f"WITH {_EV}, m AS (SELECT max(us) AS now FROM ev) SELECT event_id FROM ev, m WHERE event_type = 'click' AND (us < now - {3600 * SECOND} OR user_id % 10 = 0)")
def stale_inflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs in work for too long, or whose worker is gone."""
    events = quota_events(spark, sf_dir)
    now = F.lit(events.agg(F.max("us")).first()[0])
    return usage.stale_jobs(events.where("event_type = 'click'"), "us", now, 3600 * SECOND, F.col("user_id") % 10 != 0).select("event_id")


@query(
    "enqueue_candidates",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE coalesce(r, 0) END::INT AS retries FROM orders LEFT JOIN (SELECT l_orderkey, max(l_linenumber) AS r FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' AND o_custkey % 7 <> 0 AND (o_orderkey % 10 = 0 OR coalesce(r, 0) < 5)",
)
def enqueue_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs that are not busy and may be tried again."""
    orders = table(spark, sf_dir, "orders")
    retries = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_linenumber").cast("int").alias("retries"))
    busy = [orders.where("o_orderstatus = 'P'"), orders.where("o_custkey % 7 = 0")]
    return usage.enqueue_candidates(orders, busy, retries, "o_orderkey", 5, F.col("o_orderkey") % 10 == 0).select("o_orderkey", "retries")


@query("worker_state", f"WITH {_EV} SELECT user_id, max_by(CASE event_type WHEN 'error' THEN 'failed' WHEN 'click' THEN 'working' WHEN 'purchase' THEN 'done' END, us) AS state, max(us) AS seen_at FROM ev WHERE event_type IN ('error', 'click', 'purchase') GROUP BY user_id")
def worker_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the newest telling line says of each worker."""
    state = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "click", "working").when(F.col("event_type") == "purchase", "done")
    return usage.newest_state(quota_events(spark, sf_dir), ["user_id"], "us", state)


_HOLD = 3_600 * SECOND


@query(
    "held_state",
    f"WITH {_EV}, s AS (SELECT user_id, max_by(CASE event_type WHEN 'click' THEN 'busy' WHEN 'purchase' THEN 'idle' END, us) FILTER (event_type IN ('click', 'purchase')) AS newest, max(us) FILTER (event_type = 'error') AS failed FROM ev GROUP BY user_id) SELECT user_id, CASE WHEN (SELECT max(us) FROM ev) - failed <= {_HOLD * 24} THEN 'error' ELSE coalesce(newest, 'idle') END AS state FROM s",
)
def held_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of workers, errors held for a day."""
    events = quota_events(spark, sf_dir)
    now = F.lit(events.agg(F.max("us")).first()[0])
    state = F.when(F.col("event_type") == "click", "busy").when(F.col("event_type") == "purchase", "idle")
    return usage.held_state(events, ["user_id"], "us", state, F.col("event_type") == "error", now, _HOLD * 24)


@query(
    "worker_child_states",
    f"""WITH {_EV}, w(state, weight) AS (VALUES ('error', 4), ('out-of-quota', 3), ('waiting-quota', 3), ('waiting-429', 2), ('glossary', 2), ('repair', 2), ('translate', 1), ('busy', 1)),
c AS (SELECT user_id, event_id, tokens, ['busy', 'translate', 'repair', 'waiting-429', 'waiting-quota', 'gone', 'glossary'][event_id % 7 + 1] AS state FROM ev WHERE user_id % 3 > 0 OR event_id % 7 < 2),
b AS (SELECT user_id, arg_max(state, weight::BIGINT * 1000000000 - event_id) AS best FROM c JOIN w USING (state) GROUP BY user_id)
SELECT b.user_id, best AS state, CASE WHEN best LIKE 'waiting-%' THEN max(c.tokens)::DOUBLE END AS countdown FROM b JOIN c ON b.user_id = c.user_id AND c.state = best GROUP BY b.user_id, best""",
)
def worker_child_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A worker's state from those of its children."""
    names = F.array(*[F.lit(x) for x in ("busy", "translate", "repair", "waiting-429", "waiting-quota", "gone", "glossary")])
    children = quota_events(spark, sf_dir).where("user_id % 3 > 0 or event_id % 7 < 2")
    children = children.select("user_id", "event_id", F.get(names, (F.col("event_id") % 7).cast("int")).alias("child"), F.col("tokens").cast("double").alias("left"))
    return usage.worker_states(children, "user_id", "child", "left", "event_id")


@query(
    "startup_ramp",
    f"WITH {_EV}, d AS (SELECT event_id, user_id, us / 86400000000.0 AS day FROM ev), r AS (SELECT *, min(day) OVER (PARTITION BY user_id) + 10 AS until, row_number() OVER (PARTITION BY user_id, floor(day) ORDER BY day, event_id) AS k FROM d) SELECT event_id, day >= until OR k <= 1 AS admitted FROM r",
)
def startup_ramp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The start of each key at a slower rate, days for seconds."""
    events = quota_events(spark, sf_dir).select("event_id", "user_id", (F.col("us") / 86_400_000_000.0).alias("day"))
    return usage.ramped(events, ["user_id"], "day", 10, 1, "event_id").select("event_id", "admitted")


@query(
    "usage_key_space",
    f"""WITH {_EV}, k AS (SELECT user_id::VARCHAR AS token, event_type AS model, event_id % 2 AS scope, CASE WHEN event_id % 5 = 0 THEN 'api:calls' ELSE 'llm:reqs' END AS metric FROM ev WHERE event_id % 4 > 0 AND (event_type <> 'view' OR event_id % 5 = 0)),
b AS (SELECT token, model, scope, metric, count(*) AS n FROM k GROUP BY ALL), f AS (SELECT *, row_number() OVER (PARTITION BY token, model, scope ORDER BY CASE metric WHEN 'llm:reqs' THEN 0 ELSE 1 END) AS r FROM b)
SELECT token, model, sum(n)::BIGINT AS n FROM f WHERE r = 1 GROUP BY token, model""",
)
def usage_key_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the usage store read into fields; calls count where there are no requests."""
    events = quota_events(spark, sf_dir).where("event_type <> 'view' or event_id % 5 = 0")
    metric = F.when(F.col("event_id") % 5 == 0, "api:calls").otherwise("llm:reqs")
    scope = F.concat(F.lit("n"), (F.col("event_id") % 2).cast("string"))
    whole = F.concat_ws(":", F.lit("q"), scope, F.col("user_id").cast("string"), F.col("event_type"), metric)
    keys = events.select(F.when(F.col("event_id") % 4 == 0, F.lit("q:other")).otherwise(whole).alias("key"))
    counts = keys.select(usage.usage_key("key").alias("k"), F.lit(1).alias("n")).where("k is not null").select("k.*", "n")
    return usage.preferred_counts(counts, ["llm:reqs", "api:calls"]).select("token", "model", "n")


@query("retention_topn", "SELECT o_custkey, d AS day, k <= 4 AS kept FROM (SELECT o_custkey, d, row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC) AS k FROM (SELECT DISTINCT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders))")
def retention_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four newest days of each log stay."""
    days = table(spark, sf_dir, "orders").select("o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).distinct()
    return usage.retention(days, ["o_custkey"], [F.desc("day")], 4).select("o_custkey", "day", "kept")


@query(
    "proxy_blacklist",
    f"WITH {_EV}, i AS (SELECT *, sum(CASE WHEN event_type IN ('error', 'view') THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM ev), k AS (SELECT *, row_number() OVER (PARTITION BY user_id, g ORDER BY us) AS n FROM i WHERE event_type IN ('error', 'view')) SELECT user_id, us AS barred_at, us + 60000000 AS barred_until FROM k WHERE n % 2 = 0",
)
def proxy_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proxies barred after two time-outs in a row."""
    events = quota_events(spark, sf_dir).withColumn("failed", F.col("event_type").isin("error", "view"))
    return replay.blacklist(events, "user_id", "us", "failed", 2, 60 * SECOND)


LIMITS = Limits(rpm=2, tpm=150, rpd=4)


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quota_events(spark, sf_dir).select("user_id", "event_type", F.col("event_id").alias("id"), (F.col("us") / SECOND).alias("ts"), "tokens")


@query("fifo_eta")
def fifo_eta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each call is granted, first in first out."""
    return replay.fifo_eta(_calls(spark, sf_dir), ["user_id", "event_type"], LIMITS)


@query("admission_replay")
def admission_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which calls are admitted, and how long the others have to wait."""
    return replay.admission(_calls(spark, sf_dir), ["user_id"], LIMITS)


# ------------------------------------------------------------ pages


_TAGS = r"""trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
'(?is)<script.*?</script>', '', 'g'), '(?is)<style.*?</style>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '[ \t\r\n]+', ' ', 'g'))"""


@query("strip_tags", f"SELECT page_id, {_TAGS} AS text FROM pages")
def strip_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page text by patterns."""
    return table(spark, sf_dir, "pages").select("page_id", web.strip_tags("html").alias("text"))


@query(
    "page_links",
    r"""WITH m AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href, unnest(range(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)))) AS pos FROM pages) SELECT page_id, pos::INT AS pos, replace(href, '&amp;', '&') AS href FROM m""",
)
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages."""
    return web.page_links(table(spark, sf_dir, "pages"), ("page_id",)).select("page_id", "pos", "href")


#: Sites of the pages: numbers by the address alone, by the title before the address, and only of pages in one of two languages, with parts.
_RULES = [
    ("example.com", None, r"/([0-9]+)(?:[/?#.]|$)", None, None),
    ("example.net", r"([0-9]+)", r"/([0-9]+)(?:[/?#.]|$)", "", ""),
    ("example.org", None, r"/([0-9]+)(?:[/?#.]|$)", "/(en|de)/", r"[?&]page=([0-9]+)"),
]
_RULES_SQL = ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" for v in r) + ")" for r in _RULES)


@query(
    "page_directory",
    rf"""WITH r(site, text_number, address_number, address, part) AS (VALUES {_RULES_SQL}),
l AS (SELECT page_id AS pos, url AS link, regexp_extract(html, '<title>([^<]*)</title>', 1) AS text, regexp_extract(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1)), '([^.]+\.[^.]+)$', 1) AS site FROM pages),
m AS (SELECT l.*, coalesce(CASE WHEN text_number <> '' THEN try_cast(nullif(regexp_extract(text, text_number, 1), '') AS INT) END, CASE WHEN address_number <> '' THEN try_cast(nullif(regexp_extract(link, address_number, 1), '') AS INT) END) AS number,
  CASE WHEN part <> '' THEN try_cast(nullif(regexp_extract(link, part, 1), '') AS INT) END AS part FROM l JOIN r USING (site) WHERE coalesce(address, '') = '' OR regexp_matches(link, address)),
k AS (SELECT *, row_number() OVER (PARTITION BY site, number ORDER BY part NULLS FIRST, pos DESC) AS place FROM m WHERE number IS NOT NULL)
SELECT site, number, text AS title, link, part FROM k WHERE place = 1""".replace("\\\\", "\\"),
)
def page_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory of the pages of every site, by the rules of each."""
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    links = table(spark, sf_dir, "pages").select(F.col("page_id").alias("pos"), F.col("url").alias("link"), title.alias("text"), web.site_of("url").alias("host"))
    entries = web.directory_entries(links, spark.createDataFrame(_RULES, web.SITE_RULES), ("host",), site=F.col("host"))
    return entries.withColumnRenamed("host", "site")


@query("extract_page_text")
def extract_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and content of pages."""
    return web.page_text(table(spark, sf_dir, "pages"), web.PageLayout(noise=("^Advertisement$",)), ("page_id",))


@query("synth_directory", "SELECT page_id, n::INT AS number, 'https://example.org/' || n || '.html' AS link FROM (SELECT page_id, unnest(range(1, page_id % 9 + 1)) AS n FROM pages)")
def synth_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directories made from the latest number."""
    latest = table(spark, sf_dir, "pages").select("page_id", (F.col("page_id") % 9).cast("int").alias("latest"))
    return web.numbered_directory(latest, "latest", "https://example.org/%d.html", ("page_id",))


#: Books of 500 events each: events of some users are notices, which use up an id and no number; ids of some others cannot be looked up.
_BOOKS = """e AS (SELECT event_id // 500 AS book, event_id % 500 + 1 AS id, user_id % 40 = 0 AS notice, user_id % 7 = 3 AS hidden, event_type FROM events),
n AS (SELECT *, (id - sum(notice::INT) OVER (PARTITION BY book ORDER BY id))::BIGINT AS number FROM e),
k AS (SELECT book, id, number FROM n WHERE NOT notice AND NOT hidden),
b AS (SELECT book, min(id) AS lo, max(id) AS hi FROM e GROUP BY book),
f AS (SELECT book FROM b WHERE (book, lo) IN (SELECT (book, id) FROM k) AND (book, hi) IN (SELECT (book, id) FROM k)),
l AS (SELECT book, number, id - number AS diff, lag(id - number) OVER (PARTITION BY book ORDER BY id) AS prev FROM k JOIN f USING (book)),
s AS (SELECT book, number AS start, diff FROM l WHERE diff <> coalesce(prev, 0))"""


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "events").select(
        F.expr("event_id div 500").alias("book"), (F.col("event_id") % 500 + 1).alias("id"), (F.col("user_id") % 40 == 0).alias("notice"), (F.col("user_id") % 7 == 3).alias("hidden"), "event_type"
    )
    so_far = Window.partitionBy("book").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("number", F.col("id") - F.sum(F.col("notice").cast("int")).over(so_far))


def book_segments(rows: DataFrame) -> DataFrame:
    bounds = rows.groupBy("book").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    return drift.drift_segments(bounds, drift.table_probe(rows.where("not notice and not hidden"), ["book"]), ["book"])


@query("drift_segments", f"WITH {_BOOKS} SELECT book, start, diff FROM s")
def drift_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where ids drift from numbers, found by looking up ids."""
    return book_segments(materialize(numbered_events(spark, sf_dir)))


@query(
    "json_directory",
    f"""WITH {_BOOKS}, t AS (SELECT book, number, '第' || number || '章 ' || event_type AS title FROM n WHERE NOT notice)
SELECT t.book, number::INT AS number, title, 'https://api.example.org/chapter?id=' || t.book || '&chapterid=' || (number + coalesce(diff, 0)) AS link
FROM t ASOF LEFT JOIN s ON t.book = s.book AND t.number >= s.start""",
)
def json_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directories from JSON payloads, their links by drifted ids."""
    rows = materialize(numbered_events(spark, sf_dir))
    title = F.format_string("第%d章 %s", F.col("number"), F.col("event_type"))
    listed = rows.where("not notice").groupBy("book").agg(F.array_sort(F.collect_list(F.struct("number", title.alias("title")))).alias("ts"))
    payload = F.to_json(F.struct(F.transform("ts", lambda t: t["title"]).alias("list")))
    payloads = listed.select("book", payload.alias("payload"), F.concat(F.lit("https://api.example.org/chapter?id="), F.col("book").cast("string")).alias("base_url"))
    return web.json_directory(payloads, ("book",), segments=book_segments(rows))


@query(
    "corrected_links",
    "WITH o AS (SELECT o_orderkey, o_orderkey % 9 AS expected, o_custkey % 9 AS actual, o_orderkey % 20 AS id FROM orders), m AS (SELECT *, id + expected - actual AS moved FROM o) SELECT o_orderkey, CASE WHEN expected <> actual AND moved > 0 THEN 'https://api.example.org/chapter?id=5&chapterid=' || moved END AS link FROM m",
)
def corrected_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses moved by what the number of their page was off by."""
    url = F.concat(F.lit("https://api.example.org/chapter?id=5&chapterid="), (F.col("o_orderkey") % 20).cast("string"))
    link = drift.corrected_id(url, "chapterid", F.col("o_orderkey") % 9, F.col("o_custkey") % 9)
    return table(spark, sf_dir, "orders").select("o_orderkey", link.alias("link"))


@query(
    "next_part_links",
    "WITH l AS (SELECT l_orderkey, l_linenumber AS page, l_partkey, CASE WHEN l_returnflag = 'R' THEN 'next' ELSE 'other' END AS txt, l_linenumber + l_suppkey % 3 AS part, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos FROM lineitem), p AS (SELECT *, CASE WHEN txt = 'next' AND part > page THEN 1 WHEN part = page + 1 THEN 2 END AS pr FROM l), k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, page ORDER BY pr, pos) AS n FROM p WHERE pr IS NOT NULL) SELECT l_orderkey, page, part::VARCHAR AS link FROM k WHERE n = 1",
)
def next_part_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The successor of each page."""
    from pyspark.sql import Window

    items = table(spark, sf_dir, "lineitem")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    part = F.col("l_linenumber") + F.col("l_suppkey") % 3
    links = items.select(
        "l_orderkey",
        F.col("l_linenumber").alias("page"),
        F.when(F.col("l_returnflag") == "R", "next").otherwise("other").alias("text"),
        part.alias("part"),
        F.col("l_linenumber").alias("page_part"),
        F.lit(1).alias("number"),
        F.lit(1).alias("page_number"),
        part.cast("string").alias("link"),
        F.row_number().over(order).alias("pos"),
    )
    return web.next_parts(links, ("l_orderkey",), "page", "next")


_BLOCK = " ".join("WHEN " + " OR ".join(f"contains(lower(html), '{p}')" for p in ps) + f" THEN '{r}'" for r, ps in web.BLOCK_PHRASES.items())


@query("block_reason", f"SELECT page_id, CASE {_BLOCK} END AS reason FROM pages")
def block_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that are no content."""
    return table(spark, sf_dir, "pages").select("page_id", web.block_reason("html").alias("reason"))
