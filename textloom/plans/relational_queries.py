"""Queries of joins, sets, rankings, intervals, schedules and dictionaries, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.operators import quality, ranges, relational, repair, terms
from textloom.operators.ranges import BatchRule
from textloom.sources import files

from .registry import query, table


@query(
    "range_overlap_scan",
    "WITH r AS (SELECT min(doc_id) + (max(doc_id) - min(doc_id)) // 4 AS low, max(doc_id) - (max(doc_id) - min(doc_id)) // 4 AS high FROM documents) SELECT doc_id // 10 * 10 + 1 AS batch_start, count(*) AS n FROM documents, r WHERE doc_id // 10 * 10 + 1 <= high AND doc_id // 10 * 10 + 10 >= low GROUP BY 1",
)
def range_overlap_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that meet a range, the middle half of all ids."""
    docs = table(spark, sf_dir, "documents").withColumn("batch_start", F.expr("doc_id div 10 * 10 + 1")).withColumn("batch_end", F.col("batch_start") + 9)
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    low, high = low or 0, high or 0
    quarter = (high - low) // 4
    return ranges.overlapping(docs, "batch_start", "batch_end", low + quarter, high - quarter).groupBy("batch_start").agg(F.count(F.lit(1)).alias("n"))


_UPSERT_SQL = """WITH e AS (SELECT l_orderkey, l_linenumber, min(l_partkey)::VARCHAR AS block FROM lineitem WHERE l_linenumber % 2 = 1 GROUP BY ALL),
n AS (SELECT l_orderkey, l_linenumber, 'new ' || max(l_suppkey) AS block FROM lineitem WHERE l_linenumber <= 2 GROUP BY ALL)
SELECT coalesce(n.l_orderkey, e.l_orderkey) AS l_orderkey, coalesce(n.l_linenumber, e.l_linenumber) AS number, coalesce(n.block, e.block) AS block FROM e FULL JOIN n USING (l_orderkey, l_linenumber)"""


@query("upsert_merge", _UPSERT_SQL)
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: new blocks over existing ones."""
    from textloom.operators.sections import upsert_merge as merge

    items = table(spark, sf_dir, "lineitem")
    form = lambda df, pos, block: df.select("l_orderkey", F.col("l_linenumber").alias("number"), F.col(pos).alias("pos"), block.alias("block"))
    old = form(items.where("l_linenumber % 2 = 1"), "l_partkey", F.col("l_partkey").cast("string"))
    new = form(items.where("l_linenumber <= 2"), "l_suppkey", F.concat(F.lit("new "), F.col("l_suppkey").cast("string")))
    return merge(old, new, ("l_orderkey",)).select("l_orderkey", "number", "block")


@query(
    "rebuild_parts",
    "WITH x AS (SELECT conv_id, turn, text FROM conversations), p AS (SELECT * FROM x WHERE (conv_id + turn) % 11 <> 0) SELECT x.conv_id, count(*) AS n_expected, count(p.turn) AS n_there, string_agg(p.text, chr(10) ORDER BY p.turn) AS text FROM x LEFT JOIN p USING (conv_id, turn) GROUP BY x.conv_id HAVING count(p.turn) = count(*)",
)
def rebuild_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose parts are all there."""
    turns = table(spark, sf_dir, "conversations")
    parts = turns.where("(conv_id + turn) % 11 <> 0").select("conv_id", "turn", "text")
    return relational.rebuilt(turns.select("conv_id", "turn"), parts, ("conv_id",), "turn", "text")


@query(
    "completeness_gate",
    "WITH e AS (SELECT o_orderkey, unnest(range(1, 5)) AS part FROM orders) SELECT o_orderkey, count(*) AS n_expected, count(l.l_linenumber) AS n_there, count(*) = count(l.l_linenumber) AS complete FROM e LEFT JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) l ON o_orderkey = l_orderkey AND part = l_linenumber GROUP BY o_orderkey",
)
def completeness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4: orders whose first four parts are there."""
    expected = table(spark, sf_dir, "orders").select("o_orderkey", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("part"))
    parts = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("part"))
    return relational.completeness(expected, parts, ("o_orderkey",), "part")


@query("prune_manifest", "SELECT doc_id, quality, toxic FROM labels WHERE NOT (doc_id IN (SELECT doc_id FROM documents WHERE n_chars >= 500) AND doc_id * 2 >= (SELECT max(doc_id) FROM documents))")
def prune_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: manifest rows that a valid document inside the range makes stale go."""
    docs = table(spark, sf_dir, "documents")
    last = docs.agg(F.max("doc_id")).first()[0] or 0
    return relational.pruned_manifest(table(spark, sf_dir, "labels"), docs.where("n_chars >= 500"), ["doc_id"], F.col("doc_id") * 2 >= last)


@query("upsert_manifest", "SELECT doc_id, 1 - quality AS quality, toxic FROM labels WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, quality, toxic FROM labels WHERE doc_id % 3 <> 0")
def upsert_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: new manifest rows replace those of their key."""
    labels = table(spark, sf_dir, "labels")
    return relational.upsert(labels, labels.where("doc_id % 3 = 0").withColumn("quality", 1 - F.col("quality")), ["doc_id"])


_MENU = "printf('%02d:%02d:%02d', (s // 3600)::INT, (s // 60 % 60)::INT, (s % 60)::INT)"


@query(
    "running_menu",
    f"WITH r AS (SELECT l_orderkey, l_linenumber, coalesce(sum(l_quantity::BIGINT * 10) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 12 AS s FROM lineitem) SELECT l_orderkey, l_linenumber, s::BIGINT AS offset_seconds, {_MENU} AS label FROM r",
)
def running_menu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start offsets of the parts, at tempo 1.2."""
    from pyspark.sql import Window

    before = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.expr("cast(coalesce(s, 0) div 12 as bigint)")
    rows = table(spark, sf_dir, "lineitem").withColumn("s", F.sum(F.col("l_quantity").cast("long") * 10).over(before)).withColumn("offset_seconds", offset)
    t = F.col("offset_seconds")
    label = F.format_string("%02d:%02d:%02d", F.floor(t / 3600), F.floor(t / 60) % 60, t % 60)
    return rows.select("l_orderkey", "l_linenumber", "offset_seconds", label.alias("label"))


@query(
    "needs_work",
    """WITH d AS (SELECT doc_id, sha256(text) AS h FROM documents), l AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'other' ELSE h END AS stored, toxic = 1 AS pending FROM d JOIN labels USING (doc_id))
SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN stored <> h THEN 'changed' WHEN pending THEN 'pending' END AS reason FROM d LEFT JOIN l USING (doc_id) WHERE l.doc_id IS NULL OR stored <> h OR pending""",
)
def needs_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose result is missing, out of date or pending."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    stored = F.when(F.col("doc_id") % 4 == 0, F.lit(None)).when(F.col("doc_id") % 4 == 1, "other").otherwise(F.col("h"))
    done = docs.join(table(spark, sf_dir, "labels"), "doc_id").select("doc_id", stored.alias("stored"), (F.col("toxic") == 1).alias("pending"))
    return relational.needs_work(docs, done, ["doc_id"], "h", "stored", "pending").select("doc_id", "reason")


@query("key_filters", "SELECT c_custkey FROM customer WHERE c_custkey IN (7, 12, 80) OR right(c_name, 4) = '0042' OR c_name = 'Customer#000000099'")
def key_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows picked by index, by last four characters or by name, given as repeated comma lists."""
    flags = spark.createDataFrame([("7, 12,80",), ("0042",), ("Customer#000000099,7",)], "flag string")
    wanted = flags.select(F.explode(F.split("flag", " *, *")).alias("value")).distinct()
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    by = lambda key, source: rows.join(source.select(F.col("value").alias("k")), key == F.col("k"), "left_semi")
    short = wanted.where(F.length("value") == 4)
    index = wanted.where("value rlike '^[0-9]{1,3}$'").select(F.col("value").cast("long").alias("value"))
    return by(F.expr("right(c_name, 4)"), short).union(by(F.col("c_custkey"), index)).union(by(F.col("c_name"), wanted)).select("c_custkey").distinct()


@query(
    "title_match",
    "SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS title, contains(lower(p_name), 'small') OR contains(lower(p_name), 'bright') AS matches FROM part",
)
def title_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles folded, and whether they hold one of some signals."""
    folded = table(spark, sf_dir, "part").select("p_partkey", quality.fold_marks("p_name").alias("t"))
    title = F.trim(F.regexp_replace("t", r"(?U)[^\p{L}\p{N}]+", " "))
    signals = F.array(F.lit("small"), F.lit("bright"))
    return folded.select("p_partkey", title.alias("title"), F.exists(signals, lambda s: F.contains(F.col("t"), s)).alias("matches"))


@query(
    "term_quality",
    "SELECT p_partkey, CASE WHEN regexp_matches(p_type, '^[0-9.,:%/ -]+$') THEN 'numeric' WHEN length(p_type) < 2 THEN 'short' WHEN lower(p_type) IN ('small') THEN 'stop_word' WHEN lower(p_type) = lower(p_brand) THEN 'unchanged' WHEN NOT regexp_matches(p_brand, '(^| )\\p{Lu}') THEN 'no_name' END AS drop_reason FROM part".replace("\\\\", "\\"),
)
def term_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: sound and unsound dictionary terms."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("src"), F.col("p_brand").alias("dst"))
    return terms.term_quality(rows, ["small"]).select("p_partkey", "drop_reason")


@query("missing_numbers", "SELECT o_orderkey, n::INT AS number FROM (SELECT o_orderkey, unnest(range(1, 8)) AS n FROM orders) e WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = n)")
def missing_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers that an order has not."""
    expected = table(spark, sf_dir, "orders").select("o_orderkey", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("number"))
    actual = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("number"))
    return relational.missing_keys(expected, actual, ["o_orderkey", "number"])


@query(
    "number_gaps",
    "WITH n AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem), g AS (SELECT l_suppkey, l_partkey AS a, lead(l_partkey) OVER (PARTITION BY l_suppkey ORDER BY l_partkey) AS b FROM n) SELECT l_suppkey, count(*) AS n_missing, min(x) AS first_missing, max(x) AS last_missing FROM (SELECT l_suppkey, unnest(range(a + 1, b)) AS x FROM g WHERE b > a + 1) GROUP BY l_suppkey",
)
def number_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers missing between the smallest and the largest."""
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_partkey").alias("number"))
    found = quality.gap_ranges(rows, ("l_suppkey",))
    missing = F.sum(F.col("last") - F.col("first") + 1)
    return found.groupBy("l_suppkey").agg(missing.alias("n_missing"), F.min("first").alias("first_missing"), F.max("last").alias("last_missing"))


@query(
    "interval_overlap",
    "WITH a AS (SELECT c_custkey, c_custkey * 3 AS s, c_custkey * 3 + c_nationkey AS e FROM customer), b AS (SELECT s_suppkey, s_suppkey * 41 AS f, s_suppkey * 41 + s_nationkey * 2 AS t FROM supplier) SELECT c_custkey, s_suppkey FROM a JOIN b ON s <= t AND f <= e",
)
def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals that meet, joined by buckets."""
    a = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") * 3).alias("s"), (F.col("c_custkey") * 3 + F.col("c_nationkey")).alias("e"))
    b = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") * 41).alias("f"), (F.col("s_suppkey") * 41 + F.col("s_nationkey") * 2).alias("t"))
    return ranges.overlap_join(a, b, ("s", "e"), ("f", "t"), 32).select("c_custkey", "s_suppkey")


@query("rule_lookup", "SELECT o_orderkey, coalesce(n_nationkey, -1)::INT AS rule FROM orders LEFT JOIN nation ON o_custkey BETWEEN n_nationkey * 60 AND n_nationkey * 60 + 39")
def rule_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule whose interval holds a number, or the default."""
    start = F.col("n_nationkey").cast("long") * 60
    rules = table(spark, sf_dir, "nation").select(start.alias("start"), (start + 39).alias("end"), F.col("n_nationkey").alias("rule"))
    return ranges.rule_lookup(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", rules, "rule", F.lit(-1), 64).select("o_orderkey", "rule")


_ASOF = "WITH e AS (SELECT event_id, user_id, epoch_us(ts) AS t FROM events WHERE event_type <> 'error'), r AS (SELECT user_id, epoch_us(ts) AS t, event_id AS last_error FROM events WHERE event_type = 'error') SELECT event_id, last_error FROM e ASOF LEFT JOIN r ON e.user_id = r.user_id AND e.t >= r.t"


@query("asof_offset", _ASOF)
def asof_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last error of a user at each of the other events, in blocks of a week."""
    events = with_micros(table(spark, sf_dir, "events"))
    rows = events.where("event_type <> 'error'").select("event_id", "user_id", F.col("us").alias("at"))
    errors = events.where("event_type = 'error'").select("user_id", F.col("us").alias("start"), F.col("event_id").alias("last_error"))
    return ranges.asof(rows, errors, ["user_id"], "at", "start", "last_error", 7 * 86_400_000_000).select("event_id", "last_error")


def with_micros(events: DataFrame, ts: str = "ts", name: str = "us") -> DataFrame:
    """Adds a time without zone as microseconds since 1970, whatever the session's zone."""
    whole = f"(unix_date(cast({ts} as date)) * 86400L + hour({ts}) * 3600 + minute({ts}) * 60) * 1000000"
    return events.withColumn(name, F.expr(f"{whole} + cast(extract(second from {ts}) * 1000000 as bigint)"))


@query(
    "term_contains_join",
    "WITH w AS (SELECT item_id, string_split(text, ' ') AS ws FROM benchmark), p AS (SELECT item_id, ws, unnest(range(1, len(ws) + 1, 3)) AS pos FROM w), t AS (SELECT item_id, pos, array_to_string(ws[pos:pos + 2], ' ') AS term FROM p) SELECT doc_id, item_id, pos FROM documents JOIN t ON contains(text, term)",
)
def term_contains_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of three words that the benchmark's whole texts fall into, as substrings of documents."""
    words = table(spark, sf_dir, "benchmark").select("item_id", F.split("text", " ").alias("ws"))
    phrases = words.select("item_id", "ws", F.explode(F.expr("sequence(1L, cast(size(ws) as bigint), 3L)")).alias("pos"))
    phrases = phrases.select("item_id", "pos", F.array_join(F.slice("ws", F.col("pos").cast("int"), F.lit(3)), " ").alias("term"))
    return terms.contained_strings(table(spark, sf_dir, "documents"), phrases, "text", "term", ["doc_id"], ["item_id", "pos"])


@query(
    "first_success",
    "SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS k FROM lineitem WHERE l_returnflag <> 'N') WHERE k = 1",
)
def first_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best candidate that succeeded."""
    items = table(spark, sf_dir, "lineitem")
    return relational.first_success(items, ["l_orderkey"], [F.desc("l_extendedprice"), "l_linenumber"], F.col("l_returnflag") != "N").select("l_orderkey", "l_linenumber")


@query(
    "process_ancestors",
    "WITH RECURSIVE e AS (SELECT c_custkey AS node, CASE WHEN c_custkey % 2 = 0 THEN c_custkey - 2 ELSE c_custkey // 2 END AS up FROM customer WHERE c_custkey % 500 <> 0), w AS (SELECT node, up AS root, 1 AS depth FROM e UNION ALL SELECT w.node, e.up, depth + 1 FROM w JOIN e ON w.root = e.node) SELECT node, min_by(root, -depth) AS root, max(depth)::INT AS depth FROM w GROUP BY node",
)
def process_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ancestor of every process."""
    up = F.expr("case when c_custkey % 2 = 0 then c_custkey - 2 else c_custkey div 2 end")  # chains of 250, and trees
    edges = table(spark, sf_dir, "customer").where("c_custkey % 500 <> 0").select(F.col("c_custkey").alias("node"), up.alias("up"))
    return relational.closure(edges, "node", "up")


@query(
    "zip_align",
    """WITH u AS (SELECT conv_id, turn AS ask, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn AS answer, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE role = 'assistant') SELECT conv_id, k::INT AS place, ask, answer FROM u JOIN a USING (conv_id, k, n)""",
)
def zip_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions and answers paired by place where there are as many of both."""
    turns = table(spark, sf_dir, "conversations")
    ask = turns.where("role = 'user'").select("conv_id", F.col("turn").alias("ask"))
    answer = turns.where("role = 'assistant'").select("conv_id", F.col("turn").alias("answer"))
    return relational.zip_align(ask, answer, ["conv_id"], ["ask"], ["answer"]).select("conv_id", "place", "ask", "answer")


@query("modulo_assign", "SELECT s_suppkey, CASE WHEN s_suppkey <= 1 THEN NULL WHEN s_suppkey - 2 < 9 THEN ['p1', 'p2', 'p3'][(s_suppkey - 2) // 3 + 1] ELSE ['p1', 'p2', 'p3'][(s_suppkey - 11) % 3 + 1] END AS proxy FROM supplier WHERE s_suppkey > 0")
def modulo_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A proxy for each key."""
    return relational.modulo_assign(table(spark, sf_dir, "supplier").where("s_suppkey > 0").select("s_suppkey"), "s_suppkey", ["p1", "p2", "p3"], 3)


@query(
    "dominant_vote",
    "WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n, min(c_custkey) AS f FROM customer GROUP BY ALL), t AS (SELECT *, sum(n) OVER (PARTITION BY c_nationkey) AS total, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, f) AS k FROM c) SELECT c_nationkey, c_mktsegment AS dominant, n AS votes, total::BIGINT AS total FROM t WHERE k = 1 AND n >= 3 AND n >= total * 0.25",
)
def dominant_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: majorities with thresholds, first seen winning ties."""
    return relational.majority(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment", "c_custkey", 3, 0.25)


@query(
    "sanitize_terms",
    r"""WITH t AS (SELECT p_partkey AS ord, p_type || ' ' || p_partkey AS src, p_brand || ' X' AS dst, split_part(p_name, ' ', 1) AS head, p_brand AS reading FROM part),
q AS (SELECT *, CASE WHEN lower(src) IN ('small 5') THEN 'stop_word' WHEN NOT regexp_matches(dst, '(^| )\p{Lu}') THEN 'no_name' END AS why FROM t),
c AS (SELECT head, reading, count(*) AS n, min(ord) AS f FROM q WHERE why IS NULL GROUP BY ALL), k AS (SELECT *, sum(n) OVER (PARTITION BY head) AS total, row_number() OVER (PARTITION BY head ORDER BY n DESC, f) AS r FROM c),
d AS (SELECT head, reading AS dom FROM k WHERE r = 1 AND n >= 3 AND n >= total * 0.1)
SELECT ord, CASE WHEN why IS NULL AND dom IS NOT NULL AND dom <> reading THEN 'inconsistent' ELSE why END AS drop_reason FROM q LEFT JOIN d USING (head)""",
)
def sanitize_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: a dictionary without unsound and without inconsistent terms."""
    part = table(spark, sf_dir, "part")
    rows = part.select(
        F.col("p_partkey").alias("ord"), F.concat_ws(" ", "p_type", F.col("p_partkey").cast("string")).alias("src"), F.concat("p_brand", F.lit(" X")).alias("dst"), F.split("p_name", " ")[0].alias("head")
    )
    return terms.sanitize_terms(rows, ["small 5"], F.col("head"), 3, 0.1).select("ord", "drop_reason")


@query(
    "dedupe_latest",
    "SELECT o_orderkey, k::INT AS rank, CASE WHEN k = 1 THEN 'kept' ELSE 'older_duplicate' END AS verdict FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders)",
)
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest of each group stays."""
    orders = table(spark, sf_dir, "orders")
    return relational.latest_per_group(orders, ["o_custkey", "o_orderpriority"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_orderkey", "rank", "verdict")


@query(
    "distinct_targets",
    "SELECT user_id, coalesce(nullif(count(DISTINCT props) FILTER (event_type = 'purchase'), 0), count(DISTINCT props) FILTER (event_type = 'click')) AS n_targets FROM events GROUP BY user_id",
)
def distinct_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different targets of the preferred role, else of the other."""
    one = lambda kind: F.count_distinct(F.when(F.col("event_type") == kind, F.col("props")))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.coalesce(F.nullif(one("purchase"), F.lit(0)), one("click")).alias("n_targets"))


@query(
    "job_counts",
    "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'O') AS pending, count(*) FILTER (o_orderstatus = 'P') AS inflight, count(*) FILTER (o_orderstatus <> 'F' AND o_orderkey % 5 = 0) AS exhausted FROM orders GROUP BY ALL",
)
def job_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs by state."""
    state = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.count_if(state == "F").alias("done"),
        F.count_if(state == "O").alias("pending"),
        F.count_if(state == "P").alias("inflight"),
        F.count_if((state != "F") & (F.col("o_orderkey") % 5 == 0)).alias("exhausted"),
    )


@query("span", "SELECT o_orderpriority, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key, max(o_orderkey) FILTER (o_orderstatus = 'F') AS last_done FROM orders GROUP BY ALL")
def span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last numbers."""
    done = F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")))
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"), done.alias("last_done"))


@query(
    "fixed_chunks",
    "WITH r AS (SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 4 AS chunk FROM orders) SELECT o_custkey, chunk, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key, count(*) AS n_rows, sha256(string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey)) AS members_sha256 FROM r GROUP BY o_custkey, chunk",
)
def fixed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: runs of four orders of each customer."""
    from textloom.operators.sections import fixed_chunks as chunks

    return chunks(table(spark, sf_dir, "orders"), ["o_orderkey"], 4, ("o_custkey",))


@query(
    "quota_costs",
    "WITH c(event_type, unit_cost) AS (VALUES ('purchase', 1600), ('click', 50), ('view', 1)), s AS (SELECT user_id, sum(ceil(greatest(floor(value), 1) / 50) * coalesce(unit_cost, 1))::BIGINT AS spent FROM events LEFT JOIN c USING (event_type) GROUP BY user_id) SELECT user_id, spent, greatest(20000 - spent, 0)::BIGINT AS remaining, (greatest(20000 - spent, 0) // 1600)::BIGINT AS uploads_left FROM s",
)
def quota_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What operations cost and what is left."""
    costs = spark.createDataFrame([("purchase", 1600), ("click", 50), ("view", 1)], "event_type string, unit_cost int")
    events = table(spark, sf_dir, "events").select("user_id", "event_type", F.floor("value").alias("items"))
    return relational.quota_costs(events, costs, ["user_id"], "event_type", 20_000, 1600)


RULES = (BatchRule(1, 20, 5), BatchRule(21, 30, 2), BatchRule(95, 99, 5))


def _schedule_sql() -> str:
    """A walk batch by batch; rules and the gaps between them are segments that count their own batches."""
    first, last = "(n - 1) // 10 * 10 + 1", "(n - 1) // 10 * 10 + 10"
    for r in RULES:  # a later rule goes before an earlier one
        at = f"(n - {r.start}) // {r.size} * {r.size} + {r.start}"
        first, last = f"CASE WHEN n BETWEEN {r.start} AND {r.end} THEN {at} ELSE {first} END", f"CASE WHEN n BETWEEN {r.start} AND {r.end} THEN least({r.end}, {at} + {r.size - 1}) ELSE {last} END"
    segments, at = [], 1
    for r in sorted(RULES, key=lambda r: r.start):
        segments += [(at, r.start - 1, 10)] * (r.start > at) + [(r.start, r.end, r.size)]
        at = max(at, r.end + 1)
    before = " + ".join(f"CASE WHEN a > {lo} THEN (least({hi}, a - 1) - {lo}) // {size} + 1 ELSE 0 END" for lo, hi, size in [*segments, (at, 1 << 40, 10)])
    return f"""WITH RECURSIVE s AS (SELECT s_suppkey, s_suppkey % 150 + 1 AS low, s_suppkey % 150 + 25 AS high FROM supplier),
w(s_suppkey, low, high, n) AS (SELECT s_suppkey, low, high, low FROM s UNION ALL SELECT s_suppkey, low, high, ({last}) + 1 FROM w WHERE ({last}) + 1 <= high),
b AS (SELECT s_suppkey, low, high, ({first}) AS a, ({last}) AS z FROM w)
SELECT s_suppkey, low, high, a AS "start", z AS "end", {before} + 1 AS episode FROM b"""


@query("batch_schedule", _schedule_sql())
def batch_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches that each supplier's range meets."""
    low = (F.col("s_suppkey") % 150 + 1).alias("low")
    return ranges.batch_schedule(table(spark, sf_dir, "supplier").select("s_suppkey", low, (low + 24).alias("high")), "low", "high", RULES, 10)


@query(
    "reorder_positions",
    "SELECT o_orderkey, k AS desired, CASE WHEN k = o_orderkey % 10 THEN 'ok' ELSE 'move' END AS status FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END, o_totalprice DESC, o_orderkey) - 1 AS k FROM orders)",
)
def reorder_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each row should stand, and whether it does."""
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 0).when(F.col("o_orderpriority") == "2-HIGH", 1).otherwise(2)
    orders = table(spark, sf_dir, "orders").withColumn("now", F.col("o_orderkey") % 10)
    return relational.reordered(orders, ["o_custkey"], [rank, F.desc("o_totalprice"), F.col("o_orderkey")], "now").select("o_orderkey", "desired", "status")


@query(
    "topk_excess_lines",
    "SELECT doc_id, pos::INT AS pos FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length(line) DESC, pos) AS k FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents)) WHERE k > doc_id % 5",
)
def topk_excess_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines beyond the allowed number of longest ones."""
    rows = files.exploded_lines(table(spark, sf_dir, "documents"), ("doc_id",))
    return relational.top_excess(rows, ["doc_id"], [F.length("line").desc(), F.col("pos")], F.col("doc_id") % 5).select("doc_id", "pos")


@query(
    "union_first_wins",
    "WITH u AS (SELECT c_nationkey AS k, c_name AS v, c_custkey AS o, 0 AS layer FROM customer WHERE c_acctbal < 0 UNION ALL SELECT s_nationkey, s_name, s_suppkey, 1 FROM supplier) SELECT k, v, layer::INT AS layer FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY layer, o) AS r FROM u) WHERE r = 1",
)
def union_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earliest layer's row of each key."""
    a = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_nationkey").alias("k"), F.col("c_name").alias("v"), F.col("c_custkey").alias("o"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), F.col("s_name").alias("v"), F.col("s_suppkey").alias("o"))
    return relational.first_wins([a, b], ["k"], ["o"]).select("k", "v", "layer")


@query(
    "set_ops",
    "(SELECT 'both' AS kind, o_custkey AS k FROM orders INTERSECT SELECT 'both', c_custkey FROM customer WHERE c_acctbal > 0) UNION ALL (SELECT 'orders', o_custkey FROM orders EXCEPT SELECT 'orders', c_custkey FROM customer WHERE c_acctbal > 0) UNION ALL (SELECT 'customers', c_custkey FROM customer EXCEPT SELECT 'customers', o_custkey FROM orders)",
)
def set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intersection, and difference both ways, of customers with orders and customers."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    customers = table(spark, sf_dir, "customer")
    solvent, every = customers.where("c_acctbal > 0").select(F.col("c_custkey").alias("k")), customers.select(F.col("c_custkey").alias("k"))
    tag = lambda df, kind: df.select(F.lit(kind).alias("kind"), "k")
    return tag(orders.intersect(solvent), "both").union(tag(orders.subtract(solvent), "orders")).union(tag(every.subtract(orders), "customers"))


@query(
    "ordered_distinct",
    "WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS x, unnest(range(len(string_split(text, ' ')))) AS p FROM documents), f AS (SELECT doc_id, x, min(p) AS p FROM w GROUP BY doc_id, x) SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS words FROM f GROUP BY doc_id",
)
def ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different words in their first order."""
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.array_distinct(F.split("text", " ")), " ").alias("words"))


_MASKED = """replace(replace(replace(text, 'nation', 'ZXQ001QXZ'), 'there', 'ZXQ002QXZ'), 'the', 'ZXQ004QXZ')"""
TERMS = (("nation", "Land"), ("there", "dort"), ("over", "ZXQ009QXZ"), ("the", "Das"))


@query(
    "mask_terms",
    f"SELECT doc_id, {_MASKED} AS masked, replace(replace(replace({_MASKED}, 'ZXQ001QXZ', 'Land'), 'ZXQ002QXZ', 'dort'), 'ZXQ004QXZ', 'Das') AS unmasked FROM documents",
)
def mask_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """terms masked by tokens, and tokens replaced by targets."""
    pairs = F.array(*[F.struct(F.lit(a).alias("src"), F.lit(b).alias("dst")) for a, b in TERMS])
    masked = table(spark, sf_dir, "documents").select("doc_id", terms.mask("text", pairs).alias("masked"))
    return masked.select("doc_id", "masked", terms.unmask("masked", pairs).alias("unmasked"))


@query("reverse_index", "SELECT lower(trim(p_brand)) AS target, string_agg(p_name, '|' ORDER BY p_partkey, p_name) AS sources, count(DISTINCT p_name) AS n_sources FROM part GROUP BY 1")
def reverse_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of every target."""
    return terms.reverse_index(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ord"), F.col("p_name").alias("src"), F.col("p_brand").alias("dst")))


@query(
    "scoped_terms",
    "SELECT c_nationkey, c_name AS src FROM (SELECT *, sum(length(c_name) + length(c_mktsegment) + 2) OVER (PARTITION BY c_nationkey ORDER BY length(c_name) DESC, c_name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS u FROM customer) WHERE u <= 300",
)
def scoped_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """as many terms as a budget of characters holds."""
    rows = table(spark, sf_dir, "customer").select("c_nationkey", F.col("c_name").alias("src"), F.col("c_mktsegment").alias("dst"))
    return terms.scoped_terms(rows, ["c_nationkey"], 300).select("c_nationkey", "src")


@query(
    "merge_rules",
    "WITH u AS (SELECT s_nationkey AS number, s_name AS url, s_suppkey AS pos, 0 AS layer FROM supplier WHERE s_acctbal > 0 UNION ALL SELECT s_nationkey, s_name, s_suppkey, 1 FROM supplier), f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY number, url ORDER BY layer, pos) AS r FROM u) WHERE r = 1) SELECT number, url, row_number() OVER (PARTITION BY number ORDER BY layer, pos)::INT AS place FROM f",
)
def merge_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of two rule files in order, each once."""
    form = lambda df: df.select(F.col("s_nationkey").alias("number"), F.col("s_name").alias("url"), F.col("s_suppkey").alias("pos"))
    rows = table(spark, sf_dir, "supplier")
    return repair.merge_rules([form(rows.where("s_acctbal > 0")), form(rows)]).select("number", "url", "place")


@query("multi_key_sort", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def multi_key_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: several keys, nulls last, with a tie-break."""
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(F.asc_nulls_last("o_orderpriority"), F.desc_nulls_last("o_totalprice"), "o_orderkey")


@query("parse_url_param", "SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page FROM pages")
def parse_url_param(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a parameter of an address."""
    from textloom.sources.web import url_parameter

    return table(spark, sf_dir, "pages").select("page_id", url_parameter("url", "page").alias("page"))


@query("title_template", "SELECT c_custkey, 'Part ' || (c_custkey // 10 + 1) || ' | ' || c_name AS title FROM customer")
def title_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """titles from a template."""
    return table(spark, sf_dir, "customer").select("c_custkey", tx.template("Part {n} | {name}", n=F.expr("c_custkey div 10 + 1"), name="c_name").alias("title"))
