"""Structured Streaming queries: each runs over all files of a table, then stops, and its sink is read back."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.polish import packed
from textloom.operators.replay import Limits
from textloom.shared import materialize, shared_dir
from textloom.streaming import state, stateful
from textloom.streaming import usage as streaming

from .registry import query, table


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share."""
    return f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}"


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream, ``at`` being their time as a timestamp."""
    static = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(static.schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")
    return stream.withColumn("at", F.col("ts").cast("timestamp")).withColumn("tokens", F.round("value").cast("long"))


def closed_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, and after them a row without ids a month later, which lets the watermark pass them all."""
    static = table(spark, sf_dir, "events")
    late = static.agg((F.max("ts") + F.expr("interval 30 days")).alias("ts")).select(*[F.col(c) if c == "ts" else F.lit(None).cast(t).alias(c) for c, t in static.dtypes])
    folder = f"{shared_folder(spark)}/closing"
    late.write.parquet(folder)
    closing = spark.readStream.schema(static.schema).parquet(folder)
    return event_stream(spark, sf_dir).unionByName(closing.withColumn("at", F.col("ts").cast("timestamp")).withColumn("tokens", F.lit(None).cast("long")))


def run_to_end(stream: DataFrame, mode: str) -> DataFrame:
    """Runs a stream over what there is; ``complete`` and ``update`` results replace those of the batch before."""
    spark, folder = stream.sparkSession, shared_folder(stream.sparkSession)
    out = f"{folder}/out"
    writer = stream.writeStream.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    if mode == "append":
        running = writer.format("parquet").option("path", out).start()
    else:
        running = writer.outputMode(mode).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).start()
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query(
    "stream_windows",
    "SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) // 1000000 AS window_start, event_type, count(*) AS requests, sum(round(value)::BIGINT)::BIGINT AS used_tokens FROM events GROUP BY ALL",
)
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1, T7 as a stream: requests and tokens of each hour and model."""
    done = run_to_end(streaming.windowed_usage(event_stream(spark, sf_dir), ["event_type"], "at", "tokens", "1 hour"), "complete")
    return done.select(F.unix_seconds("window_start").alias("window_start"), "event_type", "requests", "used_tokens")


@query(
    "stream_bursts",
    "WITH e AS (SELECT event_id, user_id, epoch_us(ts) AS us FROM events WHERE event_type = 'error'), w AS (SELECT event_id, count(*) OVER o AS n_events, len(list_distinct(list(user_id) OVER o)) AS n_members FROM e WINDOW o AS (ORDER BY us RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW)) SELECT event_id, n_events::INT AS n_events, n_members::INT AS n_members FROM w WHERE n_events >= 3 AND n_members >= 3",
)
def stream_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 as a stream: errors that end an hour with errors of several keys, told when the watermark has passed their block."""
    errors = closed_event_stream(spark, sf_dir).where("event_type = 'error' or event_id is null")
    with stateful.rocksdb_state(spark):
        return run_to_end(stateful.bursts(errors, "at", "user_id", "event_id", 3600, 3, 3), "append")


@query("stream_new_jobs", "SELECT DISTINCT props FROM events")
def stream_new_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T10 as a stream: every job once."""
    jobs = event_stream(spark, sf_dir).select("props", "at")
    return run_to_end(streaming.new_jobs(jobs, "props", "at", "60 days"), "append").select("props")


@query("stream_admission")
def stream_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2, T9 as a stream: admission with the state of each key."""
    limits = Limits(rpm=2, tpm=150, rpd=4)
    with stateful.rocksdb_state(spark):
        return run_to_end(stateful.admission(closed_event_stream(spark, sf_dir), ["user_id"], limits, "at", "event_id", "tokens"), "append")


@query("staged_watch", "SELECT event_type, count(*) AS n FROM events WHERE value > 5 GROUP BY ALL")
def staged_watch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages run on every micro-batch, the second on what the first has written."""
    folder = shared_folder(spark)

    def accept(batch: DataFrame, number: int) -> None:
        batch.where("value > 5").select("event_id", "event_type").write.mode("overwrite").parquet(f"{folder}/accepted/batch={number}")

    def count(batch: DataFrame, number: int) -> None:
        accepted = spark.read.parquet(f"{folder}/accepted/batch={number}")
        accepted.groupBy("event_type").count().write.mode("overwrite").parquet(f"{folder}/counted/batch={number}")

    streaming.staged(event_stream(spark, sf_dir), [accept, count], f"{folder}/checkpoint").awaitTermination()
    counted = spark.read.parquet(f"{folder}/counted")
    return counted.groupBy("event_type").agg(F.sum("count").alias("n"))


@query("watch_state", "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def watch_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: what was last seen of every key, kept as a table."""
    folder = shared_folder(spark)
    seen = event_stream(spark, sf_dir).select("user_id", "event_id", "event_type", "value")
    state.keep_state(seen, ["user_id"], "event_id", f"{folder}/state", f"{folder}/checkpoint").awaitTermination()
    return state.load_state(spark, f"{folder}/state")


#: A provider turns texts into texts; a real one would call a model.
Provider = Callable[[list[str]], list[str]]


def reversed_words(texts: list[str]) -> list[str]:
    """A deterministic stand-in for a provider."""
    return [" ".join(reversed(t.split(" "))) for t in texts]


#: Characters of texts that a provider is asked for at once; a longer text goes alone.
ASKED_CHARS = 1 << 20


def provided(rows: DataFrame, provider: Provider, text: str, out: str) -> DataFrame:
    """Adds ``out``: what a provider makes of a text, asked for about ASKED_CHARS characters at once; null texts are not asked for."""
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.StringType())])
    at = rows.columns.index(text)

    def answers(texts: pa.Array) -> Iterator[str | None]:
        asked: list[str | None] = []
        size = 0
        for i, t in enumerate(texts):
            asked.append(t.as_py())
            size += len(asked[-1] or "")
            if size >= ASKED_CHARS or i == len(texts) - 1:
                made = iter(provider(there) if (there := [x for x in asked if x is not None]) else ())
                yield from (None if x is None else next(made) for x in asked)
                asked, size = [], 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Built value by value: neither a frame nor all texts of a batch are Python objects at once.
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(answers(batch.column(at)), pa.string(), size=batch.num_rows)], names=schema.names)

    return rows.mapInArrow(run, schema)


def translated(rows: DataFrame, keys: list[str], text: str, provider: Provider, repairs: list[tuple[Callable[[Column], Column], Provider]], most: int = 800) -> DataFrame:
    """``keys, translated``: texts cut into chunks of whole lines, each made by a provider and, while something is wrong with it, by those after it.

    ``repairs`` are (what is wrong, provider) in their order; a repair sees only
    the chunks that are wrong by its own test.  A text without lines is empty.

    What a provider has made is written before it is tested, and of a repair only
    the repaired chunks: a task has one Python worker at a time, however many
    repairs there are, sound chunks pass none of them, and nothing is asked for twice.
    """
    chunks = rows.select(*keys, F.posexplode_outer(packed(F.split(F.coalesce(text, F.lit("")), "\n"), most)).alias("pos", "chunk"))
    made = materialize(provided(chunks, provider, "chunk", "made").select(*keys, "pos", "made"))
    for wrong, repair in repairs:
        bad = F.coalesce(wrong(F.col("made")), F.lit(False))
        again = provided(made.where(bad), repair, "made", "again").withColumn("made", F.coalesce("again", "made"))
        made = made.where(~bad).unionByName(materialize(again.select(*keys, "pos", "made")))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "made"))), lambda c: c["made"]), "\n")
    return made.groupBy(*keys).agg(whole.alias("translated"))


@query("translate_stub", "SELECT doc_id, array_to_string(list_reverse(string_split(text, ' ')), ' ') AS translated FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def translate_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only parts that are not done yet go to the provider."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = table(spark, sf_dir, "labels").select("doc_id")
    return provided(docs.join(done, "doc_id", "left_anti"), reversed_words, "text", "translated").select("doc_id", "translated")


@query(
    "translate_cascade",
    r"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS ls FROM documents),
m AS (SELECT doc_id, list_transform(ls, lambda x: array_to_string(list_reverse(string_split(x, ' ')), ' ')) AS ms FROM l),
r AS (SELECT doc_id, list_transform(ms, lambda x: CASE WHEN regexp_matches(x, '[#*$%&]') THEN regexp_replace(x, '[#*$%&]+', '', 'g') ELSE x END) AS ms FROM m)
SELECT doc_id, array_to_string(list_transform(ms, lambda x: CASE WHEN regexp_matches(x, '[0-9]{8}') THEN regexp_replace(x, '[0-9]', '0', 'g') ELSE x END), chr(10)) AS translated FROM r""",
)
def translate_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents line by line through a provider and two repairs."""
    clean = lambda texts: [re.sub(r"[#*$%&]+", "", t) for t in texts]
    zero = lambda texts: [re.sub("[0-9]", "0", t) for t in texts]
    repairs = [(lambda c: c.rlike("[#*$%&]"), clean), (lambda c: c.rlike("[0-9]{8}"), zero)]
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return translated(docs, ["doc_id"], "text", reversed_words, repairs, most=0)
