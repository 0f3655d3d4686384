"""Text-file sources and sinks: batches, captions, logs, markdown notes and layered settings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions.text import lines

BATCH_NAME = r"chuong_(\d+)-(\d+)\.txt$"
#: Files without a number in their name come last.
LAST = 1_000_000_000_000


def with_batch_range(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Adds ``batch_start, batch_end`` from a file name; null where it has none."""
    part = lambda i: F.regexp_extract(name, BATCH_NAME, i).try_cast("long")
    return files.withColumn("batch_start", part(1)).withColumn("batch_end", part(2))


def read_batches(spark: SparkSession, folder: str) -> DataFrame:
    """``file_name, value, batch_start, batch_end``: whole batch files, line ends as line feeds."""
    raw = spark.read.text(f"{folder}/chuong_*.txt", wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), "value")
    plain = F.regexp_replace("value", "\r\n?| |\u0085|\f", "\n")
    return with_batch_range(raw.withColumn("value", plain))


def batch_order(rows: DataFrame) -> DataFrame:
    """Batches by first number, unnamed ones last."""
    return rows.orderBy(F.coalesce("batch_start", F.lit(LAST)), "file_name")


def write_batches(batches: DataFrame, folder: str) -> None:
    """Batches ``batch_start, batch_end, text`` as Parquet, a partition for each start; only the partitions written are replaced."""
    writer = batches.repartition("batch_start").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch_start").parquet(folder)


def exploded_lines(texts: DataFrame, keys: tuple[str, ...], text: str = "text") -> DataFrame:
    """``keys, pos, line``."""
    return texts.select(*keys, F.posexplode(lines(text)).alias("pos", "line"))


def caption_lines(texts: DataFrame, keys: tuple[str, ...], text: str = "text") -> DataFrame:
    """Text lines of SubRip captions: after a number and a time line, up to a blank line."""
    order = Window.partitionBy(*keys).orderBy("pos")
    every = exploded_lines(texts, keys, text).withColumn("line", F.trim("line"))
    start = every["line"].rlike(r"^\d+$") & F.lead("line").over(order).contains("-->")
    role = F.when(F.col("line") == "", "blank").when(start, "index").when(F.col("line").contains("-->"), "time")
    marked = every.withColumn("role", role)
    before = F.last("role", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return marked.withColumn("before", before).where("role is null and before = 'time'").select(*keys, "pos", "line")


def carried_sections(rows: DataFrame, keys: tuple[str, ...], heading: str, order: str = "pos", line: str = "line", fence: str = "```") -> DataFrame:
    """Lines with the number of the last heading above them; lines in code fences are told apart by ``fenced``."""
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    fences = F.sum(F.when(F.col(line).startswith(fence), 1).otherwise(0)).over(window)
    number = F.nullif(F.regexp_extract(line, heading, 1), F.lit("")).try_cast("int")
    marked = rows.withColumn("fenced", (fences % 2 == 1) & ~F.col(line).startswith(fence))
    return marked.withColumn("number", F.last(F.when(~F.col("fenced"), number), ignorenulls=True).over(window))


def numbers_in(text: Column | str) -> Column:
    """All whole numbers of up to five digits in a text, in order."""
    found = F.regexp_extract_all(F.col(text) if isinstance(text, str) else text, F.lit(r"(?<![0-9])([0-9]{1,5})(?![0-9])"), F.lit(1))
    return F.transform(found, lambda x: x.cast("int"))


def parsed_log(rows: DataFrame, line: str = "line") -> DataFrame:
    """``at, level, message`` and what the message tells: waiting time, model, tokens."""
    part = lambda i: F.regexp_extract(line, r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}) \| *([A-Z]+) *\| ?(.*)$", i)
    number = lambda p: F.nullif(F.regexp_extract("message", p, 1), F.lit(""))
    parsed = rows.withColumn("at", F.try_to_timestamp(F.nullif(F.replace(part(1), F.lit(","), F.lit(".")), F.lit(""))))
    parsed = parsed.withColumn("level", F.nullif(part(2), F.lit(""))).withColumn("message", F.when(F.col("at").isNotNull(), part(3)).otherwise(F.col(line)))
    return (
        parsed.withColumn("wait_seconds", number(r"suggested_wait=([0-9.]+)s").try_cast("double"))
        .withColumn("model", F.coalesce(number(r"blocked_model=([\w.\-]+)"), number(r"\bmodel=([\w.\-]+)")))
        .withColumn("tokens", number(r"estimated_tokens=(\d+)").try_cast("long"))
    )


def log_tail(rows: DataFrame, keys: tuple[str, ...], order: str, count: int = 80, most_bytes: int = 16_384, line: str = "line") -> DataFrame:
    """The last lines of each log: ``count`` at most, and as many as ``most_bytes`` hold."""
    window = Window.partitionBy(*keys).orderBy(F.desc(order))
    size = F.sum(F.octet_length(line) + 1).over(window.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("place", F.row_number().over(window)).withColumn("size", size).where((F.col("place") <= count) & (F.col("size") <= most_bytes)).drop("place", "size")


def process_rows(rows: DataFrame, command: str = "command") -> DataFrame:
    """Role and named arguments of process-table command lines."""
    words = F.split(F.trim(command), r"\s+")
    after = lambda flag: F.get(words, F.nullif(F.array_position(words, flag), F.lit(0)).cast("int"))
    return rows.select(
        "*",
        F.when(F.array_contains(words, "supervisor"), "supervisor")
        .when(F.array_contains(words, "worker"), "worker")
        .when(F.array_contains(words, "translate"), "translate-chapter")
        .when(F.array_contains(words, "monitor"), "status-monitor")
        .alias("role"),
        after("--key-index").try_cast("int").alias("key_index"),
        after("--model").alias("model"),
        F.when(after("--file").isNotNull() & after("--chapter").isNotNull(), F.concat_ws(":", F.element_at(F.split(after("--file"), "/"), -1), F.lpad(after("--chapter"), 4, "0"))).alias("target"),
    )


def setting_rows(spark: SparkSession, layers: list[Mapping[str, str]]) -> DataFrame:
    """Settings of all layers, the last layer that names a key winning.  Layers are configuration, held on the driver."""
    for layer in layers:
        for k, v in layer.items():
            if not isinstance(k, str) or not isinstance(v, str):
                raise ValueError(f"setting {k!r} must map a string to a string")
    merged = {k: (v, i) for i, layer in enumerate(layers) for k, v in layer.items()}
    return spark.createDataFrame([(k, v, i) for k, (v, i) in merged.items()], "name string, value string, layer int")


def deep_merge(base: dict, override: dict) -> dict:
    """Nested settings: maps merge key by key, anything else is replaced."""
    out = dict(base)
    for k, v in override.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def flat_json(rows: DataFrame, column: str, fields: Mapping[str, str]) -> DataFrame:
    """Fields of a JSON column by path (``$.a.b``), counts kept as strings."""
    return rows.select("*", *[F.get_json_object(column, path).alias(name) for name, path in fields.items()])
