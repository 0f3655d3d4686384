"""Texts cut into ordered sections, and put together again.

Order is carried in ``pos``; every rebuild sorts by it, so no operator relies
on the order in which rows arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import WHITE, let, lines, normalize_whitespace, strip

SEPARATOR = "\n\n\n"


def split_sections(texts: DataFrame, heading: str, keys: tuple[str, ...], text: str = "text") -> DataFrame:
    """``keys, pos, number, title, body`` of every section; what stands before the first heading is left out.

    ``heading`` matches a whole heading's start at the start of a line, its
    first group being the number.  Repeated numbers stay.
    """
    blocks = F.split(F.col(text), f"(?md)(?={heading})")
    at = texts.select(*keys, F.posexplode(blocks).alias("pos", "block")).where(F.col("block").rlike(rf"\A{heading.lstrip('^')}"))
    block = F.regexp_replace("block", r"\A\n+|\n+\z", "")
    cut = F.locate("\n", F.col("block"))
    body = F.when(cut > 0, F.expr("substring(block, locate('\n', block) + 1)")).otherwise("")
    title = F.when(cut > 0, F.expr("substring(block, 1, locate('\n', block) - 1)")).otherwise(F.col("block"))
    at = at.withColumn("block", block)
    return at.select(
        *keys, "pos", F.regexp_extract("block", heading, 1).cast("int").alias("number"), strip(title).alias("title"), strip(body).alias("body")
    )


def merge_consecutive(sections: DataFrame, keys: tuple[str, ...], number: str = "number", text: str = "body") -> DataFrame:
    """Neighbouring sections of one number as one, bodies joined by a blank line; empty ones dropped."""
    order = Window.partitionBy(*keys).orderBy("pos")
    starts = F.when(F.lag(number).over(order).eqNullSafe(F.col(number)), 0).otherwise(1)
    island = sections.withColumn("island", F.sum(starts).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("pos", F.col(text).alias("x"))))
    merged = island.groupBy(*keys, "island", number).agg(F.min("pos").alias("pos"), F.array_join(F.transform(parts, lambda p: p["x"]), "\n\n").alias(text))
    return merged.where(strip(text) != "").drop("island")


def heading_index(texts: DataFrame, heading: str, keys: tuple[str, ...], text: str = "text") -> DataFrame:
    """Per text: how many headings, how many numbers, the largest, and the numbers in first-seen order."""
    numbers = F.transform(F.regexp_extract_all(F.col(text), F.lit(f"(?md){heading}"), F.lit(1)), lambda x: x.cast("int"))
    return texts.select(
        *keys,
        F.size(numbers).alias("n_headings"),
        F.size(F.array_distinct(numbers)).alias("n_numbers"),
        F.array_max(numbers).alias("max_number"),
        F.array_join(F.array_distinct(numbers).cast("array<string>"), ",").alias("numbers"),
    )


def titles_by_number(sections: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The last non-empty title of each number."""
    return sections.where("title <> ''").groupBy(*keys, "number").agg(F.max_by("title", "pos").alias("title"))


def join_blocks(blocks: DataFrame, keys: tuple[str, ...], block: str = "block", separator: str = SEPARATOR) -> DataFrame:
    """One text per key: blocks in order of ``pos``, stripped, the whole ended by a line feed."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", F.col(block).alias("x"))))
    text = F.array_join(F.transform(ordered, lambda p: p["x"]), separator)
    return blocks.groupBy(*keys).agg(F.concat(strip(text), F.lit("\n")).alias("text"), F.count(F.lit(1)).alias("n_blocks"))


def upsert_merge(existing: DataFrame, new: DataFrame, keys: tuple[str, ...], number: str = "number") -> DataFrame:
    """Blocks of both, one for each number: the last of ``new`` wins, else the first of ``existing``.

    Both have ``keys``, ``number``, ``pos`` and ``block``.
    """
    rank = Window.partitionBy(*keys, number).orderBy("source", F.when(F.col("source") == 0, -F.col("pos")).otherwise(F.col("pos")))
    both = new.withColumn("source", F.lit(0)).unionByName(existing.withColumn("source", F.lit(1)))
    return both.withColumn("rank", F.row_number().over(rank)).where("rank = 1").drop("rank", "source")


def drop_adjacent(items: DataFrame, keys: tuple[str, ...], value: str) -> DataFrame:
    """Rows whose value is not that of the row before."""
    order = Window.partitionBy(*keys).orderBy("pos")
    before = F.lag(value).over(order)
    return items.withColumn("same", before.eqNullSafe(F.col(value)) & (F.row_number().over(order) > 1)).where("not same").drop("same")


def adjacent_free_text(text: Column | str) -> Column:
    """A text without lines that repeat the line before; blank lines always stay."""
    fresh = lambda xs: lambda x, i: (i == 0) | (x == "") | (x != F.get(xs, i - 1))
    return F.array_join(let(lines(text), lambda xs: F.filter(xs, fresh(xs))), "\n")


def canonical_block(title: Column | str, body: Column | str) -> Column:
    """Title, blank line, body; the title's repetition at the body's start is dropped."""
    name = normalize_whitespace(title)
    rest = lines(body)
    # Lines from the first that is neither blank nor the title.
    kept = F.aggregate(
        rest,
        F.array().cast("array<string>"),
        lambda acc, x: F.when((F.size(acc) == 0) & ((normalize_whitespace(x) == "") | (normalize_whitespace(x) == name)), acc).otherwise(
            F.concat(acc, F.array(F.rtrim(x, F.lit(WHITE))))
        ),
    )
    text = strip(F.array_join(kept, "\n"))
    return F.when(text == "", name).otherwise(F.concat(name, F.lit("\n\n"), text))


def context_lines(text: Column | str, pattern: str) -> Column:
    """Lines that match ``pattern`` and their neighbours, in order."""
    hit = lambda xs, i: F.coalesce(F.get(xs, i).rlike(pattern), F.lit(False))
    return let(lines(text), lambda xs: F.filter(xs, lambda x, i: hit(xs, i) | hit(xs, i - 1) | hit(xs, i + 1)))


def pack_chunks(items: Column, size: int) -> Column:
    """Greedy packing in order: the number of the chunk of every item, chunks of at most ``size``.

    ``items`` is an array of lengths; a longer item is a chunk of its own.
    """
    start = F.struct(F.lit(0).cast("long").alias("held"), F.lit(0).alias("chunk"), F.array().cast("array<int>").alias("out"))

    def add(acc: Column, n: Column) -> Column:
        fits = (acc["held"] > 0) & (acc["held"] + n <= size)
        chunk = F.when(fits, acc["chunk"]).otherwise(acc["chunk"] + 1)
        held = F.when(fits, acc["held"] + n).otherwise(n)
        return F.struct(held.cast("long").alias("held"), chunk.alias("chunk"), F.concat(acc["out"], F.array(chunk)).alias("out"))

    return F.aggregate(items, start, add, lambda acc: acc["out"])


def fixed_chunks(rows: DataFrame, order: list[str], size: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Runs of ``size`` rows in order: chunk number, first, last, count and a hash of the members.

    With ``keys`` every group is chunked on its own, which keeps groups in separate tasks.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    members = F.array_sort(F.collect_list(F.struct("place", F.col(order[0]).cast("string").alias("x"))))
    dealt = rows.withColumn("place", place).withColumn("chunk", F.floor(F.col("place") / size).cast("long"))
    return dealt.groupBy(*keys, "chunk").agg(
        F.min(order[0]).alias("first_key"),
        F.max(order[0]).alias("last_key"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sha2(F.array_join(F.transform(members, lambda m: m["x"]), ","), 256).alias("members_sha256"),
    )
