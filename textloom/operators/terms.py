"""Term dictionaries: checking, masking, and finding terms in texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .relational import majority

#: Characters of the runs that substrings are looked for by, and the terms (and their characters) that may travel with the tasks instead.
GRAM = 6
MOST_TERMS, MOST_CHARS = 50_000, 2_000_000


def longest_first(terms: DataFrame, keys: Sequence[str] = ()) -> Column:
    """The terms of a group as an array of struct(src, dst), longest first, then alphabetical."""
    return F.transform(
        F.array_sort(F.collect_list(F.struct((-F.length("src")).alias("n"), "src", "dst"))), lambda t: F.struct(t["src"].alias("src"), t["dst"].alias("dst"))
    )


def mask(text: Column | str, terms: Column, prefix: str = "ZXQ", suffix: str = "QXZ") -> Column:
    """A text whose terms (array of struct(src, dst), longest first) are replaced by numbered tokens.

    A token's number counts every term, also those that are left alone because
    their target already holds a token.
    """
    text = F.col(text) if isinstance(text, str) else text
    numbered = F.transform(terms, lambda t, i: F.struct(t["src"].alias("src"), t["dst"].alias("dst"), F.format_string(f"{prefix}%03d{suffix}", i + 1).alias("token")))
    safe = lambda t: ~t["dst"].rlike(f"{prefix}\\d+{suffix}") & (t["src"] != "")
    return F.aggregate(F.filter(numbered, safe), text, lambda acc, t: F.replace(acc, t["src"], t["token"]))


def unmask(text: Column | str, terms: Column, prefix: str = "ZXQ", suffix: str = "QXZ") -> Column:
    """Tokens replaced by their targets; tokens that stand for nothing are dropped."""
    text = F.col(text) if isinstance(text, str) else text
    numbered = F.transform(terms, lambda t, i: F.struct(t["dst"].alias("dst"), F.format_string(f"{prefix}%03d{suffix}", i + 1).alias("token")))
    out = F.aggregate(numbered, text, lambda acc, t: F.replace(acc, t["token"], t["dst"]))
    return F.regexp_replace(out, f"{prefix}\\d*{suffix}", "")


def words_of(text: Column | str) -> Column:
    """Lower-case words of letters and digits."""
    return F.filter(F.split(F.lower(F.col(text) if isinstance(text, str) else text), r"(?U)[^\p{L}\p{N}]+"), lambda w: w != "")


def _grams(text: Column | str, size: int) -> Column:
    """All runs of ``size`` characters of a text, repeats included; the empty string for 0."""
    text = F.col(text) if isinstance(text, str) else text
    if not size:
        return F.when(text.isNotNull(), F.array(F.lit("")))
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))


def _found_terms(terms: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The different terms that each text (last column) holds, a row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = ahocorasick.Automaton()
        for t in filter(None, terms):
            matcher.add_word(t, t)
        matcher.make_automaton()
        always = [""] if "" in terms else []
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                here = [*always, *({t for _, t in matcher.iter(text)} if len(matcher) else ())]
                rows += [i] * len(here)
                found += here
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*[c.take(take) for c in batch.columns[:-1]], pa.array(found, pa.string())], names=[*batch.schema.names[:-1], "__term"])

    return run


#: Places of terms that a task holds before it hands them on.
MOST_PLACES = 100_000


def _term_places(terms: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every place of every term in each text (last column), a row for each, from one pass over the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = ahocorasick.Automaton()
        for k, t in enumerate(terms):
            matcher.add_word(t, k)
        matcher.make_automaton()
        names, sizes = pa.array(terms, pa.string()), np.array([len(t) for t in terms], np.int64)

        def told(batch: pa.RecordBatch, rows: list[int], counts: list[int], hits: list[tuple[int, int]]) -> pa.RecordBatch:
            last, which = np.array(hits, np.int64).reshape(-1, 2).T
            start, take = last + 1 - sizes[which], pa.array(np.repeat(np.array(rows, np.int64), counts))
            more = [names.take(pa.array(which)), pa.array(start.astype(np.int32)), pa.array((last + 1).astype(np.int32))]
            return pa.RecordBatch.from_arrays([*[c.take(take) for c in batch.columns[:-1]], *more], names=[*batch.schema.names[:-1], "term", "start", "end"])

        for batch in batches:
            rows, counts, hits = [], [], []
            for i, text in enumerate(batch.column(batch.num_columns - 1)):
                before = len(hits)
                hits += matcher.iter(text.as_py()) if len(matcher) else ()
                rows.append(i)
                counts.append(len(hits) - before)
                if len(hits) >= MOST_PLACES:
                    yield told(batch, rows, counts, hits)
                    rows, counts, hits = [], [], []
            yield told(batch, rows, counts, hits)

    return run


def _held_numbers(terms: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The numbers of the terms that each text (last column) holds, once each, in place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = ahocorasick.Automaton()
        for k, t in enumerate(terms):
            matcher.add_word(t, k)
        matcher.make_automaton()
        for batch in batches:
            held = [sorted({k for _, k in matcher.iter(t.as_py())} if len(matcher) else ()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(held, pa.list_(pa.int32()))], names=[*batch.schema.names[:-1], "__held"])

    return run


def held_numbers(texts: DataFrame, terms: Sequence[str], text: str) -> DataFrame:
    """``texts`` with ``__held`` in place of a text: the numbers of the few terms that it holds, none of them empty."""
    rest = texts.drop(text)
    schema = T.StructType([*rest.schema.fields, T.StructField("__held", T.ArrayType(T.IntegerType()))])
    return texts.select(*rest.columns, text).mapInArrow(_held_numbers(terms), schema)


def few_terms(terms: DataFrame, term: str) -> list[str] | None:
    """The different terms, if they may travel with the tasks; else null."""
    distinct = terms.select(term).where(F.col(term).isNotNull()).distinct()
    n, chars = distinct.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length(term)), F.lit(0))).first()
    return [r[0] for r in distinct.collect()] if n <= MOST_TERMS and chars <= MOST_CHARS else None


def places(texts: DataFrame, terms: Sequence[str], text: str, keys: Sequence[str]) -> DataFrame:
    """``keys, term, start, end`` of every place of few terms, none of them empty."""
    source = texts.select(*keys, F.col(text).cast("string").alias("__whole")).where("__whole is not null")
    kinds = {"term": T.StringType(), "start": T.IntegerType(), "end": T.IntegerType()}
    schema = T.StructType([*source.schema.fields[: len(keys)], *(T.StructField(n, k) for n, k in kinds.items())])
    return source.mapInArrow(_term_places(terms), schema)


def contained_strings(texts: DataFrame, terms: DataFrame, text: str, term: str, keys: Sequence[str], term_keys: Sequence[str]) -> DataFrame:
    """Which terms are substrings of which texts.

    Up to MOST_TERMS different terms of MOST_CHARS characters are sent to the
    tasks, which run over each text once (Aho-Corasick).  More are found by an
    equi-join: each term is looked for by its rarest run of GRAM characters.  A
    text that holds a term holds all its runs, so no match is lost; candidates
    are then tested for the whole term, and a term shorter than a run is looked
    for by itself.  Repeated rows on either side give repeated matches.
    """
    named = terms.select(*term_keys, F.col(term).alias("__term")).where("__term is not null")
    distinct = named.select("__term").distinct()
    n, chars = distinct.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("__term")), F.lit(0))).first()
    if n <= MOST_TERMS and chars <= MOST_CHARS:
        few = [r[0] for r in distinct.collect()]
        source = texts.select(*keys, F.col(text).cast("string").alias("__whole")).where("__whole is not null")
        schema = T.StructType([*source.schema.fields[: len(keys)], T.StructField("__term", T.StringType())])
        return source.mapInArrow(_found_terms(few), schema).join(named, "__term").select(*keys, *term_keys)
    each = distinct.withColumn("__size", F.least(F.length("__term"), F.lit(GRAM)))
    sizes = sorted(r[0] for r in each.select("__size").distinct().collect()) or [GRAM]
    asked = each.select("__term", F.explode(F.coalesce(*[F.when(F.col("__size") == n, _grams("__term", n)) for n in sizes])).alias("__gram")).distinct()
    held = texts.select(*keys, F.explode(F.concat(*[_grams(text, n) for n in sizes])).alias("__gram"))
    held = held.join(asked.select("__gram").distinct(), "__gram", "left_semi").distinct()
    frequency = held.groupBy("__gram").agg(F.count(F.lit(1)).alias("__n"))
    filed = asked.join(frequency, "__gram", "left").withColumn("__n", F.coalesce("__n", F.lit(0)))
    rarest = filed.groupBy("__term").agg(F.min_by("__gram", F.struct("__n", "__gram")).alias("__gram"))
    candidates = held.join(rarest, "__gram").select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)], "__term")
    same = [F.col(f"__{i}").eqNullSafe(F.col(k)) for i, k in enumerate(keys)]
    whole = candidates.join(texts.select(*keys, F.col(text).alias("__whole")), same)
    return whole.where(F.contains("__whole", "__term")).select(*keys, "__term").join(named, "__term").select(*keys, *term_keys)


def term_quality(terms: DataFrame, stop: Sequence[str], least: int = 2) -> DataFrame:
    """Terms with ``drop_reason``: empty, numeric, short, stop word, same as target, or target in lower case."""
    src, dst = F.trim("src"), F.trim("dst")
    reason = (
        F.when((src == "") | (dst == ""), "empty")
        .when(src.rlike(r"^[0-9.,:%/ -]+$"), "numeric")
        .when(F.length(src) < least, "short")
        .when(F.lower(src).isin(*stop) if stop else F.lit(False), "stop_word")
        .when(F.lower(src) == F.lower(dst), "unchanged")
        .when(~F.exists(F.split(dst, " +"), lambda w: F.substring(w, 1, 1).rlike(r"\p{Lu}")), "no_name")
    )
    return terms.withColumn("drop_reason", reason)


def sanitize_terms(terms: DataFrame, stop: Sequence[str], head: Column, least: int = 3, share: float = 0.7, keep_all: bool = False) -> DataFrame:
    """Terms with ``drop_reason``; sources that share ``head`` must agree on the first word of the target.

    The agreement is the majority's among terms that are sound otherwise, first
    seen winning ties.  Without any agreement at all nothing is dropped for it.
    """
    judged = term_quality(terms, () if keep_all else stop).withColumn("__head", head).withColumn("__reading", F.get(F.split(F.trim("dst"), " +"), F.lit(0)))
    sound = judged.where("drop_reason is null and __head is not null")
    agreed = majority(sound, "__head", "__reading", "ord", least, share).select("__head", "dominant")
    joined = judged.join(agreed, "__head", "left")
    clash = F.col("drop_reason").isNull() & F.col("dominant").isNotNull() & (F.col("dominant") != F.col("__reading"))
    return joined.withColumn("drop_reason", F.when(clash, "inconsistent").otherwise(F.col("drop_reason"))).select(*terms.columns, "drop_reason")


def reverse_index(terms: DataFrame) -> DataFrame:
    """Each target with its sources in their first order; targets of several sources are ambiguous."""
    ordered = F.array_sort(F.collect_list(F.struct("ord", "src")))
    return terms.groupBy(F.lower(F.trim("dst")).alias("target")).agg(
        F.array_join(F.transform(ordered, lambda t: t["src"]), "|").alias("sources"), F.count_distinct("src").alias("n_sources")
    )


def scoped_terms(matches: DataFrame, keys: Sequence[str], budget: int) -> DataFrame:
    """Of the terms in a text (``src, dst``), longest sources first, as many as a character budget holds."""
    order = Window.partitionBy(*keys).orderBy(F.length("src").desc(), "src")
    cost = F.length("src") + F.length("dst") + 2
    return matches.withColumn("used", F.sum(cost).over(order.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("used") <= budget)
