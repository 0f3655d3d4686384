"""Rule bitmask ledger for document quality.

Every rule is evaluated once per document.  The ledger keeps the measurements
and one bit per failed rule; a policy is a named, versioned mask over those
bits, so changing a policy or asking what each rule contributes never reads
the texts again: it is bitwise aggregation over the ledger.

Defined results: a null text has no words and all measurements 0 (it fails
``few_words``); an empty text likewise; repeated rows are judged row by row;
an empty table gives an empty ledger; other columns of the input, even ones
named like a measurement, are not read, since the ledger holds only its own
columns and the columns asked for in ``keys``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD_PATTERN, lean

_WORDS = re.compile(WORD_PATTERN)
_SYMBOLS = "#*$%&|<>"

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_lower",
    "n_distinct_words",
)


@dataclass(frozen=True)
class Rule:
    """A named failure test over the measurements; its place in RULES is its bit."""

    name: str
    fails: str


#: Order is the bit order and is append-only, so stored ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbol_heavy", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "n_lines >= 4 and 10 * n_dup_lines > 3 * n_lines"),
    Rule("shouting", "10 * n_upper > 3 * (n_upper + n_lower)"),
    Rule("long_words", "word_chars > 12 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("few_distinct_words", "n_words >= 50 and 100 * n_distinct_words < 15 * n_words"),
)

#: Policies by version: the rules whose failure rejects a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": ("few_words", "repeated_windows"),
    "v2": tuple(r.name for r in RULES),
}
CURRENT_POLICY = "v2"
BASE_RULES = ("few_words", "repeated_windows")


def mask_of(names: tuple[str, ...] | list[str]) -> int:
    """The bitmask of the named rules."""
    index = {r.name: i for i, r in enumerate(RULES)}
    return sum(1 << index[n] for n in set(names))


def repeated_window_words(words: list[str], width: int = 3) -> int:
    """Words covered by windows of ``width`` words that occur at least twice."""
    n = len(words)
    if n <= width:
        return 0
    seen: dict[str, int] = {}
    key = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    ids, span = key, len(seen)
    key = ids[: n - width + 1]
    for step in range(1, width):
        if len(seen) ** (step + 1) > 2**62:  # renumber before the combined key could overflow
            _, key = np.unique(key, return_inverse=True)
        key = key * span + ids[step : n - width + 1 + step]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(key), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    covered = np.zeros(n, bool)
    for step in range(width):
        covered[step : step + len(twice)] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """All measurements of one text, in the order of MEASURES."""
    if not text:
        return (0,) * len(MEASURES)
    words = _WORDS.findall(text)
    lines = [x for x in text.split("\n") if _WORDS.search(x)]
    upper = sum(map(str.isupper, letters)) if not (letters := re.sub(r"[^A-Za-z]+", "", text)).islower() else 0
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in _SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_window_words(words),
        len(lines),
        upper,
        len(letters) - upper,
        len(set(words)),
    )


def _measure_batches(n_keys: int, at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Measures column ``at``; the first ``n_keys`` columns go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t) for t in batch.column(at).to_pylist()]
            values = np.array(rows, np.int64).reshape(len(rows), len(MEASURES))
            yield pa.RecordBatch.from_arrays(
                batch.columns[:n_keys] + [pa.array(values[:, i]) for i in range(len(MEASURES))],
                names=[*batch.schema.names[:n_keys], *MEASURES],
            )

    return run


def rule_ledger(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys``, the measurements (long) and ``failed_bits`` (long) of every row."""
    whole = text in keys and docs.schema[text].dataType == T.StringType()
    source = docs.select(*keys) if whole else docs.select(*keys, F.col(text).cast("string").alias("__text"))
    fields = [source.schema[k] for k in keys] + [T.StructField(m, T.LongType(), False) for m in MEASURES]
    measured = source.mapInArrow(lean(_measure_batches(len(keys), keys.index(text) if whole else len(keys))), T.StructType(fields))
    bits = sum((F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, r in enumerate(RULES)), F.lit(0).cast("long"))
    return measured.withColumn("failed_bits", bits)


def fails(names: tuple[str, ...], bits: str = "failed_bits") -> Column:
    """Whether any of the named rules failed."""
    return F.col(bits).bitwiseAND(F.lit(mask_of(names))) != 0


def apply_policy(ledger: DataFrame, version: str = CURRENT_POLICY) -> DataFrame:
    """Adds ``kept`` under the policy and the policy's version."""
    return ledger.withColumn("kept", ~fails(POLICIES[version])).withColumn("policy", F.lit(version))


def passing_rows(docs: DataFrame, text: str = "text", version: str = CURRENT_POLICY) -> DataFrame:
    """The rows that a policy keeps, all their columns unchanged, whatever their names."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    judged = apply_policy(rule_ledger(plain, f"c{names.index(text)}", tuple(plain.columns)), version)
    return judged.where("kept").select(*plain.columns).toDF(*names)


def ablation(ledger: DataFrame, version: str = CURRENT_POLICY) -> DataFrame:
    """For each rule of a policy: rows it fails, rows only it rejects, rows kept without it.

    The ledger is first reduced to one row per distinct bit pattern, so the
    rest runs over at most 2^rules rows.
    """
    names = POLICIES[version]
    mask = mask_of(names)
    patterns = ledger.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(mask_of([n])).cast("long").alias("bit")) for n in names])
    one = patterns.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return one.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only_this_rule"),
        F.sum(F.when((F.col("bits") == 0) | (F.col("bits") == F.col("bit")), F.col("n")).otherwise(0)).alias("n_kept_without"),
    )
