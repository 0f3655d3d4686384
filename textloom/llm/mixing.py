"""Mixing sources to target weights by hierarchical budgeting, all DataFrame functions.

Leaves are (domain, lang, source).  A token budget flows down the tree by
weight; a child that cannot hold its share is filled and the rest goes to its
siblings, and only what no sibling can hold reaches the level above.  Within a
leaf the budget buys whole epochs and then a token prefix of the next one,
each epoch being ordered by a seeded hash.

The prefix needs no global sort of a leaf: tokens are summed by hash bucket,
one bucket per leaf holds the cut, and only that bucket is ordered.  Budgets
are exact integers (decimals), so the result does not depend on summation order.

Defined results: null domain, language or source is the leaf value
``unknown``; a null or empty text has no tokens; rows that share a doc_id in a
leaf are taken or left together, and rows without one those that share a text;
a leaf without tokens gets nothing; an empty table gives an empty result; a
column of the input that is named like an added column is replaced by it, but
``mixed_rows`` gives all columns back as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, materialize

LEVELS = ("domain", "lang", "source")
_WIDE = "decimal(38,0)"


def word_tokens(text: str = "text") -> Column:
    """Whitespace words of a text, as the default token measure."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def ident_of(key: str = "doc_id", text: str = "text") -> Column:
    """What tells rows of a leaf apart: the key, or the text of a row without one."""
    return F.coalesce(F.col(f"`{key}`").cast("string"), F.concat(F.lit("~"), F.md5(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))))


def _weight(level: str, weights: dict[str, int], default: int) -> Column:
    column = F.lit(default)
    for name, weight in weights.items():
        column = F.when(F.col(level) == name, F.lit(weight)).otherwise(column)
    return column.cast(_WIDE)


def _pour(nodes: DataFrame, parent: tuple[str, ...], level: str, weights: dict[str, int], default: int) -> DataFrame:
    """Splits each parent's ``budget`` over its children by weight, none above its ``capacity``.

    Children are filled in the order in which a rising level reaches their
    capacity; the first that the level does not reach shares what is left with
    those after it.
    """
    w = nodes.withColumn("w", _weight(level, weights, default))
    order = Window.partitionBy(*parent).orderBy(F.col("capacity").cast("double") / F.col("w").cast("double"), level)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    w = (
        w.withColumn("left", F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0)).cast(_WIDE))
        .withColumn("rest", F.sum("w").over(onward).cast(_WIDE))
        .withColumn("open", (F.col("capacity") * F.col("rest")).cast(_WIDE) >= (F.col("w") * F.col("left")).cast(_WIDE))
    )
    first = Window.partitionBy(*parent).orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = w.withColumn("rank", F.row_number().over(order))
    pick = lambda c: F.first(F.when(F.col("open"), F.col(c)), ignorenulls=True).over(first)
    w = w.withColumn("level_left", pick("left")).withColumn("level_rest", pick("rest"))
    share = F.expr("cast((w * level_left) div level_rest as decimal(38,0))")
    given = F.when(F.col("level_left").isNull(), F.col("capacity")).otherwise(F.least("capacity", share))
    return w.withColumn("budget", F.greatest(given, F.lit(0).cast(_WIDE))).select(*nodes.columns)


def leaf_budgets(
    totals: DataFrame,
    budget: int | Column,
    weights: dict[str, dict[str, int]],
    defaults: dict[str, int],
    max_epochs: int,
) -> DataFrame:
    """``(domain, lang, source, tokens, budget)`` from ``(domain, lang, source, tokens)``.

    ``budget`` is a number of tokens, or a column over the totals' sum, which
    is at hand as ``all_tokens``.
    """
    leaves = totals.select(*LEVELS, F.col("tokens").cast(_WIDE).alias("tokens"))
    capacity = (F.col("tokens") * F.lit(max_epochs)).cast(_WIDE)
    whole = leaves.agg(F.sum("tokens").alias("all_tokens")).select(
        F.least(F.expr("all_tokens * %d" % max_epochs).cast(_WIDE), (budget if isinstance(budget, Column) else F.lit(budget)).cast(_WIDE)).alias("budget")
    )
    have = whole
    parent: tuple[str, ...] = ()
    for level in LEVELS:
        here = (*parent, level)
        nodes = leaves.groupBy(*here).agg(F.sum(capacity).cast(_WIDE).alias("capacity"))
        nodes = nodes.join(have, list(parent)) if parent else nodes.join(have, F.lit(True))
        have = _pour(nodes.select(*here, "capacity", "budget"), parent, level, weights.get(level, {}), defaults.get(level, 1)).select(*here, "budget")
        parent = here
    return leaves.join(have, list(LEVELS)).select(
        *LEVELS, F.col("tokens").cast("long").alias("tokens"), F.col("budget").cast("long").alias("budget")
    )


def mix(
    docs: DataFrame,
    budget: int | Column,
    weights: dict[str, dict[str, int]],
    domain: Column,
    tokens: Column | None = None,
    defaults: dict[str, int] | None = None,
    max_epochs: int = 1,
    seed: int = 0,
    key: str = "doc_id",
    text: str = "text",
    ident: Column | None = None,
    order_digits: int = 3,
) -> DataFrame:
    """The rows of ``docs`` that the mixture takes, with ``copies`` (1 or more), ``n_tokens`` and ``domain``.

    ``order_digits`` hexadecimal digits of the hash name the buckets: with 3,
    a leaf's ordered part is about 1/4096 of it.  ``ident`` tells rows apart
    (``ident_of`` key and text unless given).
    """
    known = lambda c: F.coalesce(c.cast("string"), F.lit("unknown"))
    label = {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}
    measured = tokens if tokens is not None else word_tokens(text)
    named = {f"__{level}": known(label[level]) for level in LEVELS} | {"__n": measured}
    rows = docs.withColumns(named).drop("copies", "n_tokens", "domain")
    ident = ident if ident is not None else ident_of(key, text)
    narrow = materialize(rows.select(*[F.col(f"__{x}").alias(x) for x in LEVELS], ident.alias("id"), F.col("__n").alias("n")))

    totals = narrow.groupBy(*LEVELS).agg(F.sum("n").alias("tokens"))
    leaves = leaf_budgets(totals, budget, weights, defaults or {}, max_epochs)
    safe = F.greatest("tokens", F.lit(1))
    leaves = materialize(
        leaves.withColumn("epochs", F.expr("budget div greatest(tokens, 1)")).withColumn("prefix", F.col("budget") % safe).where("tokens > 0")
    )
    hashed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.col("id")))
    bucketed = (
        narrow.join(leaves.select(*LEVELS, "epochs", "prefix"), list(LEVELS))
        .withColumn("hash", hashed)
        .withColumn("bucket", F.substring("hash", 1, order_digits))
    )
    sums = bucketed.groupBy(*LEVELS, "bucket").agg(F.sum("n").alias("n"))
    running = Window.partitionBy(*LEVELS).orderBy("bucket")
    cut_bucket = (
        sums.withColumn("upto", F.sum("n").over(running.rowsBetween(Window.unboundedPreceding, 0)))
        .join(leaves.select(*LEVELS, "prefix"), list(LEVELS))
        .where("upto > prefix")
        .groupBy(*LEVELS)
        .agg(F.min(F.struct("bucket", "upto", "n")).alias("b"))
        .select(*LEVELS, F.col("b.bucket").alias("cut_bucket"), (F.col("b.upto") - F.col("b.n")).alias("taken"))
    )
    cuts = materialize(leaves.join(cut_bucket, list(LEVELS), "left"))
    inside = Window.partitionBy(*LEVELS).orderBy("hash", "id").rangeBetween(Window.unboundedPreceding, 0)
    last = (
        bucketed.drop("prefix", "epochs")
        .join(cuts.select(*LEVELS, "prefix", "cut_bucket", "taken"), list(LEVELS))
        .where("bucket = cut_bucket")
        .withColumn("upto", F.col("taken") + F.sum("n").over(inside))
        .where("upto <= prefix")
        .groupBy(*LEVELS)
        .agg(F.max(F.struct("hash", "id")).alias("last"))
    )
    plan = materialize(
        cuts.join(last, list(LEVELS), "left").select(
            *[F.col(x).alias(f"__{x}") for x in LEVELS],
            F.col("epochs").alias("__epochs"),
            F.col("cut_bucket").alias("__cut_bucket"),
            F.col("last.hash").alias("__last_hash"),
            F.col("last.id").alias("__last_id"),
        )
    )
    chosen = rows.join(plan, [f"__{x}" for x in LEVELS]).withColumn(
        "__hash", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("__epochs").cast("string"), ident))
    )
    bucket, hash_, last_hash = F.substring("__hash", 1, order_digits), F.col("__hash"), F.col("__last_hash")
    within = (hash_ < last_hash) | ((hash_ == last_hash) & (ident <= F.col("__last_id")))
    in_prefix = (bucket < F.col("__cut_bucket")) | ((bucket == F.col("__cut_bucket")) & within)
    copies = F.col("__epochs").cast("int") + F.when(in_prefix, 1).otherwise(0)
    return (
        chosen.withColumn("copies", copies)
        .where("copies > 0")
        .select(*[F.col(f"`{c}`") for c in docs.drop("copies", "n_tokens", "domain").columns], F.col("__domain").alias("domain"), F.col("__n").alias("n_tokens"), "copies")
    )


def repeat_copies(mixed: DataFrame) -> DataFrame:
    """Each row as often as its ``copies`` say."""
    return mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("__copy")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows that a mixture takes, as often as it takes them, all their columns unchanged, whatever their names."""
    names = docs.columns
    plain = docs.toDF(*[f"__c{i}" for i in range(len(names))])
    known = [F.col(f"__c{names.index(c)}").alias(c) for c in ("doc_id", "text", "lang", "source")]
    mixed = mix(plain.select("*", *known), **options)
    return repeat_copies(mixed).select(*plain.columns).toDF(*names)
