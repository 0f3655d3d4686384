"""Variants of one text by a table of characters that stand for each other.

Characters that are tied by any chain of pairs are one class; a text's canonical
form has the smallest character of each class.  Two texts are variants of each
other exactly if their canonical forms are equal, so variants meet by an
equi-join and are never enumerated (a text of n such characters has 2^n and more).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.shared import materialize

from .glossary import spaced

#: Characters that a table may have classes for; they travel with the tasks.
MOST_CHARACTERS = 100_000


def character_classes(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``char, canonical`` of every character of the pairs: the smallest one that a chain of pairs leads to.

    Every round takes the smallest label among the neighbours, and then the label
    of that label, so a chain takes rounds by the logarithm of its length.  Pairs
    with a null, or with more or fewer characters than one, are left out.
    """
    sound = pairs.select(F.col(a).alias("char"), F.col(b).alias("other")).where("length(char) = 1 and length(other) = 1")
    both = materialize(sound.union(sound.select("other", "char")).union(sound.select("char", "char")).union(sound.select("other", "other")).distinct())
    labels = both.groupBy("char").agg(F.min("other").alias("canonical"))
    while True:
        labels = materialize(labels)
        near = both.join(labels.select(F.col("char").alias("other"), F.col("canonical").alias("near")), "other")
        lowest = near.groupBy("char").agg(F.min("near").alias("low"))
        jump = lowest.join(labels.select(F.col("char").alias("low"), F.col("canonical").alias("beyond")), "low")
        moved = labels.join(jump, "char").select("char", F.least("canonical", "low", "beyond").alias("canonical"), (F.least("low", "beyond") < F.col("canonical")).alias("moved"))
        moved = materialize(moved)
        labels = moved.drop("moved")
        if not moved.agg(F.max("moved")).first()[0]:
            return labels


def canonical(text: Column | str, classes: DataFrame) -> Column:
    """The canonical form of a text with its white space normalised; ``classes`` as above, at most MOST_CHARACTERS of them."""
    moved = classes.where("char <> canonical").orderBy("char").limit(MOST_CHARACTERS + 1).collect()
    if len(moved) > MOST_CHARACTERS:
        raise ValueError(f"more than {MOST_CHARACTERS} characters have another form")
    text = spaced(text)
    return F.translate(text, "".join(r[0] for r in moved), "".join(r[1] for r in moved)) if moved else text


def variant_join(left: DataFrame, right: DataFrame, left_text: str, right_text: str, classes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Pairs of rows whose texts are variants of each other; empty and null texts have none."""
    a = left.withColumn("__form", canonical(left_text, classes))
    b = right.withColumn("__form", canonical(right_text, classes))
    return a.where("__form <> ''").join(b, [*keys, "__form"]).drop("__form")
