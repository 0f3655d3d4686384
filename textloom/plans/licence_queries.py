"""Queries of licensed targets, over Han texts made from the conversations letter by letter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import licences

from .registry import query, table

LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Han characters that stand for the letters, in sources and in targets.
SOURCE_HAN, TARGET_HAN = ("".join(chr(base + k) for k in range(26)) for base in (0x4E00, 0x6C34))


def han(letters: Column, alphabet: str) -> Column:
    return F.translate(letters, LETTERS, alphabet)


def han_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn in the targets' characters, and its first half in the sources'."""
    letters = F.regexp_replace(F.lower("text"), "[^a-z]", "")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", letters.alias("letters"))
    half = F.expr("substring(letters, 1, cast(length(letters) div 2 as int))")
    return rows.select("conv_id", "turn", han(half, SOURCE_HAN).alias("source"), han(F.col("letters"), TARGET_HAN).alias("text"))


def han_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the benchmark, and the first and last three letters of each: terms inside others, and beside and across them."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0))).alias("w")).distinct()
    every = words.select(F.explode(F.array("w", F.substring("w", 1, 3), F.expr("right(w, 3)"))).alias("w")).distinct()
    return every.select(han(F.col("w"), SOURCE_HAN).alias("src"), han(F.col("w"), TARGET_HAN).alias("dst"))


_HAN = f"""w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{{4,}}')) AS word FROM benchmark),
v AS (SELECT word AS term FROM w UNION SELECT left(word, 3) FROM w UNION SELECT right(word, 3) FROM w),
t AS (SELECT translate(term, '{LETTERS}', '{SOURCE_HAN}') AS src, translate(term, '{LETTERS}', '{TARGET_HAN}') AS dst FROM v),
c0 AS (SELECT conv_id, turn, regexp_replace(lower(text), '[^a-z]', '', 'g') AS letters FROM conversations),
c AS (SELECT conv_id, turn, translate(left(letters, length(letters) // 2), '{LETTERS}', '{SOURCE_HAN}') AS source, translate(letters, '{LETTERS}', '{TARGET_HAN}') AS text FROM c0),
p AS (SELECT conv_id, turn, text, source, unnest(range(1, length(text) + 1)) AS s FROM c),
g AS (SELECT conv_id, turn, source, s, n, substr(text, s, n) AS dst FROM p JOIN (SELECT DISTINCT length(dst) AS n FROM t) ON s + n - 1 <= length(text)),
o AS (SELECT conv_id, turn, source, src, dst, s - 1 AS s, s - 1 + n AS e FROM g JOIN t USING (dst))"""


@query("term_positions", f'WITH {_HAN} SELECT conv_id, turn, dst AS term, s::INT AS "start", e::INT AS "end" FROM o')
def term_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of every term, nested and overlapping ones included."""
    return licences.occurrences(han_texts(spark, sf_dir), han_terms(spark, sf_dir), "text", "dst", ["conv_id", "turn"])


@query(
    "licensed_targets",
    f"""WITH {_HAN},
q AS (SELECT *, contains(source, src) AS ok FROM o WHERE source <> '')
SELECT conv_id, turn, dst AS target, count(*) AS n FROM q a WHERE NOT ok
  AND NOT EXISTS (SELECT 1 FROM q b WHERE b.conv_id = a.conv_id AND b.turn = a.turn AND b.ok AND b.s <= a.s AND b.e >= a.e) GROUP BY ALL""",
)
def licensed_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of targets that neither a source of their own nor a longer licensed target around them explains."""
    return licences.unlicensed_targets(han_texts(spark, sf_dir), han_terms(spark, sf_dir), ["conv_id", "turn"], "source", "text", anywhere=False)


@query(
    "mismatched_targets",
    f"""WITH {_HAN},
k AS (SELECT DISTINCT conv_id, turn, dst FROM c JOIN t ON contains(source, src)),
l AS (SELECT a.dst AS longer, b.dst FROM t a JOIN t b ON a.dst <> b.dst AND contains(a.dst, b.dst)),
y AS (SELECT * FROM k UNION SELECT conv_id, turn, l.dst FROM k JOIN l ON k.dst = l.longer)
SELECT conv_id, turn, dst AS target, count(*) AS n FROM o ANTI JOIN y USING (conv_id, turn, dst) WHERE source <> '' GROUP BY ALL HAVING count(*) >= 2""",
)
def mismatched_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets that come twice without a source of their own or of any longer target."""
    keys = ["conv_id", "turn"]
    return licences.unlicensed_targets(han_texts(spark, sf_dir), han_terms(spark, sf_dir), keys, "source", "text", anywhere=True, conspicuous=True)
