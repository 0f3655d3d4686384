"""Queries of dictionaries of names: variants of sources, rules, votes and modes.

Names are made from keys digit by digit, so that characters have a usual reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import glossary, variants
from textloom.shared import dealt_out

from .registry import query, table

#: Characters of the digits with variants of some, and pairs of characters that stand for each other: chains of two, three and four.
VARIANT_DIGITS = ("云开群山水火木土金月", "芸開羣山氵灬林土釒月")
VARIANT_PAIRS = (("云", "雲"), ("雲", "芸"), ("開", "开"), ("群", "羣"), ("氺", "水"), ("氺", "氵"), ("火", "灬"), ("木", "林"), ("林", "森"), ("森", "朩"), ("釒", "钅"), ("钅", "金"))

_PAIRS_SQL = ", ".join(f"('{a}', '{b}')" for a, b in VARIANT_PAIRS)


def variant_name(key: Column, form: int) -> Column:
    return F.translate(key.cast("string"), "0123456789", VARIANT_DIGITS[form])


@query(
    "source_variants",
    f"""WITH RECURSIVE p(a, b) AS (VALUES {_PAIRS_SQL}), e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r(c, o) AS (SELECT a, a FROM e UNION SELECT r.c, e.b FROM r JOIN e ON r.o = e.a), k AS (SELECT c, min(o) AS f FROM r GROUP BY c),
l AS (SELECT c_custkey, translate(c_custkey::VARCHAR, '0123456789', '{VARIANT_DIGITS[0]}') AS name FROM customer),
t AS (SELECT s_suppkey, translate(s_suppkey::VARCHAR, '0123456789', '{VARIANT_DIGITS[1]}') AS name FROM supplier),
lf AS (SELECT c_custkey, string_agg(coalesce(f, ch), '' ORDER BY i) AS form FROM (SELECT c_custkey, unnest(string_split(name, '')) AS ch, unnest(range(length(name))) AS i FROM l) LEFT JOIN k ON c = ch GROUP BY c_custkey),
tf AS (SELECT s_suppkey, string_agg(coalesce(f, ch), '' ORDER BY i) AS form FROM (SELECT s_suppkey, unnest(string_split(name, '')) AS ch, unnest(range(length(name))) AS i FROM t) LEFT JOIN k ON c = ch GROUP BY s_suppkey)
SELECT c_custkey, s_suppkey, form FROM lf JOIN tf USING (form)""",
)
def source_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """names that are variants of each other, by the closure of a table of characters."""
    classes = variants.character_classes(spark.createDataFrame(list(VARIANT_PAIRS), "a string, b string"))
    left = table(spark, sf_dir, "customer").select("c_custkey", variant_name(F.col("c_custkey"), 0).alias("name"))
    right = table(spark, sf_dir, "supplier").select("s_suppkey", variant_name(F.col("s_suppkey"), 1).alias("term"))
    met = variants.variant_join(left, right, "name", "term", classes)
    return met.select("c_custkey", "s_suppkey", variants.canonical("name", classes).alias("form"))


#: Characters of the digits and how each is read; the last two together are a person's title.
HAN_DIGITS = "王李张赵山安平海城主"
READINGS = ("Vương", "Lý", "Trương", "Triệu", "Sơn", "An", "Bình", "Hải", "Thành", "Chủ")


def entries_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as entries, some of them unsound in one way or another; dealt out first, as a part is few bytes and its entry much work."""
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    words = F.transform(F.split(key, ""), lambda c: F.element_at(F.array(*map(F.lit, READINGS)), c.cast("int") + 1))
    parts = dealt_out(table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand"), "p_partkey")
    rows = parts.select("p_partkey", "p_size", "p_brand", key.alias("key")).withColumn("ws", words)
    whole, odd = F.array_join("ws", " "), size % 10
    tail = F.when(F.col("p_partkey") % 11 == 0, "3").when(F.col("p_partkey") % 13 == 0, "x").otherwise("")
    target = (
        F.when(size == 1, "")
        .when(odd == 2, F.array_join(F.concat(F.array("p_brand"), F.expr("slice(ws, 2, size(ws))")), " "))
        .when(odd == 3, F.lower(whole))
        .when(odd == 4, F.concat(whole, F.lit(" ?")))
        .when(odd == 5, F.concat(whole, F.lit("  thành chủ ")))
        .when(odd == 6, F.array_join(F.reverse("ws"), " "))
        .otherwise(whole)
    )
    return rows.select(F.concat(F.translate("key", "0123456789", HAN_DIGITS), tail).alias("src"), target.alias("dst"), F.col("p_partkey").alias("ord"))


def context_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    words = F.transform(F.split(key, ""), lambda c: F.element_at(F.array(*map(F.lit, READINGS)), c.cast("int") + 1))
    return table(spark, sf_dir, "supplier").select(F.translate(key, "0123456789", HAN_DIGITS).alias("src"), F.array_join(words, " ").alias("dst"), F.col("s_suppkey").alias("ord"))


_RULES = glossary.Rules()


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _has(condition: str, values: tuple[str, ...]) -> str:
    return f"len(list_filter({_list(values)}, lambda x: {condition})) > 0"


def _read(key: str) -> str:
    return f"list_transform(string_split({key}, ''), lambda c: {_list(READINGS)}[c::INT + 1])"


_CAPITALS = r"len(list_filter(string_split(dst, ' '), lambda w: regexp_matches(regexp_extract(w, '\p{L}'), '\p{Lu}')))"
_BARE = r"regexp_replace({}, '^[^\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+$', '', 'g')"
_FACTS = rf"""regexp_matches(regexp_replace(src, '{glossary.PUNCTUATION}', '', 'g'), '^[一-鿿]+$') AS han,
  {_has("suffix(src, x) AND length(src) > length(x)", _RULES.person_ends)} AS ended, {_has("contains(lower(dst), x)", _RULES.titles)} AS keeps,
  ({_CAPITALS} >= 2 OR ({_CAPITALS} = 1 AND len(string_split(dst, ' ')) = 1) OR (prefix(dst, '《') AND suffix(dst, '》'))) AS proper"""
_VOTED = """{c} AS (SELECT mode, k, word, count(*) AS n, min(ord) AS f FROM {v} WHERE word <> '' GROUP BY ALL),
{m} AS (SELECT mode, k, word FROM (SELECT *, sum(n) OVER (PARTITION BY mode, k) AS total, row_number() OVER (PARTITION BY mode, k ORDER BY n DESC, f) AS place FROM {c}) WHERE place = 1 AND n >= {least} AND n >= total * {share})"""

MODES_SQL = rf"""WITH w AS (SELECT p_partkey AS ord, p_partkey::VARCHAR AS k, p_size % 10 AS z, p_size, p_brand, {_read("p_partkey::VARCHAR")} AS ws FROM part),
e AS (SELECT ord, translate(k, '0123456789', '{HAN_DIGITS}') || CASE WHEN ord % 11 = 0 THEN '3' WHEN ord % 13 = 0 THEN 'x' ELSE '' END AS src,
  CASE WHEN p_size = 1 THEN '' WHEN z = 2 THEN array_to_string(list_prepend(p_brand, ws[2:]), ' ') WHEN z = 3 THEN lower(array_to_string(ws, ' ')) WHEN z = 4 THEN array_to_string(ws, ' ') || ' ?'
    WHEN z = 5 THEN array_to_string(ws, ' ') || ' thành chủ' WHEN z = 6 THEN array_to_string(list_reverse(ws), ' ') ELSE array_to_string(ws, ' ') END AS dst FROM w),
m AS (SELECT unnest(['default', 'auto', 'runtime']) AS mode), q AS (SELECT m.mode, e.*, {_FACTS} FROM e, m),
j AS (SELECT *, CASE WHEN src = '' OR dst = '' THEN 'empty' WHEN NOT han THEN 'not_han' WHEN regexp_matches(src, '\d') OR (prefix(src, '第') AND contains(src, '章')) THEN 'numbered'
  WHEN list_contains({_list(_RULES.common_sources)}, src) OR list_contains({_list(_RULES.common_targets)}, lower(dst)) THEN 'common'
  WHEN regexp_matches(dst, '{glossary.PLACEHOLDER}|[?(（,;]') OR {_has("contains(lower(dst), x)", _RULES.suspicious)} THEN 'suspicious'
  WHEN keeps AND NOT ended THEN 'title_added' WHEN mode = 'auto' AND ended THEN 'titled_person' WHEN mode = 'runtime' AND ended AND NOT keeps THEN 'title_lost'
  WHEN NOT ({_has("suffix(src, x)", _RULES.place_ends)} OR (length(src) <= 8 AND proper)) THEN 'no_name' END AS why FROM q),
kept AS (SELECT mode, ord, src, dst FROM j WHERE why IS NULL AND mode <> 'default'),
ctx AS (SELECT s_suppkey AS ord, translate(s_suppkey::VARCHAR, '0123456789', '{HAN_DIGITS}') AS src, array_to_string({_read("s_suppkey::VARCHAR")}, ' ') AS dst FROM supplier),
voters AS (SELECT mode, ctx.ord, src, dst FROM ctx, m WHERE mode <> 'default' AND (mode, src) NOT IN (SELECT (mode, src) FROM kept)
  UNION ALL SELECT kept.mode, coalesce(ctx.ord, kept.ord + (1::BIGINT << 40)), kept.src, kept.dst FROM kept LEFT JOIN ctx USING (src)),
named AS (SELECT * FROM (SELECT *, {_FACTS} FROM voters) WHERE han AND NOT ended AND proper),
hv AS (SELECT mode, left(src, 1) AS k, {_BARE.format("string_split(dst, ' ')[1]")} AS word, ord FROM named WHERE length(src) BETWEEN 2 AND 6),
rs AS (SELECT mode, src, string_split(dst, ' ') AS ws, ord, unnest(range(length(src))) AS i FROM named WHERE length(src) <= 4 AND len(string_split(dst, ' ')) = length(src)),
rv AS (SELECT mode, src[i + 1] AS k, {_BARE.format("ws[i + 1]")} AS word, ord * 8 + i AS ord FROM rs),
{_VOTED.format(c="hc", v="hv", m="heads", least=glossary.HEAD_VOTES, share=glossary.HEAD_SHARE)},
{_VOTED.format(c="rc", v="rv", m="readings", least=glossary.READING_VOTES, share=glossary.READING_SHARE)},
mine AS (SELECT * FROM (SELECT *, {_FACTS} FROM kept) WHERE han AND NOT ended),
oh AS (SELECT mine.mode, mine.src FROM mine JOIN heads ON heads.mode = mine.mode AND heads.k = left(src, 1) WHERE proper AND length(src) BETWEEN 2 AND 6 AND {_BARE.format("string_split(dst, ' ')[1]")} NOT IN ('', word)),
ms AS (SELECT mode, src, string_split(dst, ' ') AS ws, unnest(range(length(src))) AS i FROM mine WHERE length(src) BETWEEN 2 AND 4 AND len(string_split(dst, ' ')) = length(src)),
orr AS (SELECT ms.mode, src FROM ms JOIN readings ON readings.mode = ms.mode AND readings.k = src[i + 1] WHERE {_BARE.format("ws[i + 1]")} NOT IN ('', word) GROUP BY ms.mode, src HAVING count(*) >= 2)
SELECT mode, ord, CASE WHEN why IS NOT NULL THEN why WHEN mode NOT IN (SELECT mode FROM heads) THEN NULL WHEN (mode, src) IN (SELECT (mode, src) FROM oh) THEN 'head' WHEN (mode, src) IN (SELECT (mode, src) FROM orr) THEN 'reading' END AS drop_reason FROM j"""


@query("glossary_modes", MODES_SQL)
def glossary_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10, A5, A4: entries judged by rules and by the votes of all, in the three modes."""
    entries, context = entries_of(spark, sf_dir), context_of(spark, sf_dir)
    out = None
    for mode in glossary.MODES:
        found = glossary.sanitized(entries, mode, context).select(F.lit(mode).alias("mode"), "ord", "drop_reason")
        out = found if out is None else out.unionByName(found)
    return out


@query(
    "blocked_targets",
    MODES_SQL.rsplit("SELECT mode, ord,", 1)[0]
    + """, d AS (SELECT src, dst, why FROM j WHERE mode = 'default'),
c AS (SELECT DISTINCT dst, """
    + _CAPITALS.replace("string_split(dst, ' ')", "string_split(dst, ' ')[1:3]")
    + f""" AS caps FROM d WHERE why IS NOT NULL AND dst <> '')
SELECT dst FROM c WHERE (contains(lower(dst), ' của ') OR {_has("contains(lower(dst), x)", _RULES.titles)} OR (len(string_split(dst, ' ')) >= 2 AND caps >= 2)) AND dst NOT IN (SELECT dst FROM d WHERE why IS NULL)""",
)
def blocked_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: targets of dropped entries that should not come up in a text."""
    return glossary.blocked_targets(glossary.sanitized(entries_of(spark, sf_dir)))
