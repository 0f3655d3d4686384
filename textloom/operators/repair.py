"""Repairs: which sections need one, what is done, and the rebuilt texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import let, lines, strip

from .quality import METADATA_LINES, WATERMARKS, folded
from .relational import first_wins

#: Fixed value: the body of a section that no source has.
PLACEHOLDER = "本章内容与主线剧情无关。"
PARAGRAPH = 120


# What stands for a masked term, the heading of a part, and words left in another language's sounds.
TOKEN = r"(?:ZXQ|QZX)\d{1,6}QXZ"
HEADING = r"(?mdU)^(Chương\s+\d+(?::\s+.*)?)$"
ROMANIZED = (
    "thiển trương viên",
    "thập ma",
    "thiểu điểm",
    "chẩm hội",
    "na khả thị",
    "thiên chân vạn xác",
    "thuấn gian(?: giải khai)?",
    "trừu trứ lương khí",
    "kinh đào hãi lãng",
    "đích phu trượng",
    "thuyết hoàn điều chuyển",
    "khán liễu nhãn",
    "cật sung liễu",
    "đương tâm liễu",
    "thính danh tự",
    "đảo hấp nhất khẩu lương khí",
    "giá chủng",
    "bất thị thiện",
    "vi hà hội như vậy",
    "bình nhiễu",
    "phủ tắc đáng bất trụ",
    "vạn niên tuế nguyệt",
)


def repair_reasons(
    part: Column | str, changed: Column | None = None, blocked: Column | None = None, han: str = "\\u3400-\\u4dbf\\u4e00-\\u9fff", romanized: tuple[str, ...] = ROMANIZED
) -> Column:
    """Codes of what is wrong with a translated part (null if it is missing), in fixed order; an empty array if nothing is.

    ``changed`` says whether its source has changed since, ``blocked`` how many
    terms it holds that it must not.  An empty part has ``empty-part`` twice,
    for the file and for the text.  Every count is taken once; a filter on the
    result would take all of them again.
    """
    text = F.col(part) if isinstance(part, str) else part
    yes = lambda c: F.lit(False) if c is None else F.coalesce(c, F.lit(False))
    some = lambda name, count, least=1: let(count, lambda n: F.when(n >= least, F.concat(F.lit(f"{name}:"), n.cast("string"))))
    paragraphs = F.filter(F.transform(F.split(text, "\n\n"), strip), lambda p: F.length(p) >= PARAGRAPH)
    again = let(paragraphs, lambda ps: F.size(ps) - F.size(F.array_distinct(ps)))
    left = F.size(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit("(?iu)" + "|".join(romanized)), F.lit(0)), lambda x: F.lower(strip(x)))))
    checks = [
        F.when(text == "", "empty-part"),
        F.when(yes(changed), "stale-part"),
        F.when(strip(text) == "", "empty-part"),
        F.when(text.rlike(TOKEN), "placeholder-token"),
        some("blocked-glossary-targets", F.lit(0) if blocked is None else F.coalesce(blocked, F.lit(0))),
        some("romanized-artifacts", left),
        some("han-residue", F.regexp_count(text, F.lit(f"[{han}]"))),
        some("duplicate-headers", F.regexp_count(text, F.lit(HEADING)), 2),
        some("duplicate-paragraphs", again, 3),
    ]
    return F.when(text.isNull(), F.array(F.lit("missing-part"))).otherwise(F.filter(F.array(*checks), lambda x: x.isNotNull()))


def without_noise(texts: DataFrame, text: str = "text", watermarks: tuple[str, ...] = WATERMARKS, metadata: tuple[str, ...] = METADATA_LINES) -> DataFrame:
    """Texts without promotion and metadata lines.

    Folding may need a Python function, so the folded text is a column of its own
    and lines are compared by place.
    """
    both = texts.withColumn("__plain", lines(folded(text))).withColumn("__lines", lines(text))

    def bad(line: Column, i: Column) -> Column:
        hit = F.lit(False)
        for p in watermarks:
            hit = hit | F.get(F.col("__plain"), i).rlike(f"(?iud){p}")
        for p in metadata:
            hit = hit | F.trim(line).rlike(f"(?iud){p}")
        return F.coalesce(hit, F.lit(False))

    return both.withColumn(text, F.array_join(F.filter("__lines", lambda x, i: ~bad(x, i)), "\n")).drop("__plain", "__lines")


def apply_repairs(sections: DataFrame, replacements: DataFrame, expected: DataFrame) -> DataFrame:
    """``batch, number, title, body, action``: every expected number, with its replacement, its own text or a placeholder.

    ``sections`` and ``replacements`` have ``number, title, body``; of several
    the first by ``pos`` counts.
    """
    first = lambda df, tag: df.groupBy("number").agg(F.min_by(F.struct("title", "body"), "pos").alias(tag))
    joined = expected.select("batch", "number").join(first(sections, "own"), "number", "left").join(first(replacements, "new"), "number", "left")
    action = (
        F.when(F.col("new").isNotNull() & F.col("own").isNotNull(), "replaced_from_source")
        .when(F.col("new").isNotNull(), "inserted_from_source")
        .when(F.col("own").isNotNull(), "kept")
        .otherwise("placeholder_added")
    )
    chosen = F.coalesce("new", "own", F.struct(F.format_string("第%d章 略过", F.col("number")).alias("title"), F.lit(PLACEHOLDER).alias("body")))
    return joined.select("batch", "number", chosen["title"].alias("title"), chosen["body"].alias("body"), action.alias("action"))


def repair_report(actions: DataFrame) -> DataFrame:
    """Actions in three parts: added, replaced, other; in each by number."""
    part = F.when(F.col("action").isin("placeholder_added", "inserted_from_source"), 1).when(F.col("action") == "replaced_from_source", 2).otherwise(3)
    return actions.withColumn("part", part).orderBy("part", "number", "action")


def merge_rules(layers: list[DataFrame]) -> DataFrame:
    """Candidates of all layers in order, each (number, url) once, with their place for the number."""
    merged = first_wins(layers, ("number", "url"), ("pos",))
    return merged.withColumn("place", F.row_number().over(Window.partitionBy("number").orderBy("layer", "pos")))
