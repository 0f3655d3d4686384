"""The polish pass: a translated section cleaned in a fixed order, all as one column expression.

The order of the steps matters: characters, heading, replacements, title,
rewriting rules, glued and repeated words, spacing, paragraphs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import collapse_phrases, collapse_repeats, let, normalize_ellipsis, ordered_replace, rule_rewrite, split_camel, strip
from .titles import clean_titles, ended_title, is_title_line, split_title

# Characters that separate, vanish or count as a space, and those that may stay.
CHARACTERS = (
    ("[\u2028\u2029]", "\n"),
    ("[\u00ad\u200b\u200c\u200d\ufeff]", ""),
    ("[\u00a0\u202f\u2009\u2007\u2008\u200a\u205f\u3000]", " "),
    (r"[^\n\r\t \x20-\x7E\u00c0-\u024f\u1e00-\u1eff\u0300-\u036f]+", ""),
)
# Fixed value: what stands for a paragraph break.
BREAK = "QZXBRQ"
# Residue of pages, stray marks, and dialogue that is glued to narration.
RESIDUE = (
    (r"(?U)loadAdv\(\d+,\s*\d+\);\s*", ""),
    (r"(?U)[“\"]?Gỗ\.\.\.\s*Cố tổng", "“Cố tổng"),
    ("[~～]+", " "),
    (r"([^\n])([“\"])", "$1 $2"),
    (r"(?mdU)^(chương)\s+(?=[“\"'(])", ""),
    ("([.!?…])”([A-ZÀ-Ỵ])", "$1”\n\n$2"),
    ('([.!?…])"([A-ZÀ-Ỵ])', '$1"\n\n$2'),
    ('([.!?…])”([“"])', "$1”\n\n$2"),
    ('([.!?…])"([“"])', '$1"\n\n$2'),
)
# Quotation marks of dialogue.
QUOTES = (
    ("”", '"'),
    (r'(?md)^([ \t]*)"', "$1“"),
    (r"(?mdU)^([ \t]*)“\s+", "$1“"),
    (r'(?U)\s+"', '"'),
    (r'(?U)([.!?…])\s*"', '$1"'),
    ('"([.!?…])', '$1"'),
    ('“([^”\n"]*?)"', "“$1”"),
    (r'(?U)(:\s*)"([^"\n]+)"', "$1“$2”"),
    (r'(?U)(:\s*)“([^”\n"]*?)"', "$1“$2”"),
    (r"(?U):\s*“", ": “"),
)
# Spacing.
SPACING = (
    (r"(?md)^[ \t]+", ""),
    (r"[ \t]+\n", "\n"),
    (r"([.!?…,:;])([A-Za-zÀ-ỹ“\"'])", "$1 $2"),
    (r"(?md)^[ \t]*[“\"]([^\n]+)$", "“$1"),
    (r"[ \t]{2,}", " "),
    (r"(?mdU)^\s+$", ""),
)
# Words that may follow themselves, the longest paragraph, and the length under which a line goes on.
EMPHASIS = ("rất", "quá", "lắm", "thật", "đúng", "cực", "siêu", "hơi", "mãi")
LONGEST, SHORT_LINE = 220, 70

#: A blank between two sentences, the second opening with a quotation mark or an upper-case letter.
_SENTENCE_GAP = r"(?U)(?:(?<=[.!?…])|(?<=[.!?…][\"”]))\s+(?=[\"“\p{Lu}])"
_SPEECH_GAP = r"(?U)(?=\s*[“\"])|(?<=[:;])\s+"
_PART_GAP = r"(?U)(?<=[.!?…])\s+|(?=[“\"])"


def strip_hidden(text: Column) -> Column:
    """Without characters that are neither letters in use, ASCII nor line ends."""
    return F.when(text.rlike(CHARACTERS[-1][0]), rule_rewrite(text, CHARACTERS)).otherwise(text)


def _first_line(text: Column) -> Column:
    return strip(F.substring_index(text, "\n", 1))


def _after_first_line(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"\A[^\n]*\n?", ""))


def _joined(head: Column, rest: Column) -> Column:
    return F.when(rest == "", head).otherwise(F.concat(head, F.lit("\n\n"), rest))


#: A heading of the text's own: the title on its line is group 1, or group 2 without a word for it.
_OWN_HEADING = r"(?U)^(?:Chương\s+\d+\s*(?:[:：]\s*(.*)|(?![:：]).*)|第\s*\d+\s*章\s*(.*))$"


def own_title(text: Column) -> Column:
    """The title in the heading that a text begins with; empty without one."""
    first = _first_line(text)
    return strip(F.concat(*[F.coalesce(F.regexp_extract(first, _OWN_HEADING, g), F.lit("")) for g in (1, 2)]))


def with_heading(text: Column, heading: Column, title: Column) -> Column:
    """The text under ``heading`` and ``title``, which replace a heading of its own."""
    head = F.when(title == "", heading).otherwise(F.concat(heading, F.lit(": "), title))
    return F.when(_first_line(text).rlike(_OWN_HEADING), _joined(head, _after_first_line(text))).otherwise(_joined(heading, text))


def packed(parts: Column, most: int) -> Column:
    """Parts joined by a space, greedily, into pieces of at most ``most`` characters; longer parts stay whole."""
    parts = F.filter(F.transform(parts, strip), lambda p: p != "")
    last = lambda acc: F.element_at(acc, -1)
    fits = lambda acc, p: (F.size(acc) > 0) & (F.length(F.try_element_at(acc, F.lit(-1))) + 1 + F.length(p) <= most)
    grown = lambda acc, p: F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.concat_ws(" ", last(acc), p)))
    return F.aggregate(parts, F.array().cast("array<string>"), lambda acc, p: F.when(fits(acc, p), grown(acc, p)).otherwise(F.concat(acc, F.array(p))))


def rebalanced(line: Column, most: int = LONGEST) -> Column:
    """A line as paragraphs: cut between sentences if it is long or holds speeches of several speakers."""

    marks = lambda c: F.length(line) - F.length(F.replace(line, F.lit(c), F.lit("")))
    spoken = (marks("“") >= 2) & (marks(":") >= 2)

    def of(units: Column) -> Column:
        speeches = (F.size(units) > 1) & spoken
        cut = F.when(F.size(units) > 1, units).otherwise(F.split(line, _SPEECH_GAP))
        short = lambda p: F.when(F.length(p) <= most, F.array(p)).otherwise(packed(F.split(p, _PART_GAP), most))
        return F.when((F.length(line) <= most) & ~speeches, F.array(line)).otherwise(F.flatten(F.transform(packed(cut, most), short)))

    return F.when((F.length(line) <= most) & ~spoken, F.array(line)).otherwise(let(F.split(line, _SENTENCE_GAP), of))


def merged_lines(lines: Column) -> Column:
    """Lines joined to the one before where that is open or they go on with it; a heading is left alone."""
    goes_on = lambda before, line: (
        ~before.rlike(r"(?U)^Chương\s+\d+(?::\s+.+)?$")
        & (before.rlike("[:,“(…-]$") | line.rlike(r"^\p{Ll}") | ((F.length(line) < SHORT_LINE) & ~line.rlike('^[“"A-ZÀ-Ỵ]')))
    )
    last = lambda acc: F.try_element_at(acc, F.lit(-1))
    joined = lambda acc, x: F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.concat_ws(" ", last(acc), x)))
    step = lambda acc, x: F.when((F.size(acc) > 0) & goes_on(last(acc), x), joined(acc, x)).otherwise(F.concat(acc, F.array(x)))
    return F.aggregate(lines, F.array().cast("array<string>"), step)


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text, balanced; a heading in its first line stays as it is."""
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")
    headed = lambda x, i: (i == 0) & x.rlike(r"(?U)^Chương\s+\d+(?::\s+.+)?$")
    cut = F.flatten(F.transform(lines, lambda x, i: F.when(headed(x, i), F.array(x)).otherwise(rebalanced(x))))
    return F.array_join(merged_lines(cut), "\n\n")


def polish(
    rows: DataFrame, text: str, number: str, name: str = "polished", replacements: Column | None = None, force_title: bool = False
) -> DataFrame:
    """Adds ``name``: the polished form of column ``text``, whose heading has the number in column ``number``.

    A null text stays null.  The steps are projections of their own, so that no
    step is computed twice.
    """
    heading = F.concat(F.lit("Chương "), F.col(number).cast("int").cast("string"))
    here, title = F.col("__text"), F.col("__title")

    line, more, cut = F.col("__line"), F.col("__more"), F.col("__cut")

    def folded(df: DataFrame, below: Column, whole: Column, marks: str) -> DataFrame:
        """A bare heading takes in a title below it: the next line if it is ``whole``, or the part that ``below`` cuts off."""
        df = df.withColumn("__rest", _after_first_line(here)).withColumn("__bare", _first_line(here) == heading)
        df = df.withColumn("__line", _first_line(F.col("__rest"))).withColumn("__more", _after_first_line(F.col("__rest")))
        df = df.withColumn("__whole", whole).withColumn("__cut", F.when(F.col("__bare") & ~F.col("__whole"), below))
        df = df.withColumn("__title", F.when(F.col("__bare"), F.when(F.col("__whole"), line).otherwise(cut["title"])))
        df = df.withColumn("__body", F.when(F.col("__whole"), more).otherwise(strip(F.concat(cut["body"], F.lit("\n"), more))))
        df = df.withColumn("__title", clean_titles("__title"))
        df = df.withColumn("__head", F.concat(heading, F.lit(": "), ended_title(title, marks)))
        return df.withColumn("__text", F.coalesce(_joined(F.col("__head"), F.col("__body")), here))

    plain = F.replace(strip_hidden(F.col(text)), F.lit(BREAK), F.lit("\n\n"))
    out = rows.withColumn("__text", strip(F.regexp_replace(plain, "\r\n?", "\n"))).withColumn("__title", own_title(here))
    out = out.withColumn("__title", clean_titles("__title")).withColumn("__text", with_heading(here, heading, title))
    if replacements is not None:
        out = out.withColumn("__text", ordered_replace("__text", replacements))
    out = folded(out, split_title(line), is_title_line(line), "?!")
    if force_title:  # any line but speech
        out = out.mapInArrow(lambda batches: batches, out.schema)  # a border between two sets of large expressions
        none = F.lit(None).cast("struct<title: string, body: string>")
        out = folded(out, none, (line != "") & ~line.rlike(r"^[“\"'(-]"), "?!.")
    alone = F.regexp_replace(here, F.concat(F.lit("(?md)^"), heading, F.lit("\n(?!\n)")), F.concat(heading, F.lit("\n\n")))
    for step in (
        rule_rewrite(here, RESIDUE),
        F.when(here.rlike('[“”"]'), rule_rewrite(here, QUOTES)).otherwise(here),
        split_camel(here),
        collapse_phrases(here),
        collapse_repeats(here, EMPHASIS),
        rule_rewrite(here, SPACING),
        paragraphs(alone),
        F.concat(strip(normalize_ellipsis(here)), F.lit("\n")),
    ):
        out = out.withColumn("__text", step)
    return out.withColumn(name, here).select(*[F.col(f"`{c}`") for c in rows.columns if c != name], name)
