"""Sound and unsound entries of a dictionary of names, by rules and by the agreement of all entries.

An entry turns a source in Han characters into a target in words.  Rules judge
it by itself; then entries vote, together with those of a context, on how the
first character of a name, and every single character, is read, and entries that
go against a clear majority are dropped.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import strip
from textloom.shared import dealt_out, materialize

from .relational import majority

# What is no part of a Han word, and what is left of a placeholder.
PUNCTUATION = r"[《》〈〉（）()·・「」『』、，,\s]"
PLACEHOLDER = r"(?:ZXQ|QZX)\d{1,6}Q(?:XZ)?"
# Common words that are no names, in sources and in targets.
COMMON_SOURCES = (
    "不清楚 不明白 故人 故友 友人 熟人 路人 親人 亲人 爱人 愛人 恩人 污血 乌云 烏雲 鮮血 鲜血 淚水 泪水 滾滾 滚滚 圓滾滾 圆滚滚 办公室 辦公室 经理 經理 "
    "总经理 總經理 助理 秘书 秘書 主任 部长 部長 老师 老師 同学 同學 领导 領導 公司 集团 集團 部门 部門 学校 學校 大学 大學 超市 会员超市 會員超市 宿舍 寝室 寢室 "
    "房间 房間 客厅 客廳 卧室 臥室 手机 手機 电梯 電梯 食堂 饭店 飯店 酒店 商品房 客卧 客臥 宿舍樓 宿舍楼 宿舍樓下 宿舍楼下 宾馆 賓館"
)
COMMON_TARGETS = (
    "văn phòng, quản lý, tổng giám đốc, trợ lý, chủ nhiệm, bộ trưởng, thầy, cô, đồng học, lãnh đạo, công ty, tập đoàn, bộ phận, trường học, đại học, siêu thị, "
    "siêu thị thành viên, ký túc xá, phòng ngủ, phòng khách, điện thoại, thang máy, căng tin, nhà hàng, khách sạn, nhà ở thương mại, phòng cho khách"
)
# Parts of targets that tell an explanation; ends of place names and of persons with a title; titles in targets.
SUSPICIOUS = "ám chỉ, tên công ty, quý khách hàng"
PLACE_ENDS = (
    "大学 大學 学院 學院 中学 中學 小学 小學 集团 集團 公司 分公司 俱乐部 俱樂部 酒店 饭店 飯店 餐厅 餐廳 银行 銀行 广场 廣場 小区 小區 别墅 別墅 公园 公園 路 街 巷 村 "
    "镇 鎮 市 省 区 區 县 縣 山 江 湖 湾 灣 岛 島 桥 橋"
)
PERSON_ENDS = (
    "师弟 師弟 师兄 師兄 师姐 師姐 师妹 師妹 小姐 先生 公子 少爷 少爺 少主 宗主 掌门 掌門 长老 長老 峰主 堂主 城主 家主 前辈 前輩 道友 仙子"
)
TITLES = (
    "sư đệ, sư huynh, sư tỷ, sư tỉ, sư muội, tiểu thư, tiên sinh, công tử, thiếu gia, thiếu chủ, tông chủ, chưởng môn, trưởng lão, phong chủ, đường chủ, thành chủ, "
    "gia chủ, tiền bối, đạo hữu, tiên tử"
)
# Votes and share from which the first word of a name, and the reading of a character, is agreed on.
HEAD_VOTES, HEAD_SHARE = 3, 0.7
READING_VOTES, READING_SHARE = 2, 0.75

MODES = ("default", "auto", "runtime")


@dataclass(frozen=True)
class Rules:
    """Word lists of the rules."""

    common_sources: tuple[str, ...] = tuple(COMMON_SOURCES.split())
    common_targets: tuple[str, ...] = tuple(COMMON_TARGETS.split(", "))
    suspicious: tuple[str, ...] = tuple(SUSPICIOUS.split(", "))
    place_ends: tuple[str, ...] = tuple(PLACE_ENDS.split())
    person_ends: tuple[str, ...] = tuple(PERSON_ENDS.split())
    titles: tuple[str, ...] = tuple(TITLES.split(", "))


def spaced(text: Column | str) -> Column:
    """White space as single spaces, none at the ends."""
    return strip(F.regexp_replace(F.col(text) if isinstance(text, str) else text, r"(?U)\s+", " "))


def _any_of(parts: tuple[str, ...]) -> str:
    return f"(?:{'|'.join(map(re.escape, parts))})"


def _holds(text: Column, parts: tuple[str, ...]) -> Column:
    return text.rlike(_any_of(parts)) if parts else F.lit(False)


def _ends(text: Column, parts: tuple[str, ...], behind: str = "") -> Column:
    """Whether a text ends in one of the parts, with ``behind`` before it."""
    return text.rlike(rf"(?s){behind}{_any_of(parts)}\z") if parts else F.lit(False)


def words(target: Column) -> Column:
    return F.filter(F.split(target, " "), lambda w: w != "")


def capitalised(word: Column) -> Column:
    """Whether the first letter of a word is a capital."""
    return F.regexp_extract(word, r"\p{L}", 0).rlike(r"\p{Lu}")


def bare(word: Column) -> Column:
    """A word without what is no letter, digit or underscore at its ends."""
    return F.regexp_replace(word, r"(?U)^\W+|\W+$", "")


def is_han(source: Column) -> Column:
    return F.regexp_replace(source, PUNCTUATION, "").rlike("^[一-鿿]+$")


def is_titled_person(source: Column, rules: Rules) -> Column:
    """Whether a source is a name with a person's title behind it."""
    return is_han(source) & _ends(source, rules.person_ends, ".")


def is_proper(target: Column) -> Column:
    """Whether a target looks like a name: two capitalised words, a single word that is one, or a title in book marks."""
    capitals = F.size(F.filter(words(target), capitalised))
    return (capitals >= 2) | ((capitals == 1) & (F.size(words(target)) == 1)) | (F.startswith(target, F.lit("《")) & F.endswith(target, F.lit("》")))


def drop_reason(source: Column, target: Column, mode: str, rules: Rules) -> Column:
    """Why an entry is unsound by itself; null if it is not.  ``auto`` drops all persons with titles, ``runtime`` those whose title is lost."""
    titled, low = is_titled_person(source, rules), F.lower(target)
    keeps = _holds(low, rules.titles)
    place = _ends(source, rules.place_ends)
    reason = (
        F.when((source == "") | (target == ""), "empty")
        .when(~is_han(source), "not_han")
        .when(source.rlike(r"\p{Nd}") | (F.startswith(source, F.lit("第")) & F.contains(source, F.lit("章"))), "numbered")
        .when(source.isin(*rules.common_sources) | low.isin(*rules.common_targets), "common")
        .when(target.rlike(rf"{PLACEHOLDER}|[?(（,;]") | _holds(low, rules.suspicious), "suspicious")
        .when(keeps & ~titled, "title_added")
    )
    if mode == "auto":
        reason = reason.when(titled, "titled_person")
    if mode == "runtime":
        reason = reason.when(titled & ~keeps, "title_lost")
    return reason.when(~(place | ((F.length(source) <= 8) & is_proper(target))), "no_name")


def _votes(entries: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Votes ``k, word, ord`` on the first words of names, and on the readings of characters."""
    named = entries.where(is_han(F.col("src")) & ~is_titled_person(F.col("src"), rules) & is_proper(F.col("dst")))
    head = bare(F.get(words(F.col("dst")), F.lit(0)))
    heads = named.where(F.length("src").between(2, 6)).select(F.substring("src", 1, 1).alias("k"), head.alias("word"), "ord")
    even = named.where((F.length("src") <= 4) & (F.size(words(F.col("dst"))) == F.length("src")))
    read = even.select(F.posexplode_outer(F.split("src", "")).alias("at", "k"), words(F.col("dst")).alias("ws"), "ord").where("at is not null")
    readings = read.select("k", bare(F.get("ws", F.col("at"))).alias("word"), (F.col("ord") * 8 + F.col("at")).alias("ord"))
    return heads.where("word <> ''"), readings.where("word <> '' and k <> ''")


def sanitized(entries: DataFrame, mode: str = "default", context: DataFrame | None = None, rules: Rules = Rules()) -> DataFrame:
    """``entries(src, dst, ord)`` with normalised white space and ``drop_reason``: null for those that are kept.

    Sources are different from each other.  In the modes ``auto`` and
    ``runtime`` the kept entries and those of ``context`` (replaced by kept ones
    of the same source) vote: ``head`` is told of entries whose first word is not
    the agreed one, ``reading`` of those in which two characters or more are not
    read as agreed.  Without any agreed first word nobody is dropped for either.

    Judged entries are written before they are read by verdict: a filter on a
    verdict would carry the rules, and all that sources and targets are made of,
    into every reader.  Entries are few bytes and much work, so they are dealt
    out to all cores before anything is done to them.
    """
    if mode not in MODES:
        raise ValueError(f"mode has to be one of {', '.join(MODES)}")
    dealt = dealt_out(entries, "src", "ord")
    clean = dealt.select(spaced(F.coalesce("src", F.lit(""))).alias("src"), spaced(F.coalesce("dst", F.lit(""))).alias("dst"), F.col("ord").cast("long").alias("ord"))
    judged = materialize(clean.withColumn("drop_reason", drop_reason(F.col("src"), F.col("dst"), mode, rules)))
    if mode == "default":
        return judged
    kept = judged.where("drop_reason is null").select("src", "dst", "ord")
    voters = kept
    if context is not None:  # its entries come first, and one that is replaced keeps its place
        before = context.select(spaced("src").alias("src"), spaced("dst").alias("dst"), F.col("ord").cast("long").alias("ord"))
        later = kept.withColumn("ord", F.col("ord") + (1 << 40)).join(before.select("src", F.col("ord").alias("first")), "src", "left")
        voters = before.join(kept.select("src"), "src", "left_anti").unionByName(later.select("src", "dst", F.coalesce("first", "ord").alias("ord")))
    head_votes, reading_votes = _votes(voters, rules)
    heads = materialize(majority(head_votes, "k", "word", "ord", HEAD_VOTES, HEAD_SHARE).select("k", F.col("dominant").alias("head")))
    if heads.isEmpty():
        return judged
    readings = majority(reading_votes, "k", "word", "ord", READING_VOTES, READING_SHARE).select("k", F.col("dominant").alias("reading"))
    named = kept.where(is_han(F.col("src")) & ~is_titled_person(F.col("src"), rules)).withColumn("ws", words(F.col("dst")))
    first = named.where(F.length("src").between(2, 6) & is_proper(F.col("dst"))).select("src", F.substring("src", 1, 1).alias("k"), bare(F.get("ws", F.lit(0))).alias("word"))
    off_head = first.where("word <> ''").join(heads, "k").where("word <> head").select("src", F.lit("head").alias("clash"))
    even = named.where(F.length("src").between(2, 4) & (F.size("ws") == F.length("src")))
    read = even.select("src", "ws", F.posexplode_outer(F.split("src", "")).alias("at", "k")).where("at is not null")
    read = read.select("src", "k", bare(F.get("ws", F.col("at"))).alias("word")).where("word <> ''").join(readings, "k")
    off_reading = read.groupBy("src").agg(F.count_if(F.col("word") != F.col("reading")).alias("n")).where("n >= 2").select("src", F.lit("reading").alias("clash"))
    clash = off_head.unionByName(off_reading).groupBy("src").agg(F.min("clash").alias("clash"))
    return judged.join(clash, "src", "left").select("src", "dst", "ord", F.when(F.col("drop_reason").isNull(), F.col("clash")).otherwise(F.col("drop_reason")).alias("drop_reason"))


def blocked_targets(judged: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``dst``: targets of dropped entries only, that look like names or titles and so should not come up in a text.

    One aggregate finds the targets that only dropped entries have, and the rules
    run on those: no side of a join is broadcast.
    """
    low, target = F.lower("dst"), F.col("dst")
    names = (F.size(words(target)) >= 2) & (F.size(F.filter(F.slice(words(target), 1, 3), capitalised)) >= 2)
    marked = F.contains(low, F.lit(" của ")) | _holds(low, rules.titles) | names
    targets = judged.where(target != "").groupBy("dst").agg(F.bool_and(F.col("drop_reason").isNotNull()).alias("dropped"))
    # One condition on the aggregate's result, as a filter on the target alone would be pushed below it and run on every entry.
    return targets.where(F.when(F.col("dropped"), marked).otherwise(False)).select("dst")
