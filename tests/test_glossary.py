import pytest
from pyspark.sql import functions as F

from textloom.operators import glossary, variants
from textloom.plans import glossary_queries


def judged(spark, entries, mode="default", context=None):
    rows = spark.createDataFrame([(s, d, i) for i, (s, d) in enumerate(entries)], "src string, dst string, ord int")
    given = None if context is None else spark.createDataFrame([(s, d, i) for i, (s, d) in enumerate(context)], "src string, dst string, ord int")
    return {r["src"]: r["drop_reason"] for r in glossary.sanitized(rows, mode, given).collect()}


def test_every_rule(spark):
    entries = {
        "": ("x", "empty"), "空": (None, "empty"), "abc": ("Abc Def", "not_han"), "云3": ("Vân", "not_han"), "第章": ("Chương", "numbered"), "公司": ("Công Ty", "common"),
        "云海": ("khách sạn", "common"), "云山": ("ZXQ731QTrường", "suspicious"), "云河": ("Vân Hà?", "suspicious"), "云天": ("Vân, Thiên", "suspicious"),
        "云地": ("Ám chỉ Vân", "suspicious"), "云风": ("Vân Phong Tiểu Thư", "title_added"), "云火": ("vân hoả", "no_name"), "云火山": ("vân hoả sơn", None),
        "云花": ("Vân Hoa", None), "云": ("Vân", None), "书名": ("《thư danh》", None), "《云》": ("Vân Thư", None), "一二三四五六七八九": ("Vân Hoa Nguyệt", "no_name"), "云小姐": ("Vân tiểu thư", "no_name"), "王小姐": ("Vương Tiểu Thư", None),
    }
    assert judged(spark, [(s, d) for s, (d, _) in entries.items()]) == {s: why for s, (_, why) in entries.items()}


def test_modes_treat_persons_with_titles_apart(spark):
    entries = [("王小姐", "Vương Tiểu Thư"), ("李师兄", "Lý Anh"), ("王明", "Vương Minh")]
    assert judged(spark, entries) == {"王小姐": None, "李师兄": None, "王明": None}
    assert judged(spark, entries, "auto") == {"王小姐": "titled_person", "李师兄": "titled_person", "王明": None}
    assert judged(spark, entries, "runtime") == {"王小姐": None, "李师兄": "title_lost", "王明": None}
    with pytest.raises(ValueError):
        judged(spark, entries, "other")


def test_votes_of_entries_and_context(spark):
    agreed = [("王明", "Vương Minh"), ("王海", "Vương Hải"), ("王山", "Vương Sơn")]
    odd = [("王安", "Ông An"), ("明海", "Sáng Biển"), ("海明", "Hải Minh")]
    assert judged(spark, [*agreed, *odd], "runtime") == {"王明": None, "王海": None, "王山": None, "王安": "head", "明海": None, "海明": None}
    # The context's votes make 明 and 海 agreed on, too.
    context = [("明安", "Minh An"), ("安海", "An Hải"), ("李海", "Lý Hải"), ("王明", "Something Else")]
    assert judged(spark, [*agreed, *odd], "runtime", context)["明海"] == "reading"
    assert judged(spark, odd, "auto", context) == {"王安": None, "明海": None, "海明": None}  # no first word has three votes


def test_first_seen_wins_a_tie_and_replaced_context_keeps_its_place(spark):
    entries = [("王一", "Vương Nhất"), ("王二", "Vương Nhị"), ("王三", "Vương Tam"), ("王四", "Hoàng Tứ")]
    assert judged(spark, entries, "runtime")["王四"] == "head"
    even = [*entries, ("王五", "Hoàng Ngũ"), ("王六", "Hoàng Lục")]
    assert set(judged(spark, even, "runtime").values()) == {None}  # half of the votes is no majority


def test_blocked_targets(spark):
    entries = [("abc", "Lý An"), ("云火", "lý an"), ("def", "Kẻ của Đêm"), ("云海", "Vân Hải"), ("ghi", "Vân Hải"), ("x", "sư đệ"), ("y", "Một hai ba Bốn"), ("z", "")]
    rows = spark.createDataFrame([(s, d, i) for i, (s, d) in enumerate(entries)], "src string, dst string, ord int")
    assert sorted(r["dst"] for r in glossary.blocked_targets(glossary.sanitized(rows)).collect()) == ["Kẻ của Đêm", "Lý An", "sư đệ"]


@pytest.mark.parametrize("n", [2, 3, 40])
def test_chains_of_characters_are_one_class(spark, n):
    chars = [chr(0x4E00 + (k * 37) % 997) for k in range(n)]
    pairs = list(zip(chars, chars[1:])) + [("a", "b"), ("ab", "c"), (None, "d"), ("z", "z")]
    got = {r["char"]: r["canonical"] for r in variants.character_classes(spark.createDataFrame(pairs, "a string, b string")).collect()}
    assert got == {c: min(chars) for c in chars} | {"a": "a", "b": "a", "z": "z"}


def test_variants_meet(spark):
    classes = variants.character_classes(spark.createDataFrame([("群", "羣"), ("云", "雲"), ("雲", "芸")], "a string, b string"))
    left = spark.createDataFrame([(1, "羣 云"), (2, "云云"), (3, ""), (4, None), (5, "x")], "i int, t string")
    right = spark.createDataFrame([(1, " 群\t芸"), (2, "雲芸"), (3, ""), (4, "X"), (5, None)], "j int, u string")
    got = variants.variant_join(left, right, "t", "u", classes)
    assert sorted((r["i"], r["j"]) for r in got.collect()) == [(1, 1), (2, 2)] and got.columns == ["i", "t", "j", "u"]
    none = variants.character_classes(spark.createDataFrame([], "a string, b string"))
    assert variants.variant_join(left, right, "t", "u", none).count() == 0
    assert left.select(variants.canonical(F.col("t"), none).alias("t")).where("t = '羣 云'").count() == 1


def test_rules_are_evaluated_before_entries_are_read_by_verdict(spark):
    """What sources are made of does not come up in the plan of what is kept or blocked."""
    src = F.concat(F.lit("王"), F.translate(F.col("id").cast("string"), "0123456789", "王李张赵山安平海城主"))
    entries = spark.range(40).select(src.alias("src"), F.when(F.col("id") % 2 == 0, "Vương An").otherwise("vương ?").alias("dst"), F.col("id").alias("ord"))
    for found in (glossary.sanitized(entries), glossary.sanitized(entries, "runtime")):
        assert "translate(" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_blocked_targets_read_verdicts_and_not_rules(spark):
    src = F.translate(F.col("id").cast("string"), "0123456789", "王李张赵山安平海城主")
    entries = spark.range(40).select(src.alias("src"), F.when(F.col("id") % 2 == 0, "Vương An").otherwise("vương ?").alias("dst"), F.col("id").alias("ord"))
    assert "translate(" not in glossary.blocked_targets(glossary.sanitized(entries))._jdf.queryExecution().optimizedPlan().toString()


def test_entries_are_dealt_out_before_they_are_made(spark, tmp_path):
    spark.range(1, 41, 1, 1).selectExpr("id AS p_partkey", "int(id) AS p_size", "'Brand#1' AS p_brand").write.parquet(f"{tmp_path}/part.parquet")
    assert glossary_queries.entries_of(spark, str(tmp_path)).rdd.getNumPartitions() > 1


def test_blocked_targets_are_found_without_a_join(spark):
    entries = spark.createDataFrame([("abc", "Lý An", 1), ("云海", "Vân Hải", 2), ("ghi", "Vân Hải", 3)], "src string, dst string, ord int")
    assert "Join" not in glossary.blocked_targets(glossary.sanitized(entries))._jdf.queryExecution().optimizedPlan().toString()
