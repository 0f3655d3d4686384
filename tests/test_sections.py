import duckdb
import pytest
from pyspark.sql import functions as F

from textloom.operators import quality, repair, sections
from textloom.plans import text_queries
from textloom.sources import files

HEADING = r"^第(\d+)章"
P = "这是一个段落内容，用于测试章节内重复检测。" * 12


def verify(spark, *batches):
    rows = spark.createDataFrame(list(batches), "file_name string, text string")
    cut = sections.split_sections(files.with_batch_range(rows), HEADING, ("file_name",))
    found = quality.verify(cut.withColumnRenamed("file_name", "batch"), HEADING)
    return {(r["number"], r["code"]) for r in found.collect()}


def test_repeated_block(spark):
    assert verify(spark, ("chuong_1-1.txt", f"第1章 标题\n\n{P}\n\n{P}\n")) == {(1, "duplicated_content")}


def test_clean_section(spark):
    assert verify(spark, ("chuong_1-1.txt", "第1章 标题\n\n" + "这是正常章节内容。" * 20)) == set()


def test_watermark_under_combining_marks(spark):
    line = "【記住本站域名 台灣小說網書庫多，t̲̲̅̅w̲̲̅̅k̲̲̅̅a̲̲̅̅n̲̲̅̅.c̲̲̅̅o̲̲̅̅m̲̲̅̅任你選 】"
    assert verify(spark, ("chuong_1-1.txt", f"第1章 标题\n\n{'这是正常章节内容。' * 20}\n{line}")) == {(1, "watermark_content")}
    assert verify(spark, ("chuong_1-1.txt", f"第1章 标题\n\n{'这是正常章节内容。' * 20}\nt̲w̲k̲a̲n̲.com")) == {(1, "watermark_content")}


def test_metadata_lines(spark):
    assert verify(spark, ("chuong_1-1.txt", "第1章 标题\n\n2026-03-09 11:41:07\n作者： 七柒四十九\n" + "这是正常章节内容。" * 20)) == {(1, "metadata_content")}


def test_short_empty_paged_and_missing(spark):
    text = "第1章 a\n\n短\n\n\n第2章 b\n\n\n第5章 c（1/2）\n\n" + "这是正常章节内容。" * 20
    assert verify(spark, ("chuong_1-9.txt", text)) == {
        (1, "invalid_chapter_content"),
        (2, "empty_chapter"),
        (3, "missing_chapter_in_batch"),
        (4, "missing_chapter_in_batch"),
        (5, "paginated_title"),
    }


def test_skipped_title_may_be_short(spark):
    assert verify(spark, ("chuong_1-1.txt", "第1章 略过\n\n本章内容与主线剧情无关。")) == set()


def test_repeated_number(spark):
    body = "这是正常章节内容。" * 20
    assert (1, "duplicate_chapter") in verify(spark, ("chuong_1-1.txt", f"第1章 a\n{body}"), ("chuong_2-2.txt", f"第1章 a\n{body}"))


def test_every_code_of_files(spark):
    good = "这是正常章节内容。" * 20
    files_of = spark.createDataFrame([("a", 1, 5), ("b", None, None), ("c", 6, 9)], "batch string, batch_start int, batch_end int")
    rows = [("a", 0, 1, "第1章 x", good), ("a", 1, 4, "第9章 x", good), ("b", 0, 4, "第4章 x", good), ("b", 1, 7, "第7章 x", "短")]
    cut = spark.createDataFrame(rows, "batch string, pos int, number int, title string, body string")
    failures = spark.createDataFrame([(1, "timeout", ""), (7, None, "again"), (90, "x", "")], "number int, reason string, details string")
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("gone",)], "batch string")
    codes = lambda df: sorted((r["batch"] or "", r["number"] or 0, r["code"]) for r in df.collect())
    got = quality.verify_files(files_of, cut, HEADING, asked, 1, 8, failures, fix_stale=False)
    assert codes(got) == sorted(
        [("a", 2, "missing_chapter_in_batch"), ("a", 3, "missing_chapter_in_batch"), ("a", 4, "header_mismatch"), ("b", 4, "duplicate_chapter")]
        + [("b", 0, "invalid_batch_filename"), ("b", 7, "invalid_chapter_content"), ("c", 0, "unparseable_file"), ("gone", 0, "missing_file")]
        + [("", n, "missing_chapter_in_range") for n in (2, 3, 5, 6, 8)]
        + [("", 1, "stale_manifest"), ("", 7, "failure_manifest_entry")]
    )
    assert ("", 1, "stale_manifest") not in codes(quality.verify_files(files_of, cut, HEADING, failures=failures))
    none = quality.verify_files(files_of.limit(0), cut)
    assert codes(none) == [("", 0, "no_origin_files")]


@pytest.mark.parametrize("whole", [False, True])
def test_sections_outside_the_range(spark, whole):
    files_of = spark.createDataFrame([("a", 1, 9)], "batch string, batch_start int, batch_end int")
    rows = [("a", 0, 1, "", "短"), ("a", 1, 4, "", "这是正常章节内容。" * 20), ("a", 2, 5, "", "这是正常章节内容。" * 20), ("a", 3, 8, "", "短")]
    cut = spark.createDataFrame(rows, "batch string, pos int, number int, title string, body string")
    got = {(r["number"], r["code"]) for r in quality.verify_files(files_of, cut, low=3, high=7, whole_files=whole).collect()}
    missing = {(n, "missing_chapter_in_range") for n in (3, 6, 7)}
    told = {(n, "invalid_chapter_content") for n in (1, 8)} | {(n, "missing_chapter_in_batch") for n in (3, 6, 7)}
    assert got == missing | (told if whole else set())


@pytest.mark.parametrize("n", [8, 13])
def test_the_last_section_of_verify_files_is_that_of_its_sql(spark, tmp_path, n):
    """The last number has an issue of its own, and (8) a gap before it."""
    duck = duckdb.connect()
    duck.execute(f"CREATE TABLE documents AS SELECT i AS doc_id, 'short ' || i AS text FROM range({n}) t(i); CREATE TABLE labels AS SELECT doc_id, 0 AS quality FROM documents")
    for name in ("documents", "labels"):
        duck.execute(f"COPY {name} TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
    want = duck.execute(text_queries.FILES_SQL).fetchall()
    got = text_queries.verify_files(spark, str(tmp_path)).select("batch", "number", "code", "message").collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def model_run(ids):
    best = 0
    for a in range(len(ids)):
        for b in range(a + 1, len(ids)):
            n = 0
            while b + n < len(ids) and ids[a + n] == ids[b + n]:
                n += 1
            best = max(best, n)
    return best


@pytest.mark.parametrize("ids", ["abcabcd", "aaaa", "abcd", "abcdefabcdef", "abcxabcyabcx", "a"])
def test_longest_run_is_that_of_all_pairs(spark, ids):
    lines = [c * 60 for c in ids]
    rows = spark.createDataFrame([("\n".join(lines),)], "text string")
    s = quality.with_duplication(rows, "text", "s").first()["s"]
    assert s["run_lines"] == model_run(ids)
    assert s["run_chars"] == 60 * model_run(ids)
    assert s["consecutive_lines"] == sum(x == y for x, y in zip(ids, ids[1:]))


def test_split_drops_what_stands_before_and_keeps_repeats(spark):
    rows = spark.createDataFrame([("f", "intro\n第1章 a\nx\n第1章 b\ny\n\n第3章 c")], "k string, text string")
    got = sections.split_sections(rows, HEADING, ("k",)).orderBy("pos").collect()
    assert [(r["number"], r["title"], r["body"]) for r in got] == [(1, "第1章 a", "x"), (1, "第1章 b", "y"), (3, "第3章 c", "")]


def test_upsert_keeps_first_existing_and_last_new(spark):
    old = spark.createDataFrame([("b", 1, 0, "old1"), ("b", 2, 0, "old2"), ("b", 2, 1, "later")], "batch string, number int, pos int, block string")
    new = spark.createDataFrame([("b", 3, 0, "n3"), ("b", 1, 0, "n1"), ("b", 1, 1, "n1b")], "batch string, number int, pos int, block string")
    got = {r["number"]: r["block"] for r in sections.upsert_merge(old, new, ("batch",)).collect()}
    assert got == {1: "n1b", 2: "old2", 3: "n3"}


def test_repair_with_a_gap(spark):
    own = spark.createDataFrame([(1, 0, "第1章", "a"), (3, 0, "第3章", "c")], "number int, pos int, title string, body string")
    new = spark.createDataFrame([(3, 0, "第3章", "新")], own.schema)
    expected = spark.createDataFrame([("1-3", n) for n in (1, 2, 3)], "batch string, number int")
    got = {r["number"]: (r["title"], r["body"], r["action"]) for r in repair.apply_repairs(own, new, expected).collect()}
    assert got == {1: ("第1章", "a", "kept"), 2: ("第2章 略过", repair.PLACEHOLDER, "placeholder_added"), 3: ("第3章", "新", "replaced_from_source")}


def test_canonical_block(one):
    assert one(sections.canonical_block("t", "b"), t="第1章 a", b="\n第1章 a\n\n text \nmore") == "第1章 a\n\ntext\nmore"
    assert one(sections.canonical_block("t", "b"), t="第1章 a", b="第1章 a\n") == "第1章 a"


def test_packing(spark):
    sizes = F.array(*[F.lit(n).cast("long") for n in (3, 4, 5, 2, 9)])
    assert spark.range(1).select(sections.pack_chunks(sizes, 8)).first()[0] == [1, 1, 2, 2, 3]


def test_batch_files_round_trip(spark, tmp_path):
    (tmp_path / "chuong_11-20.txt").write_text("第11章 a\r\nx")
    (tmp_path / "chuong_1-10.txt").write_text("第1章 b\ny")
    (tmp_path / "chuong_odd.txt").write_text("z")
    got = files.batch_order(files.read_batches(spark, str(tmp_path))).collect()
    assert [(r["file_name"], r["batch_start"]) for r in got] == [("chuong_1-10.txt", 1), ("chuong_11-20.txt", 11), ("chuong_odd.txt", None)]
    assert got[1]["value"] == "第11章 a\nx"
    out = str(tmp_path / "out")
    one = spark.createDataFrame([(1, 10, "a"), (11, 20, "b")], "batch_start long, batch_end long, text string")
    files.write_batches(one, out)
    files.write_batches(spark.createDataFrame([(11, 20, "c")], one.schema), out)
    assert {(r["batch_start"], r["text"]) for r in spark.read.parquet(out).collect()} == {(1, "a"), (11, "c")}


def test_captions(spark):
    rows = spark.createDataFrame([(1, "1\n00:00:01,000 --> 00:00:02,000\n阿伟来了\n\n2\n00:00:03,000 --> 00:00:04,000\n一\n二")], "k int, text string")
    assert [r["pos"] for r in files.caption_lines(rows, ("k",)).orderBy("pos").collect()] == [2, 6, 7]


def test_log_fields(spark):
    line = "2026-03-09 11:41:07,123 | WARNING | quota blocked_model=gemma-3-27b-it model=other suggested_wait=16.09s)"
    r = files.parsed_log(spark.createDataFrame([(line,), ("no log",)], "line string")).collect()
    assert (r[0]["level"], r[0]["model"], r[0]["wait_seconds"]) == ("WARNING", "gemma-3-27b-it", 16.09)
    assert r[1]["at"] is None and r[1]["message"] == "no log"


def test_sections_carried_around_code(spark):
    text = "### Chapter 2200\na\n```\n### Chapter 9\nb\n```\nc"
    rows = files.exploded_lines(spark.createDataFrame([(1, text)], "k int, text string"), ("k",))
    got = files.carried_sections(rows, ("k",), r"^### Chapter (\d+)").orderBy("pos").collect()
    assert [r["number"] for r in got] == [2200] * 7
    assert [r["fenced"] for r in got] == [False, False, False, True, True, False, False]
