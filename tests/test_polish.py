import pytest
from pyspark.sql import functions as F

from textloom.functions import polish, titles
from textloom.functions import text as tx

SPLIT = (
    "Chương 1\n\nNguyệt Minh Châu từ biệt Đối với Phương Thần hoàn toàn không biết gì về việc này, "
    "lén lút lấy ra Ngọc Điệp Đổi Mệnh.\n\nPhần tiếp theo."
)

# What the pass makes of a text.
GOLDENS = [
    ("Chương 1\n\nTỷ thay gả\n\nPhương Thần bước vào đại điện.", 1, "Chương 1: Tỷ thay gả.\n\nPhương Thần bước vào đại điện.\n"),
    ("Chương 1\n\nCái gì?\n\nPhương Thần ngẩng đầu nhìn lên.", 1, "Chương 1: Cái gì?\n\nPhương Thần ngẩng đầu nhìn lên.\n"),
    ("Chương 1041: Dùng máu viết chữ Ừm?\n\nPhương Thần trợn tròn mắt.", 1041, "Chương 1041: Dùng máu viết chữ Ừm?\n\nPhương Thần trợn tròn mắt.\n"),
    ("Chương 1: Tỷ Thay Giá.\n\nPhương Thần bước vào đại điện.", 1, "Chương 1: Tỷ Thay Giá.\n\nPhương Thần bước vào đại điện.\n"),
    (
        "Chương 71: Đắc tội người không nên đắc tội. Đắc tội người không nên đắc tội.\n\nNội dung tiếp theo.",
        71,
        "Chương 71: Đắc tội người không nên đắc tội.\n\nNội dung tiếp theo.\n",
    ),
    ("Chương 222: Không Ai Là. Đối Thủ.\n\nNội dung tiếp theo.", 222, "Chương 222: Không Ai Là Đối Thủ.\n\nNội dung tiếp theo.\n"),
    (
        "Chương 714: Đến Cực Kỳ Vô Sỉ. Đến mức vô sỉ tột độ.\n\nNội dung tiếp theo.",
        714,
        "Chương 714: Đến Cực Kỳ Vô Sỉ.\n\nNội dung tiếp theo.\n",
    ),
    (
        "Chương 68: Sự khác biệt trong cách. đối xử với hai tỷ muội. Đối đãi khác biệt của hai tỷ muội.\n\nNội dung tiếp theo.",
        68,
        "Chương 68: Sự khác biệt trong cách đối xử với hai tỷ muội.\n\nNội dung tiếp theo.\n",
    ),
    (
        "Chương 1\n\nPhương Thần đang suy tư.\n\nLàn sương tím dần tan đi.",
        1,
        "Chương 1\n\nPhương Thần đang suy tư.\n\nLàn sương tím dần tan đi.\n",
    ),
    (
        SPLIT,
        1,
        "Chương 1: Nguyệt Minh Châu từ biệt.\n\nĐối với Phương Thần hoàn toàn không biết gì về việc này, lén lút lấy ra Ngọc Điệp Đổi Mệnh.\n\n"
        "Phần tiếp theo.\n",
    ),
    (
        "Chương 1\n\nBởi vì không tranh được Phương Thần, nên tức đến phát bệnh?\n\nPhần tiếp theo.",
        1,
        "Chương 1: Bởi vì không tranh được Phương Thần, nên tức đến phát bệnh?\n\nPhần tiếp theo.\n",
    ),
    ("", 7, "Chương 7\n"),
    (None, 7, None),
]


@pytest.fixture(scope="module")
def run(spark):
    def polished(texts, **options):
        rows = spark.createDataFrame([(i, n, t) for i, (t, n) in enumerate(texts)], "i int, n int, t string")
        return [r["out"] for r in polish.polish(rows, "t", "n", "out", **options).orderBy("i").collect()]

    return polished


def test_goldens(run):
    assert run([(t, n) for t, n, _ in GOLDENS]) == [x for _, _, x in GOLDENS]


def test_words(run):
    got = run(
        [
            ("Ngôi nhà ngôi nhà Bình Minh nằm bên hồ.\n\nHọ dừng ở quán trọ quán trọ đầu làng.\n", 1),
            ("Trời rất rất lạnh.\n", 1),
            ("Cậu bé lắc đầu... rồi chạy đi.\n", 1),
            ("Cậu bé lắc đầu… rồi chạy đi.\n", 1),
            ("Ba người bạn, Đông Hải PhốHoa Lan……\n", 1),
            ("Cô ấy mua iPhone mới.\n", 1),
            ("Chương 1\n\nMèo~kêu khẽ ~ rồi nằm xuống.\n", 1),
        ]
    )
    assert "Ngôi nhà Bình Minh" in got[0] and "ở quán trọ đầu làng" in got[0] and "ngôi nhà" not in got[0]
    assert "rất rất" in got[1]
    assert "lắc đầu... rồi chạy đi" in got[2] and "," not in got[2]
    assert "lắc đầu rồi chạy đi" in got[3] and "…" not in got[3]
    assert "Đông Hải Phố Hoa Lan" in got[4]
    assert "iPhone" in got[5]
    assert "Mèo kêu khẽ rồi nằm xuống." in got[6] and "~" not in got[6]


def test_replacements(run):
    pairs = F.array(F.struct(F.lit("Ôi chao").alias("src"), F.lit("Trời ơi").alias("dst")))
    assert run([("Ôi chao, đẹp quá.\n", 1)], replacements=pairs) == ["Chương 1\n\nTrời ơi, đẹp quá.\n"]


def test_forced_title(run):
    text = "Chương 3\n\nHắn đi rồi. Không ai biết.\nVà hết.\n"
    assert run([(text, 3)], force_title=True) == ["Chương 3: Hắn đi rồi.\n\nVà hết.\n"]


def test_quotes_and_paragraphs(run):
    got = run([('Chương 2\n\nHắn nói: "Đi thôi ."\n" Được"\nkhông ai đáp\n' + "Một câu rất dài ở đây. " * 20, 2)])[0]
    lines = got.rstrip("\n").split("\n\n")
    assert lines[0] == "Chương 2" and lines[1].startswith("Hắn nói: “Đi thôi .”")
    assert "\n\nkhông" not in got and max(map(len, lines)) <= polish.LONGEST + 40


def test_a_title_ends_where_a_body_begins(one):
    assert one(titles.split_title(F.col("t")), t=SPLIT.split("\n")[2])[0] == "Nguyệt Minh Châu từ biệt"
    assert one(titles.split_title(F.col("t")), t="Một hai") is None


@pytest.mark.parametrize(
    "text, split",
    [("McDonaldTrump HộiLâm iPhone", "McDonaldTrump Hội Lâm iPhone"), ("A" + "b" * 90 + "Cd", "A" + "b" * 90 + " Cd"), ("x1Ab", "x1Ab"), ("", "")],
)
def test_camel_of_whole_words(one, text, split):
    assert one(tx.split_camel("t"), t=text) == split


def test_repeats_reach_a_fixed_point(one):
    assert one(tx.collapse_repeats("t"), t="no, no no. No no") == "no, no. No"
    assert one(tx.collapse_phrases("t"), t="a b " * 40 + "c") == "a b c"
    nested = "x y x y z x y x y z w"
    assert one(tx.collapse_phrases("t"), t=nested) == "x y z w"
    assert one(tx.collapse_phrases("t"), t="one\ntwo one two") == "one\ntwo one two"


def test_rules_run_once(spark):
    rows = spark.createDataFrame([(1, "x")], "n int, t string")
    plan = polish.polish(rows, "t", "n")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("loadAdv") == 1 and plan.count("(?mdU)^([ \\t]*)“") == 1


def test_phrases_end_at_letters_that_are_no_word_characters(one):
    assert one(tx.collapse_phrases("t"), t="a b×c a b x a b a b") == "a b×c a b x a b"
    assert one(tx.collapse_phrases("t"), t="ab cd ab cd×e") == "ab cd×e"
    assert one(tx.collapse_phrases("t"), t="ab cd ab cde ab cd1 ab cd1") == "ab cd ab cde ab cd1 ab cd1"
