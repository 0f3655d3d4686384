import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.operators import terms


@pytest.mark.parametrize(
    "seconds, shown",
    [(47.0, "47s"), (60.0, "1m:0s"), (180.0, "3m:0s"), (181.0, "3m"), (3723.0, "1h:2m"), (0.0, ""), (-5.0, ""), (0.2, "1s")],
)
def test_countdown(one, seconds, shown):
    assert one(tx.format_countdown("x"), x=seconds) == shown


def test_countdown_of_nothing(spark):
    assert spark.sql("select cast(null as double) x").select(tx.format_countdown("x")).first()[0] == ""


@pytest.mark.parametrize("n, delay", [(1, 3), (2, 6), (3, 12), (4, 24), (5, 48), (6, 60), (20, 60), (0, 3)])
def test_backoff(one, n, delay):
    assert one(tx.backoff("n"), n=n) == delay


def test_white_space(one):
    assert one(tx.normalize_whitespace("t"), t="　 a b\tc\r\n ") == "a b c"
    assert one(tx.squeeze("t"), t="a  \t b") == "a b"


def test_ellipsis_and_slug(one):
    assert one(tx.normalize_ellipsis("t"), t="a… ...b.....") == "a...b..."
    assert one(tx.slugify("t"), t="  Ab c/ D!") == "ab-c-d"


@pytest.mark.parametrize("text, found", [(" 3-12 ", (3, 12)), ("12-3", None), ("x-3", None), ("7-7", (7, 7))])
def test_range(one, text, found):
    assert one(tx.parse_range("t"), t=text) == found


@pytest.mark.parametrize("title, rest", [("第1章 标题（第2/3页）", "第1章 标题"), ("Title (1/2) ", "Title"), ("Title 1/2", "Title 1/2")])
def test_page_suffix(one, title, rest):
    assert one(tx.strip_page_suffix("t"), t=title) == rest


def test_job_ids(one):
    assert one(tx.encode_job_id("a", "b", "n"), a="x", b="f.txt", n=7) == "x::f.txt::0007"
    assert one(tx.decode_job_id("j"), j="x::f.txt::0007") == ("x", "f.txt", 7)
    assert one(tx.decode_job_id("j"), j="x::0007") is None


def test_hashes(one):
    assert one(tx.content_hash("t"), t=" a \t\r\nb\n\n") == hashlib.sha256(b"a\nb").hexdigest()
    assert one(tx.key_token("t"), t=" k ") == "key_" + hashlib.sha256(b"k").hexdigest()[:16]
    assert one(tx.key_token("t"), t=" ") == ""


def test_repeats(one):
    assert one(tx.collapse_repeats("t", ("very",)), t="The the very very big Big dog") == "The very very big dog"
    assert one(tx.collapse_phrases("t"), t="come here come here now") == "come here now"


def test_camel(one):
    assert one(tx.split_camel("t"), t="HộiLâm iPhone McDonald") == "Hội Lâm iPhone McDonald"


def test_ordered_replacement(one):
    pairs = F.array(*[F.struct(F.lit(a).alias("src"), F.lit(b).alias("dst")) for a, b in (("a", "b"), ("b", "c"), ("", "x"))])
    assert one(tx.ordered_replace("t", pairs), t="ab") == "cc"


def test_tokens(one):
    assert one(tx.estimate_tokens("t"), t="") == 1
    assert one(tx.estimate_tokens("t"), t="汉" * 100) == 53
    assert one(tx.estimate_tokens("t", reserve=True), t="a" * 400) == 374
    assert one(tx.estimate_queue_tokens("t"), t="a" * 400) == 111


def test_masking_leaves_a_target_that_holds_a_token(one):
    pairs = F.array(*[F.struct(F.lit(a).alias("src"), F.lit(b).alias("dst")) for a, b in (("上京之变", "Biến cố ZXQ125QXZ"), ("上京", "Thượng Kinh"))])
    masked = terms.mask("t", pairs)
    assert one(masked, t="上京之变 上京") == "ZXQ002QXZ之变 ZXQ002QXZ"
    assert one(terms.unmask(masked, pairs), t="上京之变 上京 ZXQ077QXZ") == "Thượng Kinh之变 Thượng Kinh "


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab \t \n", max_size=12), min_size=1, max_size=20))
def test_strip_is_that_of_unicode(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.strip("t").alias("s")).collect()
    assert all(r["s"] == r["t"].strip() for r in rows)


def test_folding_is_that_of_every_character(spark):
    """Texts folded by translating them, and those that Python folds, against the plain fold."""
    from textloom.operators import quality

    texts = ["", None, "ABC def", "Größe ÄÖÜ éè", "ﬁne ½ ㎏", "t̲̲̅̅w̲̲̅̅k", "台灣小說網 ＡＢＣ", "İstanbul ǅ ſ", "한국어", "𝒜𝔅 😀", "ẞß", "​­́", "Ἀθῆναι Ωμέγα Σς"]
    texts += ["".join(map(chr, range(k, k + 64))) for k in (*range(0x80, 0x2800, 64), *range(0x3000, 0x3400, 64), *range(0xF900, 0xFB80, 64), *range(0xFE00, 0xFFC0, 64))]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["f"] for r in rows.select("i", quality.folded("t").alias("f")).collect()}
    assert got == {i: t if t is None else quality._fold(t) for i, t in enumerate(texts)}
