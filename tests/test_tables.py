import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import drift, licences, quality, ranges, relational, replay, terms, usage
from textloom.operators.ranges import BatchRule
from textloom.operators.replay import Limits
from textloom.plans import relational_queries
from textloom.sources import web


def pairs(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_schedule_of_rules(spark):
    row = spark.createDataFrame([(4, 23)], "low int, high int")
    got = ranges.batch_schedule(row, "low", "high", [BatchRule(1, 20, 5), BatchRule(21, 30, 2)], 10)
    assert pairs(got, "start", "end") == [(1, 5), (6, 10), (11, 15), (16, 20), (21, 22), (23, 24)]


def test_episode(spark):
    row = spark.createDataFrame([(11, 15)], "low int, high int")
    got = ranges.batch_schedule(row, "low", "high", [BatchRule(1, 20, 5)], 10)
    assert pairs(got, "start", "end", "episode") == [(11, 15, 3)]


def test_default_batches_keep_their_alignment_after_a_rule(spark):
    row = spark.createDataFrame([(24, 41)], "low int, high int")
    got = ranges.batch_schedule(row, "low", "high", [BatchRule(1, 25, 5)], 10)
    assert pairs(got, "start", "end") == [(21, 25), (21, 30), (31, 40), (41, 50)]


def test_overlap_join_is_the_plain_one(spark):
    rng = random.Random(3)
    make = lambda n: [(i, a := rng.randrange(-50, 300), a + rng.randrange(-3, 90)) for i in range(n)]
    left, right = make(80), make(60)
    a = spark.createDataFrame(left, "i int, s int, e int")
    b = spark.createDataFrame(right, "j int, f int, t int")
    want = sorted((i, j) for i, s, e in left for j, f, t in right if s <= e and f <= t and s <= t and f <= e)
    assert pairs(ranges.overlap_join(a, b, ("s", "e"), ("f", "t"), 17), "i", "j") == want


def test_one_span_over_everything(spark):
    """A span over a billion points is dealt to as many bins as the other side has levels, and no pair is lost or doubled."""
    rng = random.Random(7)
    spans = [(i, s, s + rng.choice([0, 3, 40, 900])) for i, s in enumerate(rng.sample(range(-500_000_000, 500_000_000), 300))]
    wide = [(0, -(10**9), 10**9), (1, -5, 5), (2, 0, 0), (3, -(2**60), 2**60), (4, 7, 3), (5, None, 4)]
    a = spark.createDataFrame(spans + [(900, -3, 2), (901, 0, 0), (902, 4, 6)], "i int, s long, e long")
    b = spark.createDataFrame(wide, "j int, f long, t long")
    want = sorted((i, j) for i, s, e in a.collect() for j, f, t in wide if f is not None and f <= t and s <= t and f <= e)
    assert pairs(ranges.overlap_join(a, b, ("s", "e"), ("f", "t"), 32), "i", "j") == want
    assert pairs(ranges.overlap_join(b, a, ("f", "t"), ("s", "e"), 32), "i", "j") == want
    x, y = ranges.binned(a, F.col("s"), F.col("e"), 32), ranges.binned(b, F.col("f"), F.col("t"), 32)
    assert x.count() == 303 and y.count() == 4  # a row each on their own side
    dealt = ranges._above(y, ranges._levels(x), "f", 32, True).groupBy("j").count().collect()
    assert all(r["count"] <= len(ranges._levels(x)) <= 12 for r in dealt)


def test_rules_of_all_widths(spark):
    rules = [(-(10**12), -1, 1), (0, 0, 2), (1, 63, 3), (64, 10**9, 4), (10**9 + 7, 10**9 + 7, 5)]
    points = [-(10**12) - 1, -(10**12), -1, 0, 1, 40, 63, 64, 10**9, 10**9 + 1, 10**9 + 7, 40, None]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "i int, p long")
    got = ranges.rule_lookup(frame, "p", spark.createDataFrame(rules, "start long, end long, v int"), "v", F.lit(-1))
    want = [(i, next((v for s, e, v in rules if p is not None and s <= p <= e), -1)) for i, p in enumerate(points)]
    assert got.columns == ["i", "p", "v"] and pairs(got, "i", "v") == want


def lagged_segments(known, bounds):
    out = []
    for key, low, high in bounds:
        ids = sorted(i for k, i in known if k == key and low <= i <= high)
        if not ids or ids[0] != low or ids[-1] != high:
            continue
        last = 0
        for i in ids:
            diff = i - known[key, i]
            if diff != last:
                out.append((key, known[key, i], diff))
            last = diff
    return sorted(out)


@pytest.mark.parametrize("fan", [1, 2, 8])
def test_drift_is_found_by_searching(spark, fan):
    """Sources with growing drifts, unknown ids, and changes next to each other and to the ends."""
    rng = random.Random(fan)
    known, bounds = {}, []
    for key in range(7):
        size, number = (1, 2, 9, 300, 300, 1000, 40)[key], 0
        for i in range(1, size + 1):
            if key == 6 and 5 < i < 37:
                continue  # a long gap of unknown ids, the drift changing inside it
            number = i - (0 if key == 6 and i <= 5 else 4 if key == 6 else sum(i >= c for c in (3, 4, 120, 121, 250, 300)))
            if i in (1, size) or rng.random() > 0.2:
                known[key, i] = number
        bounds.append((key, 1, size))
    known.pop((5, 1000), None)  # its last id is unknown
    numbered = spark.createDataFrame([(k, i, n) for (k, i), n in known.items()], "k int, id long, number long")
    asked = []
    plain = drift.table_probe(numbered, ["k"])
    probe = lambda rows: asked.append(rows.count()) or plain(rows)
    got = drift.drift_segments(spark.createDataFrame(bounds, "k int, low long, high long"), probe, ["k"], fan=fan)
    assert pairs(got, "k", "start", "diff") == lagged_segments(known, bounds)
    if fan == 8:
        assert len(asked) <= 8 and sum(asked) < 0.7 * sum(b for _, _, b in bounds)


def test_a_search_of_drifts_sends_no_table_through_the_driver(spark, monkeypatch):
    plans, real = [], drift.materialize
    monkeypatch.setattr(drift, "materialize", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    numbered = spark.range(300).selectExpr("id div 50 AS k", "id % 50 + 1 AS id", "id % 50 + 1 - int(id % 50 > 20) AS number")
    bounds = spark.range(6).selectExpr("id AS k", "1L AS low", "50L AS high")
    got = drift.drift_segments(bounds, drift.table_probe(numbered, ["k"]), ["k"])
    assert pairs(got, "k", "start", "diff") == [(k, 21, 1) for k in range(6)]
    assert len(plans) > 1 and not any("Broadcast" in p for p in plans) and all("SortMergeJoin" in p for p in plans)


def test_numbers_become_ids(spark):
    segments = spark.createDataFrame([("a", 2381, 4), ("a", 2400, 9)], "book string, start long, diff long")
    numbers = spark.createDataFrame([("a", 2380), ("a", 2381), ("a", 2400), ("b", 5)], "book string, number long")
    got = drift.numbers_to_ids(numbers, segments, ["book"])
    assert pairs(got, "book", "number", "id") == [("a", 2380, 2380), ("a", 2381, 2385), ("a", 2400, 2409), ("b", 5, 5)]


def test_corrected_ids(one):
    fix = lambda url, e, a: one(drift.corrected_id(F.col("u"), "chapterid", F.lit(e), F.lit(a)), u=url)
    assert fix("https://x.example/api?id=7&chapterid=12", 10, 8) == "https://x.example/api?id=7&chapterid=14"
    assert fix("https://x.example/api?chapterid=12&b=chapterid", 8, 10) == "https://x.example/api?chapterid=10&b=chapterid"
    assert fix("https://x.example/api?chapterid=12", 8, 8) is None
    assert fix("https://x.example/api?chapterid=1", 2, 9) is None
    assert fix("https://x.example/api?other=1", 2, 1) is None and fix("https://x.example/api?chapterid=x", 2, 1) is None


@pytest.mark.parametrize("block", [0, 7])
def test_asof_is_the_plain_one(spark, block):
    rng = random.Random(5)
    rows = [(i, rng.randrange(3), rng.randrange(60)) for i in range(60)]
    segments = [(k, t, 100 * k + t) for k in range(3) for t in rng.sample(range(60), 6)]
    want = sorted((i, max(((t, v) for g, t, v in segments if g == k and t <= at), default=(0, None))[1] or -1) for i, k, at in rows)
    a = spark.createDataFrame(rows, "i int, k int, at int")
    b = spark.createDataFrame(segments, "k int, start int, v int")
    got = ranges.asof(a, b.withColumnRenamed("v", "value"), ["k"], "at", "start", "value", block)
    assert pairs(got.select("i", F.coalesce("value", F.lit(-1)).alias("v")), "i", "v") == want


def test_offset_segments(spark):
    numbers = spark.createDataFrame([(n,) for n in (2379, 2380, 2381, 2382)], "n int")
    segments = spark.createDataFrame([(1, 0), (2381, -4)], "start int, diff int")
    got = ranges.asof(numbers, segments, [], "n", "start", "diff")
    assert pairs(got.select((F.col("n") + F.col("diff")).alias("id")), "id") == [(2377,), (2378,), (2379,), (2380,)]


def test_proxies(spark):
    got = relational.modulo_assign(spark.range(1, 11).toDF("i"), "i", ["p1", "p2"], 3)
    assert [r["proxy"] for r in got.orderBy("i").collect()] == [None, "p1", "p1", "p1", "p2", "p2", "p2", "p1", "p2", "p1"]


def test_candidate_merge(spark):
    from textloom.operators.repair import merge_rules

    schema = "number int, url string, pos int"
    a = spark.createDataFrame([(12, "a", 0)], schema)
    b = spark.createDataFrame([(12, "a", 0), (12, "b", 1), (13, "c", 0)], schema)
    assert pairs(merge_rules([a, b]), "number", "place", "url") == [(12, 1, "a"), (12, 2, "b"), (13, 1, "c")]


def test_majority_prefers_the_first_seen(spark):
    votes = spark.createDataFrame([("g", "x", 2), ("g", "y", 1), ("g", "x", 3), ("g", "y", 4), ("h", "z", 5)], "g string, c string, o int")
    assert pairs(relational.majority(votes, "g", "c", "o", 2, 0.5), "g", "dominant", "votes", "total") == [("g", "y", 2, 4)]


def test_terms_in_texts(spark):
    texts = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "the category"), (3, None), (4, "")], "d int, t string")
    words = spark.createDataFrame([(1, "cat sat"), (2, "the"), (3, "cat"), (4, "dog")], "k int, w string")
    got = terms.contained_strings(texts, words, "t", "w", ["d"], ["k"])
    assert pairs(got, "d", "k") == [(1, 1), (1, 2), (1, 3), (2, 2), (2, 3)]


@pytest.mark.parametrize("most", [terms.MOST_TERMS, 0])
def test_strings_in_texts(spark, monkeypatch, most):
    """Few terms run over the texts, many are joined to them: the same rows."""
    monkeypatch.setattr(terms, "MOST_TERMS", most)
    texts = [(1, "the category of mats"), (2, "他在北京大学学习，😀很好"), (2, "a.b"), (None, "the cat"), (4, None), (5, "")]
    words = [(1, "cat"), (2, "egory of ma"), (3, "北京大学"), (4, "京大学学习，😀很"), (5, ".b"), (6, "dog"), (7, "e  cat"), (1, "cat"), (8, ""), (9, None), (10, "category of mats and")]
    got = terms.contained_strings(spark.createDataFrame(texts, "d int, t string"), spark.createDataFrame(words, "k int, w string"), "t", "w", ["d"], ["k"])
    want = [(d, k) for d, t in texts for k, w in words if t is not None and w is not None and w in t]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_contains_query_finds_terms_inside_words(spark, tmp_path):
    spark.createDataFrame([(1, "xalpha beta gammay")], "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "alpha beta gamma delta")], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [tuple(r) for r in relational_queries.term_contains_join(spark, str(tmp_path)).collect()] == [(1, 7, 1)]


def test_ancestors(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2), (4, 3), (5, 4), (9, 8)], "c int, p int")
    assert pairs(relational.closure(edges, "c", "p"), "node", "root", "depth") == [(2, 1, 1), (3, 1, 2), (4, 1, 3), (5, 1, 4), (9, 8, 1)]


def test_ancestors_of_long_chains(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)], "c long, p long")
    assert {(r["node"], r["root"], r["depth"]) for r in relational.closure(edges, "c", "p").collect()} == {(i, 0, i) for i in range(1, 301)}
    assert relational.closure(edges.limit(0), "c", "p").count() == 0


def test_cycles_have_no_ancestor(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (9, 1)], "c long, p long")
    with pytest.raises(ValueError):
        relational.closure(edges, "c", "p")



# ------------------------------------------------------------ usage


def test_edges_of_a_window(spark):
    events = spark.createDataFrame([(1, "k", 0, 5), (2, "k", 60, 7)], "id int, k string, ts long, tokens int")
    closed = usage.rolling_usage(events, ["k"], "ts", "tokens", 60)
    opened = usage.rolling_usage(events, ["k"], "ts", "tokens", 60, closed=False)
    assert pairs(closed, "id", "requests", "used_tokens") == [(1, 1, 5), (2, 2, 12)]
    assert pairs(opened, "id", "requests", "used_tokens") == [(1, 1, 5), (2, 1, 7)]


def test_fallback(spark):
    counts = spark.createDataFrame([("b", "llm:reqs", 5), ("b", "api:calls", 2), ("c", "api:calls", 3)], "base string, metric string, n int")
    got = usage.fallback_metric(counts, ["base"], "metric", ["api:reqs", "llm:reqs", "api:calls", "quota:reqs"])
    assert pairs(got, "base", "n") == [("b", 5), ("c", 3)]


def test_waiting_for_requests():
    got = replay.grant_times(100.0, Limits(rpm=2), [(95.0, 0), (96.0, 0)], [("a", 1)])
    assert 155.0 < got["a"] < 155.1


def test_waiting_for_tokens():
    got = replay.grant_times(100.0, Limits(tpm=20), [(90.0, 10), (91.0, 15)], [("a", 5)])
    assert 150.0 < got["a"] < 150.1


def test_waiting_in_line():
    got = replay.grant_times(100.0, Limits(rpm=1), [], [("a", 1), ("b", 1)])
    assert got["a"] == 100.0 and got["b"] > 160.0


def model_admission(calls, limits):
    taken, out = [], []
    for t, n in calls:
        live = [(a, m) for a, m in taken if a > t - 60]
        day = [a for a, _ in taken if a > t - 86400]
        used = sum(m for _, m in live)
        why = [w for w, bad in (("rpm", len(live) + 1 > limits.rpm), ("tpm", used and used + n > limits.tpm), ("rpd", len(day) + 1 > limits.rpd)) if bad]
        if not why:
            taken.append((t, n))
        out.append(",".join(why))
    return out


def test_admission_is_that_of_a_plain_model(spark):
    rng = random.Random(8)
    t, calls = 0.0, []
    for _ in range(200):
        t += rng.choice([0.5, 5, 20, 60, 4000])
        calls.append((t, rng.randrange(1, 60)))
    limits = Limits(rpm=3, tpm=100, rpd=20)
    rows = spark.createDataFrame([("k", i, a, n) for i, (a, n) in enumerate(calls)], "key string, id long, ts double, tokens long")
    got = replay.admission(rows, ["key"], limits).orderBy("id").collect()
    assert [r["reasons"] for r in got] == model_admission(calls, limits)
    assert all(r["admitted"] == (r["wait"] == 0) for r in got)


def test_throttle(spark):
    rows = spark.createDataFrame([("k", i, t) for i, t in enumerate([0.0, 1.0, 2.0, 2.5, 4.0])], "key string, id long, ts double")
    got = replay.throttled(rows, ["key"], 2.0).orderBy("id").collect()
    assert [r["picked"] for r in got] == [True, False, True, False, True]


def test_retention(spark):
    days = spark.createDataFrame([("l", f"2026-03-{d}") for d in range(10, 17)], "log string, day string")
    kept = usage.retention(days, ["log"], [F.desc("day")], 4).where("kept")
    assert [r[0] for r in pairs(kept, "day")] == ["2026-03-13", "2026-03-14", "2026-03-15", "2026-03-16"]


# ------------------------------------------------------------ pages


def test_page_with_noise(spark):
    html = "<h1 class='page-d-name'>第1章 a</h1><div id=content><p>广告</p><p>第一段</p><p>第二段</p><p>上一章</p><script>x()</script></div>"
    layout = web.PageLayout(title=(".page-d-name",), content=("#content",), noise=("广告", "上一章"))
    got = web.page_text(spark.createDataFrame([(1, html), (2, None)], "k int, html string"), layout, ("k",)).orderBy("k").collect()
    assert tuple(got[0]) == (1, "第1章 a", "第一段\n第二段")
    assert tuple(got[1]) == (2, "", "")


def test_longest_candidate_wins(spark):
    html = "<div class=content>short</div><div class=content>the longer one</div>"
    pages = spark.createDataFrame([(1, html)], "k int, html string")
    assert web.page_text(pages, web.PageLayout(content=(".content",), longest=True), ("k",)).first()["content"] == "the longer one"


def test_json_directory(spark):
    rows = spark.createDataFrame([(1, '{"list":["第1章 姐姐替嫁","第2章 神秘的种子"]}', "u?b=1")], "k int, payload string, base_url string")
    got = web.json_directory(rows, ("k",)).orderBy("number").collect()
    assert [(r["number"], r["link"]) for r in got] == [(1, "u?b=1&chapterid=1"), (2, "u?b=1&chapterid=2")]


def test_rules_of_several_sites_in_one_plan(spark):
    """The last link of a number, or its lowest part; numbers in texts, or in addresses; sites without rules."""
    html = "<a href='/1_2.html'>第1章</a><a href='/1_1.html'>第1章</a><a href='/2.html'>第2章</a><a href='/about'>about</a>"
    rows = [(1, "https://a.example/", html), (2, "https://www.B.example:8080/x", html), (3, "https://c.example/", html), (4, "https://d.example/", html), (5, None, html)]
    rules = [("a.example", r"第(\d+)章", None, None, None), ("b.example", r"第(\d+)章", "", "", r"_(\d+)\.html"), ("c.example", None, r"/(\d+)_", r"_1\.html$", None)]
    links = web.page_links(spark.createDataFrame(rows, "k int, url string, html string"), ("k",))
    got = web.directory_entries(links, spark.createDataFrame(rules, web.SITE_RULES), ("k",))
    assert pairs(got, "k", "number", "link") == [
        (1, 1, "https://a.example/1_1.html"), (1, 2, "https://a.example/2.html"),
        (2, 1, "https://www.B.example:8080/1_1.html"), (2, 2, "https://www.B.example:8080/2.html"),
        (3, 1, "https://c.example/1_1.html"),
    ]


def test_block_order(one):
    assert one(web.block_reason("h"), h="Just a moment ... Error 1015") == "rate_limited"
    assert one(web.block_reason("h"), h="fine") is None


def test_registered_resolver(spark):
    @web.resolver("test-site")
    def links(html, base):
        return [(1, html, base + "x")]

    got = web.resolve(spark.createDataFrame([(7, "u/", "t")], "k int, url string, html string"), "test-site", ("k",)).collect()
    assert [tuple(r) for r in got] == [(7, 1, "t", "u/x")]


# ------------------------------------------------------------ licences


def test_positions_of_nested_and_overlapping_terms(spark):
    texts = spark.createDataFrame([(1, "天天天地人"), (2, "a.b.a.b.a"), (3, r"x\Ey"), (4, None), (5, "")], "d int, t string")
    words = spark.createDataFrame([("天天",), ("天",), ("天地人",), ("a.b.a",), (r"\E",), ("",), (None,)], "w string")
    got = licences.occurrences(texts, words, "t", "w", ["d"])
    assert pairs(got, "d", "term", "start", "end") == [
        *[(1, "天", k, k + 1) for k in range(3)], (1, "天地人", 2, 5), (1, "天天", 0, 2), (1, "天天", 1, 3),
        (2, "a.b.a", 0, 5), (2, "a.b.a", 4, 9), (3, r"\E", 1, 3),
    ]


ENTRIES = [
    ("山", "Núi"), ("山河", "Núi Sông"), ("东海", "Đông Hải"), ("海城", "Hải Thành"), ("城主", "Thành Chủ"), ("东门", "Đông Môn"),
    ("李安", "Lý An"), ("安平", "An Bình"), ("王李", "Vương Lý"), ("李", "Lý"),
]


@pytest.mark.parametrize(
    "source, text, anywhere, found",
    [
        ("山河", "Núi Sông", True, []),
        ("山", "Núi Sông", True, [("Núi Sông", 1)]),
        ("河", "Núi Sông Núi", True, [("Núi", 2), ("Núi Sông", 1)]),
        ("山河", "Núi và Núi Sông", False, []),  # 山 itself stands in 山河
        ("东海", "Đông Hải, Hải Thành", True, [("Hải Thành", 1)]),
        ("王李安平", "Vương Lý An Bình", True, []),
        ("王李 安平", "Vương Lý An Bình", True, []),  # Lý An lies across two licensed targets
        ("王李", "Vương Lý An Bình", True, [("An Bình", 1), ("Lý An", 1)]),
        ("", "Đông Hải", True, []),
        (None, "Đông Hải", True, []),
        ("海", "ĐôngHải Đông Hải2", True, []),  # no whole words
    ],
)
def test_licences(spark, source, text, anywhere, found):
    texts = spark.createDataFrame([(1, source, text), (2, "x", "nothing")], "d int, s string, t string")
    entries = spark.createDataFrame(ENTRIES, "src string, dst string")
    got = licences.unlicensed_targets(texts, entries, ["d"], "s", "t", anywhere=anywhere, whole_words=True)
    assert pairs(got, "target", "n") == found


def test_only_places_inside_a_licensed_target_are_explained(spark):
    """The place inside 天地人 is explained by it, the other one is not."""
    entries = spark.createDataFrame([("甲乙丙", "天地人"), ("丁", "天地"), ("戊", "人和")], "src string, dst string")
    texts = spark.createDataFrame([(1, "甲乙丙", "天地人和天地"), (2, "丁", "天地人天地")], "d int, s string, t string")
    run = lambda anywhere: pairs(licences.unlicensed_targets(texts, entries, ["d"], "s", "t", anywhere=anywhere), "d", "target", "n")
    assert run(False) == [(1, "人和", 1), (1, "天地", 1), (2, "天地人", 1)]
    assert run(True) == [(1, "人和", 1), (2, "天地人", 1)]


def test_conspicuous_targets(spark):
    entries = spark.createDataFrame(ENTRIES, "src string, dst string")
    texts = spark.createDataFrame([(1, "x", "toi Đông Hải roi"), (2, "x", "toi Đông Hải Xanh"), (3, "x", "đi Đông Hải về Đông Hải")], "d int, s string, t string")
    got = licences.unlicensed_targets(texts, entries, ["d"], "s", "t", whole_words=True, conspicuous=True)
    assert pairs(got, "d", "target", "n") == [(2, "Đông Hải", 1), (3, "Đông Hải", 2)]
    listed = licences.unlicensed_targets(texts, entries, ["d"], "s", "t", targets=spark.createDataFrame([("Đông",)], "dst string"), anywhere=False)
    assert pairs(listed, "d", "target", "n") == [(1, "Đông", 1), (2, "Đông", 1), (3, "Đông", 2)]


def test_gaps_are_counted_without_a_row_for_each_number(spark):
    rows = spark.createDataFrame([(1, 0), (1, 10**12), (1, 10**12 + 1), (1, 0), (2, 5), (3, None), (3, 1), (3, 4)], "k long, number long")
    got = quality.gap_ranges(rows, ("k",))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 10**12 - 1), (3, 2, 3)]
    assert sorted(tuple(r) for r in quality.gaps(rows.where("k = 3"), ("k",)).collect()) == [(3, 2), (3, 3)]


def test_places_of_few_terms_come_from_one_pass_over_a_text(spark):
    """As by the way for many terms, and without a text beside every one of its terms."""
    texts = spark.createDataFrame([(1, "aaaa bab 𝄞ab"), (2, ""), (3, None), (4, "x")], "i int, t string")
    found = licences.occurrences(texts, spark.createDataFrame([("aa",), ("a",), ("ab",), ("bab",), ("𝄞a",), ("",), (None,)], "w string"), "t", "w", ["i"])
    text, want = "aaaa bab 𝄞ab", []
    for w in ("aa", "a", "ab", "bab", "𝄞a"):
        want += [(1, w, k, k + len(w)) for k in range(len(text)) if text.startswith(w, k)]
    assert pairs(found, "i", "term", "start", "end") == sorted(want) and "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_open_places_are_told_from_holders_by_one_read_of_the_places(spark):
    texts = spark.createDataFrame([(1, "S", "abc ab"), (2, "s", "abc")], "i int, source string, text string")
    entries = spark.createDataFrame([("S", "abc"), ("q", "ab"), ("r", "c")], "src string, dst string")
    found = licences.unlicensed_targets(texts, entries, ["i"], "source", "text", anywhere=False)
    assert pairs(found, "i", "target", "n") == [(1, "ab", 1), (2, "ab", 1), (2, "abc", 1), (2, "c", 1)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2  # places, and sources in sources


def test_conspicuous_targets_look_at_the_words_beside_them_only_behind_a_blank(spark):
    texts = spark.createDataFrame([(1, "x", "Anna ab, -ab Otto"), (2, "x", "Annaab-ab"), (3, "x", "ab Otto"), (4, "x", "An ab")], "i int, source string, text string")
    entries = spark.createDataFrame([("q", "ab")], "src string, dst string")
    found = licences.unlicensed_targets(texts, entries, ["i"], "source", "text", conspicuous=True)
    assert pairs(found, "i", "target", "n") == [(1, "ab", 2), (2, "ab", 2), (3, "ab", 1), (4, "ab", 1)]
    assert r"CASE WHEN RLIKE" in found._jdf.queryExecution().optimizedPlan().toString()


def test_few_entries_tell_each_text_without_dealing_anything_out(spark):
    texts = spark.createDataFrame([(1, "x", "ab Otto ab"), (2, "q", "ab ab"), (3, "x", "abc")], "i int, source string, text string")
    entries = spark.createDataFrame([("q", "ab"), ("r", "abc")], "src string, dst string")
    for anywhere in (True, False):
        found = licences.unlicensed_targets(texts, entries, ["i"], "source", "text", anywhere=anywhere, conspicuous=True)
        assert pairs(found, "i", "target", "n") == [(1, "ab", 2)]
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert not any(x in plan for x in ("Join", "Aggregate", "Window"))


@pytest.mark.parametrize(
    "anywhere, whole_words, conspicuous, listed", [(True, False, True, False), (False, False, False, False), (True, True, False, True), (False, True, True, True)]
)
def test_texts_told_by_themselves_are_those_told_by_joins(spark, monkeypatch, anywhere, whole_words, conspicuous, listed):
    """Nested, overlapping and bridged targets, several for a source, beside blanks and words; texts that share their keys."""
    rng = random.Random(11)
    words = ["An", "Bình", "an", "Đông", "Hải", "x", "𝄞a", "sông", "9", "An Bình", "Hải An", "Bình Đông", "Đông Hải Xanh", "anan", "na", "n"]
    entries = [(rng.choice("甲乙丙丁戊己") * rng.choice([1, 1, 2]), w) for w in words for _ in range(2)] + [(" ", "An"), ("甲", None), ("", "x")]
    gaps = ["", " ", " ", "\t", "\n ", "  ", "\u00a0", ".", "\x0b", "_"]
    rows = [(k // 2, k, "".join(rng.choices("甲乙丙丁戊己x", k=rng.randrange(5))), "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(12)))) for k in range(60)]
    rows += [(20, 41, "甲", "An Bình An"), (20, 41, "x", "anan An Bình Đông"), (70, 1, None, "An"), (71, 1, "甲", None)]
    texts = spark.createDataFrame(rows, "i int, j int, s string, t string")
    given = spark.createDataFrame(entries, "src string, dst string")
    targets = spark.createDataFrame([("An",), (" an ",), ("Bình Đông",), ("",), ("Xanh",)], "dst string") if listed else None

    def run(rows):
        found = licences.unlicensed_targets(rows, given, ["i", "j"], "s", "t", targets, anywhere, whole_words, conspicuous)
        assert found.dtypes == [("i", "int"), ("j", "int"), ("target", "string"), ("n", "bigint")]
        return sorted(map(str, found.collect()))

    told = run(texts)
    monkeypatch.setattr(terms, "MOST_TERMS", 0)
    assert told and told == run(texts)


def test_pages_are_parsed_piece_by_piece(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(web, "PARSED_BYTES", 10)
    pages = [None, "aaaa", "", "b" * 30, None, "cc", "é" * 5, "d"]
    batch = pa.RecordBatch.from_pydict({"k": list(range(8)), "__html": pages})
    pieces = [p.column("k").to_pylist() for p in web._pieces(iter((batch, batch.slice(0, 0))), "__html")]
    assert pieces == [[0, 1, 2, 3], [4, 5, 6], [7]]


def test_reasons_are_counted_once(spark):
    from textloom.plans import catalog

    plan = catalog.QUERIES["repair_reasons"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("thiển trương viên") == 1 and plan.count("u4dbf") == 1


def test_noise_lines_fold_texts_of_plain_characters_without_python(spark):
    from textloom.operators import repair

    rows = spark.createDataFrame([(1, "Été\nPROMO x\n12"), (2, "ﬁn\nﬁx promo"), (3, None)], "i int, text string")
    got = repair.without_noise(rows, "text", ("promo",), ("^[0-9]+$",))
    assert pairs(got, "i", "text") == [(1, "Été"), (2, "ﬁn"), (3, None)]
    assert "translate(" in got._jdf.queryExecution().optimizedPlan().toString()


def test_completeness_of_odd_rows_without_a_join(spark):
    expected = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1), (2, None), (None, 1), (3, 1)], "k int, part int")
    parts = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (2, None), (None, 1), (4, 1)], "k long, part long")
    out = relational.completeness(expected, parts, ("k",), "part")
    assert {tuple(r) for r in out.collect()} == {(1, 3, 3, True), (2, 2, 1, False), (None, 1, 0, False), (3, 1, 0, False)}
    assert out.dtypes == [("k", "int"), ("n_expected", "bigint"), ("n_there", "bigint"), ("complete", "boolean")]
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
