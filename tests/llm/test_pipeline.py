"""The pipeline against a plain version of each stage on the smallest documents."""

import pytest

import corpus_pipeline
from textloom.llm import minhash, mixing, pii, quality_rules
from textloom.llm.common import materialize
from textloom.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf_dir))
        out[name] = (before.collect(), docs.collect(), docs.columns, before)
    return out


def test_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages)
    assert all(sorted(c) == sorted(COLUMNS) for _, _, c, _ in list(stages.values())[:-1])


def test_quality(stages):
    before, after, _, _ = stages["quality rules"]
    names = {r.name: r.fails for r in quality_rules.RULES}
    good = set()
    for r in before:
        m = dict(zip(quality_rules.MEASURES, quality_rules.measure(r["text"])))
        if not any(eval(names[n], {}, m) for n in quality_rules.POLICIES[quality_rules.CURRENT_POLICY]):
            good.add((r["doc_id"], r["text"]))
    assert {(r["doc_id"], r["text"]) for r in after} == good


def test_near_duplicates(stages):
    before, after, _, frame = stages["near duplicates"]
    weights = minhash.document_weights(frame.select("doc_id", "text"))
    sets = {}
    for r in before:
        h, n = minhash.shingles(r["text"].split())
        sets[r["doc_id"]] = (h, weights(h, n))
    left = {r["doc_id"] for r in after}
    ids, label = sorted(sets), {i: i for i in sets}
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if minhash.weighted_jaccard(sets[a], sets[b]) >= minhash.SIMILARITY:
                low, high = sorted((label[a], label[b]))
                label = {i: low if x == high else x for i, x in label.items()}
    assert left == set(label.values())


def test_personal_data(stages):
    before, after, _, _ = stages["personal data"]
    want = {r["doc_id"]: pii.redact(r["text"], pii.scan([r["text"]], pii.default_field())[0][1]) for r in before}
    assert {r["doc_id"]: r["text"] for r in after} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_mixing(stages):
    before, after, _, frame = stages["mixing"]
    known = {(r["doc_id"], r["text"]) for r in before}
    assert {(r["doc_id"], r["text"]) for r in after} <= known
    tokens = lambda rows: sum(len(r["text"].split()) for r in rows)
    longest = max(len(r["text"].split()) for r in before)
    leaves = len({(r["lang"], r["source"]) for r in before})
    assert tokens(before) * 3 // 4 - leaves * longest <= tokens(after) <= tokens(before) * 3 // 4
    assert frame.select(mixing.word_tokens().alias("n")).agg({"n": "sum"}).first()[0] == tokens(before)


def test_tokens(stages):
    import sentencepiece

    before, after, _, _ = stages["tokens"]
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    want = sorted((r["doc_id"], tuple(library.encode(r["text"], add_eos=True))) for r in before)
    assert sorted((r["doc_id"], tuple(r["ids"])) for r in after) == want


def test_run(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r["doc_id"], tuple(r["ids"])) for r in got) == sorted((r["doc_id"], tuple(r["ids"])) for r in stages["tokens"][1])


ODD = "doc_id long, text string, lang string, source string, n_chars long, kept_id int, copy string, spans string, domain int, copies int, n_tokens int, __tokens int"


def odd_documents(spark):
    """Nulls in every column, empty, very long and repeated texts, ties, and columns named like those that the stages add."""
    word = lambda n, seed: " ".join(f"w{(i * 7919 + seed) % 997}" for i in range(n))
    rows = [(None, None, None, None, None), (1, "", "en", "src1", 0), (2, word(20_000, 1), "en", None, 9), (3, word(80, 5), None, "src7", 1)]
    rows += [(3, word(80, 5), None, "src7", 1)] * 2 + [(None, word(90, 6) + " a@b.example.com", "de", "src2", None), (5, word(80, 5), "fr", "x", 2)]
    rows += [(6, "short text", "en", "src1", 3)] + [(10 + i, word(120, 100 + i) + " +1 202 555 0100", "en", f"src{i}", 4) for i in range(12)]
    return spark.createDataFrame([(*r, 1, "c", "s", 2, 3, 4, 5) for r in rows], ODD)


def test_stages_give_columns_back_unchanged(spark, sf_dir):
    docs = odd_documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = {(r["doc_id"], r["lang"], r["source"]) for r in docs.collect()}
        docs = materialize(stage(spark, docs, sf_dir))
        rows = docs.collect()
        assert docs.columns == [c.split()[0] for c in ODD.split(", ")]
        assert all(tuple(r)[5:] == (1, "c", "s", 2, 3, 4, 5) for r in rows)
        assert rows and {(r["doc_id"], r["lang"], r["source"]) for r in rows} <= before
    assert not any("555" in r["text"] or "@" in r["text"] for r in rows)
    assert sum(r["doc_id"] == 3 for r in rows) in (0, 3, 6) and not any(r["doc_id"] in (1, 5, 6) for r in rows)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == len(rows)


def test_near_duplicates_without_ids(spark, sf_dir):
    word = lambda n, seed: " ".join(f"w{(i * 7919 + seed) % 997}" for i in range(n))
    base, other, third = word(80, 1), word(80, 300), word(80, 600)
    near = base.replace("w2 ", "w3 ", 1) + " end"
    rows = [(1, base), (None, base), (None, near), (None, other), (None, third), (None, third), (None, third + " end"), (7, other + " more"), (7, word(90, 50))]
    docs = spark.createDataFrame([(i, t, "en", "src1", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicate_stage(spark, docs, sf_dir).collect()]
    assert (1, base) in left and (7, other + " more") in left and (7, word(90, 50)) in left
    rest = [t for i, t in left if i is None]
    assert rest in ([third, third], [third + " end"]) and len(left) == 3 + len(rest)


def test_stages_of_an_empty_table(spark, sf_dir):
    docs = odd_documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
        assert docs.count() == 0
