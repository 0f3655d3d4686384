import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm import queries, sentencepiece_bpe, token_counts

TEXTS = [
    "",
    " ",
    "  two  spaces   and more    ",
    "\n\nline\n break \n",
    "Hello, world!",
    "日本語 mixed with English 😀👍🏽",
    "a" * 5000,
    " " * 3000,
    "<|endoftext|> inside <|endoftext|>",
    "</s> <s> <unk> ▁ ▁▁",
    "tab\tcarriage\r\nend",
    "é è ü ß ́ ​﻿",
    "12345 67.89 $%^&*",
    "x" + "\u0000" + "y",
]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def model():
    return sentencepiece_bpe.piece_model(queries.vocabulary("piece_bpe_32k.model"))


@pytest.mark.parametrize("text", TEXTS)
def test_pieces_of_single_texts(library, model, text):
    ids = library.encode(text, add_eos=True)
    assert model.encode(text) == ids
    assert model.decode(ids) == library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("abcdehinorst .,\n▁éß日😀 ")), max_size=60))
def test_pieces_of_random_texts(library, model, text):
    ids = library.encode(text, add_eos=True)
    assert model.encode(text) == ids
    assert model.decode(ids) == library.decode(ids)


def test_query_is_the_library(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op2_sentencepiece(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, "x"), (1, None, "x"), (2, "", None), (None, "ab", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    path = queries.vocabulary("piece_bpe_32k.model")
    out = sentencepiece_bpe.decode_documents(sentencepiece_bpe.encode_documents(docs, path), path)
    got = out.collect()
    assert len(got) == 4 and out.columns == ["doc_id", "text", "ids", "decoded"]
    assert [r["decoded"] for r in got if r["text"] in (None, "")] == ["", "", ""]
    assert sentencepiece_bpe.encode_documents(docs.limit(0), path).count() == 0


@pytest.mark.parametrize("head", [0, 5, token_counts.HEAD])
def test_counts_are_those_of_the_library(spark, head):
    """Whatever travels with the tasks and whatever is joined, the counts are the same."""
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choice("ab 'ts12.\n\t é日!") for _ in range(rng.randrange(80))) for _ in range(400)] + ["one two one two"] * 3
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, piece string").repartition(3)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, path, head=head).collect()}
    assert [got[i] for i in range(len(texts))] == [len(whole.encode(t, add_special_tokens=False).ids) for t in texts]


def test_count_query(spark, sf_dir):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op4_token_counts(spark, sf_dir).collect():
        n = len(whole.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 512)


def test_counts_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "", 6)], "doc_id long, text string, n_tokens int")
    got = token_counts.token_counts(docs, queries.vocabulary("byte_bpe_50k.json"))
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in got.collect()) == [(0, 0)] * 3
    assert token_counts.token_counts(docs.limit(0), queries.vocabulary("byte_bpe_50k.json")).count() == 0
