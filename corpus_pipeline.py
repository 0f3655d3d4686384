"""A training corpus from raw documents, in stages that each apply one operator.

``run`` applies the stages to ``documents``; every stage's result is written as
Parquet in the shared folder and read again, so a lost executor costs one stage
at most and no stage is computed twice.

Defined results: rows that repeat both doc_id and text are one document: they
stay or go together.  Rows with one doc_id and different texts are documents of
their own.  A row without a doc_id stays where it is alone; in a group it goes if
another row has an id, and where none has, the smallest by hash stays.
Null and empty texts are rejected by the quality rules.  Very long texts are
read whole by every stage.  Of equally good documents of a group the smallest
doc_id stays; ties of the mixture fall by doc_id, or by text without one.  An
empty table gives an empty result with the columns of the last stage.  All
stages but the last give every column back, other ones than those of
``documents`` as they came, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import minhash, mixing, pii, quality_rules, sentencepiece_bpe
from textloom.llm.common import materialize
from textloom.llm.queries import MIX_DEFAULTS, MIX_SEED, MIX_WEIGHTS, domain_of_source, table, vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the current rule policy rejects."""
    return quality_rules.passing_rows(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near duplicates."""
    kept = minhash.near_duplicates(docs.select("doc_id", "text")).where("kept").select("doc_id", "row_hash").distinct()
    same = (kept["row_hash"] == F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string"))) & docs["doc_id"].cast("long").eqNullSafe(kept["doc_id"])
    return docs.join(kept, same, "left_semi")


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every span of personal data in the text by its kind; the other columns stay, n_chars following the text."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index('text')}"
    rest = tuple(c for c in plain.columns if c != text)
    cleaned = pii.find_personal_data(plain, text=text, keys=rest, field=pii.fit_field(pii.labelled_table(spark)), redacted=True)
    values = {c: F.col(c) for c in rest} | {text: F.col("redacted")}
    if "n_chars" in names:
        size = f"c{names.index('n_chars')}"
        values[size] = F.length("redacted").cast(docs.schema["n_chars"].dataType)
    return cleaned.select(*[values[c].alias(c) for c in plain.columns]).toDF(*names)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources to their target weights: some documents go, some come twice."""
    return mixing.mixed_rows(
        docs, budget=F.expr("all_tokens * 3 div 4"), weights=MIX_WEIGHTS, domain=domain_of_source(), defaults=MIX_DEFAULTS, max_epochs=2, seed=MIX_SEED
    )


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, and the digest of the text that they decode to."""
    coded = sentencepiece_bpe.encode_and_decode(docs, vocabulary("piece_bpe_32k.model"), keys=("doc_id", "lang", "source"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("personal data", personal_data_stage),
    ("mixing", mixing_stage),
    ("tokens", tokens_stage),
]

#: Sampling, the random field and the tokenizer have no SQL form; tests hold the pipeline against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
