"""Token counts without token ids.

Texts are cut into pre-tokens, and a document's count is the sum over its
distinct pre-tokens of frequency times number of pieces.  The number of pieces
is found once for each distinct pre-token of the corpus:

1. One pass counts pre-tokens; each task keeps its most frequent ones.  The
   HEAD most frequent of all are counted in pieces and sent to the tasks: at
   most HEAD entries of HEAD_CHARS characters, whatever the corpus.
2. The second pass forms every document's pre-token frequencies, sums those of
   the head, and writes the others out as (pre-token, frequency).
3. The distinct pre-tokens among these are counted in pieces once, joined to
   the documents' frequencies, and summed by document.

A join for all pre-tokens would shuffle more bytes than the texts have; which
pre-tokens are in the head decides only what is shuffled, never the result.
As whatever is frequent is in the head, no key of the join is hot.

Defined results: a null text counts as empty (0 bytes, 0 tokens); very long
texts and pre-tokens are read whole; repeated rows are counted row by row; an
empty table gives an empty result; other columns, even ones named
``n_tokens``, are not read unless asked for in ``keys``.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean, materialize, slices

#: The pre-token pattern of byte-level BPE vocabularies (fixed value).
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Pre-tokens of the head and the longest of them, and how many a task names for it.
HEAD, HEAD_CHARS, HEAD_OF_TASK = 200_000, 48, 100_000
CHUNK_BYTES = 1_000_000


class Cutter:
    """Cuts texts into pre-tokens, apart from the vocabulary's special strings."""

    def __init__(self, specials: list[str]):
        self.find = regex.compile(BYTE_LEVEL_PATTERN).findall
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None

    def __call__(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text, and how many special strings stand in it."""
        if self.specials is None or not (n := len(self.specials.findall(text))):
            return self.find(text), 0
        return [x for part in self.specials.split(text) for x in self.find(part)], n


@lru_cache(maxsize=1)
def vocabulary_of(path: str):
    """The tokenizer of a byte-level BPE .json file, read once in each process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def special_strings(path: str) -> list[str]:
    """Strings of the vocabulary that are one token wherever they stand, longest first."""
    return sorted((t.content for t in vocabulary_of(path).get_added_tokens_decoder().values()), key=len, reverse=True)


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        for part in slices(batch, ("__text",), CHUNK_BYTES):
            yield part, [t or "" for t in part.column("__text").to_pylist()]


def _frequent(specials: list[str]) -> Run:
    """A task's most frequent pre-tokens with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, counts = Cutter(specials), Counter()
        for _, texts in _texts(batches):
            for text in texts:
                counts.update(cut(text)[0])
            if len(counts) > 4 * HEAD_OF_TASK:
                counts = Counter(dict(counts.most_common(2 * HEAD_OF_TASK)))
        top = [(x, n) for x, n in counts.most_common(HEAD_OF_TASK) if len(x) <= HEAD_CHARS and n > 1]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"])

    return run


def _pieces(path: str) -> Run:
    """Pre-tokens with their numbers of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = vocabulary_of(path)
        for batch in batches:
            for part in slices(batch, ("piece",), CHUNK_BYTES):
                encoded = tokenizer.encode_batch_fast(part.column("piece").to_pylist(), add_special_tokens=False)
                yield pa.RecordBatch.from_arrays([part.column("piece"), pa.array([len(e) for e in encoded], pa.int64())], names=["piece", "pieces"])

    return run


_TAIL = pa.list_(pa.struct([("piece", pa.string()), ("n", pa.int64())]))


def _sum_head(head: dict[str, int], specials: list[str]) -> Run:
    """For each document: bytes, tokens of its head pre-tokens, and the frequencies of its other ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Cutter(specials)
        for part, texts in _texts(batches):
            sums, tails = [], []
            for text in texts:
                pretokens, n = cut(text)
                frequency = Counter(pretokens)
                tails.append([{"piece": x, "n": k} for x, k in frequency.items() if x not in head])
                sums.append(n + sum(k * head.get(x, 0) for x, k in frequency.items()))
            *keys, column = part.columns
            sizes = pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())
            rows = pa.array([uuid.uuid4().bytes for _ in sums], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*keys, sizes, pa.array(sums, pa.int64()), rows, pa.array(tails, _TAIL)], names=[*part.schema.names[:-1], "n_bytes", "__head", "__row", "__tail"]
            )

    return run


def token_counts(docs: DataFrame, vocabulary: str, text: str = "text", keys: tuple[str, ...] = ("doc_id",), head: int = HEAD) -> DataFrame:
    """``keys``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row.

    ``vocabulary`` is the path of a byte-level BPE .json file, present on the
    driver and on every executor.  ``head`` is how many pre-tokens travel with
    the tasks.
    """
    specials = special_strings(vocabulary)
    source = docs.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`").cast("string").alias("__text"))
    counted = source.select("__text").mapInArrow(lean(_frequent(specials)), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    top = materialize(counted.orderBy(F.desc("n"), "piece").limit(head).select("piece"))
    known = {r["piece"]: r["pieces"] for r in top.mapInArrow(_pieces(vocabulary), "piece string, pieces long").collect()}  # at most ``head`` rows

    fields = [source.schema[i] for i in range(len(keys))] + [T.StructField("n_bytes", T.LongType(), False), T.StructField("__head", T.LongType(), False)]
    tail = T.ArrayType(T.StructType([T.StructField("piece", T.StringType()), T.StructField("n", T.LongType())]))
    schema = T.StructType([*fields, T.StructField("__row", T.BinaryType(), False), T.StructField("__tail", tail, False)])
    # Written out once, so that the rows' numbers hold.
    summed = materialize(source.mapInArrow(lean(_sum_head(known, specials)), schema))
    rest = summed.select("__row", F.explode("__tail").alias("t")).select("__row", "t.piece", "t.n")
    once = rest.select("piece").distinct().mapInArrow(_pieces(vocabulary), "piece string, pieces long")
    joined = rest.join(once, "piece").groupBy("__row").agg(F.sum(F.col("n") * F.col("pieces")).alias("__rest"))
    total = (F.col("__head") + F.coalesce("__rest", F.lit(0))).alias("n_tokens")
    return summed.drop("__tail").join(joined, "__row", "left").select(*[F.col(f"`{k}`") for k in keys], "n_bytes", total)
