"""Quality classifier: a generalised additive model with pairwise interactions.

Texts become a fixed list of features, each cut into quantile bins.  Training
boosts shallow trees cyclically, one feature after another at a small rate, so
that every feature ends with a look-up table over its bins; the pairs with the
largest gain on the residual get a table over both features' bins the same
way.  A score is the logistic of a sum of table entries, looked up for a whole
Arrow batch at once.

The labelled rows used for training are at most ``max_rows`` (a documented
bound), chosen by hash; every row of the corpus is scored.

Defined results: a null text is scored as the empty text, which has features
of its own (all zero); very long texts are read whole; repeated rows get equal
scores; an empty table gives an empty result; without a label of each kind the
model is the constant prior (0.5 without any); labels that are null or belong
to no document are ignored, and a document labelled several times counts once
for each different label; of rows that share a doc_id the smallest text is
learnt from; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize

FEATURES = (
    "log_words",
    "mean_word",
    "word_spread",
    "distinct_words",
    "log_lines",
    "duplicate_lines",
    "words_per_line",
    "symbols",
    "punctuation",
    "digits",
    "upper",
    "spaces",
    "pipes",
    "exclamations",
    "stops",
    "plain_words",
    "short_words",
    "top_word",
    "log_bytes",
)
_PLAIN = re.compile(r"(?<!\S)[^\W\d_]+[.,]?(?!\S)")


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256)
    out[[ord(c) for c in chars]] = 1
    return out


_CLASSES = np.stack(
    [
        _table("#*$%&<>@^~=_+{}[]\\/"),
        _table(".,;:?'\"()-"),
        _table("0123456789"),
        _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        _table(" \t"),
        _table("|"),
        _table("!"),
        _table("."),
    ],
    axis=1,
)


def features(text: str | None) -> np.ndarray:
    """The features of one text, in the order of FEATURES."""
    out = np.zeros(len(FEATURES))
    if not text:
        return out
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.bincount(raw, minlength=256) @ _CLASSES
    size = len(raw)
    words = text.split()
    n = len(words)
    lines = [x for x in text.split("\n") if x.strip()]
    out[[0, 4, 18]] = np.log1p([n, len(lines), size])
    out[7:15] = counts[:8] / size
    if n:
        lengths = np.fromiter(map(len, words), np.int64, n)
        distinct: dict[str, int] = {}
        for w in words:
            distinct[w] = distinct.get(w, 0) + 1
        out[[1, 2, 3]] = lengths.mean(), lengths.std(), len(distinct) / n
        out[[5, 6]] = 1 - len(set(lines)) / max(len(lines), 1), n / max(len(lines), 1)
        out[[15, 16, 17]] = len(_PLAIN.findall(text)) / n, (lengths <= 3).mean(), max(distinct.values()) / n
    return out


@dataclass
class Model:
    """Bin edges per feature, a table per feature and a table per chosen pair."""

    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row of features."""
        total = np.full(len(x), self.intercept)
        for k, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[k], x[:, k], "right")]
        for (a, b), (ea, eb), table in zip(self.pairs, self.pair_edges, self.pair_tables, strict=True):
            total += table[np.searchsorted(ea, x[:, a], "right"), np.searchsorted(eb, x[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _best_split(grad: np.ndarray, hess: np.ndarray, ridge: float) -> tuple[float, int]:
    """Gain and place of the best cut of a run of bins."""
    g, h = np.cumsum(grad)[:-1], np.cumsum(hess)[:-1]
    if not len(g):
        return 0.0, 0
    gain = g**2 / (h + ridge) + (grad.sum() - g) ** 2 / (hess.sum() - h + ridge) - grad.sum() ** 2 / (hess.sum() + ridge)
    k = int(gain.argmax())
    return float(gain[k]), k + 1


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """A shallow tree over bins: the best cut first, up to ``leaves`` leaves; its value per bin."""
    parts = [(0, len(grad))]
    while len(parts) < leaves:
        options = [(*_best_split(grad[a:b], hess[a:b], ridge), a, b) for a, b in parts]
        gain, k, a, b = max(options)
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + k), (a + k, b)]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = grad[a:b].sum() / (hess[a:b].sum() + ridge)
    return out


def _pair_tree(grad: np.ndarray, hess: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """A two-level tree over a grid: a cut of the first feature, then of the second on each side."""
    best, value = -1.0, np.zeros_like(grad)
    total = grad.sum() ** 2 / (hess.sum() + ridge)
    for cut in range(1, len(grad)):
        out, got = np.zeros_like(grad), 0.0
        for side in (slice(0, cut), slice(cut, None)):
            g, h = grad[side].sum(0), hess[side].sum(0)
            _, k = _best_split(g, h, ridge)
            for cols in (slice(0, k), slice(k, None)):
                gs, hs = g[cols].sum(), h[cols].sum()
                out[side, cols] = gs / (hs + ridge)
                got += gs**2 / (hs + ridge)
        if got - total > best:
            best, value = got - total, out
    return value, best


def train(
    x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 150, rate: float = 0.1, leaves: int = 3, n_pairs: int = 6, pair_rounds: int = 60, ridge: float = 2.0
) -> Model:
    """Cyclic boosting on the logistic loss; deterministic."""
    share = float(y.mean()) if len(y) else 0.5
    prior = float(np.log((share * len(y) + 0.5) / ((1 - share) * len(y) + 0.5)))
    if len(y) == 0 or share in (0.0, 1.0):
        return Model([np.empty(0)] * x.shape[1], prior)
    edges = [_edges(x[:, k], bins) for k in range(x.shape[1])]
    binned = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(edges)]
    model = Model(edges, prior, [np.zeros(len(e) + 1) for e in edges])
    total = np.full(len(y), prior)
    for _ in range(rounds):
        for k, table in enumerate(model.tables):
            p = 1 / (1 + np.exp(-total))
            grad = np.bincount(binned[k], y - p, len(table))
            hess = np.bincount(binned[k], p * (1 - p), len(table))
            step = rate * _tree(grad, hess, leaves, ridge)
            table += step
            total += step[binned[k]]
    coarse = [_edges(x[:, k], 8) for k in range(x.shape[1])]
    grid = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(coarse)]
    p = 1 / (1 + np.exp(-total))

    def sums(a: int, b: int, values: np.ndarray) -> np.ndarray:
        wide = len(coarse[b]) + 1
        return np.bincount(grid[a] * wide + grid[b], values, (len(coarse[a]) + 1) * wide).reshape(-1, wide)

    gains = []
    for a in range(x.shape[1]):
        for b in range(a + 1, x.shape[1]):
            gains.append((_pair_tree(sums(a, b, y - p), sums(a, b, p * (1 - p)), ridge)[1], -a, -b))
    for gain, a, b in sorted(gains, reverse=True)[:n_pairs]:
        if gain > 1e-6:
            model.pairs.append((-a, -b))
            model.pair_edges.append((coarse[-a], coarse[-b]))
            model.pair_tables.append(np.zeros((len(coarse[-a]) + 1, len(coarse[-b]) + 1)))
    for _ in range(pair_rounds):
        for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
            p = 1 / (1 + np.exp(-total))
            step = rate * _pair_tree(sums(a, b, y - p), sums(a, b, p * (1 - p)), ridge)[0]
            table += step
            total += step[grid[a], grid[b]]
    return model


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *rest, texts = batch.columns
        rows = [features(t) for t in texts.to_pylist()]
        flat = pa.array(np.concatenate(rows) if rows else np.empty(0))
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES))
        yield pa.RecordBatch.from_arrays([*rest, pa.ListArray.from_arrays(offsets, flat)], names=[*batch.schema.names[:-1], "features"])


def _score_batches(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *rest, texts = batch.columns
            x = np.array([features(t) for t in texts.to_pylist()]).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*rest, pa.array(model.score(x))], names=[*batch.schema.names[:-1], "score"])

    return run


def held_out(key: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row's crc32 puts it into the fold that is never learnt from; a null key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", max_rows: int = 20_000, seed: int = 11, **options
) -> Model:
    """Fits the model to at most ``max_rows`` labelled documents outside the held-out fold."""
    wanted = labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label"))
    wanted = wanted.where(F.col("__key").isNotNull() & F.col("__label").isin(0, 1) & ~held_out("__key")).distinct()
    some = materialize(wanted.orderBy(F.xxhash64(F.lit(seed), "__key"), "__key", "__label").limit(max_rows))
    source = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"))
    # The sample has at most max_rows rows of two numbers, hence the broadcast.
    chosen = source.join(F.broadcast(some), "__key").groupBy("__key", "__label").agg(F.min("__text").alias("__text"))
    schema = T.StructType([*chosen.schema.fields[:2], T.StructField("features", T.ArrayType(T.DoubleType()))])
    rows = chosen.mapInArrow(_feature_batches, schema).toArrow().sort_by([("__key", "ascending"), ("__label", "ascending")])
    x = np.array(rows.column("features").to_pylist(), float).reshape(rows.num_rows, len(FEATURES))
    return train(x, rows.column("__label").to_numpy().astype(float), **options)


def score_quality(docs: DataFrame, model: Model, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and ``score`` of every row."""
    source = docs.select(*keys, F.col(text).cast("string").alias("__text"))
    fields = [source.schema[k] for k in keys] + [T.StructField("score", T.DoubleType(), False)]
    return source.mapInArrow(_score_batches(model), T.StructType(fields))
