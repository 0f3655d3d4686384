"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its five-word shingles: the weight is the
shingle's count in the text times its damped inverse document frequency,

    idf = (ln(1 + N / df) / ln(1 + N / floor)) ** IDF_POWER, at most 1.

Document frequencies of all shingles are counted in all documents, in a
count-min sketch of fixed size (SKETCH_ROWS x SKETCH_CELLS counters), which is
what travels with the tasks; a table of all frequencies would not fit any.  The
sketch never counts too little, and too much by about ``floor``, the mean load
of a counter (or 1); a shingle no more frequent than that weighs 1.  idf is
rounded to 64ths, so that noise in the sketch does not make weights of its own.

The root is there because groups of copies are what is looked for: in a group
of thousands the shared shingles are frequent and each edit's are unique, and
by plain idf a few edited words would outweigh a page of shared text.

Each document gets ``BANDS * ROWS`` samples whose collision probability is the
weighted Jaccard similarity; documents that agree in all samples of a band are
candidates.  Equal word sequences are collapsed first.  In a bucket every
member is verified against a few members chosen by hash.  After components of
those links are known, only pairs from different components are left: members
outside a bucket's largest component are compared with all others of other
components, in blocks, on bounds that no link can fail and then on the texts.
So a crowded bucket with few outsiders costs its members times those, and no
pair is left out.  Verification is the weighted Jaccard similarity of the
whole texts.  Groups are the components of verified links.

Defined results: null and empty texts, and texts without a word, are groups of
their own; a text of fewer than five words is one shingle of all its words;
very long texts are read whole; rows with equal texts are one group; the group
id is the smallest doc_id in it, null doc_ids aside, and ``kept`` is doc_id <=>
group id, so rows that repeat a doc_id share it; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, lean, lean_group, materialize, slices

WIDTH = 5
BANDS, ROWS = 16, 4
SIMILARITY = 0.8
#: Counters of the document frequencies, how a merge of them is spread, and the damping of idf.
SKETCH_ROWS, SKETCH_CELLS, SKETCH_PART, SKETCH_SALTS = 2, 1 << 19, 1 << 15, 64
IDF_POWER = 0.25
BLOCK = 1024
#: Cells that a text's weight is summed in, to bound the weight that two texts share from above.
CELLS = 512
#: Room for the rounding of float32 sums in that bound.
SLACK = 1e-4
#: Members of a bucket that all its others are verified against in the first round.
LEADERS = 3
#: Shingles of texts that a block pair keeps at hand.
HELD_SHINGLES = 4_000_000
CHUNK_BYTES = 1_000_000

_U = np.uint64
_POWERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], _U)
_BASE = 0xA24BAED4963EE407
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True  # what WORD_PATTERN leaves out


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(31))
    x = x * _U(0x7FB5D329728EA185)
    x ^= x >> _U(27)
    x *= _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


@lru_cache(maxsize=2)
def _base_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""

    def powers(base: int) -> np.ndarray:
        out = np.full(size, base, _U)
        out[0] = 1
        return np.cumprod(out)

    return powers(_BASE), powers(pow(_BASE, -1, 1 << 64))


def word_hashes(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts laid end to end (bytes, and where each ends), and the number of words of each.

    A word's hash is a polynomial of its bytes, read off prefix sums, so no
    word becomes a Python object.
    """
    ends = np.asarray(ends, np.int64)
    starts = np.append(0, ends[:-1]).astype(np.int64)
    if not len(raw):
        return np.empty(0, _U), np.zeros(len(ends), np.int64)
    inside = ~_SPACES[raw]
    full = starts[starts < ends]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[full] |= inside[full]
    final = ends[starts < ends] - 1
    last[final] |= inside[final]
    a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
    size = 1 << max(20, int(len(raw)).bit_length())
    up, down = _base_powers(size)
    sums = np.zeros(len(raw) + 1, _U)
    np.cumsum(raw.astype(_U) * up[: len(raw)], out=sums[1:])
    h = (sums[b] - sums[a]) * down[a] + (b - a).astype(_U) * _POWERS[1]
    return _mix(h), np.searchsorted(a, ends) - np.searchsorted(a, starts)


def shingle_sets(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of texts' words laid end to end, each text's ascending, their counts, and where each text begins.

    Hashing runs over all texts at once; only sorting is done text by text.
    """
    n = np.maximum(sizes - WIDTH + 1, np.minimum(sizes, 1))  # a text shorter than a shingle is one
    total = int(sizes.sum())
    words = np.concatenate([words, np.zeros(WIDTH, _U)])
    begin = np.cumsum(sizes) - sizes
    out = np.cumsum(n) - n
    sums = words[:total] * _POWERS[0]
    for k in range(1, WIDTH):
        sums += words[k : total + k] * _POWERS[k]
    h = sums[np.repeat(begin - out, n) + np.arange(int(n.sum()))]
    for k in np.flatnonzero((sizes > 0) & (sizes < WIDTH)).tolist():
        h[out[k]] = (words[begin[k] : begin[k] + sizes[k]] * _POWERS[: sizes[k]]).sum() + _U(int(sizes[k]))
    h = _mix(h)
    for a, b in zip(out.tolist(), (out + n).tolist(), strict=True):
        if b - a > 1:
            h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[out[n > 0]] = True
    first = np.flatnonzero(new)
    return h[first], np.diff(np.append(first, len(h))), np.searchsorted(first, out)


def shingles(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a word list, ascending, and their counts."""
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    return shingle_sets(*word_hashes(raw, np.array([len(raw)])))[:2]


def sketch_cells(h: np.ndarray, row: int) -> np.ndarray:
    """The counter of each shingle in a row of the sketch."""
    return (h >> _U(45 - 19 * row)).astype(np.int64) & (SKETCH_CELLS - 1)


class Weights:
    """Weights of shingles: counts times damped idf, from a sketch of document frequencies; counts alone without one."""

    def __init__(self, sketch: np.ndarray | None = None, documents: int = 0):
        self.idf = None
        if sketch is not None and documents:
            floor = max(1.0, float(sketch[0].sum()) / SKETCH_CELLS)
            idf = (np.log1p(documents / np.maximum(sketch, floor)) / np.log1p(documents / floor)) ** IDF_POWER
            self.idf = (np.round(idf * 64) / 64).astype(np.float32)

    def __call__(self, h: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if self.idf is None:
            return counts.astype(float)
        rarest = self.idf[0][sketch_cells(h, 0)]
        for row in range(1, SKETCH_ROWS):
            rarest = np.maximum(rarest, self.idf[row][sketch_cells(h, row)])
        return counts * rarest.astype(float)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of minima over sum of maxima of two weighted sets (hashes ascending)."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = float(np.minimum(a[1][i], b[1][j]).sum())
    return least / (float(a[1].sum()) + float(b[1].sum()) - least)


class Sampler:
    """Improved consistent weighted sampling; all randomness is a function of shingle and sample number.

    A sample takes the shingle with the least c * exp(-r * (t - b + 1)) (in
    logarithms), t being floor(log(weight) / r + b); most weights are 1, for
    which t is 0.  Gamma variates come from tables that stay in the cache, and
    so do the runs of shingles worked on at once.
    """

    def __init__(self, samples: int = BANDS * ROWS, seed: int = 5, run: int = 16_384):
        rng = np.random.default_rng(seed)
        self.r = rng.gamma(2.0, 1.0, 1 << 12).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, 1 << 12)).astype(np.float32)
        self.odd = (rng.integers(0, 1 << 62, samples, dtype=np.uint64) << _U(1)) | _U(1)
        self.run = run

    def __call__(self, h: np.ndarray, log_weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(documents, samples): a 64-bit value for each sample of each run of shingles."""
        out = np.empty((len(starts), len(self.odd)), _U)
        ends = np.append(starts[1:], len(h))
        at = 0
        while at < len(starts):  # whole documents, as many as a run holds
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + self.run, "right")))
            a, b = int(starts[at]), int(ends[to - 1])
            out[at:to] = self._some(h[a:b], log_weight[a:b], starts[at:to] - a)
            at = to
        return out

    def _some(self, h: np.ndarray, log_weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
        out = np.empty((len(starts), len(self.odd)), _U)
        owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(h))))
        heavy = np.flatnonzero(log_weight != 0)
        log_heavy = log_weight[heavy].astype(np.float32)
        t = np.zeros(len(h), np.int64)
        for k, odd in enumerate(self.odd):
            x = h * odd
            r = self.r[(x >> _U(52)).astype(np.int32)]
            log_a = self.log_c[(x >> _U(40)).astype(np.int32) & 0xFFF]
            rest = (x >> _U(8)).astype(np.uint32).astype(np.float32) * np.float32(-(2.0**-32)) + np.float32(1)  # 1 - b
            if len(heavy):
                t[heavy] = steps = np.floor(log_heavy / r[heavy] + (1 - rest[heavy]))
                rest[heavy] += steps
            log_a -= r * rest
            hits = np.flatnonzero(log_a == np.minimum.reduceat(log_a, starts)[owner])
            if len(hits) > len(starts):  # ties: the first
                first = np.ones(len(hits), bool)
                first[1:] = owner[hits[1:]] != owner[hits[:-1]]
                hits = hits[first]
            out[:, k] = _mix(h[hits] + t[hits].view(_U) * _U(0x9E3779B97F4A7C15))
        return out


def _words(batches: Iterator[pa.RecordBatch], size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of the batches of about ``size`` bytes of text, with the hashes of their words and the words of each row."""
    for batch in batches:
        for part in slices(batch, ("text",), size):
            column = pc.fill_null(part.column("text"), "").cast(pa.large_binary())
            ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
            yield part, *word_hashes(np.frombuffer(b"".join(column.to_pylist()), np.uint8), ends)


def _digests(words: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """A digest of each text's sequence of words; null without words."""
    ends = np.cumsum(sizes)
    return [xxhash.xxh3_128_digest(words[b - n : b].tobytes()) if n else None for b, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def _count_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sketch in parts, and its number of texts with a word as part -1."""
    counts, documents = np.zeros((SKETCH_ROWS, SKETCH_CELLS), np.uint32), 0
    for _, words, sizes in _words(batches):
        h, _, _ = shingle_sets(words, sizes)
        documents += int((sizes > 0).sum())
        for row in range(SKETCH_ROWS):
            counts[row] += np.bincount(sketch_cells(h, row), minlength=SKETCH_CELLS).astype(np.uint32)
    if documents:
        parts = [np.array([documents], np.int64), *counts.astype(np.int64).reshape(-1, SKETCH_PART)]
        yield _parts(np.arange(len(parts)) - 1, parts, TaskContext.get().partitionId() % SKETCH_SALTS)


def _parts(numbers: np.ndarray, parts: list[np.ndarray], salt: int) -> pa.RecordBatch:
    columns = [pa.array(np.asarray(numbers, np.int32)), pa.array(np.full(len(parts), salt, np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["part", "salt", "counts"])


def _sum_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of equal parts of rows sorted by part and salt; one sum is held at a time."""
    here, held = None, None
    for batch in batches:
        for part, salt, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            values = np.frombuffer(counts, np.int64)
            if here == (part, salt):
                held = held + values
                continue
            if here is not None:
                yield _parts(np.array([here[0]]), [held], here[1])
            here, held = (part, salt), values
    if here is not None:
        yield _parts(np.array([here[0]]), [held], here[1])


def document_weights(docs: DataFrame) -> Weights:
    """Weights from the document frequencies of all shingles in all rows.

    Tasks' sketches are summed in two steps, the first spread by salt; what is
    collected is one sketch (8 MB), whatever the number of documents.
    """
    schema = "part int, salt int, counts binary"
    sums = docs.select("text").mapInArrow(lean(_count_shingles), schema)
    for salted in (True, False):
        sums = sums if salted else sums.withColumn("salt", F.lit(0))
        dealt = sums.repartition(*(["part", "salt"] if salted else ["part"]))
        sums = dealt.sortWithinPartitions("part", "salt").mapInArrow(lean(_sum_parts), schema)
    found = {r["part"]: np.frombuffer(r["counts"], np.int64) for r in sums.collect()}
    if not found:
        return Weights()
    return Weights(np.concatenate([found[k] for k in range(len(found) - 1)]).reshape(SKETCH_ROWS, SKETCH_CELLS), int(found[-1][0]))


def _sign(weights: Weights) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """doc_id, rid, digest of the word sequence, and band keys."""

    def signed(sampler: Sampler, batch: pa.RecordBatch, words: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        h, counts, starts = shingle_sets(words, sizes)
        some = np.flatnonzero(np.diff(np.append(starts, len(h))) > 0)
        bands = np.zeros((len(sizes), BANDS), np.int64)
        if len(some):
            values = sampler(h, np.log(weights(h, counts)), starts[some])
            keys = np.zeros((len(some), BANDS), _U)
            for r in range(ROWS):
                keys = _mix(keys * _U(31) + values[:, r::ROWS])
            bands[some] = keys.view(np.int64)
        offsets = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * BANDS)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("rid"), pa.array(_digests(words, sizes), pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(bands.ravel()))],
            names=["doc_id", "rid", "digest", "bands"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch, words, sizes in _words(batches):
            yield signed(sampler, batch, words, sizes)

    return run


def _verify(weights: Weights, similarity: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        held = 0

        def known(digest: bytes, text: str) -> tuple[np.ndarray, np.ndarray]:
            nonlocal held
            if digest not in cache:
                if held > HELD_SHINGLES // 8:
                    cache.clear()
                    held = 0
                h, n = shingles([text])
                cache[digest] = (h, weights(h, n))
                held += len(h)
            return cache[digest]

        for batch in batches:
            for part in slices(batch, ("text_a", "text_b"), CHUNK_BYTES):
                columns = [part.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")]
                keep = [weighted_jaccard(known(x, s), known(y, t)) >= similarity for x, y, s, t in zip(*columns, strict=True)]
                chosen = part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
                yield pa.RecordBatch.from_arrays(chosen.columns, names=["src", "dst"])

    return run


def most_shared(cells: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Upper bounds of the weight that a text shares with others: least sums by cell."""
    return np.minimum(others, cells).sum(1)


def _cross(weights: Weights, similarity: float) -> Callable[[pa.Table], pa.Table]:
    """Links between different components in a block pair of a bucket: its members (side 0) and those outside its largest component (side 1).

    Every pair is tested on its whole texts, in the first band that it shares,
    unless bounds from above on its similarity (the ratio of total weights, and
    the weights shared by cell) are below ``similarity``.  A link makes its two
    components one, so no more links are given than join components, and no
    pair is given that is no link.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        band = table.column("band")[0].as_py()
        side, main = table.column("side").to_numpy(), table.column("main").to_numpy(zero_copy_only=False)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        digest, text = table.column("digest"), table.column("text")
        order = np.argsort(np.array(digest.to_pylist(), object), kind="stable")
        n = table.num_rows
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        bands = table.column("bands").chunk(0).flatten().to_numpy().reshape(n, BANDS)
        group = np.unique(np.array(table.column("component").to_pylist(), object), return_inverse=True)[1]
        if (group == group[0]).all():
            return pa.table({"src": digest.slice(0, 0), "dst": digest.slice(0, 0)})
        total, cells = np.zeros(n), np.zeros((n, CELLS), np.float32)
        sets: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        held = row = 0
        for _, words, sizes in _words(iter(table.select(["text"]).to_batches())):
            h, counts, starts = shingle_sets(words, sizes)
            w, ends = weights(h, counts), np.append(starts[1:], len(h))
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                total[row] = w[a:b].sum()
                cells[row] = np.bincount((h[a:b] >> _U(40)).astype(np.int64) % CELLS, w[a:b], CELLS)
                if held + b - a <= HELD_SHINGLES:
                    sets[row] = (h[a:b].copy(), w[a:b].copy())
                    held += b - a
                row += 1

        def known(row: int) -> tuple[np.ndarray, np.ndarray]:
            nonlocal held
            if row not in sets:
                if held > HELD_SHINGLES:
                    sets.clear()
                    held = 0
                h, counts = shingles([text[row].as_py()])
                sets[row] = (h, weights(h, counts))
                held += len(h)
            return sets[row]

        found_a, found_b = [], []
        least = similarity * (1 - SLACK)
        for at in left.tolist():
            rest = right[group[right] != group[at]]
            if not main[at]:  # the pair comes up the other way round as well
                rest = rest[place[rest] > place[at]]
            rest = rest[np.minimum(total[rest], total[at]) >= least * np.maximum(total[rest], total[at])]
            rest = rest[~(bands[rest][:, :band] == bands[at][None, :band]).any(1)]
            if not len(rest):
                continue
            shared = most_shared(cells[at], cells[rest]) * (1 + SLACK)
            bound = shared / np.maximum(total[rest] + total[at] - shared, 1e-300)
            order = np.argsort(-bound, kind="stable")  # likely links first, as they make other pairs needless
            for other in rest[order[bound[order] >= least]].tolist():
                if group[other] != group[at] and weighted_jaccard(known(at), known(other)) >= similarity:
                    group[group == group[other]] = group[at]
                    found_a.append(at)
                    found_b.append(other)
        return pa.table({"src": digest.take(pa.array(found_a, pa.int64())), "dst": digest.take(pa.array(found_b, pa.int64()))})

    return run


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text", weights: Weights | None = None) -> DataFrame:
    """``doc_id``, ``class_id``, ``kept`` and ``row_hash`` (of id and text) of every row.

    The smallest id of a class is kept; of a class without ids, the row with the smallest hash.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("rid", F.xxhash64("doc_id", "text"))
    weights = weights or document_weights(rows)
    signed = materialize(rows.mapInArrow(lean(_sign(weights)), "doc_id long, rid long, digest binary, bands array<long>"))
    with_words = signed.where(F.col("digest").isNotNull())
    one = materialize(with_words.select("digest", "bands").dropDuplicates(["digest"]))
    each = one.select("digest", F.posexplode("bands").alias("band", "value"))
    leaders = F.array(*[F.min(F.struct(F.xxhash64("digest", F.lit(k)).alias("order"), "digest"))["digest"] for k in range(LEADERS)])
    buckets = each.groupBy("band", "value").agg(leaders.alias("leaders"), F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = materialize(buckets)
    led = each.join(buckets, ["band", "value"]).select("digest", F.explode(F.array_distinct("leaders")).alias("leader")).where("digest <> leader")
    stars = materialize(led.select(F.least("leader", "digest").alias("a"), F.greatest("leader", "digest").alias("b")).distinct())

    ids = stars.select(F.col("a").alias("digest")).union(stars.select(F.col("b").alias("digest"))).distinct()
    named = materialize(ids.join(with_words.groupBy("digest").agg(F.min("rid").alias("rid")), "digest"))
    candidates = _with_text(rows, named)

    def verify(pairs: DataFrame) -> DataFrame:
        full = pairs.join(candidates.select(F.col("digest").alias("b"), F.col("text").alias("text_b")), "b")
        full = full.join(candidates.select(F.col("digest").alias("a"), F.col("text").alias("text_a")), "a")
        return full.select("a", "b", "text_a", "text_b").mapInArrow(lean(_verify(weights, similarity)), "src binary, dst binary")

    first = materialize(verify(stars))
    parts = materialize(connected_components(first))
    member = one.join(ids, "digest", "left_semi").join(parts, one["digest"] == parts["node"], "left")
    member = materialize(member.select("digest", "bands", F.coalesce("component", "digest").alias("component")))
    inside = member.select("digest", "component", F.posexplode("bands").alias("band", "value")).join(buckets.select("band", "value"), ["band", "value"])
    sizes = inside.groupBy("band", "value", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = F.max(F.struct("n", "component")).alias("largest")
    mixed = sizes.groupBy("band", "value").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"), largest).where("parts > 1 and n > 2")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    mixed = mixed.select(
        "band", "value", F.col("largest.component").alias("most"), blocks(F.col("n")).alias("lefts"), blocks(F.col("n") - F.col("largest.n")).alias("rights")
    )
    placed = member.select("digest", "component", F.posexplode("bands").alias("band", "value")).join(materialize(mixed), ["band", "value"])
    placed = materialize(placed.withColumn("main", F.col("component") == F.col("most")).drop("component", "most"))
    mine = lambda blocks: F.pmod(F.xxhash64("digest"), blocks).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    left = placed.select("digest", "main", "band", "value", mine("lefts").alias("i"), every("rights").alias("j"), F.lit(0).alias("side"))
    right = placed.where("not main").select("digest", "main", "band", "value", every("lefts").alias("i"), mine("rights").alias("j"), F.lit(1).alias("side"))
    dealt = left.union(right).join(materialize(member.join(candidates, "digest")), "digest")
    second = materialize(dealt.groupBy("band", "value", "i", "j").applyInArrow(lean_group(_cross(weights, similarity)), "src binary, dst binary"))
    labels = parts
    if not second.isEmpty():  # the second round joins whole components
        known = member.select("digest", "component")
        ends = second.join(known.select(F.col("digest").alias("src"), F.col("component").alias("a")), "src")
        ends = ends.join(known.select(F.col("digest").alias("dst"), F.col("component").alias("b")), "dst")
        joined = connected_components(ends.select(F.col("a").alias("src"), F.col("b").alias("dst")))
        joined = joined.select(F.col("node").alias("component"), F.col("component").alias("whole"))
        labels = known.join(materialize(joined), "component", "left").select(F.col("digest").alias("node"), F.coalesce("whole", "component").alias("component"))
    classes = with_words.select("doc_id", "rid", "digest").join(materialize(labels), F.col("digest") == F.col("node"), "left")
    classes = classes.select("digest", "doc_id", "rid", F.coalesce("component", "digest").alias("component"))
    least = materialize(classes.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.min("rid").alias("least")))
    chosen = F.when(F.col("class_id").isNull(), F.col("rid") == F.col("least")).otherwise(F.col("doc_id").eqNullSafe(F.col("class_id")))
    grouped = materialize(classes).join(least, "component").select("doc_id", "class_id", chosen.alias("kept"), F.col("rid").alias("row_hash"))
    alone = signed.where(F.col("digest").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"), F.col("rid").alias("row_hash"))
    return grouped.union(alone)


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, words, sizes in _words(batches):
        yield pa.RecordBatch.from_arrays([pa.array(_digests(words, sizes), pa.binary()), batch.column("text")], names=["digest", "text"])


def _with_text(rows: DataFrame, named: DataFrame) -> DataFrame:
    """``digest, text`` of the digests in ``named(digest, rid)``, one text each, written out.

    Texts are joined once, by the hash of one row of each digest; the digest is
    taken again, so that rows whose hashes collide do no harm.
    """
    texts = rows.join(named.select("rid").distinct(), "rid", "left_semi").select("text")
    found = texts.mapInArrow(lean(_digest_batches), "digest binary, text string")
    return materialize(found.join(named.select("digest"), "digest", "left_semi").dropDuplicates(["digest"]))
