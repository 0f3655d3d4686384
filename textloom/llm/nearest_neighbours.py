"""Nearest neighbours by a block matrix join over int8 product tiles.

Queries and candidates are dealt to blocks by hash; every pair of blocks is a
tile, and a tile is all that a task holds.  In a tile the vectors are rounded to
int8 codes with a scale each, and the codes' inner products (whole numbers, so
exact) give every pair an approximate score and a bound on its error:

    |q.c - q'.c'| <= |q| |c - c'| + |q - q'| |c'|     (q', c': what codes stand for)

where the norms are those of the vectors at hand, not worst cases.  A pair
survives if its upper bound reaches the k-th best score so far (at first, the
k-th best lower bound).  Survivors alone are recomputed from the original
vectors in double precision, component by component in order, so that equal
vectors have equal scores wherever they are met.  A tile hands on its k best of
each query, sorted; the runs of all tiles are merged by heaps.  The result is
exact: bounds decide what is recomputed, never what is found.

Equal vectors are searched for and compared once.  Of candidates with the same
vector only the k + 1 smallest ids can be among the k best of anything, as ties
go to the smaller id; Spark limits them before and after its shuffle, so a vector
that a third of all rows share costs no more than k + 1.  Equal queries are one
query, joined to their ids at the end.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part; nor do queries without an id.  A candidate without an
id comes after its ties and has a null ``vec_id``.  Rows that repeat id and
vector are rows of their own: each is searched for, and is a candidate of the
others.  Vectors are compared with those of their own length only.  Scores that
overflow are infinite, and those that are no number come last.  With fewer than
k candidates all are given.  An empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, materialize

#: Rows of a tile's two sides at most, rows whose products are looked at together, and blocks of candidates at least.
BLOCK_QUERIES, BLOCK_CANDIDATES, SLICE, LEAST_BLOCKS = 4096, 4096, 1024, 8
#: Pairs recomputed at once.
PAIRS_AT_ONCE = 200_000
#: Share of |q| |c| that rounding in double precision stays below.
_SLACK = 1e-11

Batches = Iterator[pa.RecordBatch]
_RUN = "qid long, scores array<double>, ids array<long>, same array<boolean>"


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


class Codes:
    """int8 codes of vectors (held as floats for the matrix product), their scales, and the norms that bound errors."""

    def __init__(self, x: np.ndarray):
        self.scale = np.abs(x).max(1) / 127
        self.codes = np.rint(np.divide(x, self.scale[:, None], out=np.zeros_like(x), where=self.scale[:, None] > 0)).astype(np.int8)
        stands_for = self.codes * self.scale[:, None]
        self.norm, self.norm_code, self.error = (np.sqrt((v * v).sum(1)) for v in (x, stands_for, x - stands_for))
        # Sums of products of codes are whole numbers below 127 * 127 * d: single precision holds them up to 1,040 dimensions.
        self.product = self.codes.astype(np.float32 if x.shape[1] <= 1040 else np.float64)

    def bounds(self, rows: slice, other: Codes, columns: slice) -> tuple[np.ndarray, np.ndarray]:
        """Approximate inner products of two slices, and bounds on their errors."""
        near = (self.product[rows] @ other.product[columns].T) * (self.scale[rows, None] * other.scale[None, columns])
        error = self.norm[rows, None] * other.error[None, columns] + self.error[rows, None] * other.norm_code[None, columns]
        error += _SLACK * (self.norm[rows, None] * other.norm[None, columns])
        return near, error


def inner_products(q: np.ndarray, c: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Inner products of pairs in double precision, summed in the order of the components."""
    out = np.zeros(len(rows))
    for at in range(0, len(rows), PAIRS_AT_ONCE):
        part = slice(at, at + PAIRS_AT_ONCE)
        a, b, total = q[rows[part]], c[columns[part]], np.zeros(len(rows[part]))
        for d in range(q.shape[1]):
            total += a[:, d] * b[:, d]
        out[part] = total
    return out


def _best(row: np.ndarray, score: np.ndarray, column: np.ndarray, rank: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each row, by row: largest score first, ties by rank."""
    order = np.lexsort((rank[column], -np.where(np.isnan(score), -np.inf, score), row))
    new = np.append(True, row[order[1:]] != row[order[:-1]])
    start = np.flatnonzero(new)
    place = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    return order[place < k]


def search_tile(q: np.ndarray, c: np.ndarray, rank: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query, candidate and score of the k best of each query, in order, and the number of pairs that were recomputed.

    ``rank`` orders candidates of equal score.
    """
    row, column, score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    queries, candidates = Codes(q), Codes(c)
    found, recomputed = [], 0
    for top in range(0, len(q), SLICE):
        rows = slice(top, min(top + SLICE, len(q)))
        floor = np.full(rows.stop - top, -np.inf)
        row, column, score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        for left in range(0, len(c), SLICE):
            columns = slice(left, min(left + SLICE, len(c)))
            with np.errstate(over="ignore", invalid="ignore"):
                near, error = queries.bounds(rows, candidates, columns)
                if not left and near.shape[1] >= k:
                    lower = near - error
                    np.copyto(lower, -np.inf, where=np.isnan(lower))
                    floor = np.partition(lower, -k, axis=1)[:, -k]
                near += error
                a, b = np.nonzero(~(near < floor[:, None]))
                recomputed += len(a)
                scores = inner_products(q, c, a + top, b + left)
            row, column, score = np.append(row, a), np.append(column, b + left), np.append(score, scores)
            keep = _best(row, score, column, rank, k)
            row, column, score = row[keep], column[keep], score[keep]
            full = np.bincount(row, minlength=len(floor)) == k
            last = np.flatnonzero(np.append(row[1:] != row[:-1], True)) if len(row) else row
            worst = np.full(len(floor), -np.inf)
            worst[row[last]] = np.where(np.isnan(score[last]), -np.inf, score[last])
            floor = np.where(full, np.maximum(floor, worst), floor)
        found.append((row + top, column, score))
    row, column, score = (np.concatenate([f[i] for f in found]) for i in range(3)) if found else (row, column, score)
    return row, column, score, recomputed


def _tile(k: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks = table.column("qid").is_valid().to_numpy()
        sides = [table.filter(pa.array(m)).combine_chunks() for m in (asks, ~asks)]
        if not (sides[0].num_rows and sides[1].num_rows):
            return pa.table({"qid": pa.array([], pa.int64()), "scores": pa.array([], pa.list_(pa.float64())), "ids": pa.array([], pa.list_(pa.int64())), "same": pa.array([], pa.list_(pa.bool_()))})
        q, c = (_matrix(s.column("embedding").chunk(0)) for s in sides)
        ids = sides[1].column("vec_id").combine_chunks()
        rank = np.empty(len(ids), np.int64)
        rank[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        row, column, score, _ = search_tile(q, c, rank, k)
        same = (q[row] == c[column]).all(1)
        ends = np.append(np.flatnonzero(np.append(True, row[1:] != row[:-1])), len(row)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), v) for v in (pa.array(score), ids.take(pa.array(column)), pa.array(same))]
        return pa.table({"qid": sides[0].column("qid").take(pa.array(row[ends[:-1]])), "scores": lists[0], "ids": lists[1], "same": lists[2]})

    return run


def _merge_batches(k: int) -> Callable[[Batches], Batches]:
    """Of runs sorted by query: one run of the k best for each query."""

    def order(entry: tuple) -> tuple:
        score, vec_id, _ = entry
        return (1, 0.0) if score != score else (0, -score), vec_id is None, vec_id or 0

    def emit(done: list[tuple[int, list[tuple]]]) -> pa.RecordBatch:
        columns = [[q for q, _ in done], *[[[e[i] for e in run] for _, run in done] for i in range(3)]]
        kinds = [pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.bool_())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["qid", "scores", "ids", "same"])

    def run(batches: Batches) -> Batches:
        at, best, done = None, [], []
        for batch in batches:
            for qid, *lists in zip(*(batch.column(c).to_pylist() for c in ("qid", "scores", "ids", "same")), strict=True):
                if qid != at:
                    if at is not None:
                        done.append((at, best))
                    at, best = qid, []
                best = list(islice(heapq.merge(best, list(zip(*lists, strict=True)), key=order), k))
            if done:
                yield emit(done)
                done = []
        if at is not None:
            yield emit([(at, best)])

    return run


def nearest_neighbours(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    key: str = "vec_id",
    embedding: str = "embedding",
    block_queries: int = BLOCK_QUERIES,
    block_candidates: int = BLOCK_CANDIDATES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k candidates of largest inner product of each row that ``queries`` (over ``vec_id``) holds for."""
    single = vectors.schema[embedding].dataType.simpleString() == "array<float>"
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(embedding).cast("array<float>" if single else "array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c).cast("double") != F.lit(float("inf"))), F.lit(False)))
    rows = rows.where((F.size("embedding") > 0) & finite & F.exists("embedding", lambda c: c != 0))
    asking = rows.where(F.col("vec_id").isNotNull() & queries)
    # Numbered once, where they are written.
    classes = materialize(asking.select("embedding").distinct().withColumn("qid", F.monotonically_increasing_id()))
    query_blocks = -(-classes.count() // block_queries)
    candidate_blocks = max(LEAST_BLOCKS, -(-vectors.count() // block_candidates))
    # Sorting looks at a vector only where hashes are equal.
    alike = Window.partitionBy(F.xxhash64("embedding"), "embedding").orderBy(F.col("vec_id").asc_nulls_last())
    limited = rows.withColumn("place", F.row_number().over(alike)).where(F.col("place") <= k + 1)
    block = F.pmod(F.xxhash64("vec_id", "embedding", "place"), F.lit(candidate_blocks)).cast("int")
    blocks = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = classes.select(
        F.pmod(F.xxhash64("qid"), F.lit(max(query_blocks, 1))).cast("int").alias("i"), blocks(candidate_blocks).alias("j"), "qid", F.lit(None).cast("long").alias("vec_id"), "embedding"
    )
    offered = limited.select(blocks(max(query_blocks, 1)).alias("i"), block.alias("j"), F.lit(None).cast("long").alias("qid"), "vec_id", "embedding")
    tiles = asked.union(offered).withColumn("d", F.size("embedding")).groupBy("d", "i", "j")
    runs = tiles.applyInArrow(_tile(k + 1), _RUN)
    merged = runs.repartition("qid").sortWithinPartitions("qid").mapInArrow(lean(_merge_batches(k + 1)), _RUN)
    entries = merged.select("qid", F.arrays_zip("scores", "ids", "same").alias("entries"))
    members = asking.join(classes, "embedding").select("qid", F.col("vec_id").alias("query_id"))
    own = F.array_position(F.transform("entries", lambda e: F.coalesce(e["same"] & (e["ids"] == F.col("query_id")), F.lit(False))), True).cast("int")
    others = F.filter("entries", lambda e, p: (p + 1 != F.col("own")) & (p < F.when(F.col("own") > 0, k + 1).otherwise(k)))
    listed = members.join(entries, "qid").withColumn("own", own).select("query_id", F.posexplode(others).alias("at", "e"))
    return listed.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.ids").alias("vec_id"), F.col("e.scores").alias("score"))
