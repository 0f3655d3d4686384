"""Exact metric range join of embeddings, and near-duplicate groups from it.

Vectors are put on the unit sphere, where cosine >= c means a distance of at
most r = sqrt(2 - 2c).  Equal vectors are one class first.  Pivots cut the
classes into cells (nearest pivot).  A vector x of cell p is also a guest of a
later cell q unless q is out of reach for every partner it could have there:

* triangle inequality with a partner y of q: d(x, q) <= d(x, p) + 2r;
* the same with any pivot s: d(x, s) lies within r of the interval of
  distances that the vectors of q have from s (REFERENCES pivots are tried);
* the plane halfway between p and q separates the cells, and x must be within
  r of it: d(x, q)^2 - d(x, p)^2 <= 2 r d(p, q).

Cells are joined independently, in blocks of at most ``block`` home and
``block`` guest rows, so that a crowded cell is many small tasks.  A block
gives each vector's number of links and a spanning forest of the links, never
the pairs, so its output is linear in its rows.

The join is exact whatever the pivots are; they only decide how much is
compared.  Vectors that spread evenly over many dimensions have their
neighbours in reach of every cell, as no test by distances can tell them
apart; then this is a blocked comparison of all vectors, in which a vector
goes to about half of all cells.  ``block`` therefore is as large as a task's
memory allows: a quarter as many cells is a quarter as many copies.

Components are double precision, or single where the column is.  Vectors of
another length than the table's most frequent one are compared with those of
their own length, block by block, without pivots.

Defined results: a null, empty, zero or non-finite vector, or one with null
components, links with nothing; so does a row without vec_id, whose component
is null; vectors of different lengths do not link.  Rows that repeat a vec_id
are vectors of their own.  An empty table gives an empty result.  Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize

#: Most pivots, and those of them that cells keep intervals for; they and the intervals
#: travel with the tasks (2 MB at 64 dimensions, and 4 MB).
MAX_PIVOTS, REFERENCES = 4096, 64
#: Pivots of a table that fills no more blocks (fewer, the root of its size, below 64 vectors).
LEAST_PIVOTS = 8
#: Rows worked on at once.
ROWS_AT_ONCE = 1000
_SLACK = 1e-9


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors, in double precision, of a column of equally long arrays."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1) if len(column) else np.empty((0, 1))
    rows = rows / np.abs(rows).max(1, keepdims=True).clip(1e-300)  # squares of huge or tiny values stay finite
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


class Cells:
    """Pivots, and for every cell the intervals of its vectors' distances from the reference pivots."""

    def __init__(self, pivots: np.ndarray, radius: float):
        self.pivots, self.radius = pivots, radius
        self.n_references = min(REFERENCES, len(pivots))
        self.low = np.zeros((len(pivots), self.n_references))
        self.high = np.full((len(pivots), self.n_references), 2.0)
        self.extent = np.full(len(pivots), 2.0)

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2 - 2 * x @ self.pivots.T))

    def home(self, d: np.ndarray) -> np.ndarray:
        return d.argmin(1)

    def guests(self, d: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows, and the cells after their own that each is a guest of."""
        own = d[np.arange(len(d)), home][:, None]
        r = self.radius + _SLACK
        apart = np.sqrt(np.maximum(0.0, 2 - 2 * self.pivots[home] @ self.pivots.T))
        near = (d <= own + 2 * r) & (d <= self.extent[None] + r) & (d**2 - own**2 <= 2 * r * apart + _SLACK)
        row, cell = np.nonzero(near & (np.arange(len(self.pivots))[None] > home[:, None]))
        for s in range(self.n_references):
            at = d[row, s]
            keep = (at >= self.low[cell, s] - r) & (at <= self.high[cell, s] + r)
            row, cell = row[keep], cell[keep]
        return row, cell


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def _measure(cells: Cells) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each cell's home rows, its extent, and the intervals of distances from the references."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, m = len(cells.pivots), cells.n_references
        count, extent, low, high = np.zeros(p, np.int64), np.zeros(p), np.full((p, m), 2.0), np.zeros((p, m))
        for batch in _parts(batches):
            d = cells.distances(_matrix(batch.column("embedding")))
            home = cells.home(d)
            count += np.bincount(home, minlength=p)
            np.maximum.at(extent, home, d[np.arange(len(d)), home])
            np.minimum.at(low, home, d[:, :m])
            np.maximum.at(high, home, d[:, :m])
        arrays = [pa.array(np.arange(p, dtype=np.int32)), pa.array(count), pa.array(extent), pa.array(list(low)), pa.array(list(high))]
        yield pa.RecordBatch.from_arrays(arrays, names=["cell", "n", "extent", "low", "high"])

    return run


def _count_guests(cells: Cells) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(cells.pivots), np.int64)
        for batch in _parts(batches):
            d = cells.distances(_matrix(batch.column("embedding")))
            count += np.bincount(cells.guests(d, cells.home(d))[1], minlength=len(count))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(count), dtype=np.int32)), pa.array(count)], names=["cell", "n"])

    return run


def _block_of(ids: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % blocks.astype(np.uint64)).astype(np.int64)


def _deal(cells: Cells, home_blocks: np.ndarray, guest_blocks: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of every block pair that a class takes part in, with its side: 0 or 1.

    Task (cell, i, j) with j < blocks of home rows compares home blocks i <= j;
    others compare guest block j - blocks with home block i.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            d = cells.distances(_matrix(batch.column("embedding")))
            ids = batch.column("rep").to_numpy()
            home = cells.home(d)
            row, cell, i, j, side = [], [], [], [], []

            def add(rows: np.ndarray, q: np.ndarray, a: np.ndarray, b: np.ndarray, s: np.ndarray) -> None:
                row.append(rows), cell.append(q), i.append(a), j.append(b), side.append(s)

            mine = _block_of(ids, home_blocks[home])
            for k in range(int(home_blocks[home].max(initial=0))):
                rows = np.flatnonzero(home_blocks[home] > k)
                low, high = np.minimum(mine[rows], k), np.maximum(mine[rows], k)
                add(rows, home[rows], low, high, (mine[rows] == high).astype(np.int64))
            for k in range(int(guest_blocks[home].max(initial=0))):
                rows = np.flatnonzero(guest_blocks[home] > k)
                add(rows, home[rows], mine[rows], home_blocks[home[rows]] + k, np.zeros(len(rows), np.int64))
            rows, q = cells.guests(d, home)
            theirs = _block_of(ids[rows], np.maximum(guest_blocks[q], 1))
            for k in range(int(home_blocks[q].max(initial=0))):
                some = np.flatnonzero(home_blocks[q] > k)
                add(rows[some], q[some], np.full(len(some), k), home_blocks[q[some]] + theirs[some], np.ones(len(some), np.int64))
            take = pa.array(np.concatenate(row))
            numbers = [pa.array(np.concatenate(c).astype(np.int32)) for c in (cell, i, j, side)]
            yield pa.RecordBatch.from_arrays(
                [*numbers, *[batch.column(c).take(take) for c in ("rep", "size", "embedding")]], names=["cell", "i", "j", "side", "rep", "size", "embedding"]
            )

    return run


def _deal_plain(classes: DataFrame, lengths: DataFrame, block: int) -> DataFrame:
    """Block pairs of the vectors of each of the given lengths; the cell is the length, negative."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    placed = classes.withColumn("d", F.size("embedding")).join(lengths.select("d", blocks.alias("blocks")), "d")
    placed = placed.withColumn("mine", F.pmod(F.xxhash64("rep"), "blocks").cast("int")).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.select(
        (-F.col("d")).alias("cell"),
        F.least("mine", "k").alias("i"),
        F.greatest("mine", "k").alias("j"),
        (F.col("mine") == F.greatest("mine", "k")).cast("int").alias("side"),
        "rep",
        "size",
        "embedding",
    )


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reachable from each of n nodes over the edges (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(cosine: float) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        i, j = (table.column(c)[0].as_py() for c in ("i", "j"))
        x = _matrix(table.column("embedding").chunk(0))
        ids, size = table.column("rep").to_numpy(), table.column("size").to_numpy().astype(np.int64)
        side = table.column("side").to_numpy()
        within = i == j  # one home block with itself, all of it side 1
        left, right = (np.arange(len(ids)),) * 2 if within else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        links = np.zeros(len(ids), np.int64)
        label = np.arange(len(ids))
        for at in range(0, len(left), 512):
            part = left[at : at + 512]
            hit = x[part] @ x[right].T >= cosine
            if within:
                hit &= part[:, None] < right[None]
            a, b = np.nonzero(hit)
            if len(a):
                a, b = part[a], right[b]
                np.add.at(links, a, size[b])
                np.add.at(links, b, size[a])
                label = _forest(len(ids), np.concatenate([a, np.arange(len(ids))]), np.concatenate([b, label]))
        some = np.flatnonzero(links > 0)
        return pa.table({"rep": ids[some], "links": links[some], "other": ids[label[some]]})

    return run


def embedding_groups(
    vectors: DataFrame, cosine: float = 0.95, key: str = "vec_id", embedding: str = "embedding", block: int = 8192
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row."""
    single = vectors.schema[embedding].dataType.simpleString() == "array<float>"
    kind = "array<float>" if single else "array<double>"
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(embedding).cast(kind).alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v).cast("double") != F.lit(float("inf"))))
    sound = F.coalesce(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda v: v != 0), F.lit(False))
    # A class is known by a number of its own, fixed by being written, as different vectors may share a vec_id.
    classes = rows.where(sound).groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("size"))
    classes = materialize(classes.select(F.monotonically_increasing_id().alias("rep"), "least", "size", "embedding"))
    lengths = classes.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), "d").first()
    if usual is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    others = lengths.where(F.col("d") != usual["d"])
    plain = _deal_plain(classes.where(F.size("embedding") != usual["d"]), others, block)
    main = classes.where(F.size("embedding") == usual["d"])
    n_pivots = min(MAX_PIVOTS, max(usual["n"] // block, min(LEAST_PIVOTS, isqrt(usual["n"]))))
    chosen = main.orderBy(F.xxhash64("least"), "least", "rep").limit(n_pivots).select("embedding").toArrow()  # at most MAX_PIVOTS rows
    cells = Cells(_matrix(chosen.column("embedding").combine_chunks()), float(np.sqrt(2 - 2 * cosine)))

    # A row for each pivot and each of its intervals is collected: MAX_PIVOTS times REFERENCES at most.
    measured = materialize(main.select("embedding").mapInArrow(_measure(cells), "cell int, n long, extent double, low array<double>, high array<double>"))
    found = {r["cell"]: r for r in measured.groupBy("cell").agg(F.sum("n").alias("n"), F.max("extent").alias("extent")).collect()}
    ends = measured.select("cell", F.posexplode(F.arrays_zip("low", "high")).alias("s", "e")).groupBy("cell", "s").agg(F.min("e.low"), F.max("e.high"))
    for cell, s, low, high in ends.collect():
        cells.low[cell, s], cells.high[cell, s] = low, high
    get = lambda c: np.array([found[k][c] for k in range(n_pivots)])
    n_home, cells.extent = get("n"), get("extent")
    counted = main.select("embedding").mapInArrow(_count_guests(cells), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    guests = {r["cell"]: r["n"] for r in counted.collect()}
    n_guest = np.array([guests[k] for k in range(n_pivots)])
    home_blocks, guest_blocks = np.maximum(-(-n_home // block), 1), -(-n_guest // block)
    dealt = main.mapInArrow(_deal(cells, home_blocks, guest_blocks), f"cell int, i int, j int, side int, rep long, size long, embedding {kind}")
    compared = dealt.union(plain).groupBy("cell", "i", "j").applyInArrow(_compare(cosine), "rep long, links long, other long")
    compared = materialize(compared)
    links = compared.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(compared.select(F.col("rep").alias("src"), F.col("other").alias("dst")))
    parts = materialize(parts.withColumnRenamed("node", "rep").join(classes.select("rep", "least"), "rep"))
    smallest = parts.groupBy("component").agg(F.min("least").alias("smallest"))
    known = (
        classes.join(links, "rep", "left")
        .join(parts.join(smallest, "component").select("rep", "smallest"), "rep", "left")
        .select("embedding", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("smallest", "least").alias("component_id"))
    )
    known = materialize(known)
    joined = rows.where(sound).join(known, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.union(alone).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
