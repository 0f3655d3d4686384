"""Removal of repeated passages by range-partitioned suffixes.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts
anywhere else.  Writing out a suffix for every byte would multiply the corpus
by 200, so suffixes start at anchors: the anchor of a string is its leftmost
smallest 8-byte word (by hash) among the first ``SPAN``, which depends on the
string alone.  Equal strings thus have anchors at equal places, followed by
the same ``LEAD`` bytes at least, and every start position belongs to exactly
one anchor.  An anchor lies about every 69 bytes.

1. Anchors whose leading ``LEAD`` bytes occur once cannot be in a repeat; they
   are sorted out on 64-bit hashes, without their text.
2. The others are written out as suffixes with the bytes before them.  Equal
   ones in a task are reported at once and only one of them goes on, so a
   thousandfold copy becomes one row for each task.
3. Spark samples splitters and deals the suffixes out by range of their
   leading bytes.  Each bucket sorts its suffixes, and the reversed bytes before
   them, by multikey quicksort.  The lengths of common prefixes of neighbours
   then tell, for each of the SPAN offsets, which suffixes agree from the anchor
   on and which agree before it; strings that agree in both are equal.  Splitters
   fall between different leading bytes, which equal strings share, so no match
   reaches across a boundary, and neither do the runs of whole leads in which a
   bucket is worked off.
4. A bucket of more than BUCKET_LIMIT suffixes (the line of 64 to 199 bytes that
   stands in every document) is split by further bytes.  Of the offsets that its
   lead serves, the lower half share more bytes behind the anchor and the upper
   half more before it; each half takes its suffixes with those bytes added to
   the key, and is split on while its buckets are too large.  At a single offset
   the key is the whole string, so whatever is left there is equal and repeated.

Defined results: a null text counts as empty; texts under LENGTH bytes lose
nothing; matches never cross texts; rows with equal key and text are copies of
each other and so lose all but short texts; very long texts are read whole; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, materialize

LENGTH = 200
LEAD = 64
#: Start positions that an anchor may stand for: all whose string holds its leading bytes.
SPAN = LENGTH - LEAD + 1
#: Suffixes compared at once, suffixes of a key beyond which more bytes are added to it,
#: and digests that a task remembers.
BUCKET_ROWS, BUCKET_LIMIT, MEMO_ROWS = 20_000, 5_000, 300_000
CHUNK_BYTES = 2_000_000

_U = np.uint64
_SUFFIXES = "rid long, key long, lo int, at int, n int, end int, body binary"
_SPANS = "rid long, key long, lo int, end int"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _words(raw: np.ndarray) -> np.ndarray:
    """The 8-byte word at every place of a buffer (8 zero bytes follow it)."""
    x = np.concatenate([raw, np.zeros(8, np.uint8)]).astype(_U)
    for k in (1, 2, 4):
        x = x[:-k] | (x[k:] << _U(8 * k))
    return x[: len(raw)]


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of texts laid end to end: place, first and last start position, text number, lead hash."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"".join(texts), np.uint8)
    total = len(raw)
    if total < LENGTH:
        none = np.empty(0, np.int64)
        return none, none, none, none, none
    words = _words(raw)
    low = (_mix(words) & _U(0xFFFFFFFF00000000)) | np.arange(total, dtype=_U)
    width = 1
    while 2 * width <= SPAN:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[: total - SPAN + 1], low[SPAN - width :])[: total - LENGTH + 1]
    # Only strings inside one text count.
    ends = starts + sizes
    blocked = np.zeros(len(low) + 1, np.int32)
    first = np.minimum(np.maximum(ends - LENGTH + 1, starts), len(low))
    np.add.at(blocked, first, 1)
    np.add.at(blocked, np.minimum(ends, len(low)), -1)
    sound = np.flatnonzero(np.cumsum(blocked)[: len(low)] == 0)
    if not len(sound):
        none = np.empty(0, np.int64)
        return none, none, none, none, none
    place = (low[sound] & _U(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    at, lo, hi = place[new], sound[new], sound[np.append(new[1:], len(sound)) - 1]
    lead = np.zeros(len(at), _U)
    for k in range(0, LEAD, 8):
        lead = _mix(lead * _U(0x9E3779B97F4A7C15) + words[at + k] + _U(k))
    owner = np.searchsorted(starts, at, "right") - 1
    return at, lo, hi, owner, lead.view(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about CHUNK_BYTES of text."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, done + CHUNK_BYTES, "right")))
            yield batch.slice(at, end - at)
            at = end


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").to_pylist()]


def _lead_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _chunks(batches):
        texts = _texts(batch)
        at, _, _, owner, lead = anchors(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(sizes) - sizes
        rid = batch.column("rid").to_numpy()
        place = at - starts[owner] if len(at) else at
        yield pa.RecordBatch.from_arrays(
            [pa.array(rid[owner] if len(at) else np.empty(0, np.int64)), pa.array(place.astype(np.int32)), pa.array(lead)], names=["rid", "place", "lead"]
        )


def _suffix_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes of the flagged places; spans of those that this task has met before."""
    seen: dict[bytes, tuple[int, int, int, int]] = {}
    for batch in _chunks(batches):
        texts = _texts(batch)
        at, lo, hi, owner, _ = anchors(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(sizes) - sizes
        places = batch.column("places")
        counts = pc.list_value_length(places).to_numpy(zero_copy_only=False).astype(np.int64)
        flagged = places.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(starts, counts)
        chosen = np.flatnonzero(np.isin(at, flagged))
        whole = b"".join(texts)
        rid, key = batch.column("rid").to_pylist(), batch.column("key").to_pylist()
        rows: list[tuple] = []
        if len(seen) > MEMO_ROWS:
            seen.clear()
        for k in chosen.tolist():
            a, first, last, own = int(at[k]), int(lo[k]), int(hi[k]), int(owner[k])
            start = int(starts[own])
            body = whole[first : last + LENGTH]
            digest = xxhash.xxh3_128_digest(body + (a - first).to_bytes(2, "little"))
            here = (rid[own], key[own], first - start, last + LENGTH - start)
            met = seen.get(digest)
            if met is None:
                seen[digest] = here
                rows.append((here[0], here[1], here[2], a - first, last - first + 1, here[3], body))
                continue
            rows.append((*here[:3], None, None, here[3], None))
            if met[0] is not None:  # the first one, as yet unreported
                rows.append((*met[:3], None, None, met[3], None))
                seen[digest] = (None, 0, 0, 0)
        columns = list(zip(*rows, strict=True)) if rows else [()] * 7
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["rid", "key", "lo", "at", "n", "end", "body"])


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Sorting order of byte strings of one length (a multiple of 8) by multikey quicksort.

    The key of a step is the next 8 bytes; only strings that are still tied are
    sorted on, each within its own tie.
    """
    words = rows.view(">u8").astype(_U)
    order = np.argsort(words[:, 0], kind="stable")
    tie = np.zeros(len(rows), np.int64)  # start of the tie that a sorted place belongs to
    open_ = np.arange(len(rows))
    for depth in range(words.shape[1]):
        if depth:
            inner = np.lexsort((words[order[open_], depth], tie[open_]))
            order[open_] = order[open_][inner]
        value, group = words[order[open_], depth], tie[open_]
        new = np.append(True, (value[1:] != value[:-1]) | (group[1:] != group[:-1]))
        begin = open_[new]
        tie[open_] = begin[np.cumsum(new) - 1]
        size = np.diff(np.append(np.flatnonzero(new), len(open_)))
        open_ = open_[np.repeat(size > 1, size)]
        if not len(open_):
            break
    return order


def common_prefixes(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each row shares with the one sorted before it; -1 for the first."""
    differ = rows[order[1:]] != rows[order[:-1]]
    length = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return np.append(-1, length)


def _classes(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(rows, lengths): number of the class of rows that agree in so many leading bytes."""
    order = multikey_order(rows)
    shared = common_prefixes(rows, order)
    out = np.empty((len(rows), len(lengths)), np.int32)
    out[order] = np.cumsum(shared[:, None] < lengths[None, :], axis=0, dtype=np.int32)
    return out


def repeated_spans(
    at: np.ndarray, n: np.ndarray, bodies: list[bytes], first: np.ndarray | int = 0, last: np.ndarray | int = SPAN - 1
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of suffixes with all others of their keys: which have repeats, and the first and last offset before the anchor.

    Only offsets from ``first`` to ``last`` are looked at; suffixes of one key have the same.
    """
    width = SPAN + 7 & ~7
    after = np.frombuffer(b"".join(b[k : k + LENGTH].ljust(LENGTH, b"\0") for b, k in zip(bodies, at.tolist(), strict=True)), np.uint8).reshape(-1, LENGTH)
    before = np.frombuffer(b"".join(b[:k][::-1].ljust(width, b"\0") for b, k in zip(bodies, at.tolist(), strict=True)), np.uint8).reshape(-1, width)
    offsets = np.arange(SPAN)
    valid = (offsets[None] <= at[:, None]) & (offsets[None] > (at - n)[:, None])
    valid &= (offsets[None] >= np.reshape(first, (-1, 1))) & (offsets[None] <= np.reshape(last, (-1, 1)))
    row, offset = np.nonzero(valid)
    key = _classes(after, LENGTH - offsets)[row, offset].astype(_U) * _U(len(at) + 1) + _classes(before, offsets)[row, offset].astype(_U)
    key = key * _U(256) + offset.astype(_U)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    hit = np.zeros(len(key), bool)
    hit[order[1:]] |= same
    hit[order[:-1]] |= same
    row, offset = row[hit], offset[hit]  # rows ascend, and offsets within a row
    new = np.append(True, row[1:] != row[:-1]) if len(row) else np.empty(0, bool)
    return row[new], offset[new], offset[np.append(new[1:], True)] if len(row) else offset


def _bucket_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Works off a bucket, sorted by lead, in runs of whole leads."""
    held: list[pa.Table] = []

    def flush(table: pa.Table) -> pa.RecordBatch:
        at, n = table.column("at").to_numpy().astype(np.int64), table.column("n").to_numpy().astype(np.int64)
        first, last = table.column("first").to_numpy(), table.column("last").to_numpy()
        rows, low, high = repeated_spans(at, n, table.column("body").to_pylist(), first, last)
        anchor = table.column("lo").to_numpy().astype(np.int64) + at
        rid, key = table.column("rid").to_numpy(), table.column("key").to_numpy()
        return pa.RecordBatch.from_arrays(
            [pa.array(rid[rows]), pa.array(key[rows]), pa.array((anchor[rows] - high).astype(np.int32)), pa.array((anchor[rows] - low + LENGTH).astype(np.int32))],
            names=["rid", "key", "lo", "end"],
        )

    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in held) < BUCKET_ROWS:
            continue
        table = pa.concat_tables(held).combine_chunks()
        lead = table.column("lead")
        changes = np.flatnonzero(pc.not_equal(lead[1:], lead[:-1]).to_numpy()) + 1
        if not len(changes):
            held = [table]
            continue
        cut = int(changes[-1])
        yield flush(table.slice(0, cut).combine_chunks())
        held = [table.slice(cut)]
    if held:
        table = pa.concat_tables(held).combine_chunks()
        if table.num_rows:
            yield flush(table)


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The maximal runs that spans cover; spans that touch are one run."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _remove_batches(kept: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            rows = []
            for text, spans in zip(_texts(batch), batch.column("spans").to_pylist(), strict=True):
                runs = merge_spans([(s["lo"], s["end"]) for s in spans or ()])
                pieces, at = [], 0
                for a, b in runs:
                    pieces.append(text[at:a])
                    at = b
                rest = b"".join([*pieces, text[at:]])
                rows.append((len(text), len(text) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)][: 5 if kept else 4]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: len(arrays) + 1])

    return run


def repeated_passages(rows: DataFrame) -> DataFrame:
    """``rid, key, lo, end``: byte spans of repeats, from ``rid, key, text`` (binary)."""
    # Written out, so that anchors are found once here, and that the join reads two plain exchanges, which adaptive execution can split at a hot lead.
    leads = materialize(rows.select("rid", "text").mapInArrow(lean(_lead_batches), "rid long, place int, lead long"))
    twice = materialize(leads.groupBy("lead").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("lead"))
    places = leads.join(twice, "lead").groupBy("rid").agg(F.collect_list("place").alias("places"))
    suffixes = materialize(rows.join(places, "rid").select("rid", "key", "text", "places").mapInArrow(lean(_suffix_batches), _SUFFIXES))
    found = suffixes.where("body is null").select("rid", "key", "lo", "end")
    # The key of a suffix: what all its strings with ``first`` to ``last`` bytes before the anchor share, and which these are.
    shared = F.expr(f"concat(substring(body, at + 1, {LENGTH} - last), substring(body, at - first + 1, first), unhex(format_string('%02x%02x', first, last)))")
    apart = suffixes.where("body is not null").select("rid", "key", "lo", "at", "n", "body", F.lit(0).alias("first"), F.lit(SPAN - 1).alias("last"))
    buckets = None
    while True:
        keyed = apart.withColumn("lead", shared).withColumn("hash", F.xxhash64("lead"))
        large = materialize(keyed.groupBy("hash").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > BUCKET_LIMIT).select("hash"))
        small = keyed.join(large, "hash", "left_anti").drop("hash")
        buckets = small if buckets is None else buckets.union(small)
        if large.isEmpty():
            break
        over = keyed.join(large, "hash", "left_semi")
        whole = over.where("first = last")
        again = whole.groupBy("lead").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("lead")
        equal = whole.join(again, "lead", "left_semi")
        found = found.union(equal.select("rid", "key", (F.col("lo") + F.col("at") - F.col("first")).alias("lo"), (F.col("lo") + F.col("at") - F.col("first") + LENGTH).alias("end")))
        middle = F.expr("(first + last) div 2").cast("int")
        halves = F.array(F.struct(F.col("first").alias("first"), middle.alias("last")), F.struct((middle + 1).alias("first"), F.col("last").alias("last")))
        split = over.where("first < last").withColumn("half", F.explode(halves)).select("rid", "key", "lo", "at", "n", "body", "half.first", "half.last")
        apart = materialize(split.where("at >= first and at - n + 1 <= last"))
    dealt = buckets.select("lead", "rid", "key", "lo", "at", "n", "first", "last", "body").repartitionByRange("lead").sortWithinPartitions("lead")
    return found.union(dealt.mapInArrow(_bucket_batches, _SPANS))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", kept: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row, and the ``kept`` bytes if asked for.

    Rows are known by key and a hash of key and text, so that no scan depends
    on the order of another.  A null key is told apart by a value of its own.
    """
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    rows = source.withColumn("rid", F.xxhash64("doc_id", "text")).withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 62))))
    spans = repeated_passages(rows.select("rid", "key", "text"))
    spans = materialize(spans.groupBy("rid", "key").agg(F.collect_list(F.struct("lo", "end")).alias("spans")))
    joined = rows.join(spans, ["rid", "key"], "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(_remove_batches(kept), schema + ", kept binary" * kept)
