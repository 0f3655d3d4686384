"""Structure repair of conversations at the least cost, by cost layers.

A conversation is its rows by turn.  Its repaired form has the role initials
``(s?(ua)+)?``.  Rows can be kept (cost 0), given the role user or assistant
(1) or deleted (2, required for blank rows and duplicates), and turns without
text can be inserted (5); a truncated row that is not deleted adds 5.  The
audit is the initial of every edit in order, and of the cheapest repairs the
one with the smallest audit is taken.

Layers: for cost 0, 1, 2, ... a bitset for every place between rows holds the
grammar states from which the rest can be repaired at exactly that cost.  A
layer needs only those 1 to 6 below it.  The first layer that holds the start
state at the first place gives the cost; following set bits from there, always
by the smallest letter whose bit is set, gives the audit.  Long conversations
are worked off in blocks of rows from the last to the first, each block's layers
starting from the four costs at its end, so that work and memory are linear.

On Spark: first appearances of a text are found on digests, and later ones
marked.  Rows are dealt by range of conversation and turn, so that a conversation
that holds a third of all rows is many partitions; texts are shuffled once.  A
conversation that lies inside one partition is repaired where it is read.  Those
that a border cuts, and those with more rows or bytes than a task should hold,
go on as rows: their codes (a byte for each row, as long as their audit will be)
are gathered by conversation, and their texts then stream past the finished
audit.  The digest of a repaired conversation is by definition sequential over it.

Defined results: null roles and texts are one space; a null turn comes first and
counts for no gap; rows without conv_id are one conversation.  Rows of one turn
are ordered by role, then by the SHA-256 of their text; equal rows are duplicates
after the first.  A conversation without rows has no faults, no cost, an empty
audit and the digest of nothing.  Very long texts are passed whole; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, materialize

KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 1, 2, 5, 5
#: Faults of a row, in the low bits of its code; above them the initial of its role: s, u, a or another one.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Grammar states: nothing yet, after the system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Rows of a block of layers, and of a conversation that is kept in a task until it ends; bytes of the latter.
BLOCK, HELD_ROWS, HELD_BYTES = 16, 5_000, 4 << 20
#: Rows and bytes of a batch that a task gives.
OUT_ROWS, OUT_BYTES = 2_000, 1 << 20

#: State after a turn with each initial (None: not in the grammar).
_STEP = ((SYSTEM, None, None, None), (USER, USER, None, USER), (None, None, ASSISTANT, None), (None,) * 4)
_TURN = tuple(_STEP[2][q] if _STEP[2][q] is not None else _STEP[1][q] for q in range(4))  # after a user or assistant turn, whichever fits
_BEFORE = tuple(bytes(sum(1 << q for q in range(4) if step[q] is not None and states >> step[q] & 1) for states in range(16)) for step in (*_STEP, _TURN))
_LEGAL = {(0, 1), (1, 2), (2, 1)}

#: Least cost and audit of what must follow the last row, by state.
_TAIL = ((0, ""), (2 * INSERT_COST, "II"), (INSERT_COST, "I"), (0, ""))

Batches = Iterator[pa.RecordBatch]


def cost_layers(codes: bytes, ends: tuple[int, ...]) -> list[bytearray]:
    """Layers of cost 0, 1, ... until the first place of some layer has held every state.

    ``layers[cost][place]`` is the bitset of states from which the rows from
    ``place`` on can be repaired at that cost, ``ends`` being the cost by state
    after the last one.
    """
    n, missing = len(codes), 15
    layers: list[bytearray] = []
    before_turn = _BEFORE[4]
    nothing = bytearray(n + 1)
    while missing:
        cost = len(layers)
        layer = bytearray(n + 1)
        below = lambda by: layers[cost - by] if cost >= by else nothing  # noqa: B023, E731
        deleted, inserted = below(DELETE_COST), below(INSERT_COST)
        kept = (layer, below(TRUNCATED_COST))
        reroled = (below(REROLE_COST), below(REROLE_COST + TRUNCATED_COST))
        layer[n] = sum(1 << q for q in range(4) if ends[q] == cost)
        for i in range(n - 1, -1, -1):
            states, fault = deleted[i + 1] | before_turn[inserted[i]], codes[i] & 3
            if fault == SOUND or fault == TRUNCATED:
                late = fault == TRUNCATED
                states |= _BEFORE[codes[i] >> 2][kept[late][i + 1]] | before_turn[reroled[late][i + 1]]
            layer[i] = states
        layers.append(layer)
        missing &= ~layer[0]
    return layers


def _costs(layers: list[bytearray]) -> tuple[int, ...]:
    return tuple(next(c for c, layer in enumerate(layers) if layer[0] >> q & 1) for q in range(4))


def trace(codes: bytes, layers: list[bytearray], state: int, cost: int) -> tuple[str, int, int]:
    """The smallest audit over the rows of a block from a state and its cost, and the state and cost after it."""
    out, i = [], 0
    held = lambda by, place, q: q is not None and cost >= by and layers[cost - by][place] >> q & 1
    while i < len(codes):
        late = TRUNCATED_COST * (codes[i] & 3 == TRUNCATED)
        if held(DELETE_COST, i + 1, state):
            letter, by, i = "D", DELETE_COST, i + 1
        elif held(INSERT_COST, i, _TURN[state]):
            letter, by, state = "I", INSERT_COST, _TURN[state]
        elif held(KEEP_COST + late, i + 1, _STEP[codes[i] >> 2][state]) and codes[i] & 3 not in (BLANK, DUPLICATE):
            letter, by, state, i = "K", KEEP_COST + late, _STEP[codes[i] >> 2][state], i + 1
        else:
            letter, by, state, i = "R", REROLE_COST + late, _TURN[state], i + 1
        out.append(letter)
        cost -= by
    return "".join(out), state, cost


def _blocks_repaired(codes: bytes) -> tuple[int, str]:
    blocks = [codes[at : at + BLOCK] for at in range(0, len(codes), BLOCK)]
    ends, base = [tuple(c for c, _ in _TAIL)], [0]
    for block in reversed(blocks):
        costs = _costs(cost_layers(block, ends[-1]))
        base.append(base[-1] + min(costs))
        ends.append(tuple(c - min(costs) for c in costs))
    total = base[-1] + ends[-1][START]
    audit, state, cost = [], START, ends[-1][START]
    for k, block in enumerate(blocks):
        # What the block and all after it cost above the blocks after it at their best.
        after = len(blocks) - k - 1
        part, state, cost = trace(block, cost_layers(block, ends[after]), state, cost + base[after + 1] - base[after])
        audit.append(part)
    return total, "".join(audit) + _TAIL[state][1]


_short = lru_cache(maxsize=1 << 16)(_blocks_repaired)


def least_repair(codes: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a conversation with these codes."""
    return _short(codes) if len(codes) <= BLOCK else _blocks_repaired(codes)


class Reading:
    """What is known of a conversation whose rows come in order."""

    def __init__(self) -> None:
        self.codes = bytearray()
        self.first = self.last = None
        self.distinct = 0

    def add(self, turn: int | None, code: int) -> None:
        self.codes.append(code)
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.distinct = turn, self.distinct + 1

    def summary(self) -> dict:
        codes = bytes(self.codes)
        cost, audit = least_repair(codes)
        faults = [c & 3 for c in codes]
        initials = [c >> 2 for c in codes]
        return {
            "gaps": 0 if self.first is None else self.last - self.first + 1 - self.distinct,
            "blank": faults.count(BLANK),
            "duplicate": faults.count(DUPLICATE),
            "truncated": faults.count(TRUNCATED),
            "illegal": sum(pair not in _LEGAL for pair in zip(initials, initials[1:], strict=False)),
            "cost": cost,
            "audit": audit,
        }


class Repairing:
    """Applies an audit to rows that come in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.position = audit, 0, START, 0
        self.digest = hashlib.sha256()

    def _turn(self, edit: str, role: str, text: str) -> tuple[int, str, str, str]:
        self.digest.update(("\n" * (self.position > 0) + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.position += 1
        return self.position, edit, role, text

    def _fitting(self) -> str:
        self.state = _TURN[self.state]
        return "user" if self.state == USER else "assistant"

    def inserted(self) -> Iterator[tuple[int, str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._turn("I", self._fitting(), "")

    def row(self, code: int, role: str, text: str) -> Iterator[tuple[int, str, str, str]]:
        """The repaired turns up to this row."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            yield self._turn("R", self._fitting(), text)
        elif edit == "K":
            self.state = _STEP[code >> 2][self.state]
            yield self._turn("K", role, text)


_SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
#: kind 0: a conversation's result; 1: a repaired turn; 2: a row that goes on; 3: a row of code -1 names its conversation only.
_SCHEMA = f"conv_id long, kind int, turn long, code int, position long, edit string, role string, text string, {_SUMMARY}, repaired_sha256 string"
_KINDS = [
    ("conv_id", pa.int64()), ("kind", pa.int32()), ("turn", pa.int64()), ("code", pa.int32()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()),
    *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string()),
]
_RESULT, _TURN_ROW, _ON = range(3)


class _Out:
    """Rows of the schema above, given as batches of bounded size."""

    def __init__(self) -> None:
        self.rows, self.bytes = [], 0

    def add(self, **row: object) -> None:
        self.rows.append(row)
        self.bytes += len(row.get("text") or "") + len(row.get("audit") or "")

    def batches(self, last: bool = False) -> Batches:
        if self.rows and (last or len(self.rows) >= OUT_ROWS or self.bytes >= OUT_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in self.rows], t) for c, t in _KINDS], names=[c for c, _ in _KINDS])
            self.rows, self.bytes = [], 0


def _rows(batches: Batches, *columns: str) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, OUT_ROWS):
            part = batch.slice(at, OUT_ROWS)
            yield from zip(*(part.column(c).to_pylist() for c in columns), strict=True)


def _read_batches(turns: bool) -> Callable[[Batches], Batches]:
    """Codes rows that are sorted by conversation; repairs the conversations that are whole here."""

    def run(batches: Batches) -> Batches:
        out = _Out()
        held: list[tuple] = []
        size, on, at, before = 0, True, object(), None  # on: this conversation's rows go on

        def pass_on(row: tuple) -> None:
            out.add(conv_id=at, kind=_ON, turn=row[0], code=row[1], role=row[2], text=row[3])

        def repaired() -> None:
            reading = Reading()
            for turn, code, _, _ in held:
                if code >= 0:
                    reading.add(turn, code)
            summary = reading.summary()
            repairing = Repairing(summary["audit"])
            done = [t for _, code, role, text in held if code >= 0 for t in repairing.row(code, role, text)] + list(repairing.inserted())
            for position, edit, role, text in done if turns else ():
                out.add(conv_id=at, kind=_TURN_ROW, position=position, edit=edit, role=role, text=text)
            out.add(conv_id=at, kind=_RESULT, repaired_sha256=repairing.digest.hexdigest(), **summary)

        for conv_id, turn, role, digest, mark, code, text in _rows(batches, "conv_id", "turn", "role", "digest", "mark", "code", "text"):
            if conv_id != at:
                if not on:
                    repaired()
                held, size, on, before = [], 0, not isinstance(at, int | None), None
                at = conv_id
            same = (turn, role, digest)
            if mark == 0:  # the text came before, in another turn
                before = same
                continue
            if code >= 0:
                if same == before and code & 3 != BLANK:
                    code = code & ~3 | DUPLICATE
                before = same
            row = (turn, code, role, text)
            if not on:
                held.append(row)
                size += len(text or "")
                if len(held) > HELD_ROWS or size > HELD_BYTES:
                    on, row = True, None
                    for row in held:
                        pass_on(row)
                        yield from out.batches()
                    held = []
            else:
                pass_on(row)
            yield from out.batches()
        for row in held:  # it may go on in the next partition
            pass_on(row)
        yield from out.batches(last=True)

    return run


def _summary_batches(batches: Batches) -> Batches:
    """The audit of every conversation whose rows' codes come in order."""
    out, at, reading = _Out(), None, None
    for conv_id, turn, code in _rows(batches, "conv_id", "turn", "code"):
        if reading is None or conv_id != at:
            if reading is not None:
                out.add(conv_id=at, kind=_RESULT, **reading.summary())
                yield from out.batches()
            at, reading = conv_id, Reading()
        if code >= 0:
            reading.add(turn, code)
    if reading is not None:
        out.add(conv_id=at, kind=_RESULT, **reading.summary())
    yield from out.batches(last=True)


def _apply_batches(turns: bool) -> Callable[[Batches], Batches]:
    """Streams the rows of conversations past their audits, which come first."""
    summary = tuple(c for c, _ in _KINDS[8:15])

    def run(batches: Batches) -> Batches:
        out, at, repairing, known = _Out(), None, None, {}

        def turned(parts: Iterator[tuple[int, str, str, str]]) -> None:
            for position, edit, role, text in parts:
                if turns:
                    out.add(conv_id=at, kind=_TURN_ROW, position=position, edit=edit, role=role, text=text)

        def finish() -> None:
            turned(repairing.inserted())
            out.add(conv_id=at, kind=_RESULT, repaired_sha256=repairing.digest.hexdigest(), **known)

        for conv_id, kind, code, role, text, *values in _rows(batches, "conv_id", "kind", "code", "role", "text", *summary):
            if kind == _RESULT:
                if repairing is not None:
                    finish()
                at, known = conv_id, dict(zip(summary, values, strict=True))
                repairing = Repairing(known["audit"])
            elif code >= 0:
                turned(repairing.row(code, role, text))
            yield from out.batches()
        if repairing is not None:
            finish()
        yield from out.batches(last=True)

    return run


def _repaired(rows: DataFrame, gone: Column | None, conv: str, turn: str, role: str, text: str, turns: bool) -> DataFrame:
    blank_free = F.lit(" ")
    lost = F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))
    rows = rows.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.when(~lost, F.col(turn).cast("long")).alias("turn"),
        F.when(~lost, F.coalesce(F.col(role).cast("string"), blank_free)).alias("role"),
        F.when(~lost, F.coalesce(F.col(text).cast("string"), blank_free)).alias("text"),
        lost.alias("gone"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    known = rows.where(~F.col("gone")).select("conv_id", "role", "digest", "turn", F.struct(F.col("turn").isNotNull().alias("known"), "turn").alias("when"))
    again = known.groupBy("conv_id", "role", "digest").agg(F.min("when").alias("first"), F.max("when").alias("last")).where(F.col("first") < F.col("last"))
    again = again.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    later = known.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))).where(F.col("when") > F.col("first"))
    marks = later.select("conv_id", "turn", "role", "digest").distinct()

    initial = F.substring("role", 1, 1)
    which = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED).otherwise(SOUND)
    coded = rows.select("conv_id", "turn", "role", "digest", F.lit(1).alias("mark"), F.when(F.col("gone"), -1).otherwise(which * 4 + fault).cast("int").alias("code"), "text")
    marked = marks.select("conv_id", "turn", "role", "digest", F.lit(0).alias("mark"), F.lit(0).cast("int").alias("code"), F.lit(None).cast("string").alias("text"))
    order = ("conv_id", "turn", "role", "digest")
    dealt = coded.union(marked).repartitionByRange(*order).sortWithinPartitions(*order, "mark")
    # Ids rise from partition to partition and are fixed by being written.
    read = materialize(dealt.mapInArrow(lean(_read_batches(turns)), _SCHEMA).withColumn("place", F.monotonically_increasing_id()))
    cut = read.where(F.col("kind") == _ON)
    by_place = lambda df: df.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    audits = by_place(cut.select("conv_id", "place", "turn", "code")).mapInArrow(lean(_summary_batches), _SCHEMA)
    streamed = audits.withColumn("place", F.lit(-1).cast("long")).union(cut)
    applied = by_place(streamed).mapInArrow(lean(_apply_batches(turns)), _SCHEMA)
    return read.where(F.col("kind") != _ON).drop("place").union(applied)


def repair_summaries(
    rows: DataFrame, gone: Column | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """A row for each conversation: its faults, the cost and audit of its cheapest repair, and the digest of what that gives.

    Where ``gone`` holds, a row only tells that its conversation exists.
    """
    names = [c for c, _ in _KINDS[8:]]
    return _repaired(rows, gone, conv, turn, role, text, False).select("conv_id", *names)


def repaired_turns(
    rows: DataFrame, gone: Column | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The repaired conversations: ``conv_id, position`` (from 1), ``edit`` (K, R or I), ``role, text``."""
    return _repaired(rows, gone, conv, turn, role, text, True).where(F.col("kind") == _TURN_ROW).select("conv_id", "position", "edit", "role", "text")
