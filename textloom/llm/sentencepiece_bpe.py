"""SentencePiece merge-type encoding by backtracking, and decoding.

A text is cut into atoms that no piece crosses: a word with the space before
it, a line break, or a word without one.  Within an atom an Aho-Corasick
automaton gives the pieces that match at each position; the longest is taken
if it is compatible with the piece before it, which is tested by merging the
two again, and positions from which no encoding exists are marked in a
bitfield, so every position is left at most once per candidate.  Only pieces
whose own merge gives back themselves take part, and the sequence in which all
neighbours are compatible is the one that merging yields.

Defined results: a null or empty text gives the end id alone and decodes to
the empty string; very long texts and words are encoded whole; repeated rows
are encoded row by row; an empty table gives an empty result; other columns
are carried along untouched, except one that bears the name of an output
column, which the output replaces.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean

SPACE = "▁"
#: Atoms, and pairs of neighbours, that a worker remembers, and the longest atom among them.
MEMO_ENTRIES, MEMO_PAIRS = 250_000, 400_000
MEMO_CHARS = 40
_ATOMS = re.compile(r"▁[^▁\n]*|\n|[^▁\n]+")


class PieceModel:
    """A merge-type SentencePiece vocabulary with an encoder and a decoder.

    The library is used only to read the pieces and their scores.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.eos = sp.eos_id()
        self.unk = sp.unk_id()
        self.control = {i for i in range(size) if sp.is_control(i)}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        skip = self.control | set(self.bytes.values()) | {self.unk}
        self.rank = {p: (-sp.get_score(i), i) for i, p in enumerate(self.pieces) if i not in skip and not sp.is_unused(i)}
        crossing = [p for p in self.rank if SPACE in p.lstrip(SPACE)]
        if crossing:
            raise ValueError(f"pieces cross word starts, e.g. {crossing[0]!r}")
        #: Runs of spaces have pieces of their own, which must be the last to be merged.
        self.one = self.rank[SPACE][1]
        last = max((s for p, (s, _) in self.rank.items() if p.strip(SPACE)), default=0.0)
        if any(s <= last for p, (s, _) in self.rank.items() if len(p) > 1 and not p.strip(SPACE)):
            raise ValueError("runs of spaces must be merged last")
        self.runs: dict[int, list[int]] = {0: []}
        self.matcher = ahocorasick.Automaton()
        self.stable: set[int] = set()
        for p, (_, i) in self.rank.items():
            if (len(p) == 1 or p.strip(SPACE)) and self.merge(p) == [i]:
                self.matcher.add_word(p, (i, len(p)))
                self.stable.add(i)
        self.matcher.make_automaton()
        self.chars = {p for p in self.rank if len(p) == 1}
        #: Neighbouring characters that stand together in a piece; no piece crosses any others.
        self.joined = {a + b for i in self.stable for a, b in pairwise(self.pieces[i])}
        self.pairs: dict[int, bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.text = [self._text(i) for i in range(size)]

    def _text(self, i: int) -> str | bytes:
        if i in self.control:
            return ""
        if self.pieces[i].startswith("<0x") and i in self.bytes.values():
            return bytes([int(self.pieces[i][3:5], 16)])
        return " ⁇ " if i == self.unk else self.pieces[i].replace(SPACE, " ")

    def merge(self, text: str) -> list[int]:
        """Plain merging: best-ranked adjacent pair first, leftmost among equals."""
        rank, parts = self.rank, list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap = [(*rank[p], k, p) for k in range(len(parts) - 1) if (p := parts[k] + parts[k + 1]) in rank]
        heap = [(s, k, p) for s, _, k, p in heap]
        heapify(heap)
        end = len(parts)
        while heap:
            _, k, p = heappop(heap)
            nxt = after[k]
            if parts[k] is None or nxt >= end or parts[nxt] is None or parts[k] + parts[nxt] != p:
                continue
            parts[k], parts[nxt] = p, None
            after[k] = after[nxt]
            if after[k] < end:
                before[after[k]] = k
                if (q := p + parts[after[k]]) in rank:
                    heappush(heap, (rank[q][0], k, q))
            if before[k] >= 0 and (q := parts[before[k]] + p) in rank:
                heappush(heap, (rank[q][0], before[k], q))
        return [rank[p][1] if p in rank else self.unk for p in parts if p is not None]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two pieces' text again gives the two pieces."""
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.merge(self.pieces[left] + self.pieces[right]) == [left, right]
        return known

    def _known(self, text: str) -> list[int]:
        """Encodes a text whose characters all have pieces, by backtracking."""
        size = len(text)
        found: list[list[tuple[int, int]] | None] = [None] * size
        for end, match in self.matcher.iter(text):
            start = end - match[1] + 1
            if found[start] is None:
                found[start] = [match]  # shorter ones come first
            else:
                found[start].append(match)
        pairs, failed = self.pairs, None
        out: list[int] = []
        trail: list[tuple[int, int]] = []
        at, options, before = 0, len(found[0]), -1
        while True:
            options -= 1
            if options < 0:
                failed = failed or bytearray(size // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                at, options = trail.pop()
                out.pop()
                before = out[-1] if out else -1
                continue
            piece, length = found[at][options]
            if failed and failed[at + length >> 3] >> (at + length & 7) & 1:
                continue
            if before >= 0:
                fits = pairs.get(before << 20 | piece)
                if not (self.compatible(before, piece) if fits is None else fits):
                    continue
            out.append(piece)
            if at + length == size:
                return out
            trail.append((at, options))
            before = piece
            at += length
            options = len(found[at])

    def encode_atom(self, atom: str) -> tuple[int, ...]:
        """Ids of an atom, cut where no piece can cross; characters without a piece become bytes."""
        cuts = [k for k, two in enumerate(map("".join, pairwise(atom)), 1) if two not in self.joined]
        if not cuts:
            return self._whole(atom)
        memo, out, at = self.memo, [], 0
        for cut in [*cuts, len(atom)]:
            part = atom[at:cut]
            ids = memo.get(part)
            if ids is None:
                ids = self._whole(part)
                if len(part) <= MEMO_CHARS:
                    memo[part] = ids
            out.extend(ids)
            at = cut
        return tuple(out)

    def _whole(self, part: str) -> tuple[int, ...]:
        if len(part) == 1 and part not in self.chars:
            return tuple(self.bytes.get(b, self.unk) for b in part.encode()) if self.bytes else (self.unk,)
        return tuple(self._known(part))

    def _remember(self, atoms: list[str]) -> None:
        memo = self.memo
        for atom in set(atoms).difference(memo):
            memo[atom] = self.encode_atom(atom)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text, the end id last."""
        if not text:
            return [self.eos]
        text = SPACE + text.replace(" ", SPACE)
        atoms = _ATOMS.findall(text)
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        self._remember(atoms)
        if SPACE * 2 in text or SPACE + "\n" in text or text.endswith(SPACE):
            out = self._with_runs(atoms)
        else:
            out = list(chain.from_iterable(map(self.memo.__getitem__, atoms)))
        for atom in {a for a in atoms if len(a) > MEMO_CHARS}:
            del self.memo[atom]
        out.append(self.eos)
        return out

    def _with_runs(self, atoms: list[str]) -> list[int]:
        out: list[int] = []
        one, run = self.one, 0
        for atom in atoms:
            ids = self.memo[atom]
            if ids[0] == one:  # a space that did not merge with its word joins the run before it
                run += 1
                ids = ids[1:]
            if ids:
                out += self._run(run)
                run = 0
                out.extend(ids)
        return out + self._run(run)

    def _run(self, size: int) -> list[int]:
        known = self.runs.get(size)
        if known is None:
            known = self.merge(SPACE * size)
            if size <= 1000:
                self.runs[size] = known
        return known

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """Text of ids: byte pieces form UTF-8, one space in front is the dummy prefix."""
        parts = list(map(self.text.__getitem__, ids))
        try:
            text = "".join(parts)
        except TypeError:
            text = self._join_bytes(parts)
        first = next((i for i in ids if i not in self.control), self.eos)
        return text[1:] if self.pieces[first].startswith(SPACE) else text

    @staticmethod
    def _join_bytes(parts: list[str | bytes]) -> str:
        out: list[str] = []
        held = bytearray()
        for p in parts:
            if isinstance(p, bytes):
                held += p
                continue
            if held:
                out.append(_utf8(held))
                held = bytearray()
            out.append(p)
        return "".join(out) + (_utf8(held) if held else "")


def _utf8(raw: bytes | bytearray) -> str:
    """UTF-8, each byte that is not part of a character becoming U+FFFD."""
    try:
        return bytes(raw).decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for size in (1, 2, 3, 4):
                try:
                    out.append(bytes(raw[at : at + size]).decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


_models: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """The model at ``path``, read once in each worker."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def _batches(
    convert: Callable[[PieceModel, pa.Array], pa.Array], path: str, name: str, chunk: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                *rest, values = batch.slice(at, chunk).columns
                yield pa.RecordBatch.from_arrays([*rest, convert(model, values)], names=[*batch.schema.names[:-1], name])

    return run


def _encode_array(model: PieceModel, texts: pa.Array) -> pa.Array:
    rows = [np.array(model.encode(t), np.int32) for t in texts.to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int32), *rows]), pa.int32()))


def _decode_array(model: PieceModel, ids: pa.Array) -> pa.Array:
    flat, offsets = ids.flatten().to_numpy(zero_copy_only=False).tolist(), ids.offsets.to_pylist()
    first = offsets[0] if offsets else 0
    return pa.array([model.decode(flat[a - first : b - first]) for a, b in zip(offsets, offsets[1:], strict=False)], pa.string())


def _coded_batches(path: str, chunk: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                *rest, texts = batch.slice(at, chunk).columns
                ids = _encode_array(model, texts)
                yield pa.RecordBatch.from_arrays([*rest, ids, _decode_array(model, ids)], names=[*batch.schema.names[:-1], "ids", "decoded"])

    return run


def encode_and_decode(docs: DataFrame, model: str, text: str = "text", keys: tuple[str, ...] = ("doc_id",), chunk: int = 200) -> DataFrame:
    """``keys``, ``ids`` and the text that these decode to (``decoded``), in one pass: one model for each task."""
    source = docs.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`").cast("string").alias("__value"))
    fields = [source.schema[i] for i in range(len(keys))]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False), T.StructField("decoded", T.StringType(), False)]
    return source.mapInArrow(lean(_coded_batches(model, chunk)), T.StructType(fields))


def _apply(docs: DataFrame, column: str, cast: str, out: T.StructField, convert, path: str, chunk: int) -> DataFrame:
    rest = [c for c in docs.columns if c not in (out.name,)]
    source = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{column}`").cast(cast).alias("__value"))
    fields = [source.schema[i] for i in range(len(rest))] + [out]
    return source.mapInArrow(_batches(convert, path, out.name, chunk), T.StructType(fields))


def encode_documents(docs: DataFrame, model: str, text: str = "text", ids: str = "ids", chunk: int = 200) -> DataFrame:
    """Adds ``ids`` array<int>: the pieces of the whole text and the end id."""
    return _apply(docs, text, "string", T.StructField(ids, T.ArrayType(T.IntegerType(), False), False), _encode_array, model, chunk)


def decode_documents(encoded: DataFrame, model: str, ids: str = "ids", text: str = "decoded", chunk: int = 200) -> DataFrame:
    """Adds ``decoded`` string: the text of ``ids``; a null array decodes to the empty string."""
    filled = encoded.withColumn(ids, F.coalesce(F.col(ids), F.array().cast("array<int>")))
    return _apply(filled, ids, "array<int>", T.StructField(text, T.StringType(), False), _decode_array, model, chunk)
