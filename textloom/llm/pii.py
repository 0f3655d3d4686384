"""Personal data by fixed patterns and a linear-chain conditional random field.

The patterns give the base spans.  The field labels tokens by their word shape
and the shapes of the two tokens before and the one after, and adds spans that
the patterns cannot give: telephone numbers without a country sign, account
and identity numbers, keys and passwords.  ``fit_field`` trains it on a small
labelled table (tokens and a label for each); ``labelled_table`` is one of
sentences labelled by hand and of templates with invented fillers.

A token without an ASCII digit or an @ is outside every span, in training and
in decoding alike (so the field finds no names; there is no labelled text here
that could teach them).  Given that, the chain falls apart at such tokens, and
Viterbi over runs of the other tokens, each with the plain tokens around it,
labels a text as Viterbi over the whole text would.  All runs of a batch are
decoded at once in numpy.

Defined results: a null text is empty and has no spans; very long texts are
scanned whole; repeated rows are scanned row by row; an empty table gives an
empty result; other columns are not read unless asked for in ``keys``, and
these come back as they are, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import pii_sentences
from .common import lean, slices

Span = tuple[int, int, int]  # start, kind, end

KINDS = ("email", "ip", "card", "phone", "secret", "account")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    """Whether the check digit holds."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches; only stretches around an @ are searched, so long texts stay linear."""
    at, end = text.find("@"), 0
    while at >= 0:
        first = at
        while first > end and (text[first - 1] in _LOCAL):
            first -= 1
        m = EMAIL.match(text, first) if first < at else None
        if m:
            yield m.span()
            end = m.end()
        at = text.find("@", max(at + 1, end))


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def base_spans(text: str) -> list[Span]:
    """Pattern spans, ordered by start and then kind."""
    out: list[Span] = []
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if re.search("[0-9]", text):
        for m in IP.finditer(text):
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if 12 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# ---------------------------------------------------------------- the field

LABELS = ("O", *KINDS)
_TOKEN = re.compile(r"\S+")
_RUNS = re.compile(r"[a-z]+|[A-Z]+|[0-9]+|\s+|[^A-Za-z0-9\s]")
_HEX = re.compile(r"\W*(?:[0-9a-f]{16,}|[0-9A-F]{16,})\W*")
_CODE = re.compile(r"\W*[A-Z]{2}[0-9]{2}[A-Z0-9]{10,30}\W*")
_MIXED = re.compile(r"\W*[A-Za-z0-9_-]{14,}\W*")
_CUES = frozenset(
    "token key secret password passwd pwd pass pin otp phone tel call mobile fax telefon portable nummer llama appelez mail email card account acct iban ssn nino passport "
    "insurance licence license tax dni ip host commit md5 sha1 sha256 checksum hash revision git uuid".split()
)
_TRIGGER = re.compile(r"[0-9@]+")
UNKNOWN, EDGE, WORD = 0, 1, 2


def shape(token: str) -> str:
    """The word shape: runs become x, X, d with a coarse length; a few cue words keep their name."""
    bare = token.strip(".,;:!?()[]'\"=*$#%&|").lower()
    if bare in _CUES:
        return "cue:" + bare
    if not _TRIGGER.search(token):
        return "word" if any(c.isalpha() for c in token) else "punct:" + token[:2]
    if bare.isascii() and bare.isdigit() and 12 <= len(bare) <= 19:
        return "number:luhn" if luhn(bare) else "number:other"
    if len(token) >= 14:
        if _HEX.fullmatch(token):
            return "hex"
        if _CODE.fullmatch(token):
            return "code"
        if _MIXED.fullmatch(token) and re.search("[A-Za-z]{3}", token):
            return "mixed"
    out = []
    for run in _RUNS.findall(token):
        if run[0].isdigit():
            out.append("d%d" % min(len(run), 5))
        else:
            out.append("x" if run[0].islower() else "X" if run[0].isupper() else run[0] if run[0] in "@.+-()/:=#*,\"'" else "s")
    return "".join(out)


@dataclass(frozen=True)
class Field:
    """Weights of a trained field: emissions per shape at four positions, and transitions."""

    shapes: dict[str, int]
    emit: np.ndarray  # (4, n_shapes, n_labels): two before, one before, own, next
    step: np.ndarray  # (n_labels, n_labels)
    start: np.ndarray

    @property
    def plain(self) -> np.ndarray:
        """Shapes of tokens that are outside every span."""
        names = sorted(self.shapes, key=self.shapes.__getitem__)
        return np.array([n == "word" or n.startswith(("punct:", "cue:")) for n in names])

    def index(self, tokens: list[str]) -> list[int]:
        shapes = [shape(t) for t in tokens]
        unseen = [UNKNOWN if _TRIGGER.search(t) else WORD for t in tokens]
        return [self.shapes.get(s, u) for s, u in zip(shapes, unseen, strict=True)]

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """(batch, length + 3) shape ids, two edges before and one behind -> (batch, length, labels)."""
        return sum(self.emit[k][ids[:, k : ids.shape[1] - 3 + k]] for k in range(4))


def viterbi(field: Field, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best labels of a padded batch: ``ids`` (batch, longest + 3), edges included."""
    scores = field.scores(ids)
    scores[field.plain[ids[:, 2:-1]], 1:] = -1e9
    batch, longest, _ = scores.shape
    best = scores[:, 0] + field.start
    back = np.zeros((batch, longest, len(LABELS)), np.int8)
    final = np.where((lengths == 1)[:, None], best, 0.0)
    for t in range(1, longest):
        options = best[:, :, None] + field.step[None]
        back[:, t] = options.argmax(1)
        best = options.max(1) + scores[:, t]
        final = np.where((lengths == t + 1)[:, None], best, final)
    labels = np.zeros((batch, longest), np.int8)
    here = final.argmax(1)
    for t in range(longest - 1, -1, -1):
        active = lengths > t
        labels[active, t] = here[active]
        previous = back[np.arange(batch), t, here]
        here = np.where(active, previous, here)
    return labels


def pad(sequences: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in sequences], np.int64)
    ids = np.full((len(sequences), int(lengths.max(initial=1)) + 3), EDGE, np.int64)
    for k, s in enumerate(sequences):
        ids[k, 2 : len(s) + 2] = s
    return ids, lengths


def training_rows(rows: int = 900, seed: int = 7) -> list[tuple[list[str], list[int]]]:
    """The small labelled table: token sequences and their labels, made from templates.

    The fillers are invented, so the table holds nobody's data.
    """
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    digits = lambda n: "".join(str(int(d)) for d in rng.integers(0, 10, n))
    syllables = ("ba", "co", "du", "fel", "gor", "hin", "jat", "kel", "lom", "mir", "nes", "pol", "rud", "sa", "tor", "vin", "the", "re")
    word = lambda: "".join(pick(syllables) for _ in range(int(rng.integers(1, 4))))

    letters = lambda xs, n: "".join(pick(xs) for _ in range(n))
    lower, upper, hexes = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"

    def filler() -> tuple[list[str], int]:
        kind = int(rng.integers(0, 25))
        if kind == 0:
            return [f"{word()}.{digits(2)}@{word()}{digits(1)}.example.com"], 1
        if kind == 1:
            return [f"{word()}@{word()}.{pick(['com', 'org', 'net'])}"], 1
        if kind == 2:
            return [".".join(str(int(x)) for x in rng.integers(0, 256, 4))], 2
        if kind == 3:
            body = digits(int(rng.integers(11, 19)))
            check = next(d for d in "0123456789" if luhn(body + d))
            return ([body + check], 3) if rng.random() < 0.5 else ([body + str((int(check) + 1 + int(rng.integers(9))) % 10)], 0)
        if kind == 4:
            return [digits(3) for _ in range(int(rng.integers(1, 4)))], 0
        if kind == 5:
            return ["+1", f"({digits(3)})", f"{digits(3)}-{digits(4)}"], 4
        if kind == 6:
            return [f"({digits(3)})", f"{digits(3)}-{digits(4)}"], 4
        if kind == 7:
            return [f"{digits(3)}-{digits(3)}-{digits(4)}"], 4
        if kind == 8:
            return [f"+{digits(2)}", digits(3), digits(3), digits(4)], 4
        if kind in (9, 10):
            return ['"' + "".join(pick("0123456789abcdef") for _ in range(int(rng.integers(32, 41)))) + '"'], 5
        if kind == 11:
            return ["".join(pick("0123456789abcdef") for _ in range(int(rng.integers(24, 65))))], 5
        if kind == 12:
            return [pick(["2.0.", "2.0", "3.5", "1.0", "10.2"])], 0
        if kind == 13:
            return [digits(int(rng.integers(1, 8)))], 0
        if kind == 14:
            return [f"{digits(2)}/{digits(2)}/{digits(4)}", f"{digits(2)}:{digits(2)}"], 0
        if kind == 15:
            return [f"{word()}{digits(int(rng.integers(1, 4)))}", f"v{digits(1)}.{digits(1)}"], 0
        if kind == 16:
            return [letters(hexes.upper(), int(rng.integers(24, 41)))], 5
        if kind == 17:
            return [letters(upper, 4) + letters(upper + "0123456789" * 2, 12) + digits(1) + letters(upper, 3)], 5
        if kind == 18:
            return [pick(["sk-", "pk_", "ghp_", ""]) + letters(lower + upper, 6) + digits(2) + letters(lower + upper + "0123456789", int(rng.integers(10, 30)))], 5
        if kind == 19:
            return [pick(["DE", "FR", "ES", "GB"]) + digits(2) + pick(["", letters(upper, 4)]) + digits(int(rng.integers(12, 19)))], 6
        if kind == 20:
            return [f"{digits(3)}-{digits(2)}-{digits(4)}"], 6
        if kind == 21:
            return ["cue:phone", *pick([[digits(3), digits(4), digits(4)], [digits(5), digits(6)], [digits(3), digits(3), digits(4)], [digits(10)]])], 4
        if kind == 22:
            return ["cue:password", letters(lower, int(rng.integers(4, 9))) + digits(int(rng.integers(1, 5)))], 5
        if kind == 23:
            return [f"{word().capitalize()}{digits(1)}", letters(upper, 2) + digits(2), f"{digits(2)}th"], 0
        return [f"{digits(4)}-{digits(2)}-{digits(2)}", f"{digits(2)}%", f"{digits(3)},{digits(3)}"], 0

    cues = {"cue:phone": ("tel", "phone", "call", "mobile", "fax"), "cue:password": ("password", "passwd", "pwd")}
    table = []
    for _ in range(rows):
        tokens, labels = [], []
        for _ in range(int(rng.integers(1, 4))):
            plain = [word() for _ in range(int(rng.integers(1, 6)))]
            if rng.random() < 0.3:
                plain[-1] += pick([".", ",", "!!", "***", "$$$", ":"])
            inner, label = filler()
            if inner[0] in cues:
                plain += [pick(cues[inner.pop(0)]) + pick(["", ":"])] + pick([[], ["="]]) * (label == 5)
            elif label == 5 and rng.random() < 0.7:
                plain += [pick(["token", "key", "secret", "password"]), "="]
            tail = pick(["", "", ".", ",", "!!"])
            inner = [*inner[:-1], inner[-1] + tail]
            tokens += plain + inner
            labels += [0] * len(plain) + [label] * len(inner)
        ending = [word() for _ in range(int(rng.integers(0, 4)))]
        table.append((tokens + ending, labels + [0] * len(ending)))
    return table


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def train(table: list[tuple[list[str], list[int]]], steps: int = 120, rate: float = 0.2, decay: float = 1e-3) -> Field:
    """Fits the field by full-batch Adam on the penalised log-likelihood (forward-backward in numpy)."""
    shapes: dict[str, int] = {"?": UNKNOWN, "^": EDGE, "word": WORD}
    for tokens, _ in table:
        for t in tokens:
            shapes.setdefault(shape(t), len(shapes))
    n = len(LABELS)
    ids, lengths = pad([[shapes[shape(t)] for t in tokens] for tokens, _ in table])
    batch, longest = len(table), ids.shape[1] - 3
    gold = np.zeros((batch, longest), np.int64)
    for k, (_, labels) in enumerate(table):
        gold[k, : len(labels)] = labels
    mask = np.arange(longest)[None] < lengths[:, None]
    truth = np.eye(n)[gold] * mask[:, :, None]
    moves = truth[:, :-1, :, None] * truth[:, 1:, None, :]
    params = [np.zeros((4, len(shapes), n)), np.zeros((n, n)), np.zeros(n)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    places = [ids[:, k : longest + k] for k in range(4)]
    for step in range(1, steps + 1):
        emit, trans, start = params
        scores = sum(emit[w][places[w]] for w in range(4)) * mask[:, :, None]
        ahead = np.zeros((batch, longest, n))
        ahead[:, 0] = scores[:, 0] + start
        for t in range(1, longest):
            new = _log_sum(ahead[:, t - 1, :, None] + trans[None], 1) + scores[:, t]
            ahead[:, t] = np.where(mask[:, t, None], new, ahead[:, t - 1])
        behind = np.zeros((batch, longest, n))
        for t in range(longest - 2, -1, -1):
            new = _log_sum(trans[None] + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(mask[:, t + 1, None], new, 0.0)
        total = _log_sum(ahead[:, -1], 1)
        chance = np.exp(ahead + behind - total[:, None, None]) * mask[:, :, None]
        pair = np.exp(ahead[:, :-1, :, None] + trans[None, None] + (scores + behind)[:, 1:, None, :] - total[:, None, None, None])
        pair *= mask[:, 1:, None, None]
        error = (truth - chance) / batch
        slopes = [np.zeros_like(p) for p in params]
        for w in range(4):
            np.add.at(slopes[0][w], places[w], error)
        slopes[1] = (moves - pair).sum((0, 1)) / batch
        slopes[2] = error[:, 0].sum(0)
        for k, p in enumerate(params):
            g = slopes[k] - decay * p
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            params[k] = p + rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return Field(shapes, *params)


@lru_cache(maxsize=1)
def default_field() -> Field:
    """The field fitted to the templates' table, deterministically."""
    return train([(tokens, [LABELS.index(k) for k in labels]) for tokens, labels in labelled_rows()])


#: Columns of a labelled table: tokens, and for each the name of its kind or ``O``.
LABELLED = "tokens array<string>, labels array<string>"


#: How often a sentence labelled by hand counts beside the rows of the templates.
HAND_WEIGHT = 4


def labelled_rows(rows: int = 900, seed: int = 7) -> list[tuple[list[str], list[str]]]:
    """The rows that the templates make, and the sentences labelled by hand."""
    made = [(tokens, [LABELS[k] for k in labels]) for tokens, labels in training_rows(rows, seed)]
    return made + HAND_WEIGHT * pii_sentences.rows()


def labelled_table(spark: SparkSession, rows: int = 900, seed: int = 7) -> DataFrame:
    """The labelled table of the library: templates and sentences labelled by hand."""
    return spark.createDataFrame(labelled_rows(rows, seed), LABELLED)


def fit_field(labelled: DataFrame, max_rows: int = 5000, **options: float) -> Field:
    """Fits a field to ``tokens`` and ``labels`` of at most ``max_rows`` rows, chosen by hash.

    Rows that are null, or whose arrays differ in length, are left out; a label
    that is no kind is an error.
    """
    sound = labelled.where(F.size("tokens") == F.size("labels")).where(F.size("tokens") > 0).select("tokens", "labels")
    chosen = sound.orderBy(F.xxhash64("tokens", "labels"), "tokens", "labels").limit(max_rows).collect()
    return train([([t or "" for t in r["tokens"]], [LABELS.index(x) for x in r["labels"]]) for r in chosen], **options)


def windows(text: str) -> list[tuple[int, list[tuple[int, int]]]]:
    """Offsets of each run of tokens with a digit or an @, with the two tokens before it and the one behind, and how many of it are before.

    The token before a run is plain, so whatever the one before that is labelled here does not reach the run.
    """
    size, runs, leads = len(text), [], []
    done = 0
    for m in _TRIGGER.finditer(text):
        a, b = m.span()
        if a < done:
            continue
        while a > done and not text[a - 1].isspace():
            a -= 1
        while b < size and not text[b].isspace():
            b += 1
        if runs and text[done:a].isspace():
            runs[-1].append((a, b))
        else:
            runs.append([(a, b)])
        done = b
    for run in runs:
        lead = 0
        for _ in range(2):
            b = run[0][0]
            while b and text[b - 1].isspace():
                b -= 1
            a = b
            while a and not text[a - 1].isspace():
                a -= 1
            if a < b:
                run.insert(0, (a, b))
                lead += 1
        leads.append(lead)
        a = run[-1][1]
        while a < size and text[a].isspace():
            a += 1
        b = a
        while b < size and not text[b].isspace():
            b += 1
        if a < b:
            run.append((a, b))
    return list(zip(leads, runs, strict=True))


#: Tokens, padding included, that Viterbi decodes at once (one longer window goes alone), and bytes of text that are scanned at once.
BATCH_TOKENS, SCAN_BYTES = 8192, 1 << 20

_EDGES = ".,;:!?()[]'\"*$#%&|"


def _stripped(text: str, a: int, b: int) -> tuple[int, int]:
    """A span without its outer punctuation and white space."""
    while a < b and (text[a].isspace() or text[a] in _EDGES and text[a] != "("):
        a += 1
    while b > a and (text[b - 1].isspace() or text[b - 1] in _EDGES):
        b -= 1
    return a, b


def field_spans(field: Field, texts: list[str]) -> list[list[Span]]:
    """Spans that the field finds in each text: runs of one label, outer punctuation stripped."""
    owners, spans, rows, leads = [], [], [], []
    for k, text in enumerate(texts):
        for lead, window in windows(text) if text else ():
            owners.append(k)
            leads.append(lead)
            spans.append(window)
            rows.append(field.index([text[a:b] for a, b in window]))
    found: list[list[Span]] = [[] for _ in texts]
    order = sorted(range(len(rows)), key=lambda i: len(rows[i]))
    at = 0
    while at < len(order):  # windows of like length together, as many as fill a batch when padded to the longest
        to = at + 1
        while to < len(order) and len(rows[order[to]]) * (to + 1 - at) <= BATCH_TOKENS:
            to += 1
        part, at = order[at:to], to
        ids, lengths = pad([rows[i] for i in part])
        for i, labels in zip(part, viterbi(field, ids, lengths), strict=True):
            if not labels.any():
                continue
            text, window = texts[owners[i]], spans[i]
            k = leads[i]
            while k < len(window):
                j = k + 1
                while j < len(window) and labels[j] == labels[k]:
                    j += 1
                if labels[k]:
                    a, b = _stripped(text, window[k][0], window[j - 1][1])
                    if b > a:
                        found[owners[i]].append((a, int(labels[k]) - 1, b))
                k = j
    return found


def add_spans(base: list[Span], more: list[Span], text: str) -> list[Span]:
    """The base spans, and what they leave of ``more`` (which are in order and overlap nowhere).

    A part that is left needs a digit or an @, as tokens do; parts of a secret may be letters only.
    """
    out, at = list(base), 0
    covered: list[tuple[int, int]] = []
    for a, _, b in sorted(base):
        if covered and a <= covered[-1][1]:
            covered[-1] = (covered[-1][0], max(b, covered[-1][1]))
        else:
            covered.append((a, b))
    for a, kind, b in sorted(more):
        while at < len(covered) and covered[at][1] <= a:
            at += 1
        k, parts = at, []
        while k < len(covered) and covered[k][0] < b:
            parts.append((a, covered[k][0]))
            a = covered[k][1]
            k += 1
        if not parts:
            out.append((a, kind, b))
            continue
        for low, high in [*parts, (a, b)]:
            low, high = _stripped(text, low, high)
            part = text[low:high]
            if _TRIGGER.search(part) or (KINDS[kind] == "secret" and any(c.isalnum() for c in part)):
                out.append((low, kind, high))
    return sorted(out)


def show(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
SPAN_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("base", T.BooleanType()),
        ]
    )
)


def scan(texts: list[str | None], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    plain = [t or "" for t in texts]
    base = [base_spans(t) for t in plain]
    return [(b, add_spans(b, m, t)) for b, m, t in zip(base, field_spans(field, plain), plain, strict=True)]


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans merge."""
    out, at = [], 0
    for a, k, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"<{KINDS[k]}>"]
        at = b
    return "".join([*out, text[at:]])


def _scan_batches(field: Field, redacted: bool, chunk: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, ("__text",), chunk):
                *rest, texts = part.columns
                values = texts.to_pylist()
                rows = scan(values, field)
                fixed = [set(base) for base, _ in rows]
                spans = [[{"kind": KINDS[k], "start": a, "end": b, "base": (a, k, b) in known} for a, k, b in every] for known, (_, every) in zip(fixed, rows, strict=True)]
                more = [pa.array(spans, _SPANS)]
                if redacted:
                    more.append(pa.array([None if t is None else redact(t, s) for t, (_, s) in zip(values, rows, strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays([*rest, *more], names=[*batch.schema.names[:-1], "spans", "redacted"][: len(rest) + len(more)])

    return run


def find_personal_data(
    docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",), field: Field | None = None, redacted: bool = False, chunk: int = SCAN_BYTES
) -> DataFrame:
    """``keys``, ``spans`` array<struct<kind,start,end,base>> and, if asked for, the ``redacted`` text.

    ``field`` is a trained field; without one the default is fitted, on the driver, to the
    labelled table above.  It is a few thousand numbers and travels with the tasks.
    """
    source = docs.select(*[F.col(f"`{k}`") for k in keys], F.col(text).cast("string").alias("__text"))
    fields = [source.schema[i] for i in range(len(keys))] + [T.StructField("spans", SPAN_TYPE, False)]
    if redacted:
        fields.append(T.StructField("redacted", T.StringType(), True))
    return source.mapInArrow(lean(_scan_batches(field or default_field(), redacted, chunk)), T.StructType(fields))
