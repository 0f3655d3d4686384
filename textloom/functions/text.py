"""Scalar text functions as column expressions: cleaning, patterns, hashes, formats.

Patterns say (?U) or (?u) where Unicode classes matter and (?d) where only a
line feed ends a line, so that they mean the same as in other engines.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

#: Fixed value: all characters that count as Unicode white space.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _col(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body reads it.

    Inside a lambda an outer expression would be computed anew for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


# ------------------------------------------------------------ white space


def strip(text: ColumnOrName) -> Column:
    """Unicode white space off both ends."""
    return F.btrim(_col(text), F.lit(WHITE))


def normalize_whitespace(text: ColumnOrName) -> Column:
    """Carriage returns dropped, no-break spaces and tabs as spaces, both ends stripped."""
    return strip(F.translate(_col(text), " \t\r", "  "))


def squeeze(text: ColumnOrName) -> Column:
    """Normalised white space, runs of spaces as one."""
    return F.regexp_replace(normalize_whitespace(text), " {2,}", " ")


def lines(text: ColumnOrName) -> Column:
    """Lines of a text, split at line feeds."""
    return F.split(_col(text), "\n")


def normalize_ellipsis(text: ColumnOrName) -> Column:
    """Ellipsis characters and dot runs as three dots."""
    dots = F.regexp_replace(_col(text), "…", "...")
    dots = F.regexp_replace(dots, r"(?U)\.\.\.(?:\s*\.\.\.)+", "...")
    return F.regexp_replace(dots, r"\.{4,}", "...")


def slugify(text: ColumnOrName) -> Column:
    """Lower-case ASCII letters and digits joined by hyphens."""
    joined = F.regexp_replace(F.lower(_col(text)), "[^a-z0-9]+", "-")
    return F.regexp_replace(joined, "^-+|-+$", "")


def parse_range(text: ColumnOrName) -> Column:
    """``first-last`` as a struct; null where it is no range or runs backwards."""
    pattern = r"(?U)\A\s*(\d{1,9})-(\d{1,9})\s*\z"
    low = F.regexp_extract(_col(text), pattern, 1).try_cast("int")
    high = F.regexp_extract(_col(text), pattern, 2).try_cast("int")
    return F.when(low <= high, F.struct(low.alias("low"), high.alias("high")))


# ------------------------------------------------------------ titles

#: Fixed value: page counters at the end of a title, e.g. "(2/3)" or "（第2/3页）".
PAGE_SUFFIX = r"^(.+?)\s*[（(](?:第)?\d+/\d+(?:页|頁)?[）)]\s*$"


def has_page_suffix(title: ColumnOrName) -> Column:
    return normalize_whitespace(title).rlike(PAGE_SUFFIX)


def strip_page_suffix(title: ColumnOrName) -> Column:
    """The title without a page counter at its end."""
    clean = normalize_whitespace(title)
    return F.when(clean.rlike(PAGE_SUFFIX), F.rtrim(F.regexp_extract(clean, PAGE_SUFFIX, 1), F.lit(WHITE))).otherwise(clean)


def heading_number(title: ColumnOrName, patterns: Sequence[str]) -> Column:
    """The number that the first matching pattern finds in its first group; null without one."""
    found = [F.nullif(F.regexp_extract(_col(title), p, 1), F.lit("")) for p in patterns]
    return F.coalesce(*found).try_cast("int")


# ------------------------------------------------------------ residue of a script


def script_residue(text: ColumnOrName, chars: str) -> Column:
    """Characters of a class that are left in a text, as a struct: count, runs, distinct runs in order."""
    runs = F.regexp_extract_all(_col(text), F.lit(f"([{chars}]+)"), F.lit(1))
    return F.struct(
        F.regexp_count(_col(text), F.lit(f"[{chars}]")).cast("int").alias("n_chars"),
        F.size(runs).alias("n_runs"),
        F.array_distinct(F.transform(runs, F.lower)).alias("distinct_runs"),
    )


# ------------------------------------------------------------ rewriting


def ordered_replace(text: ColumnOrName, pairs: Column) -> Column:
    """Literal replacements applied one after the other; ``pairs`` is an array of struct(src, dst) in order."""
    return F.aggregate(pairs, _col(text), lambda acc, p: F.when(p["src"] == "", acc).otherwise(F.replace(acc, p["src"], p["dst"])))


def rule_rewrite(text: ColumnOrName, rules: Sequence[tuple[str, str]]) -> Column:
    """Regular-expression rules applied in order (Java patterns, lookaround allowed)."""
    out = _col(text)
    for pattern, replacement in rules:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def per_line(text: ColumnOrName, rules: Sequence[tuple[str, str]]) -> Column:
    """Rules applied to each line on its own, and lines that become empty dropped."""
    done = F.transform(lines(text), lambda line: strip(rule_rewrite(line, rules)))
    return F.array_join(F.filter(done, lambda line: line != ""), "\n")


def strip_invalid_chars(text: ColumnOrName, allowed: str) -> Column:
    """Only the characters of the class ``allowed``, and line feeds, stay."""
    return F.regexp_replace(_col(text), f"[^{allowed}\n]", "")


def split_camel(text: ColumnOrName) -> Column:
    """A space where a lower-case letter meets an upper-case one, in words of letters that start upper-case, but for Mc names."""
    text = _col(text)
    glued = lambda w: w.rlike(r"^\p{Lu}") & ~w.rlike(r"^Mc\p{Lu}")
    cut = lambda w: F.when(glued(w), F.regexp_replace(w, r"(?<=\p{Ll})(?=\p{Lu})", " ")).otherwise(w)
    words = F.regexp_extract_all(text, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.when(text.rlike(r"\p{Ll}\p{Lu}"), F.array_join(F.transform(words, cut), "")).otherwise(text)


def settled(text: ColumnOrName, step: Callable[[Column], Column], most: Column) -> Column:
    """``step`` applied until it changes nothing; ``most`` bounds the number of changes.

    A step that is no longer needed is not computed, so the bound costs little.
    """
    start = F.struct(_col(text).alias("text"), F.lit(False).alias("done"))
    once = lambda acc: let(step(acc["text"]), lambda new: F.struct(new.alias("text"), (new == acc["text"]).alias("done")))
    return F.aggregate(F.sequence(F.lit(0), most), start, lambda acc, _: F.when(acc["done"], acc).otherwise(once(acc)), lambda acc: acc["text"])


#: Fixed value: the letters of words that may follow themselves.
LETTERS = "A-Za-zÀ-Ỵà-ỹĐđ"


def collapse_repeats(text: ColumnOrName, kept: Sequence[str] = ()) -> Column:
    """A word that follows itself after blanks is dropped, as often as it does, but for the words in ``kept``."""
    stays = f"(?!(?:{'|'.join(kept)})\\b)" if kept else ""
    return F.regexp_replace(_col(text), rf"(?iuU)\b{stays}([{LETTERS}]+)\b(?:[ \t]+\1\b)+", "$1")


def collapse_phrases(text: ColumnOrName, longest: int = 6) -> Column:
    """Phrases of 2 to ``longest`` words that follow themselves, collapsed to one until none does."""

    def once(t: Column) -> Column:
        # Where all letters are word characters no word ends inside a run of them, so none of a run is given back.
        plain, exact = (
            rf"(?iuU)\b({word}(?:[ \t]+{word}){{1,{longest - 1}}})\b[ \t]+\1\b" for word in (f"[{LETTERS}]++", f"[{LETTERS}]+")
        )
        odd = t.rlike(rf"(?U)[{LETTERS}&&[^\w]]")
        return F.when(odd, F.regexp_replace(t, exact, "$1")).otherwise(F.regexp_replace(t, plain, "$1"))

    return settled(text, once, F.regexp_count(_col(text), F.lit(r"[ \t]+")))


def template(pattern: str, **values: ColumnOrName) -> Column:
    """``{name}`` places of a pattern filled from columns, each place once."""
    out = F.lit(pattern)
    for name, value in values.items():
        out = F.replace(out, F.lit("{%s}" % name), _col(value).cast("string"))
    return out


# ------------------------------------------------------------ hashes and codes


def content_hash(text: ColumnOrName) -> Column:
    """SHA-256 of a text whose line ends are line feeds, lines right-stripped and whole stripped."""
    plain = F.replace(F.replace(_col(text), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.sha2(strip(F.regexp_replace(plain, r"(?U)[\s&&[^\n]]+(?=\n)", "")), 256)


def merged_hash(parameters: Column, hashes: Column) -> Column:
    """One key of parameters and of child hashes in their order."""
    return F.sha2(F.concat_ws("\n", parameters, F.array_join(hashes, "\n")), 256)


def key_token(key: ColumnOrName) -> Column:
    """Name of a secret that does not give it away; empty for an empty key."""
    clean = strip(key)
    return F.when(clean == "", "").otherwise(F.concat(F.lit("key_"), F.substring(F.sha2(clean, 256), 1, 16)))


def encode_job_id(novel: ColumnOrName, file: ColumnOrName, number: ColumnOrName) -> Column:
    return F.format_string("%s::%s::%04d", _col(novel), _col(file), _col(number).cast("int"))


def decode_job_id(job_id: ColumnOrName) -> Column:
    """The three parts of a job id; null where it has not three, or no number."""
    parts = F.split(_col(job_id), "::", 3)
    number = F.get(parts, F.lit(2)).try_cast("int")
    return F.when((F.size(parts) == 3) & number.isNotNull(), F.struct(parts[0].alias("novel"), parts[1].alias("file"), number.alias("number")))


# ------------------------------------------------------------ numbers


def format_countdown(seconds: ColumnOrName) -> Column:
    """``47s``, ``3m:0s``; from over three minutes on without seconds; empty for null or nothing left."""
    total = F.ceil(_col(seconds)).cast("long")
    hours, minutes, rest = F.floor(total / 3600), F.floor(total / 60) % 60, total % 60
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    h, m, s = (x.cast("long").cast("string") for x in (hours, minutes, rest))
    coarse = F.when(hours > 0, text(h, "h:", m, "m")).otherwise(text(m, "m"))
    fine = F.when(minutes > 0, text(m, "m:", s, "s")).otherwise(text(s, "s"))
    return F.when(total.isNull() | (total <= 0), "").when(total > 180, coarse).otherwise(fine)


def jitter(index: ColumnOrName, most: float) -> Column:
    """A steady offset for each index, spread over [0, most)."""
    return ((_col(index) * 9973) % 1000) / F.lit(1000.0) * F.lit(float(most))


def backoff(attempt: ColumnOrName, first: float = 3.0, most: float = 60.0) -> Column:
    """first, doubled at every attempt after the first, at most ``most``."""
    n = F.greatest(F.least(_col(attempt), F.lit(6)), F.lit(1))
    return F.least(F.lit(most), F.lit(first) * F.pow(F.lit(2.0), n - 1))


def estimate_tokens(text: ColumnOrName, han: str = "\\u4e00-\\u9fff", reserve: bool = False) -> Column:
    """Tokens of a text by its length: 2.0, 2.6 or 4.0 characters each by share of Han characters, and 5 % more.

    ``reserve`` adds room for an answer as long as the text, 256 tokens at least.
    """
    size = F.length(_col(text))
    share = F.regexp_count(_col(text), F.lit(f"[{han}]")) / F.greatest(size, F.lit(1))
    per = F.when(share >= 0.12, 2.0).when(share >= 0.03, 2.6).otherwise(4.0)
    base = F.greatest(F.ceil(size / per), F.lit(1))
    whole = base + F.greatest(F.lit(256), base) if reserve else base
    return F.when(size == 0, F.lit(1)).otherwise(F.ceil(whole * 1.05)).cast("long")


def estimate_queue_tokens(text: ColumnOrName) -> Column:
    """The coarse estimate of a queue: four characters a token and 10 % more."""
    size = F.length(_col(text))
    return F.when(size == 0, F.lit(1)).otherwise(F.ceil(F.ceil(size / 4.0) * 1.10)).cast("long")
