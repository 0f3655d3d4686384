"""Pages: links, directories, text, successors and blocks.

Documents are parsed with the standard library's parser inside Arrow batches;
ranking, grouping and filtering of what it finds are DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from textloom.functions.text import heading_number, normalize_whitespace
from textloom.operators.drift import numbers_to_ids

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_SKIPPED = frozenset(("script", "style", "noscript", "template"))
_BLOCKS = frozenset("p div br li h1 h2 h3 h4 h5 h6 tr article section header footer nav ul ol table blockquote".split())


class _Reader(HTMLParser):
    """Collects links with their text, meta properties, and the text of each candidate container."""

    def __init__(self, containers: tuple[str, ...]):
        super().__init__(convert_charrefs=True)
        self.containers = containers
        self.links: list[list[str]] = []
        self.meta: dict[str, str] = {}
        self.candidates: list[tuple[str, list[str]]] = []
        self.open: list[tuple[str, int | None]] = []
        self.skip = 0
        self.link: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        found = {k: v or "" for k, v in attrs}
        if tag == "meta" and (name := found.get("property") or found.get("name")):
            self.meta[name] = found.get("content", "")
        if tag in _BLOCKS:
            self._say("\n")
        if tag in _VOID:
            return
        self.skip += tag in _SKIPPED
        if tag == "a" and "href" in found:
            self.link = [found["href"], ""]
            self.links.append(self.link)
        names = {tag, *(f".{c}" for c in found.get("class", "").split()), f"#{found.get('id', '')}"}
        mine = next((c for c in self.containers if c in names), None)
        if mine:
            self.candidates.append((mine, []))
        self.open.append((tag, len(self.candidates) - 1 if mine else None))

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCKS:
            self._say("\n")
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.skip -= sum(t in _SKIPPED for t, _ in self.open[k:])
                del self.open[k:]
                break
        if tag == "a":
            self.link = None

    def handle_data(self, data: str) -> None:
        if self.link is not None and not self.skip:
            self.link[1] += data
        self._say(data)

    def _say(self, data: str) -> None:
        if not self.skip:
            for _, k in self.open:
                if k is not None:
                    self.candidates[k][1].append(data)


def _read(html: str | None, containers: tuple[str, ...] = ()) -> _Reader:
    reader = _Reader(containers)
    reader.feed(html or "")
    reader.close()
    return reader


def _with_fields(keys: DataFrame, **fields: T.DataType) -> T.StructType:
    return T.StructType([*keys.schema.fields, *(T.StructField(name, kind) for name, kind in fields.items())])


def _beside(batch: pa.RecordBatch, n_keys: int, rows: Sequence[int], schema: T.StructType, values: Sequence[Sequence]) -> pa.RecordBatch:
    """The keys of some of a batch's rows (repeats allowed), and values found for each."""
    take = pa.array(rows, pa.int64())
    more = [pa.array(v, to_arrow_type(f.dataType)) for v, f in zip(values, schema.fields[n_keys:], strict=True)]
    return pa.RecordBatch.from_arrays([*[c.take(take) for c in batch.columns[:n_keys]], *more], names=schema.names)


#: Bytes of pages that are Python objects at once; a longer page goes alone.
PARSED_BYTES = 1 << 20


def _pieces(batches: Iterator[pa.RecordBatch], html: str) -> Iterator[pa.RecordBatch]:
    """Batches cut into pieces of about PARSED_BYTES of pages, so that what is found in a batch is never held all at once."""
    for batch in batches:
        first = size = 0
        for i, n in enumerate(pc.binary_length(batch.column(html)).to_pylist(), 1):
            size += n or 0
            if size >= PARSED_BYTES or i == batch.num_rows:
                yield batch.slice(first, i - first)
                first, size = i, 0


def page_links(pages: DataFrame, keys: tuple[str, ...], url: str = "url", html: str = "html") -> DataFrame:
    """``keys, pos, href, link, text`` of every link; ``link`` is absolute."""
    source = pages.select(*keys, F.col(url).alias("__url"), F.col(html).alias("__html"))
    schema = _with_fields(source.select(*keys), pos=T.IntegerType(), href=T.StringType(), link=T.StringType(), text=T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, "__html"):
            owner, pos, href, link, text = [], [], [], [], []
            for i, (base, page) in enumerate(zip(batch.column("__url").to_pylist(), batch.column("__html").to_pylist(), strict=True)):
                for k, (there, said) in enumerate(_read(page).links):
                    owner.append(i), pos.append(k), href.append(there), link.append(urljoin(base or "", there)), text.append(" ".join(said.split()))
            yield _beside(batch, len(keys), owner, schema, [pos, href, link, text])

    return source.mapInArrow(run, schema)


#: Rules of sites, a row for each: ``site``; patterns whose first group is the entry's number in the link's text (``text_number``) or,
#: tried after it, in its address (``address_number``); one that the address has to match; and one for the number of its part.
SITE_RULES = "site string, text_number string, address_number string, address string, part string"


def site_of(url: Column | str) -> Column:
    """The last two labels of an address's host, in lower case."""
    host = F.lower(F.regexp_extract(F.col(url) if isinstance(url, str) else url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)


def directory_entries(links: DataFrame, rules: DataFrame, keys: tuple[str, ...], site: Column | None = None) -> DataFrame:
    """Entries ``keys, number, title, link, part`` of links ``keys, pos, link, text``, each by the rules of its site.

    Rules are joined by site and their patterns are columns, so links of any
    number of sites are one plan.  Of links with one number the last counts, or
    where the site numbers parts the lowest part.  Links of sites without rules,
    and those without a number, are no entries.
    """
    first = lambda text, pattern: F.when(F.col(pattern) != "", F.nullif(F.call_function("regexp_extract", F.col(text), F.col(pattern), F.lit(1)), F.lit(""))).try_cast("int")
    found = links.withColumn("__site", site_of("link") if site is None else site).join(rules, F.col("__site") == F.col("site"))
    found = found.where((F.coalesce("address", F.lit("")) == "") | F.rlike("link", F.col("address")))
    number = F.coalesce(first("text", "text_number"), first("link", "address_number"))
    found = found.select(*keys, "pos", "text", "link", number.alias("number"), first("link", "part").alias("part")).where("number is not null")
    place = F.row_number().over(Window.partitionBy(*keys, "number").orderBy(F.asc_nulls_first("part"), F.desc("pos")))
    return found.withColumn("place", place).where("place = 1").select(*keys, "number", F.col("text").alias("title"), "link", "part")


def numbered_directory(latest: DataFrame, last: str, pattern: str, keys: tuple[str, ...]) -> DataFrame:
    """Entries 1 to ``last`` with an address made from a pattern with %d."""
    rows = latest.where(F.col(last) >= 1).select(*keys, F.explode(F.sequence(F.lit(1), F.col(last))).alias("number"))
    return rows.withColumn("link", F.format_string(pattern, F.col("number")))


# How titles give their number, tried in this order.
NUMBERED_TITLES = (r"(?i)(?:chapter|chuong|ch(?:\.|apter)?)[^\d]{0,8}(\d+)", r"第\s*(\d+)\s*章", r"\b(\d{1,5})\b")


def json_directory(
    payloads: DataFrame, keys: tuple[str, ...], payload: str = "payload", base: str = "base_url", segments: DataFrame | None = None, block: int = 0
) -> DataFrame:
    """Entries of a ``{"list": [title, ...]}`` payload: ``keys, number, title, link``.

    A title without a number counts by its place; of repeated numbers the last
    entry counts.  Where ids drift from numbers, ``segments`` (``keys, start,
    diff``, see ``operators.drift``) gives the id that goes into the link.
    """
    rows = payloads.select(*keys, F.col(base).alias("base"), F.from_json(payload, "list array<string>")["list"].alias("titles"))
    rows = rows.select(*keys, "base", F.posexplode_outer("titles").alias("pos", "title")).where("pos is not null")
    title = normalize_whitespace(F.coalesce("title", F.lit("")))
    number = F.coalesce(heading_number(title, NUMBERED_TITLES), F.col("pos") + 1).alias("number")
    last = rows.select(*keys, "base", "pos", number, title.alias("title")).groupBy(*keys, "number").agg(F.max_by(F.struct("base", "title"), "pos").alias("e"))
    entries = last.select(*keys, "number", F.when(F.col("e.title") == "", F.format_string("第%d章", "number")).otherwise(F.col("e.title")).alias("title"), F.col("e.base").alias("base"))
    placed = numbers_to_ids(entries, segments, keys, block=block) if segments is not None else entries.withColumn("id", F.col("number"))
    return placed.select(*keys, "number", "title", F.concat("base", F.lit("&chapterid="), F.col("id").cast("string")).alias("link"))


@dataclass(frozen=True)
class PageLayout:
    """Containers of a page's title and content, first match first, and lines that are noise."""

    title: tuple[str, ...] = ("h1", "title")
    content: tuple[str, ...] = ("article", "#content", ".content", "body")
    noise: tuple[str, ...] = ()
    longest: bool = False


def page_text(pages: DataFrame, layout: PageLayout, keys: tuple[str, ...], html: str = "html") -> DataFrame:
    """``keys, title, content``: of the first container that is there (or the longest one), without noise and title lines."""
    source = pages.select(*keys, F.col(html).alias("__html"))
    schema = _with_fields(source.select(*keys), title=T.StringType(), candidates=T.ArrayType(T.StringType()))

    def pick(reader: _Reader, names: tuple[str, ...]) -> list[str]:
        ranked = sorted(range(len(reader.candidates)), key=lambda k: (names.index(c) if (c := reader.candidates[k][0]) in names else 99, k))
        return ["".join(reader.candidates[k][1]) for k in ranked if reader.candidates[k][0] in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, "__html"):
            title, candidates = [], []
            for page in batch.column("__html").to_pylist():
                reader = _read(page, tuple(dict.fromkeys(layout.title + layout.content)))
                title.append(next((t for t in (" ".join(t.split()) for t in pick(reader, layout.title)) if t), ""))
                candidates.append(pick(reader, layout.content))
            yield _beside(batch, len(keys), range(batch.num_rows), schema, [title, candidates])

    parsed = source.mapInArrow(run, schema)
    ranked = F.transform("candidates", lambda c, i: F.struct(F.length(c).alias("n"), (-i).alias("pos"), c.alias("text")))
    chosen = F.array_max(ranked)["text"] if layout.longest else F.get("candidates", F.lit(0))
    clean = F.filter(F.transform(F.split(F.coalesce(chosen, F.lit("")), "\n"), normalize_whitespace), lambda x: x != "")
    noise = lambda x: any_of(x, layout.noise) | (x == F.col("title"))
    return parsed.select(*keys, "title", F.array_join(F.filter(clean, lambda x: ~noise(x)), "\n").alias("content"))


def any_of(text: Column, patterns: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for p in patterns:
        hit = hit | text.rlike(p)
    return hit


def strip_tags(html: Column | str) -> Column:
    """Text of a page by patterns alone: scripts, styles, comments and tags dropped, the common entities resolved."""
    text = F.col(html) if isinstance(html, str) else html
    for pattern, to in (
        (r"(?is)<script.*?</script>", ""),
        (r"(?is)<style.*?</style>", ""),
        (r"(?s)<!--.*?-->", ""),
        (r"<[^>]*>", " "),
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&amp;", "&"),
        (r"[ \t\r\n]+", " "),
    ):
        text = F.regexp_replace(text, pattern, to)
    return F.trim(text)


def next_parts(links: DataFrame, keys: tuple[str, ...], page: str, next_text: str) -> DataFrame:
    """The successor of each page within its chapter: a link whose text says next, else the part one higher.

    ``links`` has ``number`` and ``part`` of the page (``page_number``,
    ``page_part``) and of the link's target.
    """
    same = links.where("number = page_number")
    priority = F.when(F.col("text").rlike(next_text) & (F.col("part") > F.col("page_part")), 1).when(F.col("part") == F.col("page_part") + 1, 2)
    place = F.row_number().over(Window.partitionBy(*keys, page).orderBy("priority", "pos"))
    return same.withColumn("priority", priority).where("priority is not null").withColumn("place", place).where("place = 1").select(*keys, page, "link")


#: Phrases that tell a blocked page, rate limits first.
BLOCK_PHRASES: Mapping[str, tuple[str, ...]] = {
    "rate_limited": ("error 1015", "you are being rate limited", "banned you temporarily"),
    "challenge": ("just a moment", "verify you are human", "performing security verification", "checking your browser"),
    "denied": ("access denied", "used cloudflare to restrict access"),
}


def block_reason(html: Column | str) -> Column:
    """Why a page is no content; null if it is."""
    text = F.lower(F.col(html) if isinstance(html, str) else html)
    out = F.lit(None).cast("string")
    for reason, phrases in reversed(BLOCK_PHRASES.items()):
        hit = F.lit(False)
        for p in phrases:
            hit = hit | text.contains(p)
        out = F.when(hit, F.lit(reason)).otherwise(out)
    return out


def url_parameter(url: Column | str, name: str) -> Column:
    """A query parameter of an address; null without it."""
    return F.try_parse_url(F.col(url) if isinstance(url, str) else url, F.lit("QUERY"), F.lit(name))


#: Row functions by site, for pages whose layout needs more than containers.
Resolver = Callable[[str, str], list[tuple[int, str, str]]]
RESOLVERS: dict[str, Resolver] = {}


def resolver(site: str) -> Callable[[Resolver], Resolver]:
    """Registers a resolver (html, base address) -> [(number, title, link)]."""

    def register(function: Resolver) -> Resolver:
        RESOLVERS[site] = function
        return function

    return register


def resolve(pages: DataFrame, site: str, keys: tuple[str, ...], url: str = "url", html: str = "html") -> DataFrame:
    """``keys, number, title, link`` by a registered resolver."""
    function = RESOLVERS[site]
    source = pages.select(*keys, F.col(url).alias("__url"), F.col(html).alias("__html"))
    schema = _with_fields(source.select(*keys), number=T.IntegerType(), title=T.StringType(), link=T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, "__html"):
            pages = zip(batch.column("__url").to_pylist(), batch.column("__html").to_pylist(), strict=True)
            found = [(i, *entry) for i, (base, page) in enumerate(pages) for entry in function(page or "", base or "")]
            owner, *values = zip(*found, strict=True) if found else [()] * 4
            yield _beside(batch, len(keys), owner, schema, values)

    return source.mapInArrow(run, schema)
