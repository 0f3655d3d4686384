"""Batch and caption files as a Spark data source: ``spark.read.format("textloom_files")``, also as a stream and a sink.

Options: ``path`` (a folder, by a path or URI that pyarrow opens), ``kind``
(``batches`` or ``captions``), ``low`` and ``high`` (numbers asked for; files
whose name gives no range are kept), ``partition_bytes``.

Names are ``chuong_<first>-<last>.txt`` (or one number).  Files are chosen by
name, size and time alone, on the driver; a file that a pushed filter on
``file_name``, ``batch_start`` or ``batch_end`` or the options rule out is never
opened.  Tasks read groups of files and hold one file at a time.  Filters are
pushed where ``spark.sql.python.filterPushdown.enabled`` is set.

As a stream, files are taken in the order of (time, name); an offset is the last
one taken, so a batch that is run again reads the same files.  A file has to be
put in place whole, with a time no older than those already taken.

As a sink, rows ``file_name, value`` become files; a task writes hidden drafts,
and the driver renames them when all tasks are done, so a retried task leaves
nothing behind that counts.
"""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Row, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.types import StructType

#: Fixed value: how a batch file is named.
NAME = re.compile(r"^chuong_(\d+)(?:-(\d+))?\.(?:txt|srt)$")
SCHEMAS = {
    "batches": "file_name string, batch_start int, batch_end int, value string",
    "captions": "file_name string, batch_start int, batch_end int, pos int, begins string, ends string, value string",
}
PARTITION_BYTES = 32 << 20


def name_range(name: str) -> tuple[int | None, int | None]:
    """First and last number of a file, nulls where its name tells none."""
    m = NAME.match(name)
    return (int(m[1]), int(m[2] or m[1])) if m else (None, None)


@dataclass(frozen=True)
class File:
    name: str
    size: int
    time: int

    @property
    def span(self) -> tuple[int | None, int | None]:
        return name_range(self.name)


def _opened(options: dict[str, str]) -> tuple[fs.FileSystem, str]:
    path = options["path"]
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _listed(options: dict[str, str]) -> list[File]:
    system, root = _opened(options)
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    files = [File(i.base_name, i.size, i.mtime_ns or 0) for i in found if i.type == fs.FileType.File and i.base_name[0] not in "._"]
    low, high = (int(v) if (v := options.get(k)) else None for k in ("low", "high"))
    inside = lambda a, b: a is None or ((low is None or b >= low) and (high is None or a <= high))
    return sorted((f for f in files if inside(*f.span)), key=lambda f: (f.span[0] is None, f.span[0] or 0, f.name))


def captions(text: str) -> Iterator[tuple[int, str, str, str]]:
    """Number, begin, end and text of the cues of a SubRip file; broken cues are passed over."""
    for block in re.split(r"\n[ \t]*\n", text.replace("\r\n", "\n").strip()):
        lines = block.strip().split("\n")
        if len(lines) >= 2 and lines[0].strip().isdigit() and (m := re.match(r"\s*(\S+)\s*-->\s*(\S+)", lines[1])):
            yield int(lines[0]), m[1], m[2], "\n".join(line.strip() for line in lines[2:])


@dataclass
class Group(ds.InputPartition):
    names: tuple[str, ...]


def _groups(files: Sequence[File], size: int) -> list[Group]:
    groups, held, total = [], [], 0
    for f in files:
        if held and total + f.size > size:
            groups.append(Group(tuple(held)))
            held, total = [], 0
        held.append(f.name)
        total += f.size
    return [*groups, Group(tuple(held))] if held else groups


def _rows(options: dict[str, str], group: Group | None) -> Iterator[tuple]:
    if group is None:  # what Spark reads where there are no partitions
        return
    system, root = _opened(options)
    for name in group.names:
        with system.open_input_stream(posixpath.join(root, name)) as stream:
            text = stream.read().decode("utf-8", "replace")
        if options.get("kind", "batches") == "captions":
            for cue in captions(text):
                yield (name, *name_range(name), *cue)
        else:
            yield (name, *name_range(name), text)


_TESTS = {
    ds.EqualTo: lambda a, b: a is not None and a == b,
    ds.GreaterThan: lambda a, b: a is not None and a > b,
    ds.GreaterThanOrEqual: lambda a, b: a is not None and a >= b,
    ds.LessThan: lambda a, b: a is not None and a < b,
    ds.LessThanOrEqual: lambda a, b: a is not None and a <= b,
    ds.In: lambda a, b: a is not None and a in b,
    ds.IsNull: lambda a, _: a is None,
    ds.IsNotNull: lambda a, _: a is not None,
}


class FilesReader(ds.DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options, self.filters = options, []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        """Takes the filters that a name can answer; Spark keeps the others."""
        for f in filters:
            if type(f) in _TESTS and f.attribute in (("file_name",), ("batch_start",), ("batch_end",)):
                self.filters.append((type(f), f.attribute[0], getattr(f, "value", None)))
            else:
                yield f

    def _chosen(self, file: File) -> bool:
        values = dict(zip(("file_name", "batch_start", "batch_end"), (file.name, *file.span), strict=True))
        return all(_TESTS[kind](values[column], value) for kind, column, value in self.filters)

    def partitions(self) -> list[Group]:
        return _groups([f for f in _listed(self.options) if self._chosen(f)], int(self.options.get("partition_bytes", PARTITION_BYTES)))

    def read(self, partition: Group) -> Iterator[tuple]:
        return _rows(self.options, partition)


class FilesStream(ds.DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def _ordered(self) -> list[File]:
        return sorted(_listed(self.options), key=lambda f: (f.time, f.name))

    def initialOffset(self) -> dict:
        return {"time": -1, "name": ""}

    def latestOffset(self) -> dict:
        files = self._ordered()
        return {"time": files[-1].time, "name": files[-1].name} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Group]:
        low, high = (start["time"], start["name"]), (end["time"], end["name"])
        return _groups([f for f in self._ordered() if low < (f.time, f.name) <= high], int(self.options.get("partition_bytes", PARTITION_BYTES)))

    def read(self, partition: Group) -> Iterator[tuple]:
        return _rows(self.options, partition)

    def commit(self, end: dict) -> None:
        pass


@dataclass
class Drafts(ds.WriterCommitMessage):
    names: tuple[tuple[str, str], ...]


class FilesWriter(ds.DataSourceWriter):
    """Names have to be told apart by the rows; of a name that comes twice one of its texts is kept."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.options, self.overwrite = options, overwrite

    def write(self, iterator: Iterator[Row]) -> Drafts:
        system, root = _opened(self.options)
        system.create_dir(root, recursive=True)
        names = []
        for row in iterator:
            draft = f".draft-{uuid.uuid4().hex}"
            with system.open_output_stream(posixpath.join(root, draft)) as out:
                out.write((row["value"] or "").encode())
            names.append((draft, row["file_name"]))
        return Drafts(tuple(names))

    def commit(self, messages: list[Drafts | None]) -> None:
        system, root = _opened(self.options)
        done = [pair for m in messages if m for pair in m.names]
        if self.overwrite:
            kept = {name for _, name in done}
            for f in _listed({"path": self.options["path"]}):
                if f.name not in kept:
                    system.delete_file(posixpath.join(root, f.name))
        for draft, name in done:
            system.move(posixpath.join(root, draft), posixpath.join(root, name))

    def abort(self, messages: list[Drafts | None]) -> None:
        system, root = _opened(self.options)
        for draft, _ in (pair for m in messages if m for pair in m.names):
            system.delete_file(posixpath.join(root, draft))


class TextloomFiles(ds.DataSource):
    """The data source ``textloom_files``."""

    @classmethod
    def name(cls) -> str:
        return "textloom_files"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("kind", "batches")]

    def reader(self, schema: StructType) -> FilesReader:
        return FilesReader(dict(self.options))

    def streamReader(self, schema: StructType) -> FilesStream:
        return FilesStream(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> FilesWriter:
        return FilesWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Makes ``textloom_files`` known to a session, with filters pushed into it."""
    spark.dataSource.register(TextloomFiles)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
