"""Python data sources: pages of binary files, read by an adapter, and records written as one named JSON file each.

    formats.register(spark)
    spark.read.format("pages").option("decoder", "package.module:open_file").option("kind", "words").load(path)
    records.write.format("named_json").mode("overwrite").save(path)

Files are reached through Arrow's file systems, so paths may be local, shared or URIs of a store.
"""

from __future__ import annotations

import importlib
import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

#: What an adapter's ``page(number)`` gives under each kind, after the columns that all kinds have.
KINDS = {
    "words": "text string, x0 double, top double, x1 double, bottom double, size double, fontname string",
    "text": "text string",
    "images": "index int, name string, width int, height int, content binary",
    "links": "index int, uri string, x0 double, top double, x1 double, bottom double",
    "tables": "index int, rows array<array<string>>, x0 double, top double, x1 double, bottom double",
}
PAGE = "source_file string, page_number int, {0}, error string"


def file_system(path: str):
    """(file system, path in it) of a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), os.path.abspath(path))


def _fields(kind: str) -> list[str]:
    out, depth, start = [], 0, 0
    for i, c in enumerate(kind):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(kind[start:i])
            start = i + 1
    return [f.split()[0] for f in [*out, kind[start:]]]


@dataclass
class Pages(InputPartition):
    """Pages ``first`` to ``last`` of a file; all of them where ``last`` is None."""

    file: str
    first: int
    last: int | None


class PageSource(DataSource):
    """Options: ``path`` (a file or a folder), ``pattern`` (a suffix, .pdf unless given), ``decoder`` (module:function, called with
    a file's bytes; its result has ``pages``, their number, and ``page(n)``, a mapping of kinds to rows), ``kind``, and
    ``pagesPerPartition`` (0: a file is one partition and is counted where it is read; else files are opened once before, to be
    counted). A page or file that can't be decoded is a row with ``error`` and nothing else, page 0 standing for the file."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return PAGE.format(KINDS[self.options.get("kind", "words")])

    def reader(self, schema: StructType) -> DataSourceReader:
        return PageReader(self.options)


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.kind = options["path"], options.get("kind", "words")
        self.decoder, self.suffix = options["decoder"], options.get("pattern", ".pdf").lstrip("*")
        self.step = int(options.get("pagesPerPartition", "0"))

    def _open(self, file: str):
        module, name = self.decoder.split(":")
        system, _ = file_system(self.path)
        with system.open_input_stream(file) as stream:
            return getattr(importlib.import_module(module), name)(stream.read())

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, path = file_system(self.path)
        found = [system.get_file_info(path)]
        if found[0].type == fs.FileType.Directory:
            found = sorted(system.get_file_info(fs.FileSelector(path)), key=lambda i: i.path)
        files = [i.path for i in found if i.type == fs.FileType.File and i.path.endswith(self.suffix)]
        if not self.step:
            return [Pages(f, 1, None) for f in files]
        out = []
        for file in files:
            try:
                count = self._open(file).pages
            except Exception:
                count = None  # the task that reads it tells why
            out += [Pages(file, 1, None)] if count is None else [Pages(file, n, min(n + self.step - 1, count)) for n in range(1, count + 1, self.step)]
        return out

    def read(self, partition: Pages | None) -> Iterator[tuple]:
        if partition is None:  # no file at all
            return
        fields = _fields(KINDS[self.kind])
        source = os.path.basename(partition.file)
        failed = lambda page, e: (source, page, *[None] * len(fields), f"{type(e).__name__}: {e}")
        try:
            opened = self._open(partition.file)
            last = partition.last or opened.pages
        except Exception as e:
            yield failed(0, e)
            return
        for number in range(partition.first, last + 1):
            try:
                rows = [tuple(row.get(f) for f in fields) for row in opened.page(number).get(self.kind, [])]
            except Exception as e:
                yield failed(number, e)
                continue
            for row in rows:
                yield (source, number, *row, None)


class NamedJson(DataSource):
    """Writes each row as ``stem``.json: indented, letters kept as they are, columns in order, the stem and null columns left out.
    A file appears whole or not at all: it is written beside its place and then moved there, so a repeated task or job
    writes the same bytes again. Files of other stems stay, whatever the mode. A stem must be a file's name."""

    @classmethod
    def name(cls) -> str:
        return "named_json"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return NamedJsonWriter(self.options["path"], schema)


@dataclass
class Written(WriterCommitMessage):
    files: int


class NamedJsonWriter(DataSourceWriter):
    def __init__(self, path: str, schema: StructType):
        self.path, self.fields = path, {f.name: f.dataType for f in schema.fields}

    def write(self, rows: Iterator[Row]) -> WriterCommitMessage:
        system, path = file_system(self.path)
        system.create_dir(path, recursive=True)
        count = 0
        for row in rows:
            stem = row["stem"]
            if not stem or stem != os.path.basename(stem) or stem in (".", ".."):
                raise ValueError(f"not a file's name: {stem!r}")
            record = {name: _plain(row[name], kind) for name, kind in self.fields.items() if name != "stem" and row[name] is not None}
            beside = f"{path}/.{stem}.{uuid.uuid4().hex}"
            try:
                with system.open_output_stream(beside) as stream:
                    stream.write(json.dumps(record, indent=2, ensure_ascii=False).encode())
                system.move(beside, f"{path}/{stem}.json")
            except BaseException:
                if system.get_file_info(beside).is_file:
                    system.delete_file(beside)
                raise
            count += 1
        return Written(count)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Nothing is left to do: every file is in its place."""

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files that were written stay; each is whole."""


def _plain(value, kind: DataType):
    if value is None:
        return None
    if isinstance(kind, StructType):
        return {f.name: _plain(value[f.name], f.dataType) for f in kind.fields}
    if isinstance(kind, ArrayType):
        return [_plain(v, kind.elementType) for v in value]
    if isinstance(kind, MapType):
        return {str(k): _plain(v, kind.valueType) for k, v in value.items()}
    return value if isinstance(value, (str, int, float, bool)) else str(value)


def register(spark: SparkSession) -> None:
    for source in (PageSource, NamedJson):
        spark.dataSource.register(source)
