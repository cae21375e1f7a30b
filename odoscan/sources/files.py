"""A batch data source for folders of per-vehicle files whose headers differ.

``FolderSource`` plans one partition per group of neighbouring files. A task opens its files
one after the other, reads each one's own header, and returns rows by column name, so
files of any layout land in one table. ``what="headers"`` returns a row per file instead
(names, types, what went wrong), which is how the columns of the table are found.

A file that cannot be read gives one row that only names the file and the error; what had been
read of it before is left out by the caller. Rows get the number ``file << 34 | row``,
where files are numbered by name, so it does not depend on how files are grouped.

CSV: one header record, quoted fields may hold line breaks, an empty field is null, a short
record is filled with nulls, and of a long one the additional fields are left out; both are
marked in ``RAGGED``. Parquet: footers are read first, columns keep their types, and columns
whose types differ between files become text. Files are read in pieces, so a file may be
larger than a task's memory. Folders are listed and files opened through Arrow, which knows
local paths and hdfs, s3 and gs addresses.
"""

from __future__ import annotations

import csv
import fnmatch
import io
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql import types as T

from odoscan.config import HEADER_ALIASES, Roles

ERROR, RAGGED = "_error", "_ragged"
HEADERS = "path string, file long, bytes long, names array<string>, types array<string>, error string"
#: Bits of a row's number within its file.
ROW_BITS = 34
_PIECE = 8192


def canonical_names(headers: Sequence[str], aliases: dict[str, str] | None = None) -> list[str]:
    """Trim, turn line breaks into spaces, and apply the alias map."""
    aliases = HEADER_ALIASES if aliases is None else aliases
    tidy = [h.strip().replace("\n", " ") for h in headers]
    return [aliases.get(h, h) for h in tidy]


def entity_of(name: str) -> str:
    """The entity in a file's name: what stands before the extension and the first underscore."""
    return (name.rsplit(".", 1)[0] if "." in name else name).split("_")[0]


def open_folder(directory: str):
    """The file system of a folder, and the folder's path there."""
    from pyarrow import fs

    if "://" in directory or directory.startswith("file:/"):
        return fs.FileSystem.from_uri(directory)
    return fs.LocalFileSystem(), directory


def matching_files(directory: str, pattern: str) -> list[tuple[str, int]]:
    """(name, bytes) of the files directly in a folder, by name. Hidden and empty files do not count."""
    from pyarrow import fs

    system, base = open_folder(directory)
    if system.get_file_info(base).type != fs.FileType.Directory:
        raise FileNotFoundError(f"directory not found: {directory}")
    found = system.get_file_info(fs.FileSelector(base, recursive=False))
    files = [(f.base_name, f.size) for f in found if f.type == fs.FileType.File and f.size]
    return sorted((n, s) for n, s in files if fnmatch.fnmatchcase(n, pattern) and n[0] not in "._")


@dataclass
class FileGroup(InputPartition):
    first: int
    names: list[str]
    sizes: list[int]


def grouped(files: Sequence[tuple[str, int]], most_bytes: int, most_files: int = 4096) -> list[FileGroup]:
    """Neighbouring files, up to a total size; a larger file stands alone."""
    groups: list[FileGroup] = []
    held = 0
    for number, (name, size) in enumerate(files):
        if not groups or held + size > most_bytes or len(groups[-1].names) >= most_files:
            groups.append(FileGroup(number, [], []))
            held = 0
        groups[-1].names.append(name)
        groups[-1].sizes.append(size)
        held += size
    return groups


class _Csv:
    def __init__(self, raw):
        csv.field_size_limit(sys.maxsize)
        self.records = csv.reader(io.TextIOWrapper(io.BufferedReader(raw), encoding="utf-8-sig", newline=""), strict=True)
        self.header = next(self.records, None)
        if self.header is None:
            raise ValueError("no header")
        self.types = ["string"] * len(self.header)

    def pieces(self) -> Iterator[tuple[int, list, list[bool]]]:
        width, rows, ragged = len(self.header), [], []
        for record in self.records:
            if not record:
                continue  # a blank line
            ragged.append(len(record) != width)
            if ragged[-1]:
                record = (record + [""] * width)[:width]
            rows.append(record)
            if len(rows) == _PIECE:
                yield len(rows), self._columns(rows, width), ragged
                rows, ragged = [], []
        if rows:
            yield len(rows), self._columns(rows, width), ragged

    @staticmethod
    def _columns(rows: list[list[str]], width: int) -> list[pa.Array]:
        return [pa.array([x or None for x in column], pa.string()) for column in (zip(*rows, strict=True) if width else [])]


class _Parquet:
    def __init__(self, raw):
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_type

        self.file = pq.ParquetFile(raw)
        self.header = list(self.file.schema_arrow.names)
        self.types = [from_arrow_type(f.type, True).simpleString() for f in self.file.schema_arrow]

    def pieces(self) -> Iterator[tuple[int, list, list[bool]]]:
        for batch in self.file.iter_batches(batch_size=_PIECE):
            yield batch.num_rows, batch.columns, [False] * batch.num_rows


def _opened(system, path: str):
    return (_Parquet if path.endswith(".parquet") else _Csv)(system.open_input_file(path) if path.endswith(".parquet") else system.open_input_stream(path))


def _as_type(column: pa.Array, wanted: pa.DataType) -> pa.Array:
    return column if column.type == wanted else column.cast(wanted)


class FolderReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema = schema
        self.directory, self.pattern = options["path"].rstrip("/"), options.get("pattern", "*.csv")
        self.most_bytes = int(options.get("groupbytes", 128 << 20))
        self.what, self.keep = options.get("what", "rows"), options.get("keep", "first")
        self.roles = Roles(entity=options.get("entity", Roles.entity), source=options.get("source", Roles.source), record=options.get("record", Roles.record))

    def partitions(self) -> Sequence[InputPartition]:
        files = matching_files(self.directory, self.pattern)
        return grouped(files, self.most_bytes) or [FileGroup(0, [], [])]

    def read(self, partition: FileGroup) -> Iterator[pa.RecordBatch]:
        system, base = open_folder(self.directory)
        for number, (name, size) in enumerate(zip(partition.names, partition.sizes, strict=True), partition.first):
            if self.what == "headers":
                yield self._header(system, base, number, name, size)
            else:
                yield from self._rows(system, base, number, name)

    def _header(self, system, base: str, number: int, name: str, size: int) -> pa.RecordBatch:
        names = types = error = None
        try:
            file = _opened(system, f"{base}/{name}")
            names, types = file.header, file.types
        except Exception as reason:  # whatever is wrong with a file, the others are read
            error = _told(reason)
        text = pa.list_(pa.string())
        columns = [
            pa.array([f"{self.directory}/{name}"], pa.string()), pa.array([number], pa.int64()), pa.array([size], pa.int64()),
            pa.array([names], text), pa.array([types], text), pa.array([error], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["path", "file", "bytes", "names", "types", "error"])

    def _rows(self, system, base: str, number: int, name: str) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(self.schema)
        fixed = {self.roles.entity: entity_of(name), self.roles.source: f"{self.directory}/{name}"}
        at = 0
        try:
            file = _opened(system, f"{base}/{name}")
            places: dict[str, list[int]] = {}
            for i, column in enumerate(canonical_names(file.header)):
                places.setdefault(column, []).append(i)
            for count, columns, ragged in file.pieces():
                out = []
                for want in wanted:
                    if want.name in fixed:
                        out.append(pa.array([fixed[want.name]] * count, pa.string()))
                    elif want.name == RAGGED:
                        out.append(pa.array(ragged, pa.bool_()))
                    elif want.name in places:
                        out.append(self._picked([columns[i] for i in places[want.name]], want.type))
                    elif want.name == self.roles.record:
                        out.append(pa.array(range(number << ROW_BITS | at, (number << ROW_BITS | at) + count), pa.int64()))
                    else:
                        out.append(pa.nulls(count, want.type))
                at += count
                yield pa.RecordBatch.from_arrays(out, schema=wanted)
        except Exception as reason:  # one damaged file must not take the others along
            told = {**fixed, ERROR: _told(reason)}
            yield pa.RecordBatch.from_arrays([pa.array([told.get(w.name)], w.type) for w in wanted], schema=wanted)

    def _picked(self, columns: list[pa.Array], kind: pa.DataType) -> pa.Array:
        import pyarrow.compute as pc

        if self.keep == "filled" and len(columns) > 1:
            return pc.coalesce(*[_as_type(c, kind) for c in columns])
        return _as_type(columns[-1 if self.keep == "last" else 0], kind)


def _told(reason: Exception) -> str:
    return f"{type(reason).__name__}: {reason}"[:500]


class FolderSource(DataSource):
    """``spark.read.format("odoscan_folder")``; options path, pattern, what, keep, groupBytes."""

    @classmethod
    def name(cls) -> str:
        return "odoscan_folder"

    def schema(self) -> str:
        if self.options.get("what") == "headers":
            return HEADERS
        raise ValueError("give the columns with schema(), as sources.folder.folder_columns finds them, or ask for what=headers")

    def reader(self, schema: T.StructType) -> FolderReader:
        return FolderReader(schema, dict(self.options))
