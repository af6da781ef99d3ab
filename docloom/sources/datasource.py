"""Python data sources ``docloom`` (read: lines of documents; write: one document a partition).

Files are listed, read and written through Arrow's file systems: a path may be local or a URI such as hdfs:// or s3://.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from docloom.codec import DocumentError

from .reader import lines_of_document
from .writer import build

#: Bytes of files that one partition reads about; a larger file stands alone.
PARTITION_BYTES = 32 << 20
SUFFIXES = {"pdf": "pdf", "docx": "docx", "xlsx": "xlsx", "xls": "xlsx", "csv": "csv", "txt": "csv"}


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if re.match(r"[A-Za-z][\w+.-]+:", path) else (fs.LocalFileSystem(), path)


def listed(path: str) -> list[fs.FileInfo]:
    """Files of a folder, of a pattern of names in a folder, or the one file."""
    system, inside = place(path.rstrip("/"))
    folder, _, name = inside.rpartition("/")
    if any(c in name for c in "*?["):
        found = system.get_file_info(fs.FileSelector(folder or "/", allow_not_found=True))
        found = [f for f in found if fnmatch.fnmatchcase(f.base_name, name)]
    else:
        info = system.get_file_info(inside)
        found = system.get_file_info(fs.FileSelector(inside)) if info.type == fs.FileType.Directory else [info]
    return sorted((f for f in found if f.type == fs.FileType.File), key=lambda f: f.path)


class Documents(InputPartition):
    def __init__(self, files: list[tuple[str, int]]):
        super().__init__(files)
        self.files = files


class DocumentReader(DataSourceReader):
    """Small files share a partition; offset and limit stop early, on a filter of path only those files are opened."""

    def __init__(self, options):
        self.options, self.only = options, None

    def pushFilters(self, filters):
        for f in filters:
            if type(f).__name__ == "EqualTo" and f.attribute == ("path",):
                self.only = f.value
            else:
                yield f

    def partitions(self):
        parts, size = [[]], 0
        for f in listed(self.options.get("path", "")):
            if self.only is None or self.only == f.path:
                if parts[-1] and size + f.size > PARTITION_BYTES:
                    parts.append([])
                    size = 0
                parts[-1].append((f.path, f.size))
                size += f.size
        return [Documents(p) for p in parts if p]

    def read(self, partition) -> Iterator[tuple]:
        system, _ = place(self.options.get("path", ""))
        start, limit = max(0, int(self.options.get("offset", 1)) - 1), self.options.get("limit")
        most = int(self.options.get("maxBytes", 64 << 20))
        for path, size in partition.files:
            lines, error = self._lines(system, path) if size <= most else ([], f"the file has {size} bytes, more than {most}")
            if error:
                if self.options.get("mode", "PERMISSIVE").upper() == "FAILFAST":
                    raise DocumentError(f"{path}: {error}")
                yield path, None, None, error
            for k, line in enumerate(lines[start : len(lines) if limit is None else start + int(limit)], start + 1):
                yield path, k, line, None

    def _lines(self, system: fs.FileSystem, path: str) -> tuple[list[str], str | None]:
        form = self.options.get("format", "auto")
        kind = SUFFIXES.get(path.rpartition(".")[2].lower(), "unknown") if form == "auto" else form
        with system.open_input_stream(path) as f:
            return lines_of_document(f.read(), kind)


class Written(WriterCommitMessage):
    def __init__(self, path: str, rows: int):
        self.path, self.rows = path, rows


class DocumentWriter(DataSourceWriter):
    def __init__(self, options, overwrite: bool):
        self.options, self.overwrite = options, overwrite

    def write(self, rows) -> Written:
        from pyspark import TaskContext

        (system, folder), form = place(self.options["path"]), self.options.get("format", "csv")
        held = [list(r) for r in rows]
        if not held:
            return Written("", 0)
        system.create_dir(folder, recursive=True)
        # Attempts write files of their own; commit gives one attempt's its name.
        task = TaskContext.get()
        target = f"{folder.rstrip('/')}/part-{task.partitionId():05d}.{form}.{task.taskAttemptId()}.tmp"
        with system.open_output_stream(target) as f:
            f.write(build(form, rows=held, title=self.options.get("title")))
        return Written(target, len(held))

    def commit(self, messages) -> None:
        system, folder = place(self.options["path"])
        if self.overwrite:
            for f in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                if f.base_name.startswith("part-") and not f.base_name.endswith(".tmp"):
                    system.delete_file(f.path)
        for m in messages:
            if m and m.path:
                name, attempt, _ = m.path.rsplit(".", 2)
                taken = not self.overwrite and system.get_file_info(name).type == fs.FileType.File
                stem, form = name.rsplit(".", 1)
                system.move(m.path, f"{stem}-{attempt}.{form}" if taken else name)

    def abort(self, messages) -> None:
        system, _ = place(self.options["path"])
        for m in messages:
            if m and m.path and system.get_file_info(m.path).type == fs.FileType.File:
                system.delete_file(m.path)


class DocloomSource(DataSource):
    """spark.dataSource.register(DocloomSource); spark.read.format("docloom").load(path)."""

    @classmethod
    def name(cls) -> str:
        return "docloom"

    def schema(self) -> str:
        return "path string, line_no bigint, line string, error string"

    def reader(self, schema):
        return DocumentReader(self.options)

    def writer(self, schema, overwrite: bool):
        return DocumentWriter(self.options, overwrite)


def register(spark) -> None:
    """Registers the source; filters on path are pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DocloomSource)
