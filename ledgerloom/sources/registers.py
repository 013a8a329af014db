"""A Spark data source over staged register files: spark.read.format("registers").load(folder).

A partition is a register's folder cut into runs of files, so pages of one register are read side by side. Filters on source_key, url_ix,
page_ix and file are answered from names: folders of other registers are not listed, and files that they exclude are not opened. With the option
contents=false no file is opened at all.
"""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "source_key string, url_ix int, page_ix int, file string, path string, modified timestamp, size long, content binary"
_TYPES = pa.schema([("source_key", pa.string()), ("url_ix", pa.int32()), ("page_ix", pa.int32()), ("file", pa.string()), ("path", pa.string()), ("modified", pa.timestamp("us", "UTC")), ("size", pa.int64()), ("content", pa.binary())])
NAMED = ("source_key", "url_ix", "page_ix", "file")  # what a name tells
_TESTS = {EqualTo: lambda x, v: x == v, GreaterThan: lambda x, v: x > v, GreaterThanOrEqual: lambda x, v: x >= v, LessThan: lambda x, v: x < v, LessThanOrEqual: lambda x, v: x <= v, In: lambda x, v: x in v}


def place(file: str) -> tuple[int | None, int | None]:
    """Number of the address and of its page in <n>-<m>.<ending>; none for downloads."""
    m = re.search(r"(\d+)-(\d+)\.[^./]*$", file)
    return (int(m[1]), int(m[2])) if m else (None, None)


class Run(InputPartition):
    """Files of one register, next to each other in the order of pages."""

    def __init__(self, source_key: str, files: list[str]):
        self.source_key, self.files = source_key, files


class RegisterReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        options = {k.lower(): v for k, v in options.items()}
        self.store, self.root = fs.FileSystem.from_uri(options["path"]) if "://" in options["path"] or options["path"].startswith("file:/") else (fs.LocalFileSystem(), options["path"])
        self.per_run = int(options.get("filesperpartition", 64))
        self.contents = options.get("contents", "true").lower() == "true"
        self.tests: list[tuple[str, Any, Any]] = []

    def pushFilters(self, filters: list) -> Iterator:  # noqa: N802
        """Takes what names tell; gives the rest back to Spark."""
        for f in filters:
            test, column = _TESTS.get(type(f)), getattr(f, "attribute", ())
            if test and len(column) == 1 and column[0] in NAMED:
                self.tests.append((column[0], test, f.value))
            else:
                yield f

    def _fits(self, **names) -> bool:
        return all(names[c] is not None and test(names[c], value) for c, test, value in self.tests if c in names)

    def _list(self, at: str, kind: fs.FileType) -> list[str]:
        return sorted(i.base_name for i in self.store.get_file_info(fs.FileSelector(at, allow_not_found=True)) if i.type == kind and not i.base_name.startswith((".", "_")))

    def partitions(self) -> list[Run]:
        out = []
        for key in self._list(self.root, fs.FileType.Directory):
            if not self._fits(source_key=key):
                continue
            found = [(*place(f), f) for f in self._list(posixpath.join(self.root, key), fs.FileType.File)]
            found.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1] or 0, x[2]))
            files = [f for url, page, f in found if self._fits(url_ix=url, page_ix=page, file=f)]
            out += [Run(key, files[i : i + self.per_run]) for i in range(0, len(files), self.per_run)]
        return out or [Run("", [])]

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        for f in partition.files:
            path = posixpath.join(self.root, partition.source_key, f)
            info = self.store.get_file_info(path)
            content = None
            if self.contents:
                with self.store.open_input_stream(path) as s:
                    content = s.read()
            url, page = place(f)
            row = (partition.source_key, url, page, f, path, info.mtime, info.size, content)
            yield pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(row, _TYPES)], schema=_TYPES)


class Registers(DataSource):
    """Options: path (load), filesPerPartition (64), contents (true). The folder is read by the executors, from any store they share."""

    @classmethod
    def name(cls) -> str:
        return "registers"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RegisterReader:
        return RegisterReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """The format under its name, with filters handed down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Registers)


def write_files(files: DataFrame, folder: str) -> None:
    """The raw downloads as the files they were: rows (source_key, file, content) to folder/<source_key>/<file>, by the executors."""
    store, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:/") else (fs.LocalFileSystem(), folder)

    def run(rows):
        for r in rows:
            at = posixpath.join(root, r.source_key)
            store.create_dir(at, recursive=True)
            aside = posixpath.join(at, f".{r.file}")
            with store.open_output_stream(aside) as f:
                f.write(bytes(r.content))
            store.move(aside, posixpath.join(at, r.file))  # a file is there whole or not at all

    files.select("source_key", "file", "content").foreachPartition(run)
