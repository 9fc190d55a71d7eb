"""Text files under names that the rows give, as a Spark data source writer.

Spark's own writers choose file names themselves.  Here every row carries the
name of its file and one line for it.  Tasks write to a hidden folder of their
job, and the driver moves whole files to their names once all tasks are done:
what a killed or repeated task leaves behind is never seen, and a file appears
complete or not at all.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


class NamedLines(DataSource):
    """``named_lines``: rows (file, line), those of a file side by side. Options: ``path``, and ``header``, a line that begins every file."""

    @classmethod
    def name(cls) -> str:
        return "named_lines"

    def schema(self) -> str:
        return "file string, line string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return NamedLinesWriter(dict(self.options))


@dataclass
class Staged(WriterCommitMessage):
    files: list[tuple[str, str]]


class NamedLinesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.header, self.job = options["path"].rstrip("/"), options.get("header"), uuid.uuid4().hex

    def _folder(self, root: str) -> str:
        return f"{root}/_staged-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, root = _store(self.path)
        files: list[tuple[str, str]] = []
        out = None
        for batch in iterator:
            for name, line in zip(batch.column("file"), batch.column("line")):
                if not files or files[-1][1] != name.as_py():
                    if out is not None:
                        out.close()
                    files.append((f"{uuid.uuid4().hex}", name.as_py()))
                    store.create_dir(self._folder(root), recursive=True)
                    out = store.open_output_stream(f"{self._folder(root)}/{files[-1][0]}", compression=None)
                    if self.header:
                        out.write(f"{self.header}\n".encode())
                out.write(f"{line.as_py()}\n".encode())
        if out is not None:
            out.close()
        return Staged(files)

    def commit(self, messages: list[Staged | None]) -> None:
        store, root = _store(self.path)
        files = [f for m in messages if m for f in m.files]
        names = [name for _, name in files]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError("the rows of a file do not lie side by side")
        for staged, name in files:
            target = f"{root}/{name}"
            store.create_dir(target.rpartition("/")[0], recursive=True)
            store.move(f"{self._folder(root)}/{staged}", target)
        self.abort(messages)

    def abort(self, messages: list[Staged | None]) -> None:
        """Take the hidden folder away, with whatever lost tasks have left there."""
        store, root = _store(self.path)
        if store.get_file_info(self._folder(root)).type == fs.FileType.Directory:
            store.delete_dir(self._folder(root))


def write_lines(rows: DataFrame, path: str, *order: str | Column, header: str | None = None) -> None:
    """Write ``rows`` (file, line, ...) below ``path``, each file's lines in the given order.

    A file is written by one task, so this is for files that one process could
    have written: the run of one sampler, a report.  Files with these names are
    replaced, others stay.
    """
    rows.sparkSession.dataSource.register(NamedLines)
    together = rows.repartition("file").sortWithinPartitions("file", *order).select("file", "line")
    writer = together.write.format("named_lines").mode("append")
    (writer.option("header", header) if header else writer).save(path)
