"""A sink for whole small files: every row's bytes become a file of its own under the given folder.

A task writes a file under a name of its own and moves it to its final name once it is whole, so a repeated or lost task
leaves no half of a file and replaces what it has written before. A failed job leaves whole files; what says that all are
there (a store's description) is written after all tasks. An existing file of the same name is replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and plain path of a folder given as path or uri."""
    fs, p = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    return fs, p.rstrip("/")


@dataclass
class Written(WriterCommitMessage):
    files: int


def put_file(fs: pafs.FileSystem, final: str, payload: pa.Buffer | bytes) -> None:
    """Write a file under a name of its own, then give it its final name: others see it whole or not at all."""
    folder, _, last = final.rpartition("/")
    fs.create_dir(folder)
    temporary = f"{folder}/.{last}-{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary) as f:
        f.write(payload)
    try:
        fs.move(temporary, final)
    except OSError:  # file systems that don't move onto a file
        fs.delete_file(final)
        fs.move(temporary, final)


class FilesWriter(DataSourceArrowWriter):
    """Rows of (name, payload); a name may hold folders. Tasks give their files the final names themselves, so the driver
    has nothing to do for a file."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = open_folder(self.path)
        n = 0
        for b in iterator:
            for name, payload in zip(b.column("name").to_pylist(), b.column("payload"), strict=True):
                put_file(fs, f"{root}/{name}", payload.as_buffer())
                n += 1
        return Written(n)

    def commit(self, messages: list) -> None:
        pass

    def abort(self, messages: list) -> None:
        pass


class FilesSink(DataSource):
    """df.select("name", "payload").write.format("whole_files").mode("append").save(path)"""

    @classmethod
    def name(cls) -> str:
        return "whole_files"

    def schema(self) -> str:
        return "name string, payload binary"

    def writer(self, schema, overwrite: bool) -> FilesWriter:
        return FilesWriter(self.options)


def write_files(files: DataFrame, path: str) -> None:
    """files: name string, payload binary."""
    files.sparkSession.dataSource.register(FilesSink)
    files.select("name", "payload").write.format("whole_files").mode("append").save(path)
