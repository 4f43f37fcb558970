"""A data source whose rows become named files: pieces of text in order, staged by the tasks and moved to their places by one commit.

A row is ``file, section, value``. The rows of a file must come together and in order, as after a repartition by ``file`` and a sort within partitions; they are
written as they come, so no file is ever held. Between two rows of one section stands the option ``between``. Paths of files count from the option ``path``, which
may be of any kind that ``pyarrow.fs`` opens.

A task writes below ``_staged-<job>/<attempt>``; a task that fails or runs twice leaves nothing elsewhere. When all tasks are done, the driver moves each file to
its place, one by one; files of the same names are replaced, others stay. If the job fails, what was staged is removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import PurePosixPath

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

NAME = "corpusloom_files"
SCHEMA = "file string, section int, value string"


@dataclass
class Staged(WriterCommitMessage):
    """Where a task has put each of its files."""

    files: list[tuple[str, str]]


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _inside(name: str) -> str:
    if not name or name.startswith("/") or ".." in PurePosixPath(name).parts:
        raise ValueError(f"not a path below the root: {name!r}")
    return name


class FilesWriter(DataSourceArrowWriter):
    def __init__(self, path: str, between: str, job: str) -> None:
        self.path, self.between, self.job = path, between, job

    def _staging(self) -> tuple[fs.FileSystem, str, str]:
        system, root = _opened(self.path)
        return system, root, f"{root}/_staged-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        system, _, staging = self._staging()
        own, files, seen = f"{staging}/{uuid.uuid4().hex}", [], set()
        out, name, before = None, None, None
        try:
            for batch in iterator:
                columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("file", "section", "value"))
                for file, section, value in zip(*columns, strict=True):
                    if file != name:
                        if out is not None:
                            out.close()
                        if file in seen:
                            raise ValueError(f"the rows of {file!r} do not come together")
                        seen.add(file)
                        if not files:
                            system.create_dir(own)
                        name, before = file, None
                        files.append((f"{own}/{len(files)}", _inside(file)))
                        out = system.open_output_stream(files[-1][0])
                    elif section is not None and section == before:
                        out.write(self.between.encode())
                    before = section
                    out.write((value or "").encode())
        finally:
            if out is not None:
                out.close()
        return Staged(files)

    def commit(self, messages: list[Staged | None]) -> None:
        system, root, staging = self._staging()
        moves = [m for message in messages if message is not None for m in message.files]
        places = [place for _, place in moves]
        if len(set(places)) < len(places):
            self.abort(messages)
            raise ValueError("a file was written by several tasks")
        for folder in {str(PurePosixPath(root, place).parent) for place in places}:
            system.create_dir(folder)
        for staged, place in moves:
            system.move(staged, f"{root}/{place}")
        self.abort(messages)

    def abort(self, messages: list[Staged | None]) -> None:
        system, _, staging = self._staging()
        if system.get_file_info(staging).type == fs.FileType.Directory:
            system.delete_dir(staging)


class Files(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> FilesWriter:
        return FilesWriter(self.options["path"], self.options.get("between", ""), self.options["job"])


def write_files(rows: DataFrame, root: str, between: str = "", order: tuple[str, ...] = ()) -> None:
    """Write ``file, section, value`` below a root; rows of a file by section, then by the columns ``order``, which are not written."""
    spark: SparkSession = rows.sparkSession
    spark.dataSource.register(Files)
    rows = rows.repartition("file").sortWithinPartitions("file", "section", *order).selectExpr("file", "cast(section as int) section", "value")
    rows.write.format(NAME).mode("append").option("between", between).option("job", uuid.uuid4().hex).save(root)
