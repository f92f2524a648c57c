"""A sink of binary files that commits: files are written aside by each task and moved to their place when all tasks are done."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT = "framewright_files"


@dataclass
class TaskFiles(WriterCommitMessage):
    """The folder that one attempt of a task has filled."""

    folder: str
    files: int


class FilesWriter(DataSourceWriter):
    """Each attempt of a task has a folder of its own below `_aside/<job>`, so that a lost or doubled attempt leaves nothing that counts. Commit moves the
    files of the attempts that Spark took; a file that is there already stays as it is, since only whole files ever get there. Abort clears the job's folder."""

    def __init__(self, folder: str, overwrite: bool):
        self.folder, self.overwrite, self.job = folder.rstrip("/"), overwrite, uuid.uuid4().hex

    def _place(self) -> tuple[pafs.FileSystem, str, str]:
        system, root = pafs.FileSystem.from_uri(self.folder) if ":/" in self.folder else (pafs.LocalFileSystem(), self.folder)
        return system, root, f"{root}/_aside/{self.job}"

    def write(self, iterator: Iterator) -> TaskFiles:
        system, _, aside = self._place()
        own, count = f"{aside}/{uuid.uuid4().hex}", 0
        system.create_dir(own, recursive=True)
        for row in iterator:
            with system.open_output_stream(f"{own}/{_checked(row['name'])}") as f:
                f.write(bytes(row["content"] or b""))
            count += 1
        return TaskFiles(own, count)

    def commit(self, messages: list[TaskFiles | None]) -> None:
        system, root, aside = self._place()
        for message in messages:
            if message is None:
                continue
            for info in system.get_file_info(pafs.FileSelector(message.folder)):
                target = f"{root}/{info.base_name}"
                if self.overwrite or system.get_file_info(target).type == pafs.FileType.NotFound:
                    system.move(info.path, target)
        self._clear(system, aside)

    def abort(self, messages: list[TaskFiles | None]) -> None:
        system, _, aside = self._place()
        self._clear(system, aside)

    @staticmethod
    def _clear(system: pafs.FileSystem, aside: str) -> None:
        with contextlib.suppress(FileNotFoundError):
            system.delete_dir(aside)


def _checked(name: str) -> str:
    if not name or "/" in name or name in (".", "..", "_aside"):
        raise ValueError(f"{name!r} is no name of a file")
    return name


class FilesSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> FilesWriter:
        return FilesWriter(self.options["path"], overwrite)


def save_files(files: DataFrame, folder: str, overwrite: bool = False) -> None:
    """Write files (name, content) into a folder that all executors share; what is there already stays, or with overwrite gives way. A name that repeats is written once."""
    spark: SparkSession = files.sparkSession
    spark.dataSource.register(FilesSink)
    once = files.select("name", "content").dropDuplicates(["name"])
    once.write.format(FORMAT).mode("overwrite" if overwrite else "append").option("path", folder).save()
