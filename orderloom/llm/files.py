"""Files of our own formats in the shared folder, opened by Python code in tasks."""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

from pyarrow import fs
from pyspark import TaskContext


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI (local, HDFS, object stores) and the path in it."""
    if urlsplit(path).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlsplit(path).path
    return fs.FileSystem.from_uri(path)


def mounted_path(path: str) -> str | None:
    """The plain path of a file in a folder that all nodes have mounted; none in other stores."""
    system, inner = filesystem(path)
    return inner if isinstance(system, fs.LocalFileSystem) else None


def own_file(folder: str, suffix: str) -> str:
    """A name that no other task or attempt of a task uses.

    A task names the files it wrote in the rows it returns. Spark keeps the rows of one
    successful attempt per task, so what a lost or repeated attempt wrote is never read.
    """
    return f"{folder.rstrip('/')}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}{suffix}"


class Sink:
    """An output file that knows how much was written."""

    def __init__(self, path: str):
        system, inner = filesystem(path)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.path, self.size, self._out = path, 0, system.open_output_stream(inner, compression=None)

    def write(self, data: bytes) -> None:
        self._out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self._out.close()


def open_input(path: str):
    system, inner = filesystem(path)
    return system.open_input_file(inner)
