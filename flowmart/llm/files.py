"""Files that tasks write to and read from the shared folder."""

from __future__ import annotations

import contextlib
import posixpath
from collections.abc import Iterator

import pyarrow.fs
from pyspark import TaskContext


def located(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a URI or an absolute path."""
    return pyarrow.fs.FileSystem.from_uri(path)


def partition_id() -> int:
    return TaskContext.get().partitionId()


@contextlib.contextmanager
def committed(path: str) -> Iterator[object]:
    """A file that appears under its name when complete.

    Each attempt of a task writes a file of its own; the last one to end gives the name
    its content, which is the same for all, as tasks get the same rows in the same order.
    """
    files, name = located(path)
    files.create_dir(posixpath.dirname(name), recursive=True)
    attempt = f"{name}.attempt-{TaskContext.get().taskAttemptId()}"
    try:
        with files.open_output_stream(attempt) as stream:
            yield stream
    except BaseException:
        with contextlib.suppress(OSError):
            files.delete_file(attempt)
        raise
    files.move(attempt, name)


class Ranges:
    """Range reads of a folder's files; one file is kept open."""

    def __init__(self, folder: str):
        self.files, self.folder = located(folder)
        self.name, self.file = "", None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            if self.file:
                self.file.close()
            self.file = self.files.open_input_file(f"{self.folder}/{name}")
            self.name = name
        data = self.file.read_at(length, offset)
        if len(data) != length:
            raise OSError(f"{name}: {length} bytes expected at {offset}, {len(data)} found")
        return data
