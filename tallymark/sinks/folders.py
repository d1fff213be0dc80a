"""Single steps on a shared folder: exclusive creation, moves, removal.

Only the driver takes them, a few a run. They go through the file system that Spark itself
uses for the path. Creating a file with its content, or not at all if it is there, is a hard
link on a local disk and a rename that refuses to overwrite elsewhere; moves and swaps are
renames. Each is one step on HDFS and on stores with a real namespace. Object stores that
copy on rename don't promise that: keep claims and pointers on one that does.
"""

from __future__ import annotations

import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

MOVERS = 16


@dataclass(frozen=True)
class Entry:
    """A file or folder found in a folder; `modified` in milliseconds."""

    path: str
    is_folder: bool
    modified: int

    @property
    def name(self) -> str:
        return self.path.rstrip("/").rsplit("/", 1)[-1]


def _local(path: str) -> str:
    return unquote(urlparse(path).path) if path.startswith("file:") else path


class Folder:
    """A folder in any file system Spark can write; names are relative to it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._system = self._path().getFileSystem(conf)
        self._context = self._hadoop.FileContext.getFileContext(self._system.getUri(), conf)

    def at(self, name: str = "") -> str:
        return f"{self.root}/{name}" if name else self.root

    def _path(self, name: str = ""):
        return self._hadoop.Path(self.at(name))

    def exists(self, name: str = "") -> bool:
        return self._system.exists(self._path(name))

    def entries(self, name: str = "") -> list[Entry]:
        """What lies in the folder, by name, without hidden files; nothing where there is no folder."""
        if not self.exists(name):
            return []
        found = [Entry(s.getPath().toString(), s.isDirectory(), s.getModificationTime()) for s in self._system.listStatus(self._path(name))]
        return sorted((e for e in found if not e.name.startswith((".", "_"))), key=lambda e: e.name)

    def remove(self, name: str) -> bool:
        """Whether there was something to remove."""
        return self._system.delete(self._path(name), True)

    def read(self, name: str) -> str:
        stream = self._system.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _staged(self, text: str) -> str:
        """Name of a new hidden file with the text."""
        name = f".{uuid.uuid4().hex}.tmp"
        stream = self._system.create(self._path(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return name

    def _rename(self, source: str, name: str, how: str) -> None:
        kind = self._hadoop.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.valueOf(how)
        self._context.rename(self._hadoop.Path(source), self._path(name), options)

    def create_once(self, name: str, text: str) -> bool:
        """Create a file with all its text; False, and nothing changed, if it is there already."""
        staged = self._staged(text)
        try:
            if self._system.getUri().getScheme() == "file":
                os.link(_local(self.at(staged)), _local(self.at(name)))
            else:
                self._rename(self.at(staged), name, "NONE")
        except FileExistsError:
            return False
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        finally:
            self.remove(staged)
        return True

    def swap_in(self, path: str, name: str) -> None:
        """Put another file, given by its path, in the place of one of this folder in one step."""
        self._rename(path, name, "OVERWRITE")

    def take_in(self, source: str, name: str = "") -> None:
        """Move a finished table's files below `name`, files of the same folders side by side.

        A folder that isn't there yet, such as that of a new run, moves in one step. Part
        files carry the id of their write, so no name meets another.
        """
        self._system.mkdirs(self._path(name))
        moves = []
        for entry in Folder(self.spark, source).entries():
            target = f"{name}/{entry.name}" if name else entry.name
            if entry.is_folder and self.exists(target):
                self.take_in(entry.path, target)
            else:
                moves.append((entry.path, target))
        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(lambda move: self._rename(*move, "NONE"), moves))
