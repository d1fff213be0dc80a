"""A snapshot history that is swapped whole.

Every refresh writes a version in a folder of its own and then puts a pointer to it in
place, a file `current-<number>` that appears in one step. A reader follows the highest
pointer, so it sees the last whole version whatever happens to a refresh; one that broke off
leaves a folder nothing points to. Of two refreshes that began from the same version the
second finds its pointer there already and fails, instead of losing the first one's rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallymark.operators.drift import snapshot_union
from tallymark.sinks.folders import Folder
from tallymark.sources.files import read_history

POINTER = "current-"


class ConcurrentRefresh(RuntimeError):
    """Another refresh has taken the next version."""


@dataclass(frozen=True)
class History:
    """Versions of a CSV history below one folder."""

    spark: SparkSession
    root: str

    def _folder(self) -> Folder:
        return Folder(self.spark, self.root)

    def _current(self, folder: Folder) -> tuple[int, str]:
        """Number and folder of the last whole version, (0, '') before the first."""
        pointers = [e.name for e in folder.entries() if e.name.startswith(POINTER)]
        if not pointers:
            return 0, ""
        return int(pointers[-1].removeprefix(POINTER)), folder.read(pointers[-1])

    def read(self, schema: T.StructType | str) -> DataFrame:
        """Rows of the last whole version; none before the first refresh."""
        folder = self._folder()
        _, name = self._current(folder)
        if not name:
            return self.spark.createDataFrame([], schema)
        return read_history(self.spark, folder.at(name), schema)

    def refresh(self, new: DataFrame) -> int:
        """Put new rows ahead of the history; returns the number of the version.

        The history is read with the columns of the new rows.
        """
        folder = self._folder()
        number, old = self._current(folder)
        rows = snapshot_union(new, read_history(self.spark, folder.at(old), new.schema)) if old else new
        name = f"version-{number + 1:09d}-{uuid.uuid4().hex}"
        rows.write.option("header", True).option("sep", ",").csv(folder.at(name))
        if not folder.create_once(f"{POINTER}{number + 1:09d}", name):
            folder.remove(name)
            raise ConcurrentRefresh(f"version {number + 1} of {self.root} was written meanwhile")
        return number + 1

    def keep(self, versions: int) -> int:
        """Remove all versions but the last ones, whole or broken off, and their pointers; returns how many."""
        if versions < 1:
            raise ValueError("the version in use stays")
        folder = self._folder()
        number, _ = self._current(folder)
        old = [e for e in folder.entries() if int(e.name.split("-")[1]) <= number - versions]
        for entry in old:
            folder.remove(entry.name)
        return sum(e.is_folder for e in old)
