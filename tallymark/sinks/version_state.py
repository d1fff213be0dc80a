"""Latest versions kept in a bucketed table, into which each day's versions are merged.

Grouping the whole history every night shuffles all of it. Here the state is stored in
buckets of some of the describing columns: a merge scans it bucket by bucket, sends only
the day's rows into the same buckets, and groups both where they are. The merged state is
written next to the old one, already in its buckets, and a view then turns to it, so a
reader has the whole of one or of the other.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.predicates import quoted
from tallymark.operators.versions import latest_version
from tallymark.session import new_work_path

BUCKETS = 200


@dataclass(frozen=True)
class VersionState:
    """One row per combination of `describe` with its latest `version`, under the view `name`.

    `bucket_by` names some of the describing columns; nulls of a column fall into one
    bucket, so where an id is often missing another column belongs beside it.
    """

    spark: SparkSession
    name: str
    describe: Sequence[str]
    version: str
    bucket_by: Sequence[str]
    buckets: int = BUCKETS
    root: str | None = None  # where tables go; the shared folder by default

    def __post_init__(self):
        if not self.bucket_by or not set(self.bucket_by) <= set(self.describe):
            raise ValueError("buckets are made of describing columns")

    def _columns(self) -> list:
        return [quoted(c) for c in (*self.describe, self.version)]

    def _dealt(self, versions: DataFrame) -> DataFrame:
        """A day's latest versions in the state's buckets; combined before they move."""
        latest = latest_version(versions, self.describe, self.version).select(*self._columns())
        return latest.repartition(self.buckets, *map(quoted, self.bucket_by))

    def _store(self, state: DataFrame) -> None:
        table = f"{self.name}_{uuid.uuid4().hex}"
        path = f"{self.root.rstrip('/')}/{table}" if self.root else new_work_path(self.spark, table)
        writer = state.write.format("parquet").option("path", path)
        writer.bucketBy(self.buckets, *self.bucket_by).sortBy(*self.bucket_by).saveAsTable(table)
        self.spark.sql(f"CREATE OR REPLACE VIEW `{self.name}` AS SELECT * FROM `{table}`")

    def create(self, versions: DataFrame) -> None:
        """Begin the state, from no rows or from a history."""
        self._store(self._dealt(versions))

    def read(self) -> DataFrame:
        return self.spark.table(f"`{self.name}`")

    def merged(self, versions: DataFrame) -> DataFrame:
        """The state with more versions, in its buckets; versions may come late or again."""
        both = self.read().select(*self._columns()).union(self._dealt(versions))
        return latest_version(both, self.describe, self.version).select(*self._columns())

    def merge(self, versions: DataFrame) -> None:
        """Take a day's versions into the state. Tables that no view names any more are left to retention."""
        self._store(self.merged(versions))
