"""One side of nightly joins, stored once in buckets of each key it is matched on.

The same two systems are matched on the same keys every night, by several rules. Stored
here, a side is dealt to its buckets once per change, and every join reads both sides
bucket by bucket, without a shuffle of either.

A bucket can't be split. So rows without the key, which may be most of a side, and rows
of hot keys (`hot_keys`: each a fair partition's share of the rows, so few) are stored
apart, outside the buckets. They are joined by `match_hot` with the few rows of the other
side that have such a key, and these are all that moves.

A side's tables belong to one version, and the view `name` says which. A refresh writes
the new version's tables beside the old ones and then turns the view, so a reader has the
whole of one or of the other, and a refresh that breaks off changes nothing. Tables that
no view names any more are left to retention.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.predicates import quoted
from tallymark.operators.matching import hot_keys, match_anti, match_hot, match_inner
from tallymark.session import new_work_path, written_once

BUCKETS = 200


@dataclass(frozen=True)
class MatchTables:
    """A side that is matched on `keys`, under the view `name`.

    Sides that are joined need as many buckets and keys of one type.
    """

    spark: SparkSession
    name: str
    keys: Sequence[str]
    buckets: int = BUCKETS
    root: str | None = None  # where tables go; the shared folder by default

    def _path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}" if self.root else new_work_path(self.spark, table)

    def refresh(self, side: DataFrame) -> None:
        """Store the side anew, in the buckets of every key."""
        version = uuid.uuid4().hex
        side = written_once(side, self.name)
        for number, key in enumerate(self.keys):
            column = quoted(key)
            hot = [value for value in hot_keys(side, key) if value is not None]
            apart = column.isNull() | (column.isin(hot) if hot else F.lit(False))
            dealt = side.where(~apart).repartition(self.buckets, column)
            table = f"{self.name}_{version}_{number}"
            writer = dealt.write.format("parquet").option("path", self._path(table))
            writer.bucketBy(self.buckets, key).sortBy(key).saveAsTable(table)
            side.where(apart).write.format("parquet").option("path", self._path(f"{table}_apart")).saveAsTable(f"{table}_apart")
        self.spark.sql(f"CREATE OR REPLACE VIEW `{self.name}` AS SELECT '{version}' AS version")

    def read(self) -> Stored:
        """The side as of now; one object reads one version, whatever is refreshed later."""
        return Stored(self, self.spark.table(f"`{self.name}`").first()["version"])


@dataclass(frozen=True)
class Stored:
    """A version of a side."""

    tables: MatchTables
    version: str

    def _table(self, key: str, kind: str = "") -> DataFrame:
        number = list(self.tables.keys).index(key)
        return self.tables.spark.table(f"`{self.tables.name}_{self.version}_{number}{kind}`")

    def dealt(self, key: str) -> DataFrame:
        """Rows in buckets of the key: neither null nor hot."""
        return self._table(key)

    def crowded(self, key: str) -> DataFrame:
        """Rows of hot keys."""
        return self._table(key, "_apart").where(quoted(key).isNotNull())

    def unkeyed(self, key: str) -> DataFrame:
        """Rows without the key."""
        return self._table(key, "_apart").where(quoted(key).isNull())

    def hot(self, key: str) -> list:
        """The hot keys, no more than `hot_keys` can find."""
        return [row[0] for row in self.crowded(key).select(quoted(key)).distinct().collect()]

    def rows(self) -> DataFrame:
        """All rows, as they were given."""
        key = self.tables.keys[0]
        return self.dealt(key).unionByName(self._table(key, "_apart"))


def _checked(left: Stored, right: Stored, left_key: str, right_key: str) -> None:
    if left.tables.buckets != right.tables.buckets:
        raise ValueError("sides that are joined need as many buckets")
    kinds = [side.dealt(key).schema[key].dataType for side, key in ((left, left_key), (right, right_key))]
    if kinds[0] != kinds[1]:
        raise ValueError(f"keys of one type are needed, not {kinds[0].simpleString()} and {kinds[1].simpleString()}")


def match_stored(left: Stored, right: Stored, left_key: str, right_key: str) -> DataFrame:
    """Inner join; rows in buckets stay where they are."""
    _checked(left, right, left_key, right_key)
    parts = [match_inner(left.dealt(left_key), right.dealt(right_key), left_key, right_key)]
    hot, hot_right = left.hot(left_key), right.hot(right_key)
    if hot:
        few = right.dealt(right_key).union(right.crowded(right_key)).where(quoted(right_key).isin(hot))
        parts.append(match_hot(left.crowded(left_key), few, left_key, right_key, hot=hot))
    if hot_right:
        few = left.dealt(left_key).where(quoted(left_key).isin(hot_right))
        back = match_hot(right.crowded(right_key), few, right_key, left_key, hot=hot_right)
        parts.append(back.select(*map(quoted, parts[0].columns)))
    return reduce(DataFrame.union, parts)


def match_anti_stored(left: Stored, right: Stored, left_key: str, right_key: str) -> DataFrame:
    """Left rows without a match, those without the key included; rows in buckets stay where they are."""
    _checked(left, right, left_key, right_key)
    hot, hot_right = left.hot(left_key), right.hot(right_key)
    rest = left.dealt(left_key)
    if hot_right:  # known to have a match
        rest = rest.where(~quoted(left_key).isin(hot_right))
    keys = right.dealt(right_key).select(quoted(right_key).alias("_key"))
    alone = rest.join(keys, quoted(left_key) == F.col("_key"), "left_anti")
    parts = [alone, left.unkeyed(left_key)]
    single = [value for value in hot if value not in set(hot_right)]
    if single:
        few = right.dealt(right_key).where(quoted(right_key).isin(single))
        crowd = left.crowded(left_key).where(quoted(left_key).isin(single))
        parts.append(match_anti(crowd, few, left_key, right_key, hot=single))
    return reduce(DataFrame.union, parts)
