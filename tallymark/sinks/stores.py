"""Where result tables live: a folder, a catalog database or a JDBC database."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from hashlib import sha256
from typing import Protocol
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark import fixed_values as fv
from tallymark.functions.predicates import quoted
from tallymark.operators.shape import renamed, to_logical
from tallymark.session import shared_folder
from tallymark.sinks.folders import Folder
from tallymark.sources.jdbc import Connection, quoted_table, read_relation


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


class Store(Protocol):
    spark: SparkSession

    def create(self, table: str, schema: T.StructType) -> None: ...

    def read(self, table: str) -> DataFrame: ...

    def append(self, df: DataFrame, table: str) -> None: ...

    def claims(self) -> Folder:
        """Where publishers into this store claim their keys."""
        ...


@dataclass(frozen=True)
class FolderStore:
    """Parquet tables below one folder, partitioned by the run key if asked.

    With the run key as partition a report of the latest run reads only that
    run, and replacing or removing a run touches only its folder. Several
    publishers may append at once: each writes to a folder of its own and moves
    the files in, since two writers of one folder remove each other's files.
    """

    spark: SparkSession
    root: str
    partitions: Mapping[str, str] = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def create(self, table: str, schema: T.StructType) -> None:
        empty_frame(self.spark, schema).write.mode("ignore").parquet(self.path(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def claims(self) -> Folder:
        return Folder(self.spark, f"{self.root.rstrip('/')}/_claims")

    def append(self, df: DataFrame, table: str) -> None:
        root, staged = Folder(self.spark, self.root), f"_staged/{uuid.uuid4().hex}"
        writer = df.write
        if table in self.partitions:
            writer = writer.partitionBy(self.partitions[table])
        writer.parquet(root.at(staged))
        root.take_in(root.at(staged), table)
        root.remove(staged)

    def replace_run(self, df: DataFrame, table: str) -> None:
        """Replace the runs whose keys are in `df`; files of other runs are not touched.

        Spark writes the new files aside and puts whole run folders in place at the end, so
        a job that fails leaves the runs as they were. A reader that lists the table in
        just that moment misses the run; it has to read again.
        """
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(self.partitions[table]).parquet(self.path(table))

    def drop_run(self, table: str, key: int) -> bool:
        """Remove one run from a table partitioned by the run key; whether there was one.

        Its row stays in the run log: the key was given out.
        """
        return Folder(self.spark, self.path(table)).remove(f"{self.partitions[table]}={int(key)}")

    def update(self, table: str, rows: Column, values: Mapping[str, Column]) -> int:
        """Set columns of the few rows that match; returns how many files held some.

        Each file that holds one is written anew and swapped in by a rename, so a
        reader sees the file before or after. Meant for run rows: such a file has the rows
        of one run. Not for partitioned tables.
        """
        if table in self.partitions:
            raise ValueError(f"{table} is partitioned: replace its runs")
        root, held = Folder(self.spark, self.path(table)), self.read(table)
        files = [r.file for r in held.where(rows).select(F.input_file_name().alias("file")).distinct().collect()]
        for file in files:
            staged = Folder(self.spark, f"{self.root.rstrip('/')}/_staged/{uuid.uuid4().hex}")
            old = self.spark.read.schema(held.schema).parquet(file)
            new = old.withColumns({c: F.when(rows, v).otherwise(quoted(c)) for c, v in values.items()})
            new.select(*map(quoted, held.columns)).coalesce(1).write.parquet(staged.root)
            part = next(e for e in staged.entries() if e.name.endswith(".parquet"))
            root.swap_in(part.path, unquote(file).rsplit("/", 1)[-1])
            staged.remove("")
        self.spark.catalog.refreshByPath(self.path(table))
        return len(files)


@dataclass(frozen=True)
class CatalogStore:
    """Tables of the session catalog."""

    spark: SparkSession
    database: str
    partitions: Mapping[str, str] = field(default_factory=dict)

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def create(self, table: str, schema: T.StructType) -> None:
        empty_frame(self.spark, schema).write.mode("ignore").saveAsTable(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def append(self, df: DataFrame, table: str) -> None:
        name = self.name(table)
        if self.spark.catalog.tableExists(name):
            columns = self.read(table).columns
            df.select(*map(quoted, columns)).write.insertInto(name)
            return
        writer = df.write.mode("append")
        if table in self.partitions:
            writer = writer.partitionBy(self.partitions[table])
        writer.saveAsTable(name)

    def claims(self) -> Folder:
        """In the shared folder: a database may lie in several places, or in none."""
        return Folder(self.spark, f"{shared_folder(self.spark).rstrip('/')}/_claims/{self.database}")

    def drop_run(self, table: str, key: int) -> None:
        """Remove one run from a table partitioned by the run key."""
        column = self.partitions[table]
        self.spark.sql(
            f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION (`{column}` = {int(key)})"
        )


@dataclass(frozen=True)
class JdbcStore:
    """Tables of a database.

    Each task commits its own rows. If a task is repeated after its commit its
    rows arrive twice, so `publish_run` compares the stored count before the
    run becomes visible. PostgreSQL takes arrays as they are; for databases
    without arrays they are stored as JSON text.
    """

    spark: SparkSession
    connection: Connection
    writers: int = 8
    arrays_as_text: bool = False

    def _save(self, df: DataFrame, table: str, mode: str) -> None:
        arrays = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
        if arrays and self.arrays_as_text:
            df = df.withColumns({c: F.to_json(quoted(c)) for c in arrays})
        (
            df.write.format("jdbc")
            .option("url", self.connection.url)
            .option("dbtable", quoted_table(table))
            .option("numPartitions", self.writers)
            .options(**self.connection.properties)
            .mode(mode)
            .save()
        )

    def create(self, table: str, schema: T.StructType) -> None:
        self._save(empty_frame(self.spark, schema), table, "ignore")

    def read(self, table: str) -> DataFrame:
        return read_relation(self.spark, self.connection, quoted_table(table))

    def append(self, df: DataFrame, table: str) -> None:
        self._save(df, table, "append")

    def claims(self) -> Folder:
        """In the shared folder, one chain for all users of a database."""
        name = sha256(self.connection.url.encode()).hexdigest()[:16]
        return Folder(self.spark, f"{shared_folder(self.spark).rstrip('/')}/_claims/{name}")


@dataclass(frozen=True)
class NamedTable:
    """Existing table behind a logical one, with its column names."""

    table: str
    columns: Mapping[str, str]


@dataclass(frozen=True)
class NamedStore:
    """Another store whose tables and columns carry the names already in use."""

    store: Store
    tables: Mapping[str, NamedTable]

    @property
    def spark(self) -> SparkSession:
        return self.store.spark

    def _named(self, table: str) -> NamedTable:
        known = self.tables.get(table, NamedTable(table, {}))
        return NamedTable(known.table, {"run_key": fv.RUN_LOG_COLUMNS["run_key"], **known.columns})

    def create(self, table: str, schema: T.StructType) -> None:
        named = self._named(table)
        fields = [T.StructField(named.columns.get(f.name, f.name), f.dataType, f.nullable) for f in schema]
        self.store.create(named.table, T.StructType(fields))

    def read(self, table: str) -> DataFrame:
        named = self._named(table)
        return to_logical(self.store.read(named.table), named.columns)

    def append(self, df: DataFrame, table: str) -> None:
        named = self._named(table)
        self.store.append(renamed(df, named.columns), named.table)

    def claims(self) -> Folder:
        return self.store.claims()
