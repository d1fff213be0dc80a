"""Daily documents taken in as they arrive, each one once.

A stream over the documents' folder keeps in its checkpoint which files it has seen; a
run takes what is new and ends. Documents are taken apart into record texts, which land in
a table, one folder per batch. A batch that is repeated after a failure has the same number
and the same files, and replaces its own folder, so every record lands once.

With the records land the schemas of the batch's days, so drift over all days is known
without reading older records again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.text import decoded, printable
from tallymark.operators.nested_drift import DRIFT_SCHEMA, combined, day_schemas, drift_of_schemas, schema_of
from tallymark.sources.json_documents import path_day, record_texts, typed_records

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
RECORD_SCHEMA = "day date, record string, batch long"
DAY_SCHEMA = "day date, schema string, batch long"


@dataclass(frozen=True)
class Landing:
    """Where a table's documents come from and where their records go."""

    spark: SparkSession
    base: str  # holds <year>/<month>/<day>/
    root: str
    files: str  # names of the documents, such as accounts.json

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _put(self, rows: DataFrame, name: str, batch: int) -> None:
        tagged = rows.withColumn("batch", F.lit(batch).cast("long"))
        writer = tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch").parquet(self._at(name))

    def _land(self, documents: DataFrame, batch: int) -> None:
        texts = printable(decoded(F.col("content")))
        records = record_texts(documents.select(path_day(F.col("path")).alias("day"), texts.alias("text")), F.col("text"), "day")
        self._put(records, "records", batch)
        landed = self.spark.read.schema(RECORD_SCHEMA).parquet(self._at("records")).where(F.col("batch") == batch)
        self._put(day_schemas(landed, "day"), "schemas", batch)

    def ingest(self, files_per_batch: int | None = None) -> int:
        """Take in the documents that have come since the last call; returns their number.

        A broken document fails its batch and is tried again next time; the batches
        before it stay. `files_per_batch` bounds a batch, as after a long pause.
        """
        reader = self.spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", self.files)
        if files_per_batch is not None:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        writer = reader.load(self.base).writeStream.foreachBatch(self._land).trigger(availableNow=True)
        query = writer.option("checkpointLocation", self._at("checkpoint")).start()
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    def _read(self, name: str, schema: str) -> DataFrame:
        """A landed table; empty before the first batch."""
        try:
            return self.spark.read.schema(schema).parquet(self._at(name))
        except Exception as error:
            if getattr(error, "getCondition", lambda: None)() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def texts(self) -> DataFrame:
        """(day, record, batch) of all that has landed."""
        return self._read("records", RECORD_SCHEMA)

    def records(self, schema: T.StructType | str) -> DataFrame:
        """All landed records as columns, next to `day` and `batch`."""
        return typed_records(self.texts(), schema, "day", "batch")

    def drift(self) -> DataFrame:
        """Drift per day over all that has landed, from the landed schemas alone.

        Documents of one day may come in several batches; their schemas are combined.
        """
        days: dict = {}
        for row in self._read("schemas", DAY_SCHEMA).where("day IS NOT NULL AND schema IS NOT NULL").orderBy("day", "batch").collect():
            kind = schema_of(row.schema)
            days[row.day] = combined(days[row.day], kind) if row.day in days else kind
        return self.spark.createDataFrame(drift_of_schemas(list(days.items())), DRIFT_SCHEMA)
