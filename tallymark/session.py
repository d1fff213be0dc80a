"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session with adaptive execution on; sizing stays with the cluster.

    `settings` uses underscores for dots, e.g. `spark_driver_memory="8g"`.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in ADAPTIVE_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="tallymark-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_work_path(spark: SparkSession, name: str) -> str:
    """Unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The frame as a parquet table in the shared folder, evaluated once, now.

    For frames that several results use. The table outlives lost executors
    and a reader takes only the columns it needs. `compression` is Spark's own unless
    given, as for a table whose size counts more than the time to write it.
    """
    path = new_work_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_together(**frames: DataFrame) -> list[DataFrame]:
    """Several independent frames written at the same time, in the given order."""
    with ThreadPoolExecutor(len(frames)) as pool:
        session = next(iter(frames.values())).sparkSession
        write = inheritable_thread_target(session)(written_once)
        return list(pool.map(lambda item: write(item[1], item[0]), frames.items()))
