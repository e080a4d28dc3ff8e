"""Where intermediate tables go.

Iterative jobs cut their lineage by writing a Parquet table into the shared
folder the cluster names in ``spark.checkpoint.dir``; a lost executor then only
costs the tasks it was running.  Only a session on one machine (local master) may
leave the folder unnamed; it then gets one of its own.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_fallback: str | None = None
_made = threading.local()  # .paths: folders this thread has named, in order, inside ``temporary``


def shared_folder(spark: SparkSession) -> str:
    """Raises ValueError when a cluster session names no shared folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    global _fallback
    if _fallback is None:
        _fallback = tempfile.mkdtemp(prefix="spark-")
    return _fallback


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, unique path below the shared folder."""
    path = f"{shared_folder(spark)}/stepforge/{label}-{uuid.uuid4().hex}"
    if getattr(_made, "paths", None) is not None:
        _made.paths.append(path)
    return path


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that are written to the shared folder inside the block.

    Whatever is needed later must have been written elsewhere before the block ends.
    Tables of other threads are not touched.
    """
    outer, _made.paths = getattr(_made, "paths", None), []
    try:
        yield
    finally:
        for path in _made.paths:
            remove_folder(spark, path)
        _made.paths = outer


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table whose last reader has been written."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def materialize(df: DataFrame, label: str = "table", **options: str) -> DataFrame:
    """Write ``df`` once and read it back; ``options`` are the writer's.

    The result has no lineage beyond the written files and carries real size
    statistics, so Catalyst decides on broadcasts from facts.
    """
    return Written(df, label, **options).table


class Written:
    """A table written to the shared folder; ``drop`` deletes it after its last use."""

    def __init__(self, df: DataFrame, label: str = "table", **options: str):
        self.spark = df.sparkSession
        self.path = new_folder(self.spark, label)
        df.write.options(**options).parquet(self.path)
        self.table = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        remove_folder(self.spark, self.path)
