"""Repeated runs over a growing folder of recordings.

The file stream only keeps track of which files are new (exactly once, in its
checkpoint); each batch of files goes through the same processing as a full run,
against the duplicate index that earlier batches left behind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepforge.functions import text as T
from stepforge.operators import export
from stepforge.plans.factory_run import RunOptions, RunTables, open_index, process, publish
from stepforge.sources import sinks
from stepforge.sources.recordings import scan_lines
from stepforge.storage import exists, temporary

FILES_PER_BATCH = 1000


def start_incremental(spark: SparkSession, recordings_dir: str, work_dir: str, facts: DataFrame,
                      regions: DataFrame | None = None, responses: DataFrame | None = None,
                      options: RunOptions = RunOptions(), pattern: str = "*.jsonl",
                      files_per_batch: int = FILES_PER_BATCH, trigger: dict | None = None,
                      on_batch: Callable[[RunTables, int], None] | None = None,
                      out_dir: str | None = None, version: str = "1.0.0"):
    """Start following ``recordings_dir``.

    Each batch leaves what a full run leaves: scores (``work_dir/scored/batch_id=N``), its
    part of the duplicate index, registry rows, events and membership; with ``out_dir``
    also training examples (``v.../batch=N``).  A repeated batch replaces itself.  Batches
    and full runs may share a work folder.
    """
    version = T.canonical_version(version)
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(recordings_dir)
        .select("path")  # the bytes are not read here
    )

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [r.path for r in batch.collect()]  # at most files_per_batch names
        if not paths:
            return
        run = f"batch-{batch_id:09d}"
        with temporary(spark):
            index = open_index(spark, work_dir, run, options)
            stored = f"{work_dir}/annotation_cache"
            cache = spark.read.parquet(stored) if exists(spark, stored) else None
            tables = process(scan_lines(spark, paths, pattern), facts, regions, options, responses, cache, index)
            tables.scored.write.mode("overwrite").parquet(f"{work_dir}/scored/batch_id={batch_id}")
            index.add(tables.kept)
            approved = publish(spark, tables, work_dir, version, run, responses is not None)
            if out_dir:
                wanted = approved.where(F.col("training_stage").isin(list(options.export_stages)))
                sinks.write_examples(export.build_examples(wanted, options.agent_name), out_dir, version, f"batch={batch_id}")
            if on_batch:
                on_batch(tables, batch_id)

    return (
        files.writeStream.option("checkpointLocation", f"{work_dir}/stream_checkpoint")
        .foreachBatch(run_batch)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
