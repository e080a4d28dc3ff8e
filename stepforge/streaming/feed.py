"""Live status feed of agent tasks.

New steps arrive as files.  Per task the feed emits ``step_update`` when the latest
step changes and ``task_finished`` once; a finished task stays silent afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from stepforge.operators.history import status_of

STEP_SCHEMA = (
    "task_id string, step_index long, action_type string, success boolean, error string, "
    "reasoning string, screenshot_path string"
)
EVENT_SCHEMA = (
    "task_id string, event string, status string, step long, action string, success boolean, "
    "error string, reasoning string, screenshot string"
)
IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def latest_per_batch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Only the newest step of a task matters, so each Arrow batch is reduced to one
    row per task before the shuffle; a task with very many steps sends few rows."""
    for frame in frames:
        yield frame.loc[frame.groupby("task_id", sort=False)["step_index"].idxmax()] if len(frame) else frame


def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState,
           forget_after_ms: int | None = None) -> Iterator[pd.DataFrame]:
    """State per task: last reported step and whether the end was reported.

    A finished task stays silent for good; its state is a few bytes.  Only with
    ``forget_after_ms`` the state goes that long after the end, and a still later
    step would then be reported anew.
    """
    if state.hasTimedOut:
        state.remove()
        return
    last, finished = state.get if state.exists else (-1, False)
    newest = None
    for frame in frames:
        row = frame.loc[frame["step_index"].idxmax()]
        if newest is None or row["step_index"] > newest["step_index"]:
            newest = row
    if finished or newest is None or int(newest["step_index"]) <= last:
        return
    text = lambda v: None if v is None or pd.isna(v) else str(v)
    status = text(newest["status"])
    ended = status in ("completed", "failed")
    events = [
        (key[0], "step_update", status, int(newest["step_index"]), text(newest["action_type"]),
         bool(newest["success"]), text(newest["error"]), (text(newest["reasoning"]) or "")[:100],
         text(newest["screenshot_path"]))
    ]
    if ended:
        events.append((key[0], "task_finished", status, None, None, None, None, None, None))
        if forget_after_ms is not None:
            state.setTimeoutDuration(forget_after_ms)
    state.update((int(newest["step_index"]), ended))
    out = pd.DataFrame(events, columns=[c.split()[0] for c in EVENT_SCHEMA.split(", ")])
    yield out.astype({"step": "Int64", "success": "boolean"})


def task_events(steps: DataFrame, forget_after_ms: int | None = None) -> DataFrame:
    """Feed events of a stream of steps."""
    rated = steps.withColumn("status", status_of(F.col("action_type"), F.col("error")))
    newest = rated.mapInPandas(latest_per_batch, rated.schema)
    timeout = GroupStateTimeout.NoTimeout if forget_after_ms is None else GroupStateTimeout.ProcessingTimeTimeout

    def keep(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        return follow(key, frames, state, forget_after_ms)

    return newest.groupBy("task_id").applyInPandasWithState(
        keep, EVENT_SCHEMA, "last_step long, finished boolean", "update", timeout,
    )


def start_feed(spark: SparkSession, steps_dir: str, out_dir: str, checkpoint_dir: str,
               trigger: dict | None = None, forget_after_ms: int | None = None):
    """Follow a folder of step files (Parquet); events are appended to ``out_dir``.

    ``trigger`` defaults to one second; {"availableNow": True} drains and stops.
    """
    steps = spark.readStream.schema(STEP_SCHEMA).parquet(steps_dir)

    def append(batch: DataFrame, batch_id: int) -> None:
        # the folder name makes a repeated batch overwrite itself
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    writer = (
        task_events(steps, forget_after_ms).writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint_dir)
        .foreachBatch(append)
        .trigger(**(trigger or {"processingTime": "1 second"}))
    )
    # old tombstones may wait for the next steps: no batches for timeouts alone, which
    # would also keep a draining query from ever ending
    before = spark.conf.get(IDLE_BATCHES)
    spark.conf.set(IDLE_BATCHES, "false")
    try:
        return writer.start()
    finally:
        spark.conf.set(IDLE_BATCHES, before)


def waiting_tasks(tasks: DataFrame, steps: DataFrame) -> DataFrame:
    """Tasks without any step yet."""
    waiting = tasks.select("task_id").join(steps.select("task_id").distinct(), "task_id", "left_anti")
    return waiting.select(
        "task_id", F.lit("waiting").alias("event"), F.lit("Task not started yet").alias("message")
    )
