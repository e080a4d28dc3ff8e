"""Step history of agent tasks: status, recent steps, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def recent_steps(steps: DataFrame, n: int = 10) -> DataFrame:
    """The last ``n`` steps per task; Spark keeps at most n per task before the shuffle."""
    newest = Window.partitionBy("task_id").orderBy(F.desc("step_index"))
    return steps.withColumn("back", F.row_number().over(newest)).where(F.col("back") <= n)


def status_of(last_action: Column, last_error: Column) -> Column:
    return (
        F.when(last_action == "done", "completed")
        .when(last_action == "fail", "failed")
        .when(F.coalesce(last_error, F.lit("")) != "", "failed")
        .otherwise("running")
    )


def task_status(steps: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """(task_id, status, n_steps); tasks without steps are running."""
    last = F.max_by(F.struct("action_type", "error"), "step_index")
    rolled = steps.groupBy("task_id").agg(last.alias("last"), F.count(F.lit(1)).alias("n_steps"))
    if tasks is not None:
        rolled = tasks.select("task_id").join(rolled, "task_id", "left")
    return rolled.select(
        "task_id",
        status_of(F.col("last.action_type"), F.col("last.error")).alias("status"),
        F.coalesce("n_steps", F.lit(0)).cast("long").alias("n_steps"),
    )


def task_results(steps: DataFrame) -> DataFrame:
    """Per task: success, number of steps, last description, outcome text."""
    last = F.max_by(F.struct("action_type", "error", "description"), "step_index")
    rolled = steps.groupBy("task_id").agg(last.alias("last"), F.count(F.lit(1)).alias("n_steps"))
    success = status_of(F.col("last.action_type"), F.col("last.error")) == "completed"
    said = F.when(F.col("last.action_type").isNotNull(), F.coalesce("last.description", F.lit(""))).otherwise("")
    failed = F.lit("Task did not complete successfully")
    return rolled.select(
        "task_id",
        success.alias("success"),
        "n_steps",
        F.when(said != "", said).when(~success, failed).otherwise("SUCCESS").alias("outcome"),
    )


def report_lines(steps: DataFrame) -> DataFrame:
    """The step log of the report as rows (task_id, step_index, part, line).

    A report of a long task stays many rows; sort by step_index and part to print it.
    """
    flag = F.when(F.col("success"), "OK").otherwise("FAIL")
    info = F.when(
        F.col("action_type").isNotNull(), F.concat(F.col("action_type"), F.lit(" "), flag)
    ).otherwise("no action")
    entry = F.format_string("  [%02d] %s", F.col("step_index"), info)
    problem = F.when(
        F.coalesce("error", F.lit("")) != "", F.concat(F.lit("       Error: "), F.col("error"))
    )
    return steps.select(
        "task_id", "step_index", F.posexplode(F.array_compact(F.array(entry, problem))).alias("part", "line")
    )


def screenshots(steps: DataFrame) -> DataFrame:
    return steps.where("screenshot_path != ''").select("task_id", "step_index", "screenshot_path", "action_type")
