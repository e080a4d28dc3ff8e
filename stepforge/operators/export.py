"""Eligibility, example assembly and export summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.functions import rendering as G
from stepforge.functions import text as T


def skip_reason(stage: Column) -> Column:
    """First reason why a row is not exported for ``stage``; NULL when it is."""
    blank = lambda name: T.strip(F.coalesce(F.col(name), F.lit(""))) == ""
    own = F.coalesce("training_stage", F.lit(""))
    return (
        F.when(F.col("status") != "approved", F.concat(F.lit("status:"), F.col("status")))
        .when((own != stage) & (own != D.STAGE_ALL), F.concat(F.lit("wrong_stage:"), own))
        .when(F.col("action_type").isNull(), "missing_raw")
        .when(blank("reasoning") & blank("description"), "missing_reasoning_and_description")
        .when(~F.col("file_exists"), "screenshot_missing")
    )


def stage_candidates(samples: DataFrame, stages: list[str] = D.EXPORT_STAGES) -> DataFrame:
    """Every row once per stage with its ``reason`` (NULL = exported)."""
    return samples.withColumn("stage", F.explode(F.array(*[F.lit(s) for s in stages]))).withColumn(
        "reason", skip_reason(F.col("stage"))
    )


def summary(samples: DataFrame, stages: list[str] = D.EXPORT_STAGES) -> DataFrame:
    """(stage, reason, n); reason 'exported' counts the written rows.

    Reasons per row are few, so the rows combine before the shuffle.
    """
    return (
        stage_candidates(samples, stages)
        .groupBy("stage", F.coalesce("reason", F.lit("exported")).alias("reason"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def stage_totals(counts: DataFrame) -> DataFrame:
    """exported / skipped / rate per stage from the summary rows.

    Rows of other stages count as skipped; ``wrong_stage`` tells how many.
    """
    exported = F.sum(F.when(F.col("reason") == "exported", F.col("n")).otherwise(0))
    other = F.sum(F.when(F.col("reason").startswith("wrong_stage:"), F.col("n")).otherwise(0))
    total = F.sum("n")
    return counts.groupBy("stage").agg(
        total.alias("total_samples"), exported.alias("exported"), (total - exported).alias("skipped"),
        other.alias("wrong_stage"), (exported / F.greatest(total, F.lit(1))).alias("export_rate"),
    )


def build_examples(samples: DataFrame, agent: str = D.AGENT_NAME,
                   previous_description: str | None = None) -> DataFrame:
    """Exported rows of every stage with both turns, prompt and JSON line.

    A row is exported for its own stage only, so no explode over stages is needed
    unless it is marked for all of them.
    """
    own = F.coalesce("training_stage", F.lit(""))
    every = F.array(*[F.lit(s) for s in D.EXPORT_STAGES])
    stages = F.when(own == D.STAGE_ALL, every).when(own.isin(D.EXPORT_STAGES), F.array(own))
    c = F.col
    eligible = samples.withColumn("stage", F.explode(stages)).where(skip_reason(c("stage")).isNull())
    previous = None if previous_description is None else c(previous_description)
    action = G.action_json(c("action_type"), c("coordinates"), c("text"), c("key"), c("description"))
    return (
        eligible.withColumn("action_json", action)
        .withColumn(
            "human",
            G.human_turn(c("task"), c("step_index"), c("regions"), c("ocr_text_raw"), c("action_type"),
                         c("coordinates"), c("description"), c("stage"), previous),
        )
        .withColumn("assistant", G.assistant_turn(c("task"), c("reasoning"), c("description"), c("action_json")))
        .withColumn("system", G.stage_prompt(c("stage"), agent))
        .withColumn("line", G.example_line(c("human"), c("assistant"), c("screenshot_path"), c("system")))
    )


def structure_error(conversations: Column, images: Column) -> Column:
    """Why an example is malformed, NULL when it is fine."""
    return structure_error_of(
        conversations.isNotNull(), F.size(conversations), images.isNotNull(), F.size(images)
    )


def structure_error_of(has_turns: Column, n_turns: Column, has_images: Column, n_images: Column) -> Column:
    return (
        F.when(~has_turns, "Missing conversations")
        .when(~has_images, "Missing images")
        .when(n_turns < 2, "Need >= 2 turns")
        .when(n_images < 1, "Need >= 1 image")
    )


def check_examples(examples: DataFrame) -> DataFrame:
    """Totals and errors of read examples; a nonzero error count should fail a run."""
    error = F.coalesce(
        F.when(F.col("_corrupt").isNotNull(), "Invalid JSON"),
        structure_error(F.col("conversations"), F.col("images")),
    )
    return examples.select(error.alias("error")).agg(
        F.count(F.lit(1)).alias("total"), F.count("error").alias("errors")
    )
