"""Run metrics from the labelled rows of one run - aggregates, no counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def funnel(rows: DataFrame) -> DataFrame:
    """(stage, processed, passed, failed, pass_rate, fail_rate).

    Needs ingested, gate_status, enrich_failed, approved per physical input row;
    one pass over the data, then five rows are unfolded.
    """
    ingested = F.col("ingested")
    valid = ingested & (F.col("gate_status") != "rejected")
    good = valid & ~F.col("enrich_failed")
    approved = valid & F.col("approved")
    pairs = [
        ("ingestion", F.lit(True), ingested),
        ("validation", ingested, valid),
        ("enrichment", valid, good),
        ("annotation", valid, valid),
        ("curation", valid, approved),
    ]
    totals = rows.agg(
        *[
            F.struct(
                F.lit(name).alias("stage"),
                F.count_if(F.coalesce(entered, F.lit(False))).alias("processed"),
                F.count_if(F.coalesce(passed, F.lit(False))).alias("passed"),
            ).alias(name)
            for name, entered, passed in pairs
        ]
    )
    n = F.greatest(F.col("processed"), F.lit(1))
    return (
        totals.select(F.explode(F.array(*[name for name, _, _ in pairs])).alias("c"))
        .select("c.*")
        .withColumn("failed", F.col("processed") - F.col("passed"))
        .withColumn("pass_rate", F.col("passed") / n)
        .withColumn("fail_rate", F.col("failed") / n)
    )


def rejection_counts(rows: DataFrame) -> DataFrame:
    """(reason, n): failing gate, the first 40 characters of each warning, quality
    rejections, and rows that fit no stage."""
    gate = F.array(F.when(F.col("gate_status") == "rejected", F.col("failed_gate")))
    warned = F.when(
        F.col("gate_status") == "quarantined",
        F.transform("warnings", lambda w: F.concat(F.lit("warning:"), F.substring(w, 1, 40))),
    ).otherwise(F.array().cast("array<string>"))
    later = F.array(
        F.col("rejection_reason"),
        F.when(F.col("approved") & (F.col("training_stage") == ""), "no_stage_assigned"),
    )
    return (
        rows.select(F.explode(F.array_compact(F.concat(gate, warned, later))).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_reasons(counts: DataFrame, n: int = 10) -> DataFrame:
    return counts.orderBy(F.desc("n"), "reason").limit(n)


def quality_bucket(score: Column) -> Column:
    return (
        F.when(score >= 0.9, "0.90-1.00")
        .when(score >= 0.8, "0.80-0.90")
        .when(score >= 0.7, "0.70-0.80")
        .when(score >= 0.6, "0.60-0.70")
        .otherwise("0.00-0.60")
    )


def histogram(rows: DataFrame, score: str = "composite") -> DataFrame:
    return rows.groupBy(quality_bucket(F.col(score)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def shares(rows: DataFrame, column: str) -> DataFrame:
    """(value, n, pct) - the window runs over the few counted values only."""
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counted.withColumn("pct", F.col("n") / total * 100)


def overall_yield(n_exported: Column, n_ingested: Column) -> Column:
    return F.when(n_ingested > 0, n_exported / n_ingested * 100)
