"""Chains that several queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.operators import dedup, enrich, gate
from stepforge.sources import adapters as A
from stepforge.storage import materialize


def with_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = A.samples(spark, sf_dir)
    facts = A.screenshot_facts(spark, sf_dir).drop("phash").withColumn("file_exists", F.lit(True))
    joined = samples.join(facts, samples.screenshot_path == facts.path, "left")
    return joined.withColumn("file_exists", F.coalesce("file_exists", F.lit(False)))


def standard_gate() -> gate.Gate:
    """schema, coordinates, image, dedup - in this order, image not fatal."""
    return (
        gate.Gate()
        .register("schema", gate.schema_reason, fatal=True, failed=gate.schema_failed)
        .register("coordinates", gate.coordinate_reason, fatal=True, failed=gate.coordinate_failed)
        .register("image", gate.image_reason, failed=gate.image_failed)
        .register("dedup", duplicate_reason, fatal=True, failed=lambda: F.col("original_id").isNotNull())
    )


def duplicate_reason():
    return F.when(
        F.col("original_id").isNotNull(), F.concat(F.lit("Duplicate of "), F.col("original_id"))
    )


def gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples through the gate; duplicates are looked for among rows that passed the
    cheaper fatal checks and have a screenshot."""
    rows = with_facts(spark, sf_dir)
    candidates = rows.where(
        ~gate.schema_failed() & ~gate.coordinate_failed() & F.col("file_exists")
    ).select(F.col("sample_id").alias("id"), F.col("doc_id").alias("ord"), F.col("sha256").alias("sha"))
    # narrow and used several times: written once
    originals = dedup.exact_duplicates(materialize(candidates, "candidates")).withColumnRenamed("id", "sample_id")
    return standard_gate().run(rows.join(originals, "sample_id", "left"))


def gated_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(gated(spark, sf_dir), "gated")


def scored(spark: SparkSession, sf_dir: str, gate_rows: DataFrame | None = None) -> DataFrame:
    """Rows that passed the gate: enriched, scored and routed."""
    rows = gated(spark, sf_dir) if gate_rows is None else gate_rows
    passed = rows.where("gate_status <> 'rejected'").withColumn("phash", F.lit(""))
    enriched = enrich.add_difficulty(enrich.enrich(passed))
    return finish(enriched)


def scored_table(spark: SparkSession, sf_dir: str, gate_rows: DataFrame | None = None) -> DataFrame:
    """The same, written once.

    Reports and exports filter on scores.  Over a written table such a filter is a
    Parquet predicate; over the lazy plan it would drag the whole scoring along.
    """
    return materialize(scored(spark, sf_dir, gate_rows).drop("document"), "scored")


def finish(enriched: DataFrame, threshold: float = D.QUALITY_THRESHOLD) -> DataFrame:
    flags = (
        enriched.withColumn("image_valid", ~F.exists("warnings", lambda w: w.startswith("image: ")))
        .withColumn("coordinates_valid", F.lit(True))
        .withColumn("not_duplicate", F.lit(True))
    )
    return enrich.route(enrich.score(enrich.add_personal_flag(flags), threshold))
