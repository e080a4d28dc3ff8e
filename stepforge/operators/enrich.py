"""Enrichment: an ordered chain of DataFrame transforms; failures become columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge.functions import personal
from stepforge.functions import regions as R
from stepforge.functions import scoring as S
from stepforge.functions import text as T

# (name, transform, failure): failure is a Column with the error text or NULL
Enricher = tuple[str, Callable[[DataFrame], DataFrame], Callable[[], Column]]

NEVER = lambda: F.lit(None).cast("string")


def _missing_screenshot(what: str) -> Callable[[], Column]:
    return lambda: F.when(
        ~F.col("file_exists"), F.concat(F.lit(f"Screenshot not found for {what}: "), F.col("screenshot_path"))
    )


def add_hashes(df: DataFrame) -> DataFrame:
    """Digest and perceptual hash come from the image facts already joined."""
    return df.withColumn("sha256", F.coalesce("sha256", F.lit(""))).withColumn(
        "phash", F.coalesce("phash", F.lit(""))
    )


def add_regions(df: DataFrame) -> DataFrame:
    """Cleaned regions; an engine that gave none counts as an empty array."""
    none = F.array().cast(f"array<{R.REGION_TYPE}>")
    kept = F.when(F.col("file_exists"), F.coalesce(R.clean_regions(F.col("regions")), none)).otherwise(none)
    return df.withColumn("regions", kept).withColumn("n_regions", F.size("regions"))


def add_cleaned_regions(df: DataFrame) -> DataFrame:
    """The same for regions that were cleaned once per screenshot, before samples were joined to them."""
    none = F.array().cast(f"array<{R.REGION_TYPE}>")
    kept = F.when(F.col("file_exists"), F.coalesce("regions", none)).otherwise(none)
    return df.withColumn("regions", kept).withColumn("n_regions", F.size("regions"))


def add_language(df: DataFrame) -> DataFrame:
    text = R.joined_text(F.col("regions"), F.col("ocr_text_raw"))
    return (
        df.withColumn("_text", text)
        .withColumn("language", T.detect_language(F.col("_text")))
        .withColumn("tags", T.language_tags(F.col("tags"), F.col("_text"), F.col("language")))
        .drop("_text")
    )


DEFAULT_CHAIN: list[Enricher] = [
    ("hash_computer", add_hashes, _missing_screenshot("hashing")),
    ("ocr_enricher", add_regions, _missing_screenshot("OCR")),
    ("language_detector", add_language, NEVER),
]

CLEANED_CHAIN: list[Enricher] = [
    (name, add_cleaned_regions if transform is add_regions else transform, failure) for name, transform, failure in DEFAULT_CHAIN
]


def enrich(df: DataFrame, chain: list[Enricher] = DEFAULT_CHAIN) -> DataFrame:
    """Run the chain in order and list per row what failed.

    A failing step leaves its columns empty and the next one still runs; the
    status becomes ``enriched`` in any case.
    """
    events = []
    out = df
    for name, transform, failure in chain:
        error = failure()
        events.append(
            F.struct(
                F.lit(name).alias("stage"),
                F.when(error.isNull(), "success").otherwise("failed").alias("result"),
                error.alias("error"),
            )
        )
        out = transform(out)
    return (
        out.withColumn("enrich_events", F.array(*events))
        .withColumn("enrich_failed", F.exists("enrich_events", lambda e: e["result"] == "failed"))
        .withColumn("status", F.lit("enriched"))
    )


def score(df: DataFrame, threshold: float) -> DataFrame:
    """Sub-scores, composite, rounded score and approval."""
    c = F.col
    return (
        df.withColumn(
            "validation_score",
            S.validation_score(c("schema_valid"), c("image_valid"), c("coordinates_valid"),
                               c("no_pii"), c("not_duplicate")),
        )
        .withColumn("reasoning_score", S.reasoning_score(c("description"), c("reasoning"), c("intent"), c("reasoning_verified")))
        .withColumn("ocr_score", S.ocr_score(c("n_regions"), R.mean_confidence(c("regions"))))
        .withColumn("diversity_score", S.diversity_score(c("language"), c("is_error_step"), F.size("tags"), c("action_type")))
        .withColumn("composite", S.composite(c("validation_score"), c("reasoning_score"), c("ocr_score"), c("diversity_score")))
        .withColumn("quality_score", T.nearest(c("composite"), 4))
        .withColumn("approved", c("composite") >= threshold)
        .withColumn("status", F.when(c("approved"), "approved").otherwise("rejected"))
        .withColumn(
            "rejection_reason",
            F.when(
                ~c("approved"),
                F.concat(F.lit("Quality score "), T.fixed(c("composite"), 3), F.lit(f" below threshold {threshold}")),
            ),
        )
    )


def add_personal_flag(df: DataFrame) -> DataFrame:
    """``no_pii``: neither the step's own words, its reasoning nor its screen text hold personal data."""
    screen = R.joined_text(F.col("regions"), F.col("ocr_text_raw"))
    own = [F.col(x) for x in ("task", "description", "text", "reasoning")]
    return df.withColumn("no_pii", personal.none_found(*own, screen))


def route(df: DataFrame) -> DataFrame:
    c = F.col
    stage = S.route_stage(
        c("quality_score"), c("step_index"), c("action_type"), c("coordinates"), c("description"),
        c("reasoning"), c("intent"), c("reasoning_verified"), c("n_regions"),
    )
    return df.withColumn("training_stage", F.when(c("approved"), stage).otherwise(""))


def add_difficulty(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumn(
        "difficulty",
        S.difficulty(c("task"), c("step_index"), c("n_regions"), c("action_type"), c("language")),
    )
