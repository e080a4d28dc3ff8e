"""Annotations from cached, recorded or freshly produced responses.

The call to an annotator is the user's own function; here its *responses* are a
table (sample_id, provider, raw_response) that is joined, parsed and chosen from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.functions import parsing as P
from stepforge.functions import rendering as G
from stepforge.functions import regions as R
from stepforge.functions import text as T

ANNOTATION_COLUMNS = (
    "reasoning", "intent", "annotated_by", "annotation_method", "annotation_confidence",
    "reasoning_verified",
)


def cache_key(sha256: Column, action_type: Column, task: Column) -> Column:
    """First 32 hex digits over digest, action and the first 50 task characters."""
    prefix = F.lower(T.strip(F.substring(task, 1, 50)))
    return F.substring(F.sha2(F.concat_ws("|", sha256, action_type, prefix), 256), 1, 32)


def lookup_cache(samples: DataFrame, cache: DataFrame) -> DataFrame:
    """Samples plus ``cached`` (annotation struct or NULL).

    The key holds the file digest, which after duplicate removal is nearly unique,
    so the join is balanced; a small cache is broadcast by Catalyst on its size.
    Samples without a digest never hit; they are spread by id over the tasks.
    """
    hit = cache.select(F.col("cache_key").alias("_key"), F.struct(*ANNOTATION_COLUMNS).alias("cached"))
    key = F.when(
        F.coalesce("sha256", F.lit("")) != "",
        cache_key(F.col("sha256"), F.col("action_type"), F.col("task")),
    )
    spread = F.coalesce("cache_key", F.concat(F.lit("\u0000"), F.col("sample_id")))
    keyed = samples.withColumn("cache_key", key).withColumn("_key", spread)
    return keyed.join(hit, "_key", "left").drop("_key")


def annotation_requests(samples: DataFrame, agent: str = D.AGENT_NAME, verbatim: bool = False) -> DataFrame:
    """One request row per sample: both prompt parts and the inline image if given.

    ``verbatim`` gives screen and typed texts as they are (see ``rendering.reasoning_request``);
    without regions and raw text the user part then is NULL.
    """
    c = F.col
    screen = R.request_text(c("regions"), c("ocr_text_raw"))
    if verbatim:
        screen = F.when(c("regions").isNotNull() | c("ocr_text_raw").isNotNull(), screen)
    image = [c("inline_image")] if "inline_image" in samples.columns else []
    return samples.select(
        "sample_id",
        F.lit(D.REASONING_SYSTEM_TEMPLATE.format(agent=agent)).alias("system_prompt"),
        G.reasoning_request(
            c("task"), screen, c("action_type"), c("step_index"), G.total_steps(c("step_index")),
            c("description"), c("coordinates"), c("text"), verbatim=verbatim,
        ).alias("user_prompt"),
        *image,
    )


def difficulty_requests(samples: DataFrame) -> DataFrame:
    c = F.col
    return samples.select(
        "sample_id",
        F.lit(D.DIFFICULTY_SYSTEM_TEXT).alias("system_prompt"),
        G.difficulty_request(
            c("task"), G.total_steps(c("step_index")), c("action_type"), c("step_index"), c("n_regions")
        ).alias("user_prompt"),
    )


Annotator = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def run_annotator(requests: DataFrame, annotate: Annotator, parallelism: int | None = None) -> DataFrame:
    """Apply a user function to the request batches.

    ``annotate`` yields frames with sample_id, provider, raw_response.  Rate limits
    and retries belong to it.  The partitions stay as they are; ``parallelism`` sets
    their number where an annotator must not run in more copies.
    """
    dealt = requests if parallelism is None else requests.repartition(parallelism)
    return dealt.mapInPandas(
        annotate, "sample_id string, provider string, raw_response string"
    )


def choose_response(responses: DataFrame, min_chars: int = D.MIN_REASONING_CHARS) -> DataFrame:
    """Per sample the first provider, in priority order, whose response parses."""
    priority = F.array_position(
        F.array(*[F.lit(p) for p in D.PROVIDER_PRIORITY]), F.col("provider")
    )
    parsed = (
        # exploded: a filter on the result is not moved below, where it would bring parses of its own
        responses.select("*", F.explode(F.array(P.parse_response(F.col("raw_response"), min_chars))).alias("parsed"))
        .withColumn("priority", priority)
        .where("parsed is not null and priority > 0")
    )
    # an aggregate, not a window: combined before the shuffle
    best = parsed.groupBy("sample_id").agg(
        F.min(F.struct("priority", "provider", "parsed")).alias("best")
    )
    return best.select(
        "sample_id", F.col("best.provider").alias("provider"),
        F.col("best.parsed.reasoning").alias("llm_reasoning"),
        F.col("best.parsed.intent").alias("llm_intent"),
    )


def resolve_annotation(samples: DataFrame) -> DataFrame:
    """Annotation columns from cache hit, chosen response or description fallback.

    Needs ``cached`` and provider / llm_reasoning / llm_intent (NULL if none).
    """
    c = F.col
    verified = P.verify_reasoning(c("llm_reasoning"), c("regions"))
    answer = lambda verified: F.struct(
        c("llm_reasoning").alias("reasoning"),
        c("llm_intent").alias("intent"),
        F.concat(F.lit("free_llm:"), c("provider")).alias("annotated_by"),
        F.lit("auto_llm").alias("annotation_method"),
        F.when(verified, D.VERIFIED_CONFIDENCE).otherwise(D.UNVERIFIED_CONFIDENCE).alias("annotation_confidence"),
        verified.alias("reasoning_verified"),
    )
    fresh = F.when(c("provider").isNotNull(), T.once(verified, answer))
    fallback = F.when(
        F.length(T.strip(F.coalesce(c("description"), F.lit("")))) >= 5,
        F.struct(
            G.fallback_reasoning(c("task"), c("description")).alias("reasoning"),
            c("task").alias("intent"),
            F.lit("description_fallback").alias("annotated_by"),
            F.lit("fallback").alias("annotation_method"),
            F.lit(D.FALLBACK_CONFIDENCE).alias("annotation_confidence"),
            F.lit(False).alias("reasoning_verified"),
        ),
    )
    outcome = (
        F.when(c("cached").isNotNull(), "cache_hits")
        .when(c("provider").isNotNull(), c("provider"))
        .when(fallback.isNotNull(), "fallback")
        .otherwise("failed")
    )
    chosen = samples.withColumn("annotation", F.coalesce(c("cached"), fresh, fallback)).withColumn(
        "annotation_outcome", outcome
    )
    return chosen


def quality_flags(annotation: Column) -> list[Column]:
    """has_reasoning, reasoning_length, reasoning_verified; untouched without annotation."""
    return [
        F.coalesce(F.length(annotation["reasoning"]) > 0, F.lit(False)).alias("has_reasoning"),
        F.coalesce(F.length(annotation["reasoning"]), F.lit(0)).alias("reasoning_length"),
        F.coalesce(annotation["reasoning_verified"], F.lit(False)).alias("quality_verified"),
    ]


def confidence_of(verified: Column, variant: str = "free") -> Column:
    """Confidence of a model annotation; the older annotators used other levels."""
    # ---- fixed values ----
    levels = {"free": (0.80, 0.60), "groq_file": (0.75, 0.55), "auto": (0.8, 0.5)}
    high, low = levels[variant]
    return F.when(verified, high).otherwise(low)


def outcome_counts(annotated: DataFrame) -> DataFrame:
    return annotated.groupBy("annotation_outcome").agg(F.count(F.lit(1)).alias("n"))


def cache_rows(annotated: DataFrame) -> DataFrame:
    """Fresh model annotations as cache entries."""
    return annotated.where(
        "annotation.annotation_method = 'auto_llm' and cached is null and cache_key is not null"
    ).select("cache_key", "annotation.*", F.current_timestamp().cast("string").alias("created_at"))
