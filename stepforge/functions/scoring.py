"""Difficulty, composite quality and stage routing as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.functions import text as T


def _len(c: Column) -> Column:
    return F.coalesce(F.length(c), F.lit(0))


def _stripped_len(c: Column) -> Column:
    return F.coalesce(F.length(T.strip(c)), F.lit(0))


def _when_int(condition: Column, value: int) -> Column:
    return F.when(condition, value).otherwise(0)


def difficulty(task: Column, step_index: Column, n_regions: Column, action_type: Column,
               language: Column) -> Column:
    """Rule-based difficulty, 1 (trivial) to 5 (expert)."""

    def keywords(lowered: Column) -> Column:
        hard = T.count_contained(lowered, D.HARD_KEYWORDS)
        medium = T.count_contained(lowered, D.MEDIUM_KEYWORDS)
        return F.when(hard >= 3, 3).when(hard >= 1, 2).when(medium >= 2, 1).otherwise(0)

    complexity = F.coalesce(
        *[F.when(action_type == a, F.lit(n)) for a, n in D.ACTION_COMPLEXITY.items()], F.lit(1)
    )
    points = (
        F.lit(1)
        + T.once(F.lower(task), keywords)
        + F.when(step_index >= 15, 2).when(step_index >= 8, 1).otherwise(0)
        + F.when(n_regions >= 50, 2).when(n_regions >= 25, 1).otherwise(0)
        + complexity
        - 1
        + _when_int(language.isin("ur", "ps", "ar"), 1)
    )
    return F.greatest(F.lit(1), F.least(F.lit(5), points))


def validation_score(schema_valid: Column, image_valid: Column, coordinates_valid: Column,
                     no_pii: Column, not_duplicate: Column) -> Column:
    flags = (schema_valid, image_valid, coordinates_valid, no_pii, not_duplicate)
    passed = sum((F.coalesce(f, F.lit(False)).cast("int") for f in flags), F.lit(0))
    return passed / F.lit(5.0)


def reasoning_score(description: Column, reasoning: Column, intent: Column,
                    verified: Column) -> Column:
    label = F.when(_stripped_len(description) > 5, 0.25).otherwise(0.0)
    full = (
        label
        + F.when(_stripped_len(reasoning) > 10, 0.25).otherwise(0.0)
        + F.when(_len(reasoning) >= 200, 0.25).when(_len(reasoning) >= 100, 0.15)
        .when(_len(reasoning) >= 50, 0.08).otherwise(0.0)
        + F.when(F.coalesce(verified, F.lit(False)), 0.15).otherwise(0.0)
        + F.when(_stripped_len(intent) > 5, 0.10).otherwise(0.0)
    )
    return F.when(_len(reasoning) == 0, label).otherwise(F.least(F.lit(1.0), full))


def ocr_score(n_regions: Column, mean_confidence: Column) -> Column:
    return F.least(
        F.lit(1.0),
        F.when(n_regions > 0, 0.4).otherwise(0.0)
        + F.when(n_regions >= 5, 0.3).when(n_regions >= 2, 0.1).otherwise(0.0)
        + F.when(mean_confidence >= 0.85, 0.3).when(mean_confidence >= 0.70, 0.2)
        .when(mean_confidence >= 0.50, 0.1).otherwise(0.0),
    )


def diversity_score(language: Column, is_error_step: Column, n_tags: Column,
                    action_type: Column) -> Column:
    return F.least(
        F.lit(1.0),
        F.lit(0.5)
        + F.when(language.isin("ur", "ps", "ar", "hi"), 0.3).otherwise(0.0)
        + F.when(F.coalesce(is_error_step, F.lit(False)), 0.2).otherwise(0.0)
        + F.when(n_tags >= 3, 0.1).otherwise(0.0)
        + F.when(action_type.isin("type", "right_click", "key", "scroll"), 0.1).otherwise(0.0),
    )


def composite(validation: Column, reasoning: Column, ocr: Column, diversity: Column) -> Column:
    """Weighted sum clamped to [0, 1]; the approval test uses this unrounded value."""
    weighted = (
        D.WEIGHT_VALIDATION * validation + D.WEIGHT_REASONING * reasoning
        + D.WEIGHT_OCR * ocr + D.WEIGHT_DIVERSITY * diversity
    )
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), weighted))


def route_stage(score: Column, step_index: Column, action_type: Column, coordinates: Column,
                description: Column, reasoning: Column, intent: Column, verified: Column,
                n_regions: Column) -> Column:
    """Training stage for a (rounded) score; '' when none fits."""
    planning = (
        (score >= D.STAGE_MIN_SCORE[D.STAGE_PLANNING])
        & (step_index >= D.PLANNING_MIN_STEP)
        & (_len(reasoning) >= D.PLANNING_MIN_REASONING)
        & F.coalesce(verified, F.lit(False))
        & (_len(intent) > 10)
    )
    action = (score >= D.STAGE_MIN_SCORE[D.STAGE_ACTION]) & (
        (_stripped_len(reasoning) >= 20) | (_stripped_len(description) >= 5)
    )
    grounding = (
        (score >= D.STAGE_MIN_SCORE[D.STAGE_GROUNDING])
        & coordinates.isNotNull()
        & action_type.isin(D.CLICK_FAMILY)
        & (n_regions >= 2)
    )
    return (
        F.when(planning, D.STAGE_PLANNING)
        .when(action, D.STAGE_ACTION)
        .when(grounding, D.STAGE_GROUNDING)
        .otherwise("")
    )


