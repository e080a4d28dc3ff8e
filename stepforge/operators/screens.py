"""Before/after comparison of consecutive frames of a session."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.functions import pixels as X
from stepforge.functions import rendering as G

PIXEL_COLUMNS = ("height", "width", "channels", "data")


def frame_pairs(placed: DataFrame) -> DataFrame:
    """Each frame with its successor: an equi-join on (session, place).

    Both sides are unique on that key, so a long session spreads over all tasks,
    which a window with whole images in it would not.
    """
    before = placed.select("session_id", "pos", *[F.col(c).alias(f"before_{c}") for c in PIXEL_COLUMNS])
    after = placed.select("session_id", (F.col("pos") - 1).alias("pos"), *[F.col(c).alias(f"after_{c}") for c in PIXEL_COLUMNS])
    return before.join(after, ["session_id", "pos"])


def compare(pairs: DataFrame) -> DataFrame:
    """Change ratio, kind, changed regions (most changed first), summary."""
    args = [f"before_{c}" for c in PIXEL_COLUMNS] + [f"after_{c}" for c in PIXEL_COLUMNS]
    d = pairs.withColumn("diff", X.frame_difference(*args))
    ratio, regions = F.col("diff.ratio"), F.col("diff.regions")
    same = F.col("diff.same_shape")
    changed = F.when(same, G.ranked_regions(regions)).otherwise(F.array(F.lit("entire_screen")))
    return (
        d.withColumn("change_ratio", ratio)
        .withColumn("channel_ratio", F.col("diff.channel_ratio"))
        .withColumn("region_ratios", regions)
        .withColumn(
            "change_type",
            F.when(same, G.change_type(ratio, G.active_regions(regions))).otherwise("full_screen"),
        )
        .withColumn("changed_regions", changed)
        .withColumn("most_changed", F.when(same, G.most_changed(regions)).otherwise("center"))
        .withColumn("is_significant", ~same | (ratio >= D.SIGNIFICANT_CHANGE))
        .withColumn(
            "summary",
            F.when(same, G.change_summary(F.col("change_type"), F.col("changed_regions"), ratio))
            .otherwise("Full screen change — screenshot sizes differ"),
        )
        .drop("diff", *args)
    )


def verify_effect(compared: DataFrame, threshold: float = D.SIGNIFICANT_CHANGE) -> DataFrame:
    """Had the action an effect?  Some actions are never checked."""
    unchecked = F.col("action_type").isin(D.NO_EFFECT_CHECK)
    ratio = F.when(unchecked, 0.0).otherwise(F.col("channel_ratio"))
    return compared.withColumn("effect_ratio", ratio).withColumn(
        "effect_ok", unchecked | (F.col("channel_ratio") >= threshold)
    )
