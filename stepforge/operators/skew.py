"""Joins and numbering that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key with more rows than this is split.  The list of such keys is broadcast; it
# can never hold more than (all rows / HOT_ROWS) entries.
HOT_ROWS = 2_000_000
CUT_SAMPLES = 20  # sampled rows for each part of a hot session


def attach_per_key(rows: DataFrame, per_key: DataFrame, key: str, row_id: str,
                   count_column: str = "n", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join of ``rows`` to one record per ``key`` (a string column).

    Records of hot keys come by broadcast; the rows they serve are then spread by
    row id through the shuffle join, where only the other keys look for a match.
    """
    values = [c for c in per_key.columns if c != key]
    hot = per_key.where(F.col(count_column) > hot_rows).select(
        key, F.struct(*values).alias("_hot")
    )
    cold = per_key.where(F.col(count_column) <= hot_rows).select(
        F.col(key).alias("_key"), F.struct(*values).alias("_cold")
    )
    spread = F.when(F.col("_hot").isNull(), F.col(key)).otherwise(
        F.concat(F.lit("\u0000"), F.col(row_id).cast("string"))
    )
    joined = (
        rows.join(F.broadcast(hot), key, "left")
        .withColumn("_key", spread)
        .join(cold, "_key", "left")
        .withColumn("_value", F.coalesce("_hot", "_cold"))
    )
    return joined.select(*rows.columns, *[F.col("_value")[v].alias(v) for v in values])


def split_counts(keyed: DataFrame, key: str = "key", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Hot keys with the number of slices each needs (a bounded, broadcastable table)."""
    return (
        keyed.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > hot_rows)
        .select(key, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_slices"))
    )


def _cut_points(steps: DataFrame, order: Sequence[str], session: str, hot_rows: int) -> DataFrame:
    """(session, _cuts): for each hot session, order values that cut it into parts of about ``hot_rows`` rows.

    Every ``CUT_SAMPLES``-th value of a sample of the session; rows are drawn by their
    hash, so a task that runs again draws the same.  All samples together are at most
    about ``CUT_SAMPLES`` for every ``hot_rows`` rows.
    """
    hot = steps.groupBy(session).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    drawn = F.pmod(F.xxhash64(*order), F.col("_n")) < CUT_SAMPLES * F.ceil(F.col("_n") / hot_rows)
    sample = steps.join(F.broadcast(hot), session).where(drawn).groupBy(session).agg(
        F.array_sort(F.collect_list(F.struct(*order))).alias("_sample")
    )
    cuts = F.filter("_sample", lambda _, i: (i + 1) % CUT_SAMPLES == 0)
    return hot.join(sample, session, "left").select(session, F.coalesce(cuts, F.array()).alias("_cuts"))


def in_order(steps: DataFrame, order: Sequence[str], payload: Sequence[str],
             lookahead: int, session: str = "session_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds ``pos`` (0-based place in the session) and ``following`` (the next rows).

    ``following`` is an array of up to ``lookahead`` payload structs.  A normal
    session is one window group.  A hot session is cut at quantiles of its order
    values, so a minute that holds millions of steps is cut as well, and each part is
    a group of its own; the rows lost at a part's end are supplied from the first
    ``lookahead`` rows of the parts after it, which are few.  Only rows equal in all
    of ``order`` stay together.
    """
    hot = _cut_points(steps, order, session, hot_rows)
    item = F.struct(*payload)
    before = F.size(F.filter("_cuts", lambda cut: cut <= F.struct(*order))).cast("long")
    marked = (
        steps.join(F.broadcast(hot), session, "left").withColumn("_is_hot", F.col("_cuts").isNotNull())
        .withColumn("_part", F.when(F.col("_is_hot"), before).otherwise(F.lit(0).cast("long"))).drop("_cuts")
    )
    group = Window.partitionBy(session, "_part").orderBy(*order)
    placed = marked.withColumn("_rank", F.row_number().over(group))
    if lookahead:
        placed = placed.withColumn(
            "_next", F.collect_list(item).over(group.rowsBetween(1, lookahead))
        )

    # only rows of hot sessions reach the branch below
    hot_rows_only = marked.where("_is_hot")
    earlier = Window.partitionBy(session).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    parts = (
        hot_rows_only.groupBy(session, "_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_base", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .select(session, "_part", "_base")
    )
    if lookahead:
        heads = (
            hot_rows_only.withColumn("_rank", F.row_number().over(group))
            .where(F.col("_rank") <= lookahead)
            .select(session, "_part", "_rank", item.alias("_item"))
        )
        along = Window.partitionBy(session).orderBy("_part", "_rank")
        last_head = Window.partitionBy(session, "_part")
        tails = (
            heads.withColumn("_tail", F.collect_list("_item").over(along.rowsBetween(1, lookahead)))
            .withColumn("_last", F.max("_rank").over(last_head))
            .where(F.col("_rank") == F.col("_last"))
            .select(session, "_part", "_tail")
        )
        parts = parts.join(tails, [session, "_part"], "left")
    out = placed.join(parts, [session, "_part"], "left").withColumn(
        "pos", (F.col("_rank") - 1 + F.coalesce("_base", F.lit(0))).cast("long")
    )
    columns = [*steps.columns, "pos"]
    if lookahead:
        whole = F.when(F.col("_tail").isNull(), F.col("_next")).otherwise(
            F.slice(F.concat("_next", "_tail"), 1, lookahead)
        )
        out = out.withColumn("following", whole)
        columns.append("following")
    return out.select(*columns)

