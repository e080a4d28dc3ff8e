"""Quality analysis of whole sessions.

Input rows: session_id, pos, following, step_index, action_type, coordinates,
has_coordinates, text, task - the output of ``skew.in_order`` with
``LOOKAHEAD`` and ``PAYLOAD``.  Every detector is then a row-wise expression; the
report needs one aggregation by (session, action type) and one by session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.functions import text as T
from stepforge.sources.sinks import number_text

LOOKAHEAD = 2 * max(D.LOOP_WINDOWS) - 1
PAYLOAD = ("action_type", "coordinates", "text")


def _type(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _loop(window: int) -> Column:
    """The types from here repeat directly: first half equals second half."""
    types = F.concat(
        F.array(_type(F.col("action_type"))),
        F.transform("following", lambda r: _type(r["action_type"])),
    )
    return (F.size(types) >= 2 * window) & (
        F.slice(types, 1, window) == F.slice(types, window + 1, window)
    )


def _redundant() -> Column:
    nxt = F.get("following", 0)
    kind = _type(F.col("action_type"))
    same_point = F.col("coordinates").isNotNull() & (F.col("coordinates") == nxt["coordinates"])
    same = (
        F.when(kind == "key", False)
        .when(kind.isin(D.CLICK_FAMILY), F.coalesce(same_point, F.lit(False)))
        .when(kind == "type", F.col("text").eqNullSafe(nxt["text"]))
        .otherwise(True)
    )
    return (F.size("following") > 0) & (kind == _type(nxt["action_type"])) & same


def _impossible() -> Column:
    c = F.col("coordinates")
    inside = (
        c[0].between(0.0, 1.0) & c[1].between(0.0, 1.0) & ~F.isnan(c[0]) & ~F.isnan(c[1])
    )
    return (
        F.coalesce(F.col("action_type").isin(D.CLICK_FAMILY), F.lit(False))
        & F.col("has_coordinates")
        & ~F.coalesce(inside, F.lit(False))
    )


def flag_steps(placed: DataFrame) -> DataFrame:
    """loop_2..loop_4 start here, redundant with the next step, impossible point."""
    return placed.select(
        "*",
        *[_loop(w).alias(f"loop_{w}") for w in D.LOOP_WINDOWS],
        _redundant().alias("redundant"),
        _impossible().alias("impossible"),
    )


def loop_issues(flagged: DataFrame) -> DataFrame:
    """At most one warning per session and window: the first repeating place."""
    firsts = flagged.groupBy("session_id").agg(
        *[
            F.min(
                F.when(
                    F.col(f"loop_{w}"),
                    F.struct(
                        F.col("pos").alias("start"),
                        F.concat(
                            F.array(_type(F.col("action_type"))),
                            F.transform(F.slice("following", 1, w - 1), lambda r: _type(r["action_type"])),
                        ).alias("types"),
                    ),
                )
            ).alias(f"first_{w}")
            for w in D.LOOP_WINDOWS
        ]
    )
    found = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(f"first_{w}").isNotNull(),
                    F.struct(F.lit(w).alias("window"), F.col(f"first_{w}")["start"].alias("start"),
                             F.col(f"first_{w}")["types"].alias("types")),
                )
                for w in D.LOOP_WINDOWS
            ]
        )
    )
    one = firsts.select("session_id", F.explode(found).alias("loop")).select("session_id", "loop.*")
    last = F.col("start") + 2 * F.col("window") - 1
    listed = F.array_join(F.transform("types", lambda t: F.concat(F.lit("'"), t, F.lit("'"))), ", ")
    return one.select(
        "session_id",
        "window",
        F.lit("warning").alias("severity"),
        F.lit("loop_detected").alias("issue_type"),
        F.concat(F.lit("Steps "), F.col("start"), F.lit("–"), last, F.lit(" repeat sequence: ["),
                 listed, F.lit("]")).alias("description"),
        F.sequence(F.col("start"), last).alias("step_indices"),
    )


def redundancy_issues(flagged: DataFrame) -> DataFrame:
    kind, coords = F.col("action_type"), F.col("coordinates")
    head = F.concat(F.lit("Steps "), F.col("pos"), F.lit(" and "), F.col("pos") + 1, F.lit(": consecutive "))
    text = (
        F.when(
            kind.isin(D.CLICK_FAMILY),
            F.concat(head, kind, F.lit(" at same coordinates ["), number_text(coords[0]), F.lit(", "),
                     number_text(coords[1]), F.lit("]")),
        )
        .when(
            kind == "type",
            F.concat(head, F.lit("type with same text '"), F.coalesce("text", F.lit("None")), F.lit("'")),
        )
        .otherwise(F.concat(head, F.lit("identical "), _type(kind), F.lit(" actions")))
    )
    return flagged.where("redundant").select(
        "session_id",
        F.lit("warning").alias("severity"),
        F.lit("redundant_actions").alias("issue_type"),
        text.alias("description"),
        F.array(F.col("pos"), F.col("pos") + 1).alias("step_indices"),
    )


def coordinate_issues(flagged: DataFrame) -> DataFrame:
    c = F.col("coordinates")
    step = F.concat(F.lit("Step "), F.col("step_index"), F.lit(": coordinates "))
    text = F.when(
        c.isNull(), F.concat(step, F.lit("could not be parsed as [x, y]"))
    ).otherwise(
        F.concat(step, F.lit("["), T.fixed(c[0], 3), F.lit(", "), T.fixed(c[1], 3),
                 F.lit("] are outside valid range [0.0, 1.0]"))
    )
    return flagged.where("impossible").select(
        "session_id",
        F.lit("error").alias("severity"),
        F.lit("impossible_coordinates").alias("issue_type"),
        text.alias("description"),
        F.array(F.col("step_index").cast("long")).alias("step_indices"),
    )


def action_counts(steps: DataFrame) -> DataFrame:
    """Rows (session_id, action_type, n); a missing type counts as 'unknown'."""
    return steps.groupBy(
        "session_id", F.coalesce("action_type", F.lit("unknown")).alias("action_type")
    ).agg(F.count(F.lit(1)).alias("n"))


def _sorted_counts(pairs: Column) -> Column:
    """Pairs (type, n) as text 'click=5,type=2': most frequent first, then by name."""
    ranked = F.array_sort(
        F.transform(pairs, lambda p: F.struct((-p["n"]).alias("minus"), p["action_type"].alias("name")))
    )
    return F.transform(ranked, lambda r: F.struct(r["name"].alias("action_type"), (-r["minus"]).alias("n")))


def action_statistics(steps: DataFrame) -> DataFrame:
    """Per session the ordered (type, count) list.  The inner groups hold one row per type."""
    pairs = F.collect_list(F.struct("action_type", "n"))
    return action_counts(steps).groupBy("session_id").agg(_sorted_counts(pairs).alias("action_counts"))


def counts_text(pairs: Column) -> Column:
    return F.array_join(
        F.transform(pairs, lambda p: F.concat(p["action_type"], F.lit("="), p["n"].cast("string"))), ","
    )


def low_diversity(steps: DataFrame, max_ratio: float = D.LOW_DIVERSITY_RATIO) -> DataFrame:
    """Non-terminal action types that make up more than ``max_ratio`` of a session."""
    from pyspark.sql import Window

    counted = (
        steps.where(~_type(F.col("action_type")).isin(D.TERMINAL_ACTIONS))
        .groupBy("session_id", _type(F.col("action_type")).alias("action_type"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("total", F.sum("n").over(Window.partitionBy("session_id")))
    )
    ratio = F.col("n") / F.col("total")
    return counted.where(ratio > max_ratio).select(
        "session_id", "action_type", "n", "total", ratio.alias("ratio"),
        F.lit("warning").alias("severity"),
        F.lit("low_diversity").alias("issue_type"),
        F.concat(
            F.lit("Action '"), F.col("action_type"), F.lit("' appears "), F.col("n"), F.lit("/"), F.col("total"),
            F.lit(" times ("), T.fixed(ratio * 100, 0), F.lit("%) — model may overfit to this action"),
        ).alias("description"),
    )


def all_issues(flagged: DataFrame) -> DataFrame:
    """Every issue as one row; the order of detectors is loops, repeats, diversity, points."""
    columns = ("session_id", "severity", "issue_type", "description", "step_indices")
    diversity = low_diversity(flagged).withColumn("step_indices", F.array().cast("array<bigint>"))
    return (
        loop_issues(flagged).select(*columns)
        .unionByName(redundancy_issues(flagged).select(*columns))
        .unionByName(diversity.select(*columns))
        .unionByName(coordinate_issues(flagged).select(*columns))
    )


def quality_report(flagged: DataFrame, threshold: float = D.TRAJECTORY_THRESHOLD,
                   max_ratio: float = D.LOW_DIVERSITY_RATIO) -> DataFrame:
    """One row per session: issue counts, score, verdict, action counts.

    First aggregation by (session, type) combines map-side; the second sees at most
    one row per type.  The score is computed in whole tenths from the counts.
    """
    by_type = flagged.groupBy("session_id", F.col("action_type").alias("_raw")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("pos", "task")).alias("first"),
        *[F.max(F.col(f"loop_{w}").cast("int")).alias(f"loop_{w}") for w in D.LOOP_WINDOWS],
        F.count_if("redundant").alias("n_redundant"),
        F.count_if("impossible").alias("n_impossible"),
    )
    terminal = _type(F.col("_raw")).isin(D.TERMINAL_ACTIONS)
    per_session = by_type.groupBy("session_id").agg(
        F.min("first")["task"].alias("task"),
        F.sum("n").alias("total_steps"),
        _sorted_counts(
            F.collect_list(F.struct(F.coalesce("_raw", F.lit("unknown")).alias("action_type"), "n"))
        ).alias("action_counts"),
        sum((F.max(f"loop_{w}") for w in D.LOOP_WINDOWS), F.lit(0)).cast("long").alias("n_loops"),
        F.sum("n_redundant").alias("n_redundant"),
        F.sum("n_impossible").alias("n_impossible"),
        F.collect_list(F.when(~terminal, F.col("n"))).alias("_meaningful"),
    )
    total = F.aggregate("_meaningful", F.lit(0).cast("long"), lambda a, x: a + x)
    dominant = F.size(F.filter("_meaningful", lambda x: x / F.col("_total") > max_ratio))
    scored = (
        per_session.withColumn("_total", total)
        .withColumn("n_low_diversity", dominant.cast("long"))
        .withColumn("n_errors", F.col("n_impossible"))
        .withColumn("n_warnings", F.col("n_loops") + F.col("n_redundant") + F.col("n_low_diversity"))
    )
    return verdict(scored, threshold).drop("_meaningful", "_total")


def verdict(counted: DataFrame, threshold: float = D.TRAJECTORY_THRESHOLD) -> DataFrame:
    """Score, decision and summary from n_errors and n_warnings."""
    tenths = F.greatest(F.lit(0), 10 - 3 * F.col("n_errors") - F.col("n_warnings"))
    with_score = counted.withColumn("quality_score", tenths / F.lit(10.0)).withColumn(
        "use_for_training", F.col("quality_score") >= threshold
    )
    approved = F.format_string("APPROVED (score=%.2f, %d warnings)", F.col("quality_score"), F.col("n_warnings"))
    rejected = F.format_string(
        "REJECTED (score=%.2f, %d errors, %d warnings)",
        F.col("quality_score"), F.col("n_errors"), F.col("n_warnings"),
    )
    return with_score.withColumn("summary", F.when(F.col("use_for_training"), approved).otherwise(rejected))


def with_empty_sessions(sessions: DataFrame, report: DataFrame) -> DataFrame:
    """Sessions without a single step get score 0 and the empty-trajectory error."""
    empty = F.col("total_steps").isNull()
    joined = sessions.select("session_id").join(report, "session_id", "left")
    return (
        joined.withColumn("n_empty", empty.cast("long"))
        .withColumn("n_errors", F.when(empty, 1).otherwise(F.col("n_errors")))
        .withColumn("quality_score", F.coalesce("quality_score", F.lit(0.0)))
        .withColumn("use_for_training", F.coalesce("use_for_training", F.lit(False)))
        .withColumn("summary", F.coalesce("summary", F.lit("REJECTED — empty trajectory")))
        .withColumn("task", F.coalesce("task", F.lit("unknown")))
        .withColumn("total_steps", F.coalesce("total_steps", F.lit(0)))
    )


def batch_summary(report: DataFrame) -> DataFrame:
    """One row over all sessions: approvals, average score, issues, score classes."""
    score, n = F.col("quality_score"), F.count(F.lit(1))
    # scores are whole tenths, so the average comes from an integer sum
    tenths = F.sum(F.round(score * 10).cast("long"))
    return report.agg(
        n.alias("sessions"),
        F.count_if("use_for_training").alias("approved"),
        F.count_if(~F.col("use_for_training")).alias("flagged"),
        (F.count_if("use_for_training") / n * 100).alias("approved_pct"),
        (tenths / n / 10).alias("avg_score"),
        F.sum("n_loops").alias("loop_issues"),
        F.sum("n_redundant").alias("redundant_issues"),
        F.sum("n_low_diversity").alias("low_diversity_issues"),
        F.sum("n_impossible").alias("impossible_issues"),
        F.count_if(score == 1.0).alias("perfect"),
        F.count_if((score >= 0.8) & (score < 1.0)).alias("good"),
        F.count_if((score >= 0.6) & (score < 0.8)).alias("marginal"),
        F.count_if(score < 0.6).alias("poor"),
    )
