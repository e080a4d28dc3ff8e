"""Whole-session analysis and step history."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.functions import text as T
from stepforge.operators import history as H
from stepforge.operators import skew
from stepforge.operators import trajectory as R
from stepforge.plans import sqlviews as V
from stepforge.plans.catalog import query
from stepforge.sources import adapters as A


def flagged(spark, sf):
    return R.flag_steps(A.placed_steps(spark, sf))


def indices(c):
    return F.array_join(F.transform(c, lambda i: i.cast("string")), ",")


@query("WIN1", V.with_view(V.PLACED, """
SELECT session_id, "window", 'loop_detected' AS issue_type,
  'Steps ' || p || '–' || (p + 2 * "window" - 1) || ' repeat sequence: [' || types || ']' AS description,
  array_to_string(range(p, p + 2 * "window"), ',') AS step_indices
FROM (
  SELECT session_id, 2 AS "window", min(pos) AS p, min_by('''' || action_type || ''', ''' || t1 || '''', pos) AS types FROM flagged_v WHERE loop_2 GROUP BY 1
  UNION ALL SELECT session_id, 3, min(pos), min_by('''' || action_type || ''', ''' || t1 || ''', ''' || t2 || '''', pos) FROM flagged_v WHERE loop_3 GROUP BY 1
  UNION ALL SELECT session_id, 4, min(pos), min_by('''' || action_type || ''', ''' || t1 || ''', ''' || t2 || ''', ''' || t3 || '''', pos) FROM flagged_v WHERE loop_4 GROUP BY 1)"""))
def loops(spark, sf):
    return R.loop_issues(flagged(spark, sf)).select(
        "session_id", "window", "issue_type", "description", indices("step_indices").alias("step_indices")
    )


@query("WIN2", V.with_view(V.PLACED, """
SELECT session_id, pos, action_type, pos || ',' || (pos + 1) AS step_indices,
  CASE WHEN action_type = 'type' THEN 'Steps ' || pos || ' and ' || (pos + 1) || ': consecutive type with same text ''' || coalesce(text, 'None') || ''''
    WHEN action_type = 'click' THEN 'clicks' ELSE 'Steps ' || pos || ' and ' || (pos + 1) || ': consecutive identical ' || action_type || ' actions' END AS description
FROM flagged_v WHERE redundant"""))
def redundant(spark, sf):
    rows = flagged(spark, sf)
    issues = R.redundancy_issues(rows).select(
        "session_id", F.col("step_indices")[0].alias("pos"), indices("step_indices").alias("step_indices"), "description"
    )
    kinds = rows.where("redundant").select("session_id", "pos", "action_type")
    return issues.join(kinds, ["session_id", "pos"]).withColumn(
        "description", F.when(F.col("action_type") == "click", "clicks").otherwise(F.col("description"))
    )


@query("WIN3", V.with_view(V.PLACED, """
SELECT session_id, 'error' AS severity, step_index::VARCHAR AS step_indices,
  printf('Step %d: coordinates [%.3f, %.3f] are outside valid range [0.0, 1.0]', step_index, coordinates[1], coordinates[2]) AS description
FROM flagged_v WHERE impossible"""))
def impossible(spark, sf):
    # row-wise: no session order is needed
    steps = A.steps(spark, sf).withColumn("impossible", R._impossible())
    return R.coordinate_issues(steps).select(
        "session_id", "severity", indices("step_indices").alias("step_indices"), "description"
    )


@query("WIN4", V.with_view(V.HISTORY, """
SELECT task_id, step_index, action_type, back::INT AS back FROM (
  SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY step_index DESC) AS back FROM history_v) WHERE back <= 10"""))
def recent(spark, sf):
    return H.recent_steps(A.history(spark, sf)).select("task_id", "step_index", "action_type", "back")


@query("WIN6", V.with_view(V.PLACED, "SELECT session_id, event_id, pos AS step_number FROM placed_v"))
def numbering(spark, sf):
    return A.placed_steps(spark, sf, lookahead=0).select("session_id", "event_id", F.col("pos").alias("step_number"))


@query("AGG8", V.with_view(V.STEPS, """
SELECT session_id, string_agg(action_type || '=' || n, ',' ORDER BY n DESC, action_type) AS action_counts
FROM (SELECT session_id, action_type, count(*) AS n FROM steps_v GROUP BY ALL) GROUP BY session_id"""))
def action_stats(spark, sf):
    return R.action_statistics(A.steps(spark, sf)).select(
        "session_id", R.counts_text(F.col("action_counts")).alias("action_counts")
    )


@query("AGG9", V.with_view(V.STEPS, """
SELECT session_id, action_type, n, total::BIGINT AS total, n / total::DOUBLE AS ratio FROM (
  SELECT *, sum(n) OVER (PARTITION BY session_id) AS total FROM (
    SELECT session_id, action_type, count(*) AS n FROM steps_v WHERE action_type NOT IN ('done', 'fail') GROUP BY ALL))
WHERE n / total::DOUBLE > 0.8::DOUBLE"""))
def diversity(spark, sf):
    return R.low_diversity(A.steps(spark, sf)).select("session_id", "action_type", "n", "total", "ratio")


REPORT_SQL = """
SELECT session_id, task, total_steps, n_loops, n_redundant, n_impossible, n_low_diversity, n_errors, n_warnings, quality_score,
  quality_score >= 0.6::DOUBLE AS use_for_training,
  CASE WHEN quality_score >= 0.6::DOUBLE THEN printf('APPROVED (score=%.2f, %d warnings)', quality_score, n_warnings)
    ELSE printf('REJECTED (score=%.2f, %d errors, %d warnings)', quality_score, n_errors, n_warnings) END AS summary
FROM report_v"""


@query("AGG10", V.with_view(V.REPORT, REPORT_SQL))
def session_report(spark, sf):
    return R.quality_report(flagged(spark, sf)).drop("action_counts")


@query("AGG11", V.with_view(V.REPORT, """
SELECT count(*) AS sessions, count(*) FILTER (quality_score >= 0.6::DOUBLE) AS approved, count(*) FILTER (quality_score < 0.6::DOUBLE) AS flagged,
  count(*) FILTER (quality_score >= 0.6::DOUBLE) / count(*)::DOUBLE * 100 AS approved_pct,
  sum(round(quality_score * 10)::BIGINT)::BIGINT / count(*)::DOUBLE / 10 AS avg_score,
  sum(n_loops)::BIGINT AS loop_issues, sum(n_redundant)::BIGINT AS redundant_issues, sum(n_low_diversity)::BIGINT AS low_diversity_issues,
  sum(n_impossible)::BIGINT AS impossible_issues, count(*) FILTER (quality_score = 1) AS perfect,
  count(*) FILTER (quality_score >= 0.8::DOUBLE AND quality_score < 1) AS good,
  count(*) FILTER (quality_score >= 0.6::DOUBLE AND quality_score < 0.8::DOUBLE) AS marginal,
  count(*) FILTER (quality_score < 0.6::DOUBLE) AS poor FROM report_v"""))
def summary(spark, sf):
    return R.batch_summary(R.quality_report(flagged(spark, sf)))


@query("AGG16", V.with_view(V.HISTORY, f"""
SELECT task_id, {V.STATUS} AS status, n_steps FROM (
  SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY step_index DESC) AS back, count(*) OVER (PARTITION BY task_id) AS n_steps FROM history_v)
WHERE back = 1"""))
def status(spark, sf):
    return H.task_status(A.history(spark, sf))


@query("AGG17", V.with_view(V.HISTORY, """
SELECT task_id, step_index, 0 AS part, printf('  [%02d] %s', step_index,
  CASE WHEN action_type IS NULL THEN 'no action' ELSE action_type || CASE WHEN success THEN ' OK' ELSE ' FAIL' END END) AS line FROM history_v
UNION ALL SELECT task_id, step_index, 1, '       Error: ' || error FROM history_v WHERE error IS NOT NULL"""))
def report(spark, sf):
    return H.report_lines(A.history(spark, sf))


@query("AGG17_result", V.with_view(V.HISTORY, f"""
SELECT task_id, {V.STATUS} = 'completed' AS success, n_steps,
  CASE WHEN action_type IS NOT NULL THEN description WHEN {V.STATUS} <> 'completed' THEN 'Task did not complete successfully' ELSE 'SUCCESS' END AS outcome
FROM (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY step_index DESC) AS back, count(*) OVER (PARTITION BY task_id) AS n_steps FROM history_v)
WHERE back = 1"""))
def result(spark, sf):
    return H.task_results(A.history(spark, sf))


@query("VAL9", V.with_view(V.HISTORY, "SELECT task_id, step_index, screenshot_path, action_type FROM history_v WHERE screenshot_path <> ''"))
def shots(spark, sf):
    return H.screenshots(A.history(spark, sf))


@query("FN29", V.with_view(V.STEPS, f"""
SELECT event_id, action_type, level::INT AS level, {V.strings(D.RISK_NAMES)}[(level + 1)::INT] AS name FROM (
  SELECT event_id, action_type, CASE
    WHEN action_type = 'click' AND {V.any_of('lower(task)', D.RISKY_CLICK_WORDS)} THEN 3
    WHEN action_type = 'type' AND {V.any_of('lower(task)', D.RISKY_TYPE_WORDS)} THEN 3
    WHEN action_type = 'type' THEN 2 WHEN action_type IN ('click', 'key') THEN 1 ELSE 0 END AS level FROM steps_v)"""))
def risk(spark, sf):
    level = T.risk_level(F.col("action_type"), F.lit(""), F.col("task"))
    return A.steps(spark, sf).select("event_id", "action_type", level.alias("level"), T.risk_name(level).alias("name"))


@query("FN34", V.with_view(V.STEPS, "SELECT event_id, CASE " + " ".join(
    f"WHEN contains(lower(task), '{k}') THEN {V.lit(' > '.join(p))}" for k, p in D.PLAN_STEPS.items()
) + f" ELSE {V.lit(' > '.join(D.GENERIC_PLAN))} END AS plan FROM steps_v"))
def plans(spark, sf):
    return A.steps(spark, sf).select("event_id", F.array_join(T.task_plan(F.col("task")), " > ").alias("plan"))


@query("FN36", V.with_view(V.HISTORY, """
SELECT event_id, 'Step ' || step_index || ': ' || CASE WHEN action_type IS NULL THEN ''
  ELSE action_type || ' | success=' || CASE WHEN success THEN 'True' ELSE 'False' END END AS entry FROM history_v"""))
def entries(spark, sf):
    return A.history(spark, sf).select(
        "event_id", T.history_entry(F.col("step_index"), F.col("action_type"), F.col("success")).alias("entry")
    )


@query("NRM2", V.with_view(V.STEPS, f"SELECT event_id, array_to_string({V.tags('task', 'action_type')}, ',') AS tags FROM steps_v"))
def step_tags(spark, sf):
    return A.steps(spark, sf).select(
        "event_id", F.array_join(T.infer_tags(F.col("task"), F.col("action_type")), ",").alias("tags")
    )


@query("NRM3", V.with_view(V.STEPS, """
SELECT event_id, 's_' || substr(sha256('session_' || session_id || '.jsonl:' || (event_id + 1)), 1, 16) AS sample_id FROM steps_v"""))
def ids(spark, sf):
    from stepforge.operators.normalize import sample_id

    return A.recorded_lines(spark, sf).select(
        "event_id", sample_id(F.col("source_file"), F.col("line_number")).alias("sample_id")
    )


@query("SET4", V.with_view(V.HISTORY, """
SELECT task_id, CASE WHEN task_id = (SELECT min(task_id) FROM history_v) THEN 'failed' ELSE 'running' END AS status,
  CASE WHEN task_id = (SELECT min(task_id) FROM history_v) THEN 'Cancelled by user' ELSE '' END AS result
FROM history_v GROUP BY task_id"""))
def cancel(spark, sf):
    from stepforge.operators.registry import complete_task

    tasks = A.history(spark, sf).select("task_id").distinct()
    first = tasks.agg(F.min("task_id")).scalar()
    table = tasks.select(
        "task_id", first.alias("first_task"), F.lit("running").alias("status"), F.lit("").alias("result")
    )
    return complete_task(table, F.col("first_task"), False, "Cancelled by user").drop("first_task")


@query("E2E2", V.with_view(V.REPORT, REPORT_SQL))
def analysis(spark, sf):
    """Session report over all recorded steps - the headline query."""
    return session_report(spark, sf)
