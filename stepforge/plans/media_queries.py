"""Images, screen changes and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.functions import pixels as X
from stepforge.operators import screens as S
from stepforge.operators import skew
from stepforge.operators.duplicate_index import StoredIndex
from stepforge.plans import sqlviews as V
from stepforge.plans.catalog import query
from stepforge.sources import adapters as A
from stepforge.storage import materialize, new_folder
from stepforge.streaming import feed, incremental

c = F.col

_GREY = """frames_v AS (
  SELECT vec_id, 's' || label AS session_id, i - 1 AS i, g, 255 - g AS h, (g + (i - 1) * 3) % 256 AS s FROM (
    SELECT vec_id, label, unnest(range(1, 65)) AS i, unnest(list_transform(embedding, lambda v: least(255, greatest(0, floor((v::DOUBLE + 0.5::DOUBLE) * 255)::INT)))) AS g FROM embeddings))"""
_DIFF = _GREY + """,
order_v AS (SELECT vec_id, 's' || label AS session_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos FROM embeddings),
pixel_v AS (
  SELECT a.session_id, o.pos, a.i, (abs(a.g - b.g) + abs(a.h - b.h) + abs(a.s - b.s) > 90)::INT AS changed,
    (abs(a.g - b.g) > 30)::INT + (abs(a.h - b.h) > 30)::INT + (abs(a.s - b.s) > 30)::INT AS channels,
    (CASE WHEN a.i // 8 < 2 THEN 0 WHEN a.i // 8 < 5 THEN 1 ELSE 2 END) * 3 + (CASE WHEN a.i % 8 < 2 THEN 0 WHEN a.i % 8 < 5 THEN 1 ELSE 2 END) AS region
  FROM order_v o JOIN order_v p ON o.session_id = p.session_id AND p.pos = o.pos + 1
    JOIN frames_v a ON a.vec_id = o.vec_id JOIN frames_v b ON b.vec_id = p.vec_id AND a.i = b.i),
regions_v AS (SELECT session_id, pos, region, sum(changed)::BIGINT / count(*)::DOUBLE AS share FROM pixel_v GROUP BY ALL),
totals_v AS (SELECT session_id, pos, sum(changed)::BIGINT / 64::DOUBLE AS change_ratio, sum(channels)::BIGINT / 192::DOUBLE AS channel_ratio FROM pixel_v GROUP BY ALL),
""" + f"""ranked_v AS (
  SELECT session_id, pos, count(*) FILTER (share > 0.05::DOUBLE) AS active, coalesce(string_agg({V.strings(D.SCREEN_REGIONS)}[(region + 1)::INT], ', ' ORDER BY share DESC, region) FILTER (share > 0), '') AS changed,
    min_by({V.strings(D.SCREEN_REGIONS)}[(region + 1)::INT], (-share, region)) AS most_changed FROM regions_v GROUP BY ALL),
diff_v AS (
  SELECT *, CASE WHEN change_ratio < 0.001::DOUBLE THEN 'no_change' WHEN change_ratio < 0.02::DOUBLE THEN 'minor_change' WHEN change_ratio > 0.5::DOUBLE THEN 'full_screen'
    WHEN change_ratio > 0.15::DOUBLE AND active >= 5 THEN 'layout_shift' WHEN change_ratio BETWEEN 0.05::DOUBLE AND 0.15::DOUBLE AND active <= 2 THEN 'new_element'
    WHEN change_ratio BETWEEN 0.02::DOUBLE AND 0.05::DOUBLE THEN 'text_update' ELSE 'minor_change' END AS change_type,
    array_to_string(string_split(changed, ', ')[1:3], ', ') AS top, printf('%.1f%%', change_ratio * 100) AS pct
  FROM totals_v JOIN ranked_v USING (session_id, pos))"""


def placed(spark, sf):
    """Frames with their place; only the key columns go through the numbering."""
    f = A.frames(spark, sf)
    keys = skew.in_order(f.select("session_id", "vec_id"), ["vec_id"], [], 0)
    return keys.join(f.drop("session_id"), "vec_id")


def compared(spark, sf):
    return S.compare(S.frame_pairs(placed(spark, sf)))


_SINC = lambda x: f"CASE WHEN {x} = 0 THEN 1 ELSE sin(pi() * {x}) / (pi() * {x}) END"

# The hash of an 8x8 frame: grey, windowed-sinc resampling to 64x64 in two rounded steps, the 16x16 lowest
# frequencies of the cosine transform, bits against their median.
_HASHED = _GREY + f""",
grey_v AS (SELECT vec_id, i // 8 AS y, i % 8 AS x, (19595 * s + 38470 * h + 7471 * g + 32768) >> 16 AS v FROM frames_v),
weight_v AS (
  SELECT t, j, w / sum(w) OVER (PARTITION BY t) AS w FROM (
    SELECT t, j, CASE WHEN abs(d) < 3 THEN ({_SINC('d')}) * ({_SINC('(d / 3)')}) ELSE 0 END AS w FROM (
      SELECT t, j, (j + 0.5::DOUBLE) - (t + 0.5::DOUBLE) / 8 AS d FROM (SELECT unnest(range(64)) AS t), (SELECT unnest(range(8)) AS j)))),
wave_v AS (SELECT k, n, 2 * cos(pi() * k * (2 * n + 1) / 128) AS c FROM (SELECT unnest(range(16)) AS k), (SELECT unnest(range(64)) AS n)),
across_v AS (SELECT vec_id, y, t, greatest(0, least(255, round_even(sum(v * w), 0))) AS v FROM grey_v JOIN weight_v ON x = j GROUP BY ALL),
small_v AS (SELECT vec_id, w.t AS u, a.t, greatest(0, least(255, round_even(sum(v * w), 0))) AS v FROM across_v a JOIN weight_v w ON y = j GROUP BY ALL),
half_v AS (SELECT vec_id, k, t, sum(v * c) AS v FROM small_v JOIN wave_v ON u = n GROUP BY ALL),
low_v AS (SELECT vec_id, h.k, c.k AS l, sum(v * c) AS v FROM half_v h JOIN wave_v c ON t = n GROUP BY ALL),
bit_v AS (SELECT vec_id, k * 16 + l AS i, (v > median(v) OVER (PARTITION BY vec_id))::INT AS b FROM low_v)"""


@query("IMG2", V.with_view(_HASHED, """
SELECT vec_id, string_agg(digit, '' ORDER BY place) AS phash FROM (
  SELECT vec_id, i // 4 AS place, printf('%x', sum(b << (3 - i % 4)::INT)::INT) AS digit FROM bit_v GROUP BY ALL) GROUP BY vec_id"""))
def hashes(spark, sf):
    return A.frames(spark, sf).select("vec_id", X.perceptual_hash("height", "width", "channels", "data").alias("phash"))


@query("IMG3", V.with_view(_GREY, "SELECT vec_id, floor(var_pop(v) * 1000)::BIGINT AS variance_milli FROM (SELECT vec_id, unnest([g, h, s]) AS v FROM frames_v) GROUP BY 1"))
def variance(spark, sf):
    v = X.pixel_variance("height", "width", "channels", "data")
    return A.frames(spark, sf).select("vec_id", F.floor(v * 1000).alias("variance_milli"))


@query("IMG4", V.with_view(_DIFF, "SELECT session_id, pos, change_ratio, change_type, change_ratio >= 0.01::DOUBLE AS is_significant FROM diff_v"))
def difference(spark, sf):
    return compared(spark, sf).select("session_id", "pos", "change_ratio", "change_type", "is_significant")


@query("IMG5", V.with_view(_DIFF, """SELECT session_id, pos, CASE WHEN pos % 4 = 0 THEN 0 ELSE channel_ratio END AS effect_ratio, pos % 4 = 0 OR channel_ratio >= 0.01::DOUBLE AS effect_ok FROM diff_v"""))
def effect(spark, sf):
    rows = compared(spark, sf).withColumn("action_type", F.when(c("pos") % 4 == 0, "wait").otherwise("click"))
    return S.verify_effect(rows).select("session_id", "pos", "effect_ratio", "effect_ok")


@query("IMG6", "SELECT vec_id, 8 AS image_width, 8 AS image_height FROM embeddings")
def dimensions(spark, sf):
    return A.frames(spark, sf).select("vec_id", c("width").alias("image_width"), c("height").alias("image_height"))


_CLASSES = """SELECT l_orderkey, l_linenumber, ratio, active FROM (SELECT l_orderkey, l_linenumber, l_extendedprice / 105000::DOUBLE AS ratio, (l_quantity::INT % 10) AS active FROM lineitem)"""


@query("FN30", f"""SELECT l_orderkey, l_linenumber, CASE WHEN ratio < 0.001::DOUBLE THEN 'no_change' WHEN ratio < 0.02::DOUBLE THEN 'minor_change' WHEN ratio > 0.5::DOUBLE THEN 'full_screen'
    WHEN ratio > 0.15::DOUBLE AND active >= 5 THEN 'layout_shift' WHEN ratio BETWEEN 0.05::DOUBLE AND 0.15::DOUBLE AND active <= 2 THEN 'new_element'
    WHEN ratio BETWEEN 0.02::DOUBLE AND 0.05::DOUBLE THEN 'text_update' ELSE 'minor_change' END AS change_type FROM ({_CLASSES})""")
def classification(spark, sf):
    from stepforge.functions.rendering import change_type

    li = A.table(spark, sf, "lineitem")
    kind = change_type(c("l_extendedprice") / 105000.0, c("l_quantity").cast("int") % 10)
    return li.select("l_orderkey", "l_linenumber", kind.alias("change_type"))


@query("FN31", V.with_view(_DIFF, """SELECT session_id, pos, CASE change_type WHEN 'no_change' THEN 'No meaningful change detected'
  WHEN 'minor_change' THEN 'Minor change in ' || top || ' — likely cursor or clock (' || pct || ' of pixels)' WHEN 'text_update' THEN 'Text updated in ' || top || ' (' || pct || ' of pixels changed)'
  WHEN 'new_element' THEN 'New element appeared in ' || top || ' (' || pct || ' of pixels changed)' WHEN 'layout_shift' THEN 'Major layout change across ' || top || ' — possible new window (' || pct || ')'
  ELSE 'Full screen change — application likely switched (' || pct || ')' END AS summary FROM diff_v"""))
def change_summary(spark, sf):
    return compared(spark, sf).select("session_id", "pos", "summary")


@query("SRT5", V.with_view(_DIFF, "SELECT session_id, pos, changed, most_changed FROM diff_v"))
def region_ranking(spark, sf):
    return compared(spark, sf).select("session_id", "pos", F.array_join("changed_regions", ", ").alias("changed"), "most_changed")


@query("STR1", V.with_view(V.HISTORY, f"""
SELECT task_id, 'step_update' AS event, {V.STATUS} AS status, step_index AS step, coalesce(action_type, '') AS action FROM (
  SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY step_index DESC) AS back FROM history_v) WHERE back = 1
UNION ALL SELECT task_id, 'task_finished', {V.STATUS}, -1, '' FROM (
  SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY step_index DESC) AS back FROM history_v) WHERE back = 1 AND {V.STATUS} <> 'running'"""))
def live_feed(spark, sf):
    """The step history arriving as one batch of files."""
    base = new_folder(spark, "feed")
    A.history(spark, sf).select(
        "task_id", "step_index", "action_type", "success", "error", c("description").alias("reasoning"), "screenshot_path"
    ).write.parquet(f"{base}/steps")
    q = feed.start_feed(spark, f"{base}/steps", f"{base}/events", f"{base}/checkpoint", {"availableNow": True})
    q.awaitTermination()
    return spark.read.schema(feed.EVENT_SCHEMA).parquet(f"{base}/events").select(
        "task_id", "event", "status", F.coalesce("step", F.lit(-1)).alias("step"), F.coalesce("action", F.lit("")).alias("action")
    )


@query("STR2", V.with_view(V.FULL_RUN, """
SELECT count(*) FILTER (r_schema IS NULL AND r_coords IS NULL AND path IS NOT NULL AND dropped_doc IS NULL) AS kept,
  count(*) FILTER (gate_status <> 'rejected') AS scored FROM gated_v"""))
def growing_folder(spark, sf):
    """Recordings arriving in two batches; what was kept of the first stays known.

    The lines are written by ranges, in as many files as their size asks for.
    """
    base = new_folder(spark, "incremental")
    lines = A.sample_lines(spark, sf)
    last = lines.agg(F.max("line_number")).scalar()
    parts = lines.withColumn("part", F.floor((c("line_number") - 1) * 4 / last).cast("int"))
    facts = materialize(A.screenshot_facts(spark, sf).withColumnRenamed("file_sha", "sha256"), "facts")
    for early in (True, False):
        half = parts.where(c("part") < 2 if early else c("part") >= 2).repartitionByRange("line_number").sortWithinPartitions("line_number")
        half.select("value", "part").write.mode("append").partitionBy("part").text(f"{base}/in")
        q = incremental.start_incremental(
            spark, f"{base}/in", f"{base}/work", facts, pattern="*.txt", trigger={"availableNow": True}
        )
        q.awaitTermination()
    index = StoredIndex(spark, f"{base}/work/duplicate_index", "reader")
    kept = index.rows().agg(F.count(F.lit(1)).alias("kept"))
    scored = spark.read.parquet(f"{base}/work/scored").agg(F.count(F.lit(1))).scalar()
    return kept.select("kept", scored.alias("scored"))
