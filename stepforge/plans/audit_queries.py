"""Queries of the audits (survey section 2.14), each over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepforge.functions import parsing as P
from stepforge.functions import personal as personal_findings
from stepforge.operators import audit, semantic, versions
from stepforge.plans import shared
from stepforge.plans import sqlviews as V
from stepforge.plans.catalog import query
from stepforge.sources import adapters as A
from stepforge.sources import recordings
from stepforge.storage import materialize, new_folder

_PERSONAL = V.personal("text")
_FLAGS = ", ".join(f"{test} AS {name}" for name, test in _PERSONAL.items())


@query("X2", """
SELECT session_id, original, n_steps FROM (
  SELECT session_id, n_steps, min(session_id) OVER (PARTITION BY sequence) AS original FROM (
    SELECT 'c' || conv_id AS session_id, count(*) AS n_steps, string_agg(role, ',' ORDER BY turn) AS sequence FROM conversations GROUP BY conv_id))
WHERE original <> session_id""")
def repeated_sessions(spark, sf):
    """Conversations as sessions whose turns are the steps."""
    turns = A.table(spark, sf, "conversations")
    session = F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("session_id")
    return audit.sequence_duplicates(turns.select(session, F.col("turn").alias("pos"), F.col("role").alias("action_type")))


@query("X3", V.with_view(V.STEPS, """
SELECT session_id, count(gap) AS n_gaps, count(*) FILTER (gap < 0.1::DOUBLE) AS n_fast, count(*) FILTER (gap > 30) AS n_slow FROM (
  SELECT session_id, (epoch_us(lead(ts) OVER (PARTITION BY session_id ORDER BY ts, event_id)) - epoch_us(ts)) / 1e6 AS gap FROM steps_v)
GROUP BY session_id"""))
def velocity(spark, sf):
    return audit.velocity(A.steps(spark, sf))


@query("X4", V.with_view(V.STEPS, f"""
SELECT session_id, count(*) AS n_clicks, greatest((max(coordinates[1]) - min(coordinates[1])) * 1920, (max(coordinates[2]) - min(coordinates[2])) * 1080) <= 10 AS clustered
FROM steps_v WHERE action_type IN {V.CLICKS} AND coordinates IS NOT NULL GROUP BY session_id HAVING count(*) >= 2"""))
def clustered(spark, sf):
    return audit.clustered_clicks(A.steps(spark, sf))


@query("X5", V.with_view(V.SAMPLES, """
SELECT sample_id, len(words)::BIGINT AS n_words, len(shown)::BIGINT AS n_shown, len(shown) > 0 AS supported FROM (
  SELECT sample_id, words, list_filter(words, lambda w: contains(lower(coalesce(ocr_text_raw, '')), w)) AS shown FROM (
    SELECT sample_id, ocr_text_raw, list_distinct(regexp_extract_all(lower(task), '[a-z]{4,}')) AS words FROM samples_v WHERE action_type = 'done'))"""))
def unsupported(spark, sf):
    return audit.goal_evidence(A.samples(spark, sf))


@query("X6", V.with_view(V.STEPS, """
SELECT session_id, in_order, terminal, in_order AND terminal AS passed FROM (
  SELECT session_id, NOT coalesce(bool_or(later <= step_index), false) AS in_order, arg_max(action_type, (ts, event_id)) IN ('done', 'fail') AS terminal FROM (
    SELECT *, lead(step_index) OVER (PARTITION BY session_id ORDER BY ts, event_id) AS later FROM steps_v) GROUP BY session_id)"""))
def logic(spark, sf):
    return audit.logic_gate(A.steps(spark, sf))


@query("X7", f"SELECT *, NOT ({' OR '.join(_PERSONAL)}) AS no_pii FROM (SELECT doc_id, {_FLAGS} FROM documents)")
def personal(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", *audit.personal_data(F.col("text")))


@query("X7_masks")
def personal_masks(spark, sf):
    """Texts with personal data, masked: what was found, and that nothing is left."""
    d = A.table(spark, sf, "documents").select("doc_id", "text")
    # few texts, used twice: written once
    d = materialize(d.where(~personal_findings.none_found(F.col("text"))), "personal")
    found = personal_findings.findings(d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_findings"), F.array_sort(F.collect_set("kind")).alias("kinds"))
    masked = d.select("doc_id", personal_findings.masked_text(F.col("text")).alias("masked"))
    return masked.join(found, "doc_id").select(
        "doc_id", "n_findings", F.array_join("kinds", ",").alias("kinds"), F.sha2("masked", 256).alias("masked_sha256"),
        personal_findings.none_found(F.col("masked")).alias("clean"),
    )


@query("X8", V.with_view(V.SAMPLES, """
SELECT sample_id, CASE WHEN doc_id % 5 = 0 THEN 'removed' WHEN doc_id % 7 = 0 THEN 'added' WHEN toxic = 1 AND task <> 'Quit' THEN 'changed' ELSE 'same' END AS change
FROM samples_v WHERE NOT (doc_id % 5 = 0 AND doc_id % 7 = 0)"""))
def changed(spark, sf):
    """A version without some samples, with some new ones, and with the tasks of toxic ones reset."""
    s = A.samples(spark, sf).select("sample_id", "doc_id", "task", "action_type", "toxic")
    after = s.where("doc_id % 5 <> 0").withColumn("task", F.when(F.col("toxic") == 1, "Quit").otherwise(F.col("task")))
    return audit.version_diff(s.where("doc_id % 7 <> 0"), after, "sample_id", ["task", "action_type"])


@query("X8_runs", """
SELECT 's_' || doc_id AS sample_id, string_agg(run_id, ',' ORDER BY run_id) AS runs FROM (
  SELECT doc_id, 'run_' || lang AS run_id FROM documents UNION SELECT doc_id, 'run_labelled' FROM labels) GROUP BY doc_id""")
def used_by(spark, sf):
    sample = F.concat(F.lit("s_"), F.col("doc_id").cast("string")).alias("sample_id")
    by_lang = A.table(spark, sf, "documents").select(sample, F.concat(F.lit("run_"), "lang").alias("run_id"))
    labelled = A.table(spark, sf, "labels").select(sample, F.lit("run_labelled").alias("run_id"))
    runs = audit.runs_of(by_lang.unionByName(labelled).where("run_id is not null"))
    return runs.select("sample_id", F.array_join("runs", ",").alias("runs"))


_SHARES = {"en": 0.4, "de": 0.3, "fr": 0.2, "es": 0.1}


@query("X8_changes", V.with_view(V.SAMPLES, """
SELECT sample_id, CASE WHEN doc_id % 101 = 0 THEN 'removed' ELSE 'changed' END AS change
FROM samples_v WHERE doc_id % 101 = 0 OR (doc_id % 97 = 0 AND task <> 'Quit')"""))
def stored_changes(spark, sf):
    """Two stored versions that differ in few rows; only buckets with another digest are read."""
    s = A.samples(spark, sf).select("sample_id", "doc_id", "task", "action_type")
    after = s.where("doc_id % 101 <> 0").withColumn("task", F.when(F.col("doc_id") % 97 == 0, "Quit").otherwise(F.col("task")))
    paths = [new_folder(spark, "version") for _ in range(2)]
    for rows, path in zip((s, after), paths):
        versions.write_version(rows, path, "sample_id", ["task", "action_type"])
    return versions.changes(spark, *paths, "sample_id", ["task", "action_type"])


@query("X9", f"""
WITH share_v(lang, share) AS (VALUES {', '.join(f"('{k}', {v}::DOUBLE)" for k, v in _SHARES.items())}),
quota_v AS (SELECT lang, floor(min(n / share) OVER () * share) AS quota FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang) JOIN share_v USING (lang))
SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('0:' || doc_id), doc_id) AS r FROM documents) JOIN quota_v USING (lang) WHERE r <= quota""")
def balanced(spark, sf):
    return audit.balance(A.table(spark, sf, "documents").select("doc_id", "lang"), "lang", _SHARES, "doc_id")


@query("X10", V.with_view(V.SAMPLES, """
SELECT sample_id, task, doc_lang FROM (SELECT *, row_number() OVER (PARTITION BY task || '|' || doc_lang ORDER BY md5('1:' || sample_id), sample_id) AS r FROM samples_v) WHERE r <= 50"""))
def held_out(spark, sf):
    """Fifty samples of every task and language, locked away for tests."""
    s = A.samples(spark, sf).select("sample_id", "task", "doc_lang").withColumn("stratum", F.concat("task", F.lit("|"), "doc_lang"))
    quotas = s.select("stratum").distinct().withColumn("quota", F.lit(50))
    return audit.quota_sample(s, "stratum", quotas, "sample_id", seed=1).drop("stratum")


@query("X10_expert", "SELECT doc_id FROM documents WHERE ('0x' || left(md5('2:' || doc_id), 8))::BIGINT < 214748364")
def expert(spark, sf):
    return audit.expert_sample(A.table(spark, sf, "documents").select("doc_id"), "doc_id", seed=2)


@query("X11", V.with_view(V.SAMPLES, """
SELECT sample_id, mean_confidence FROM (
  SELECT sample_id, list_reduce(list_transform(regions, lambda r: r.confidence), lambda a, b: a + b, 0::DOUBLE) / len(regions) AS mean_confidence FROM samples_v)
ORDER BY mean_confidence, sample_id LIMIT 100"""))
def uncertain(spark, sf):
    from stepforge.functions import regions as R

    scored = A.samples(spark, sf).select("sample_id", R.mean_confidence(F.col("regions")).alias("mean_confidence"))
    return audit.annotation_queue(scored, "mean_confidence", 100, "sample_id")


_SHARD = 300


@query("X12", f"""
WITH placed AS (SELECT doc_id, md5(concat_ws('|', doc_id, lang, source, n_chars)) AS d, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents)
SELECT place // {_SHARD} AS shard, count(*) AS n_rows, min(doc_id) AS first_key, max(doc_id) AS last_key, 1::BIGINT AS n_files,
  sha256(string_agg(d, '' ORDER BY place)) AS digest FROM placed GROUP BY 1""")
def shards(spark, sf):
    """Released in shards of exactly 300 rows and read back from the files: all full but the last."""
    path = new_folder(spark, "release")
    audit.write_shards(A.table(spark, sf, "documents"), "doc_id", path, _SHARD)
    digest = F.md5(F.concat_ws("|", *(F.col(x).cast("string") for x in ("doc_id", "lang", "source", "n_chars"))))
    read = spark.read.parquet(path)
    return audit.shard_manifest(read.withColumn("shard", F.col("shard").cast("long")), "doc_id", digest)


_OUTPUTS = """outputs_v AS (SELECT *, CASE WHEN role = 'system' THEN 'x' WHEN m IN (0, 1, 2) THEN 'x' WHEN m <> 3 AND x > 1 THEN 'x' END AS error FROM (
  SELECT conv_id, turn, role, (conv_id + turn) % 7 AS m, ((conv_id + turn) % 13) / 10.0 AS x FROM conversations))"""


@query("X13", f"""
WITH {_OUTPUTS}
SELECT conv_id, long_enough, roles_ok, action_ok, long_enough AND roles_ok AND action_ok AS passed FROM (
  SELECT conv_id, count(*) >= 3 AS long_enough,
    regexp_full_match(string_agg(role, ' ' ORDER BY turn), '(system )?user( assistant user)*( assistant)?') AS roles_ok,
    arg_max(role = 'assistant' AND error IS NULL, turn) AS action_ok FROM outputs_v GROUP BY conv_id)""")
def strict_chats(spark, sf):
    return audit.strict_conversations(A.model_outputs(spark, sf), P.parse_action(F.col("output"))["error"].isNull())


@query("X14", V.with_view(V.SAMPLES + ",\n" + V.FACTS, """
SELECT sample_id, CASE WHEN path IS NULL THEN 'missing' WHEN 2 * width < 800 OR 2 * height < 600 THEN 'too small' WHEN 4 * length < 51200 THEN 'too few bytes'
  WHEN len(regions) < 2 THEN 'too few regions' END AS reason FROM samples_v s LEFT JOIN facts_v f ON s.screenshot_path = f.path"""))
def strict_images(spark, sf):
    """The screenshots at twice their resolution, so that some pass."""
    rows = shared.with_facts(spark, sf).withColumns({"width": 2 * F.col("width"), "height": 2 * F.col("height"), "length": 4 * F.col("length")})
    return rows.select("sample_id", audit.strict_image(F.size("regions")).alias("reason"))


@query("SRC6", V.with_view(V.SAMPLES, """
SELECT screenshot_path AS image_path, task, step_index + 1 AS total_steps, length(reasoning) AS reasoning_chars, action_type, coordinates[1] AS x, "key", description FROM samples_v"""))
def annotation_files(spark, sf):
    """Samples written as files of up to 500 annotation documents, read back."""
    path = new_folder(spark, "annotations")
    action = F.struct(F.col("action_type").alias("type"), "coordinates", "text", "key", "description").alias("action")
    document = F.to_json(
        F.struct(F.col("screenshot_path").alias("image_path"), F.col("task").alias("task_instruction"),
                 (F.col("step_index") + 1).alias("total_steps"), "reasoning", action)
    )
    files = A.samples(spark, sf).groupBy(F.floor(F.col("doc_id") / 500).alias("file")).agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list(document), ",\n"), F.lit("\n]")).alias("value")
    )
    files.write.partitionBy("file").text(path)
    read = recordings.read_annotation_documents(spark, path, "*.txt")
    return read.select("image_path", "task", "total_steps", F.length("reasoning").cast("long").alias("reasoning_chars"),
                       "action_type", F.get("coordinates", 0).alias("x"), "key", "description")


@query("X1", """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
told AS (SELECT vec_id * 2 AS vec_id, e FROM v
  UNION ALL SELECT a.vec_id * 2 + 1, list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] + 0.33::DOUBLE * b.e[i])
  FROM v a JOIN v b ON b.vec_id = a.vec_id + 1),
sized AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM told),
near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sized a JOIN sized b ON a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) > 0.95),
reach AS (SELECT vec_id AS node, vec_id AS seen FROM told UNION SELECT node, b FROM reach JOIN near ON seen = a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, group_id FROM told
JOIN (SELECT node, min(seen) AS group_id FROM reach GROUP BY node) ON node = vec_id
LEFT JOIN (SELECT a, count(*) AS n_links FROM near GROUP BY a) ON a = vec_id""")
def semantic_duplicates(spark, sf):
    """Every vector and a retelling of it, moved by a third towards its successor: about half of them stay close."""
    return semantic.links(A.retold_vectors(spark, sf))
