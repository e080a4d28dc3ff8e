"""Writers: training examples, manifest, flat table, run report, sessions."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.functions import text as T
from stepforge.operators import skew
from stepforge.sources import keyed_files

SESSIONS_A_TASK = 1000


def write_examples(examples: DataFrame, out_dir: str, version: str, part: str = "") -> None:
    """JSON lines in one folder per stage (``training_stage=...``), replaced per version, or per part of it."""
    (
        examples.select(F.col("stage").alias("training_stage"), F.col("line").alias("value"))
        .hint("rebalance", "training_stage")
        .write.mode("overwrite")
        .partitionBy("training_stage")
        .text(f"{out_dir}/v{version.replace('.', '_')}" + (f"/{part}" if part else ""))
    )


def manifest_entries(counts: dict[str, int], version: str, prefix: str = "steps") -> dict:
    """Dataset description per stage, from at most three counts."""
    # ---- fixed values: manifest layout ----
    return {
        f"{prefix}_{stage}_{version.replace('.', '_')}": {
            "file_name": f"v{version.replace('.', '_')}/training_stage={stage}",
            "formatting": "sharegpt",
            "columns": {"prompt": "conversations", "images": "images", "system": "system"},
            "tags": {
                "role_tag": "from", "content_tag": "value", "user_tag": "human",
                "assistant_tag": "gpt", "system_tag": "system",
            },
            "num_samples": n,
            "stage": stage,
            "version": version,
        }
        for stage, n in counts.items()
    }


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """One small driver-side text through the Hadoop file system API."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text_file(spark: SparkSession, path: str) -> str | None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return None
    rows = spark.read.text(path, wholetext=True).collect()  # a manifest: a few kilobytes
    return rows[0].value if rows else ""


def update_manifest(spark: SparkSession, out_dir: str, counts: dict[str, int], version: str,
                    prefix: str = "steps") -> dict:
    """Insert or replace this version's entries in ``dataset_info.json``."""
    path = f"{out_dir}/dataset_info.json"
    info = json.loads(read_text_file(spark, path) or "{}")
    info.update(manifest_entries(counts, version, prefix))
    write_text_file(spark, path, json.dumps(info, indent=2, ensure_ascii=False))
    return info


def write_report(spark: SparkSession, path: str, report: dict) -> None:
    """Metrics of one run as a JSON document."""
    write_text_file(spark, path, json.dumps(report, indent=2, ensure_ascii=False))


def tags_json(tags: Column) -> Column:
    """Tag array as JSON text with ', ' between the items, ASCII only."""
    return F.concat(F.lit("["), F.array_join(F.transform(tags, T.json_string_ascii), ", "), F.lit("]"))


def number_text(c: Column) -> Column:
    """A double as the shortest decimal text that reads back equal (0.0001, not 1.0E-4)."""
    plain = c.cast("string")
    expanded = F.regexp_replace(c.cast("decimal(38,18)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(F.contains(plain, F.lit("E")), expanded).otherwise(plain)


def flat_rows(samples: DataFrame) -> DataFrame:
    """The 22-column export row; rows without a readable screenshot are dropped.

    Needs ``file_exists`` and ``screenshot`` (bytes) from the image join.
    """
    blank = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    coords = F.col("coordinates")
    point = F.when(
        F.size(coords) > 0,
        F.concat(F.lit("["), number_text(coords[0]), F.lit(", "), number_text(coords[1]), F.lit("]")),
    ).otherwise("")
    return samples.where("file_exists").select(
        "sample_id", "session_id", "step_index", "task", blank("task_category"), "action_type",
        point.alias("coordinates"),
        F.coalesce("text", F.lit("")).alias("text_input"),
        F.coalesce("key", F.lit("")).alias("key_input"),
        blank("description"), blank("reasoning"), blank("intent"),
        "screenshot",
        F.coalesce("ocr_text_raw", F.lit("")).alias("ocr_text"),
        F.coalesce("language", F.lit("unknown")).alias("detected_lang"),
        F.coalesce("platform", F.lit("unknown")).alias("platform"),
        F.coalesce("difficulty", F.lit(0)).alias("difficulty"),
        T.nearest(F.coalesce("quality_score", F.lit(0.0)), 4).alias("quality_score"),
        blank("training_stage"), "source_type",
        tags_json(F.col("tags")).alias("tags"),
        blank("dataset_version"),
    )


def card_language_counts(samples: DataFrame) -> DataFrame:
    """Languages over all input samples, exported or not."""
    return samples.groupBy(F.col("language")).agg(F.count(F.lit(1)).alias("n"))


def size_category(n: Column) -> Column:
    return F.when(n < 10000, "1K<n<10K").otherwise("10K<n<100K")


def append_session_steps(steps: DataFrame, out_dir: str, folders: int | None = None, hot_rows: int = skew.HOT_ROWS) -> None:
    """Recorder output: one JSON object per step, appended, one folder per session.

    The folder name carries the session file name, so session globs keep working; a run adds
    one file to it, its lines by ``step_index``.  Tasks get about equal numbers of sessions, and
    a session of more than ``hot_rows`` steps is dealt over several tasks, a file each.
    With ``folders``, sessions share that many folders by a hash of their id.  A session's
    steps stay together, and each line tells its session.
    """
    if folders is not None:
        name = F.concat(F.lit("shared_"), F.pmod(F.xxhash64("session_id"), F.lit(folders)).cast("string"))
        _json_by_folder(steps.withColumn("session_file", _session_file(name)).hint("rebalance", "session_file"), out_dir)
        return
    named = steps.withColumn("session_file", _session_file(F.coalesce("session_id", F.lit("null"))))
    sessions = named.agg(F.approx_count_distinct("session_file")).first()[0]
    tasks = max(steps.sparkSession.sparkContext.defaultParallelism, -(-sessions // SESSIONS_A_TASK))
    hot = skew.split_counts(named.select("session_file"), "session_file", hot_rows)
    slices = F.floor(F.pmod(F.xxhash64("step_index"), F.coalesce("_slices", F.lit(1))))
    dealt = (
        named.join(F.broadcast(hot), "session_file", "left").withColumn("_slice", slices).drop("_slices")
        .repartition(tasks, "session_file", "_slice").sortWithinPartitions("session_file", "step_index")
    )
    if not keyed_files.reaches(out_dir):
        _json_by_folder(dealt.drop("_slice"), out_dir)
        return
    line = F.to_json(F.struct(*steps.columns), {"ignoreNullFields": "false"})
    (
        dealt.select(F.col("session_file").alias("folder"), F.encode(F.concat(line, F.lit("\n")), "utf-8").alias("content"))
        .write.format(keyed_files.use(steps.sparkSession)).mode("append")
        .option("prefix", "session_file=").option("suffix", ".json").save(out_dir)
    )


def _session_file(name: Column) -> Column:
    return F.concat(F.lit("session_"), name, F.lit(".jsonl"))


def _json_by_folder(steps: DataFrame, out_dir: str) -> None:
    steps.write.mode("append").partitionBy("session_file").option("ignoreNullFields", "false").json(out_dir)


def read_session_steps(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Steps of all session folders, with the ``session_file`` they lie in."""
    if not keyed_files.reaches(path):
        return spark.read.schema(f"{schema}, session_file string").json(path)
    pieces = spark.read.format(keyed_files.use(spark)).load(path)
    lines = pieces.select(
        F.url_decode(F.replace(F.regexp_extract("folder", "^session_file=(.*)$", 1), F.lit("+"), F.lit("%2B"))).alias("session_file"),
        F.explode(F.split(F.decode("content", "utf-8"), "\n")).alias("line"),
    )
    return lines.where("line <> ''").select(F.from_json("line", schema).alias("step"), "session_file").select("step.*", "session_file")


def write_legacy_examples(examples: DataFrame, out_dir: str) -> None:
    """Older layout: one folder per stage file, nothing for an empty stage."""
    (
        examples.select("stage_file", F.col("line").alias("value"))
        .hint("rebalance", "stage_file")
        .write.mode("overwrite")
        .partitionBy("stage_file")
        .text(out_dir)
    )
