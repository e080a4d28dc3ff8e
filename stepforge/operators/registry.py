"""Versioned registry tables: samples, datasets, membership of training runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.functions import text as T
from stepforge.sources.sinks import tags_json
from stepforge.storage import Written, exists, remove_folder

SAMPLE_COLUMNS = (
    "sample_id", "session_id", "step_index", "source_type", "task", "task_category", "status",
    "quality_score", "approved", "training_stage", "detected_language", "action_type",
    "schema_version", "dataset_version", "created_at", "updated_at", "tags", "rejection_reason",
)


def registry_rows(samples: DataFrame) -> DataFrame:
    """The 18 registry columns; the task is capped at 500 characters."""
    return samples.select(
        "sample_id", "session_id", "step_index", "source_type",
        F.substring("task", 1, D.REGISTRY_TASK_CHARS).alias("task"),
        F.coalesce("task_category", F.lit("")).alias("task_category"),
        "status",
        F.coalesce("quality_score", F.lit(0.0)).alias("quality_score"),
        F.coalesce("approved", F.lit(False)).alias("approved"),
        F.coalesce("training_stage", F.lit("")).alias("training_stage"),
        F.coalesce("language", F.lit("unknown")).alias("detected_language"),
        "action_type",
        F.lit("1.0.0").alias("schema_version"),
        F.coalesce("dataset_version", F.lit("")).alias("dataset_version"),
        F.coalesce("created_at", F.lit("")).alias("created_at"),
        F.coalesce("updated_at", F.lit("")).alias("updated_at"),
        tags_json(F.col("tags")).alias("tags"),
        F.coalesce("rejection_reason", F.lit("")).alias("rejection_reason"),
    )


def upsert(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Insert or replace: the incoming row wins for its key.

    If ``incoming`` holds a key more than once, its row with the latest ``updated_at``
    (or else any one) wins; the current rows without a new version are found by an
    anti join and pass through unsorted.
    """
    once = latest(incoming, key, "updated_at") if "updated_at" in incoming.columns else incoming.dropDuplicates([key])
    return current.join(incoming.select(key), key, "left_anti").unionByName(once)


def latest(rows: DataFrame, key: str, recency: str) -> DataFrame:
    """The most recent row per key.  max_by combines before the shuffle, so a key with
    very many versions arrives as one row per task."""
    others = [c for c in rows.columns if c != key]
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*others), recency).alias("row"))
    return newest.select(key, "row.*").select(*rows.columns)


def insert_or_ignore(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """First row wins: known keys are left alone."""
    return current.unionByName(incoming.join(current.select(key), key, "left_anti"))


def query(registry: DataFrame, status: str | None = None, min_score: float | None = None,
          language: str | None = None, training_stage: str | None = None,
          source_type: str | None = None, limit: int | None = None, ordered: bool = False) -> DataFrame:
    """Optional filters; best score first if ``ordered`` or limited (0 or None: no limit)."""
    out = registry
    equal = {
        "status": status, "detected_language": language, "training_stage": training_stage,
        "source_type": source_type,
    }
    for name, value in equal.items():
        if value is not None:
            out = out.where(F.col(name) == value)
    if min_score is not None:
        out = out.where(F.col("quality_score") >= min_score)
    if limit or ordered:
        out = out.orderBy(F.desc("quality_score"), "sample_id")
    return out.limit(limit) if limit else out


def statistics(registry: DataFrame) -> DataFrame:
    """Totals, approval rate (percent) and average score of approved rows, one pass.

    Scores are stored with four digits; they are added as integers so that the
    result does not depend on the order of the rows.
    """
    n = F.count(F.lit(1))
    approved = F.count_if("approved")
    rejected = F.count_if(F.col("status") == "rejected")
    quarantined = F.count_if(F.col("status") == "quarantined")
    is_ok = F.col("status") == "approved"
    points = F.sum(F.when(is_ok, F.round(F.col("quality_score") * 10000).cast("long")))
    average = F.coalesce(points / F.count_if(is_ok) / 10000, F.lit(0.0))
    return registry.agg(
        n.alias("total_samples"), approved.alias("approved"), rejected.alias("rejected"),
        quarantined.alias("quarantined"),
        (n - approved - rejected - quarantined).alias("pending"),
        T.nearest(approved / F.greatest(n, F.lit(1)) * 100, 1).alias("approval_rate"),
        T.nearest(average, 4).alias("avg_quality_score"),
    )


def distribution(registry: DataFrame) -> DataFrame:
    """(dimension, value, n) for language, stage (approved rows only) and action."""
    pairs = F.array(
        F.struct(F.lit("language").alias("dimension"), F.col("detected_language").alias("value")),
        F.when(
            F.col("approved"),
            F.struct(F.lit("stage").alias("dimension"), F.col("training_stage").alias("value")),
        ),
        F.struct(F.lit("action").alias("dimension"), F.col("action_type").alias("value")),
    )
    return (
        registry.select(F.explode(F.array_compact(pairs)).alias("p"))
        .groupBy("p.dimension", "p.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def contaminated(registry: DataFrame, test_ids: DataFrame) -> DataFrame:
    """Ids of a test set that the registry holds.

    Both id columns are unique, so the semi join is balanced; Catalyst broadcasts
    the test ids when they are small.
    """
    return registry.join(test_ids.select("sample_id").distinct(), "sample_id", "left_semi").select("sample_id")


def version_row(spark: SparkSession, version: str, total: int, approved: int, notes: str,
                created_at: str) -> DataFrame:
    return spark.createDataFrame(
        [(T.canonical_version(version), created_at, total, approved, notes, False)],
        "version string, created_at string, total_samples long, approved_samples long, "
        "notes string, locked boolean",
    )


def create_version(datasets: DataFrame, row: DataFrame) -> DataFrame:
    """Insert or replace a version.  A locked version is left as it is."""
    open_row = row.join(datasets.where("locked").select("version"), "version", "left_anti")
    return upsert(datasets, open_row, "version")


def lock_version(datasets: DataFrame, version: str) -> DataFrame:
    wanted = T.canonical_version(version)
    return datasets.withColumn("locked", F.when(F.col("version") == wanted, True).otherwise(F.col("locked")))


def complete_task(tasks: DataFrame, task_id: str | Column, success: bool, result: str) -> DataFrame:
    is_it = F.col("task_id") == task_id
    status = "completed" if success else "failed"
    return tasks.withColumn("status", F.when(is_it, status).otherwise(F.col("status"))).withColumn(
        "result", F.when(is_it, result).otherwise(F.col("result"))
    )


def list_versions(datasets: DataFrame) -> DataFrame:
    """Adds ``place``, 1 for the newest by version number (not by text), and sorts by it.

    A dataset has a handful of versions a year, so one ordered group holds them.
    """
    newest = Window.partitionBy(F.lit(0)).orderBy(T.parse_version(F.col("version")).desc())
    return datasets.withColumn("place", F.row_number().over(newest)).orderBy("place")


def register(rows: DataFrame, path: str) -> None:
    """Upsert rows into the stored registry: Parquet partitioned by version.

    Only the partitions that hold a row's old or new version are read and replaced
    (a sample may move between versions); all other rows stay.  The new state is
    written aside first, so a lost job leaves the table as it was.
    """
    spark = rows.sparkSession
    incoming = Written(rows, "incoming")
    touched = {r[0] for r in incoming.table.select("dataset_version").distinct().collect()}  # a few versions
    state = upsert(incoming.table.limit(0), incoming.table, "sample_id")
    if exists(spark, path):
        # versions are text, whatever partition discovery would make of them
        stored = spark.read.schema(incoming.table.schema).parquet(path)
        left = stored.join(incoming.table.select("sample_id"), "sample_id", "left_semi").select("dataset_version").distinct()
        touched |= {r[0] for r in left.collect()}
        state = upsert(stored.where(F.col("dataset_version").isin(sorted(touched))), incoming.table, "sample_id")
    state = Written(state, "registry")
    filled = {r[0] for r in state.table.select("dataset_version").distinct().collect()}
    (
        state.table.hint("rebalance", "dataset_version").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset_version").parquet(path)
    )
    for version in touched - filled:  # all of its samples have moved
        remove_folder(spark, f"{path}/dataset_version={version}")
    state.drop()
    incoming.drop()
