"""From raw recorded lines to sample rows, with a reason for every refusal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.functions import parsing as P
from stepforge.functions import rendering as G
from stepforge.functions import regions as R
from stepforge.functions import text as T


def sample_id(source_file: Column, line_number: Column, prefix: str = "s_") -> Column:
    """Deterministic id: the same line of the same file is the same sample."""
    origin = F.concat(source_file, F.lit(":"), line_number.cast("string"))
    return F.concat(F.lit(prefix), F.substring(F.sha2(origin, 256), 1, 16))


def normalize_recorded(parsed: DataFrame, source_type: str = "human_demo") -> DataFrame:
    """Typed sample columns plus ``ingest_error`` (NULL for good rows).

    Numbers given as text are accepted; coordinates shorter than two numbers
    become NULL and are left to the coordinate check, extra ones are cut off.
    """
    data = F.col("data")
    get = lambda path, kind: F.try_variant_get(data, path, kind)
    action = get("$.action", "variant")
    action_kind = F.when(action.isNull(), "OBJECT").otherwise(P.kind_of(action))
    task = T.strip(F.coalesce(get("$.task", "string"), F.lit("")))
    action_type = F.lower(T.strip(F.coalesce(get("$.action.type", "string"), F.lit(""))))
    step_index = get("$.step_index", "int")
    x, y = get("$.action.coordinates[0]", "double"), get("$.action.coordinates[1]", "double")
    error = (
        F.when(P.kind_of(data) != "OBJECT", "not_an_object")
        .when(step_index.isNull(), "bad_step_index")
        .when(task == "", "missing_task")
        .when(action_kind != "OBJECT", "action_not_an_object")
        .when(action_type == "", "missing_action_type")
    )
    return parsed.select(
        "source_file",
        "line_number",
        error.alias("ingest_error"),
        sample_id(F.col("source_file"), F.col("line_number")).alias("sample_id"),
        F.coalesce(get("$.session_id", "string"), F.lit("unknown")).alias("session_id"),
        step_index.alias("step_index"),
        F.lit(source_type).alias("source_type"),
        task.alias("task"),
        action_type.alias("action_type"),
        F.when(x.isNotNull() & y.isNotNull(), F.array(x, y)).alias("coordinates"),
        get("$.action.text", "string").alias("text"),
        get("$.action.key", "string").alias("key"),
        T.strip(F.coalesce(get("$.action.description", "string"), F.lit(""))).alias("description"),
        F.coalesce(get("$.screenshot_path", "string"), F.lit("")).alias("screenshot_path"),
        F.coalesce(get("$.ocr_text", "string"), F.lit("")).alias("ocr_text_raw"),
        F.coalesce(
            get("$.timestamp", "string"),
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
        ).alias("created_at"),
        F.lit("raw").alias("status"),
        T.infer_tags(task, action_type).alias("tags"),
    )


# source type -> transform; further recorders are added here
NORMALIZERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "human_demo": normalize_recorded,
}


def normalize(parsed: DataFrame, source_type: str = "human_demo") -> DataFrame:
    if source_type not in NORMALIZERS:
        raise NotImplementedError(f"no normaliser for source type {source_type!r}")
    return NORMALIZERS[source_type](parsed)


def ingest_summary(line_kinds: DataFrame) -> DataFrame:
    """total / ingested / failed / success rate in one pass.

    Input: one row per physical line with ``ingested`` true or false; blank and
    corrupt lines count as failed.
    """
    total, good = F.count(F.lit(1)), F.count_if(F.col("ingested"))
    return line_kinds.agg(
        total.alias("total_lines"),
        good.alias("ingested"),
        (total - good).alias("failed"),
        F.when(total == 0, 0.0).otherwise(good / total).alias("success_rate"),
    )


def label_ingested(lines: DataFrame) -> DataFrame:
    """``ingested`` flag per physical line (input: output of ``parse_lines``)."""
    normal = normalize_recorded(lines.withColumn("data", F.coalesce("data", F.parse_json(F.lit("null")))))
    return normal.select(F.col("ingest_error").isNull().alias("ingested"))


def format_legacy(rows: DataFrame, agent: str = D.AGENT_NAME) -> DataFrame:
    """Three-turn examples from plain arguments; ``format_error`` marks bad points."""
    c = F.col
    error = F.when(
        c("coordinates").isNotNull() & ~R.in_unit_range(c("coordinates")[0], c("coordinates")[1]),
        "coordinates_out_of_range",
    )
    action = G.legacy_action_json(
        c("action_type"), c("coordinates"), c("text"), c("key"), c("direction"), c("amount"),
        c("description"),
    )
    return (
        rows.withColumn("format_error", error)
        .withColumn("system_turn", F.lit(D.LEGACY_SYSTEM_TEMPLATE.format(agent=agent)))
        .withColumn("user_turn", G.legacy_question(c("task")))
        .withColumn(
            "assistant_turn",
            G.legacy_answer(c("task"), c("action_type"), c("reasoning"), c("description"), action),
        )
    )


def format_prebuilt(rows: DataFrame, agent: str = D.AGENT_NAME) -> DataFrame:
    """The same from a ready action JSON; no thinking block without reasoning."""
    return (
        rows.withColumn("system_turn", F.lit(D.LEGACY_SYSTEM_TEMPLATE.format(agent=agent)))
        .withColumn("user_turn", G.prebuilt_question(F.col("task")))
        .withColumn("assistant_turn", G.prebuilt_answer(F.col("reasoning"), F.col("action_json")))
    )


def split_legacy_stages(rows: DataFrame) -> DataFrame:
    """Single-step documents feed stages 1 and 2, longer ones stage 3."""
    short = F.array(F.lit(D.STAGE_GROUNDING), F.lit(D.STAGE_ACTION))
    stages = F.when(F.coalesce("total_steps", F.lit(1)) == 1, short).otherwise(
        F.array(F.lit(D.STAGE_PLANNING))
    )
    return rows.withColumn("stage_file", F.explode(stages))
