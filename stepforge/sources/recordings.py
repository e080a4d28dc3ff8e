"""Readers for recorded sessions and other line- or document-wise JSON."""

from __future__ import annotations

import bz2
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stepforge.functions import parsing as P
from stepforge.functions import text as T
from stepforge.storage import materialize

LINE_KEYS = ("step_index", "task", "action", "screenshot_path", "ocr_text", "timestamp")
SCREEN_KEYS = ("screen_width", "screen_height")


COMPRESSED = (".gz", ".bz2")


def _damage(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        bad = []
        for path, content in zip(frame["path"], frame["content"]):
            stream = zlib.decompressobj(31) if path.endswith(".gz") else bz2.BZ2Decompressor()
            try:
                for at in range(0, len(content), 1 << 20):
                    stream.decompress(content[at : at + (1 << 20)])
                whole = stream.eof
            except (zlib.error, OSError, EOFError):
                whole = False
            if not whole:
                bad.append(path)
        yield pd.DataFrame({"source_file": pd.Series(bad, dtype="object")})


def unreadable_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(source_file) of the compressed files whose stream is damaged or cut.

    Plain text can't be damaged in this sense, and is not looked at.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*{" + ",".join(COMPRESSED) + "}")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
        .select("path", "content")
    )
    return files.mapInPandas(_damage, "source_file string")


def scan_lines(spark: SparkSession, path: str, pattern: str = "*.jsonl",
               recursive: bool = False) -> DataFrame:
    """Physical lines with provenance: value, source_file, line_number (1-based).

    Files are split across tasks like any text scan, so a file of any size is
    read in parallel.  Inside one split the rows keep their order, hence a line's
    number is its offset in the split plus the lines in earlier splits of the
    file.  The split counts (one row per split) are written out once; the join
    then has exact sizes to choose its strategy from.

    Of a damaged compressed file the readable lines come, and a line 0 with a value
    that is no JSON, so that the loss is counted as a failure and can be found.
    """
    lines = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", str(recursive).lower())
        .option("ignoreCorruptFiles", "true")
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_block_start").alias("split_start"),
            F.monotonically_increasing_id().alias("row_id"),
        )
    )
    before = Window.partitionBy("source_file").orderBy("split_start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    splits = (
        lines.groupBy("source_file", "split_start")
        .agg(F.min("row_id").alias("first_row"), F.count(F.lit(1)).alias("n_lines"))
        .withColumn("earlier", F.coalesce(F.sum("n_lines").over(before), F.lit(0)))
        .select("source_file", "split_start", "first_row", "earlier")
    )
    numbered = lines.join(materialize(splits, "splits"), ["source_file", "split_start"]).select(
        "value",
        "source_file",
        (F.col("row_id") - F.col("first_row") + F.col("earlier") + 1).alias("line_number"),
    )
    if not pattern.endswith((*COMPRESSED, "*")):
        return numbered
    lost = unreadable_files(spark, path, recursive).select(
        F.lit("{unreadable file").alias("value"), "source_file", F.lit(0).cast("long").alias("line_number")
    )
    return numbered.unionByName(lost)


def parse_lines(lines: DataFrame) -> DataFrame:
    """Adds ``data`` (VARIANT) and ``line_kind``: blank, corrupt or parsed.

    Each line is parsed once: filters on ``data`` are not moved below the explode, where
    every field they test would bring a parse (and the making of the line) of its own.
    """
    text = T.strip_long(F.col("value"))
    parsed = lines.select("*", F.explode(F.array(F.try_parse_json(text))).alias("data"))
    return parsed.withColumn(
        "line_kind",
        F.when(text == "", "blank").when(F.col("data").isNull(), "corrupt").otherwise("parsed"),
    )


def read_jsonl(spark: SparkSession, path: str, pattern: str = "*.jsonl",
               recursive: bool = False) -> tuple[DataFrame, DataFrame]:
    """(parsed lines, rejected lines); blank lines are in neither but keep their number."""
    labelled = parse_lines(scan_lines(spark, path, pattern, recursive))
    good = labelled.where("line_kind = 'parsed'").select("data", "source_file", "line_number")
    bad = labelled.where("line_kind = 'corrupt'").select("value", "source_file", "line_number")
    return good, bad


def recorded_steps(parsed: DataFrame, screen_size_required: bool = False) -> DataFrame:
    """Strict typed steps for session analysis; a line missing a required key is dropped.

    The recorder that writes no screen size is accepted unless
    ``screen_size_required`` is set.
    """
    data = F.col("data")
    required = LINE_KEYS + (SCREEN_KEYS if screen_size_required else ())
    present = [F.try_variant_get(data, f"$.{k}", "variant").isNotNull() for k in required]
    complete = P.kind_of(data) == "OBJECT"
    for p in present:
        complete = complete & p
    get = lambda path, kind: F.try_variant_get(data, path, kind)
    return parsed.where(complete).select(
        "source_file",
        "line_number",
        F.coalesce(get("$.session_id", "string"), F.lit("")).alias("session_id"),
        get("$.step_index", "int").alias("step_index"),
        get("$.task", "string").alias("task"),
        get("$.action.type", "string").alias("action_type"),
        *raw_coordinates(data),
        get("$.action.text", "string").alias("text"),
        get("$.screenshot_path", "string").alias("screenshot_path"),
        get("$.ocr_text", "string").alias("ocr_text"),
        get("$.screen_width", "int").alias("screen_width"),
        get("$.screen_height", "int").alias("screen_height"),
        get("$.timestamp", "string").alias("timestamp"),
        F.coalesce(get("$.reasoning", "string"), F.lit("")).alias("reasoning"),
        F.coalesce(get("$.verified", "boolean"), F.lit(False)).alias("verified"),
    )


def raw_coordinates(data: Column) -> list[Column]:
    """The recorded point as [x, y] plus whether anything was recorded at all.

    A recorded value that is no point gives NULL coordinates with
    ``has_coordinates`` true, so the analysis can call it impossible.
    """
    raw = F.try_variant_get(data, "$.action.coordinates", "variant")
    x = F.try_variant_get(data, "$.action.coordinates[0]", "double")
    y = F.try_variant_get(data, "$.action.coordinates[1]", "double")
    recorded = raw.isNotNull() & (P.kind_of(raw) != "VOID")
    return [
        F.when(x.isNotNull() & y.isNotNull(), F.array(x, y)).alias("coordinates"),
        F.coalesce(recorded, F.lit(False)).alias("has_coordinates"),
    ]


def read_annotation_documents(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Files of one JSON document, or an array of documents, each (the older annotation layout)."""
    schema = (
        "image_path string, task_instruction string, total_steps int, reasoning string, "
        "action struct<type:string,coordinates:array<double>,text:string,key:string,description:string>"
    )
    return (
        spark.read.schema(schema)
        .option("multiLine", "true")
        .option("pathGlobFilter", pattern)
        .json(path)
        .select(
            F.coalesce("image_path", F.lit("")).alias("image_path"),
            F.coalesce("task_instruction", F.lit("")).alias("task"),
            F.coalesce("total_steps", F.lit(1)).alias("total_steps"),
            F.coalesce("reasoning", F.lit("")).alias("reasoning"),
            F.coalesce("action.type", F.lit("click")).alias("action_type"),
            F.col("action.coordinates").alias("coordinates"),
            F.col("action.text").alias("text"),
            F.col("action.key").alias("key"),
            F.coalesce("action.description", F.lit("")).alias("description"),
        )
    )


EXAMPLE_SCHEMA = (
    "conversations array<struct<`from`:string,role:string,value:string>>, "
    "images array<string>, system string, _corrupt string"
)


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    """Conversation examples, one per line; unreadable lines keep ``_corrupt``."""
    return (
        spark.read.schema(EXAMPLE_SCHEMA)
        .option("pathGlobFilter", "*.jsonl")
        .option("recursiveFileLookup", "true")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .json(path)
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Registry, cache and history tables are Parquet folders."""
    return spark.read.parquet(path)
