"""Event log and run membership as append-only tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepforge.functions import text as T

EVENT_SCHEMA = (
    "sample_id string, seq int, event string, stage string, result string, "
    "details map<string,string>"
)


def events_of(labelled: DataFrame) -> DataFrame:
    """ingested / validated / enriched events of fully labelled rows.

    Needs sample_id, session_id, step_index, gate_events, enrich_events (NULL when
    the row never got there).
    """
    no_map = F.create_map().cast("map<string,string>")
    ingested = F.array(
        F.struct(
            F.lit("ingested").alias("event"), F.lit("recorder_source").alias("stage"),
            F.lit("success").alias("result"),
            F.create_map(
                F.lit("session"), F.col("session_id"), F.lit("step"), F.col("step_index").cast("string")
            ).alias("details"),
        )
    )
    gates = F.transform(
        "gate_events",
        lambda e: F.struct(
            F.lit("validated").alias("event"), e["stage"].alias("stage"), e["result"].alias("result"),
            F.when(
                e["result"] == "fail",
                F.create_map(F.lit("reason"), e["reason"], F.lit("fatal"), e["fatal"].cast("string")),
            ).otherwise(no_map).alias("details"),
        ),
    )
    kind = "array<struct<event:string,stage:string,result:string,details:map<string,string>>>"
    enriched = F.transform(
        "enrich_events",
        lambda e: F.struct(
            F.lit("enriched").alias("event"), e["stage"].alias("stage"), e["result"].alias("result"),
            F.when(e["error"].isNotNull(), F.create_map(F.lit("error"), e["error"])).otherwise(no_map).alias("details"),
        ),
    )
    every = F.concat(
        ingested.cast(kind), gates.cast(kind), F.coalesce(enriched.cast(kind), F.array().cast(kind))
    )
    return labelled.select("sample_id", F.posexplode(every).alias("seq", "e")).select(
        "sample_id", "seq", "e.*"
    )


def append_events(events: DataFrame, path: str, run_id: str, event_time: str | None = None,
                  version: str = "1.0.0") -> None:
    """Append a run's events; all carry the time of the run (now, if none is given) and the version."""
    time = F.current_timestamp() if event_time is None else F.lit(event_time).cast("timestamp")
    (
        events.withColumn("run_id", F.lit(run_id)).withColumn("event_time", time).withColumn("version", F.lit(version))
        .write.mode("append").parquet(path)
    )


def _place(events: DataFrame) -> Column:
    """Order of a sample's events: by run, then inside the run."""
    known = [c for c in ("event_time", "run_id") if c in events.columns]
    return F.struct(*known, "seq")


def assemble(events: DataFrame) -> DataFrame:
    """Per sample the events in order of the runs.  A sample has one event per stage and run."""
    ordered = F.array_sort(F.collect_list(F.struct(_place(events).alias("at"), "seq", "event", "stage", "result")))
    listed = events.groupBy("sample_id").agg(ordered.alias("events"))
    plain = lambda e: F.struct(e["seq"].alias("seq"), e["event"].alias("event"), e["stage"].alias("stage"), e["result"].alias("result"))
    return listed.withColumn("events", F.transform("events", plain))


def processed_by(lineage: DataFrame, stage: str) -> DataFrame:
    return lineage.withColumn("processed", F.exists("events", lambda e: e["stage"] == stage))


def last_event(events: DataFrame, stage: str) -> DataFrame:
    return (
        events.where(F.col("stage") == stage)
        .groupBy("sample_id")
        .agg(F.max_by(F.struct("event", "result"), _place(events)).alias("last"))
        .select("sample_id", "last.event", "last.result")
    )


def add_membership(membership: DataFrame, ids: DataFrame, run_id: str) -> DataFrame:
    """(sample_id, run_id) pairs with the run added once per id."""
    new = ids.select("sample_id", F.lit(run_id).alias("run_id")).distinct()
    known = membership.select("sample_id", "run_id")
    return known.unionByName(new.join(known, ["sample_id", "run_id"], "left_anti"))


LINEAGE_JSON = (
    "sample_id string, source_file string, source_line int, collector_id string, "
    "collection_device string, created_at string, included_in_runs array<string>, "
    "events array<struct<event:string,stage:string,timestamp:string,result:string,version:string>>"
)


def read_lineage_lines(lines: DataFrame) -> DataFrame:
    """Lineage records from JSON lines: broken lines are skipped, the last line of an id wins.

    Input: value, source_file, line_number.
    """
    record = F.from_json(F.col("value"), LINEAGE_JSON)
    parsed = lines.where(T.strip(F.col("value")) != "").select(
        record.alias("r"), F.struct("source_file", "line_number").alias("at")
    )
    good = parsed.where(
        "r.sample_id is not null and r.source_file is not null and r.source_line is not null"
    )
    return (
        good.groupBy("r.sample_id").agg(F.max_by("r", "at").alias("r"))
        .select(
            "sample_id", "r.source_file", "r.source_line",
            F.coalesce("r.collector_id", F.lit("unknown")).alias("collector_id"),
            F.coalesce("r.collection_device", F.lit("unknown")).alias("collection_device"),
            F.coalesce("r.included_in_runs", F.array().cast("array<string>")).alias("included_in_runs"),
            F.coalesce("r.events", F.array()).alias("events"),
        )
    )


def load_lineage(spark: SparkSession, path: str) -> DataFrame:
    from stepforge.sources.recordings import scan_lines

    return read_lineage_lines(scan_lines(spark, path))
