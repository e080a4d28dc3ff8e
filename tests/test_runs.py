"""What has to survive from run to run: registry rows, event order, the feed's silence, damaged files."""

import gzip
import json

import pandas as pd
from pyspark.sql import functions as F

from stepforge.operators import lineage, registry
from stepforge.sources import recordings
from stepforge.storage import Written, exists, temporary
from stepforge.streaming import feed

ROW = "sample_id string, status string, updated_at string, dataset_version string"


def stored(spark, path):
    return sorted(tuple(r) for r in spark.read.schema(ROW).parquet(path).select("sample_id", "dataset_version").collect())


def test_rows_of_earlier_runs_stay_and_moved_rows_move(spark, tmp_path):
    path = str(tmp_path / "registry")
    runs = [[("a", "1.0.0")], [("b", "1.0.0"), ("c", "2.0.0")], [("b", "2.0.0")], [("a", "2.0.0")]]
    wanted = {}
    for i, run in enumerate(runs):
        registry.register(spark.createDataFrame([(s, "new", str(i), v) for s, v in run], ROW), path)
        wanted |= dict(run)
        assert stored(spark, path) == sorted(wanted.items())
    assert not exists(spark, f"{path}/dataset_version=1.0.0")


def test_upsert_takes_the_latest_of_equal_keys(spark):
    current = spark.createDataFrame([("a", "old", "0", "1"), ("b", "old", "0", "1")], ROW)
    incoming = spark.createDataFrame([("a", "x", "1", "1"), ("a", "y", "2", "1")], ROW)
    got = {r["sample_id"]: r["status"] for r in registry.upsert(current, incoming, "sample_id").collect()}
    assert got == {"a": "y", "b": "old"} and registry.upsert(current, incoming, "sample_id").count() == 2


def test_events_are_ordered_by_run(spark, tmp_path):
    path = str(tmp_path / "events")
    kind = "sample_id string, seq int, event string, stage string, result string, details map<string,string>"
    first = spark.createDataFrame([("s", 0, "ingested", "in", "success", None), ("s", 1, "validated", "dedup", "fail", None)], kind)
    lineage.append_events(first, path, "run_z", "2024-01-01 00:00:00")
    lineage.append_events(first.withColumn("result", F.lit("pass")), path, "run_a", "2024-01-02 00:00:00")
    events = spark.read.parquet(path)
    got = lineage.assemble(events).first()["events"]
    assert [(e["seq"], e["result"]) for e in got] == [(0, "success"), (1, "fail"), (0, "pass"), (1, "pass")]
    assert lineage.last_event(events, "dedup").first()["result"] == "pass"


class State:
    hasTimedOut, exists, get = False, False, None

    def update(self, value):
        self.exists, self.get = True, value

    def setTimeoutDuration(self, ms):
        self.timeout = ms

    def remove(self):
        self.exists = False


def test_a_finished_task_stays_silent_for_good():
    step = lambda i, status: pd.DataFrame(
        [{"step_index": i, "status": status, "action_type": "done", "success": True, "error": None, "reasoning": "", "screenshot_path": ""}]
    )
    state = State()
    events = pd.concat(feed.follow(("t",), iter([step(1, "completed")]), state))
    assert events["event"].tolist() == ["step_update", "task_finished"] and not hasattr(state, "timeout")
    assert list(feed.follow(("t",), iter([step(9, "running")]), state)) == []
    list(feed.follow(("u",), iter([step(1, "completed")]), forgetful := State(), 1000))
    assert forgetful.timeout == 1000


def test_a_cut_file_is_reported(spark, tmp_path):
    whole = gzip.compress("\n".join(json.dumps({"n": i}) for i in range(50)).encode())
    (tmp_path / "good.jsonl.gz").write_bytes(whole)
    (tmp_path / "cut.jsonl.gz").write_bytes(whole[: len(whole) // 2])
    good, bad = recordings.read_jsonl(spark, str(tmp_path), "*.jsonl.gz")
    assert good.where(F.col("source_file").contains("good")).count() == 50
    lost = bad.where("line_number = 0").collect()
    assert len(lost) == 1 and "cut.jsonl.gz" in lost[0]["source_file"]


def test_spent_tables_can_be_dropped(spark):
    table = Written(spark.range(3), "spent")
    assert table.table.count() == 3 and exists(spark, table.path)
    table.drop()
    assert not exists(spark, table.path)


def test_temporary_tables_go_and_others_stay(spark):
    stays = Written(spark.range(2), "stays")
    with temporary(spark):
        goes = Written(spark.range(2), "goes")
        assert exists(spark, goes.path)
    assert not exists(spark, goes.path) and exists(spark, stays.path)
