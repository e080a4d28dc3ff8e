import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stepforge.plans import sample_queries as Q
from stepforge.sources import adapters as A
from stepforge.sources import sinks as W


def _lines(folder):
    return [json.loads(x) for f in sorted(Path(folder).glob("part-*")) for x in f.read_text().splitlines()]


def test_each_session_gets_its_own_file(spark, monkeypatch):
    made, new = [], Q.new_folder
    monkeypatch.setattr(Q, "new_folder", lambda *a: made.append(new(*a)) or made[-1])
    got = {r.session_id: (r.n, r.first_step) for r in Q.recorder_sink(spark, "/root/testdata/sf0.001").collect()}
    want = Counter(r.session_id for r in A.steps(spark, "/root/testdata/sf0.001").select("session_id").collect())
    folders = {p.name: p for p in Path(made[0]).iterdir() if p.name[0] != "."}
    assert set(folders) == {f"session_file=session_{s}.jsonl" for s in want}
    for session, (n, first) in got.items():
        steps = _lines(folders[f"session_file=session_{session}.jsonl"])
        assert n == len(steps) == want[session] and {s["session_id"] for s in steps} == {session}
        order = [s["step_index"] for s in steps]
        assert order == sorted(order) and order[0] == first
        assert set(steps[0]) == {"session_id", "step_index", "task", "action_type", "coordinates", "text"}  # nulls as well


def test_long_sessions_odd_names_and_repeated_runs(spark, tmp_path):
    out = str(tmp_path / "rec")
    steps = spark.range(100).selectExpr("if(id < 90, 'a/b=1%', if(id < 99, 'é +:', null)) AS session_id", "id AS step_index", "'x\\ny' AS text")
    W.append_session_steps(steps, out, hot_rows=20)
    long = [p for p in Path(out).iterdir() if "a%2Fb" in p.name]
    assert len(long) == 1 and len(list(long[0].glob("part-*"))) > 1
    W.append_session_steps(steps.where("id >= 90"), out)
    for back in (W.read_session_steps(spark, out, "session_id string, step_index long, text string"),
                 spark.read.schema("session_id string, step_index long, text string, session_file string").json(out)):
        rows = back.collect()
        assert sorted(r.step_index for r in rows) == sorted([*range(100), *range(90, 100)])
        assert {(r.session_id, r.session_file) for r in rows} == {
            ("a/b=1%", "session_a/b=1%.jsonl"), ("é +:", "session_é +:.jsonl"), (None, "session_null.jsonl")}
        assert {r.text for r in rows} == {"x\ny"}


def test_a_failed_run_leaves_no_files(spark, tmp_path):
    out = tmp_path / "rec"
    bad = F.when(F.col("id") == 30, F.raise_error(F.lit("no"))).otherwise("x").cast("string")
    steps = spark.range(40).select(F.concat(F.lit("s"), F.col("id") % 4).alias("session_id"), F.col("id").alias("step_index"), bad.alias("text"))
    with pytest.raises(Exception, match="no"):
        W.append_session_steps(steps, str(out))
    assert not list(out.rglob("session_*"))
    W.append_session_steps(steps.where("id < 0"), str(out))
    assert W.read_session_steps(spark, str(out), "step_index long").count() == 0
