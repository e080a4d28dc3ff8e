"""Files in, files out: scans, images, the full run, streams."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.functions import pixels as X
from stepforge.operators import annotate as O
from stepforge.operators import lineage as L
from stepforge.operators import normalize as Z
from stepforge.operators import registry as R
from stepforge.operators import screens as S
from stepforge.operators.duplicate_index import StoredIndex
from stepforge.plans import factory_run as E
from stepforge.sources import images as I
from stepforge.sources import recordings as C
from stepforge.sources import sinks as W
from stepforge.streaming import feed, incremental


def test_line_numbers_over_splits(spark, tmp_path):
    text = "\n".join("" if i % 5 == 0 else f'{{"n": {i}}}' for i in range(1, 400)) + "\n"
    (tmp_path / "session_a.jsonl").write_text(text)
    (tmp_path / "session_b.jsonl").write_text("x\n\ny")
    (tmp_path / "other.txt").write_text("no\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        got = C.scan_lines(spark, str(tmp_path), "session_*.jsonl").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    a = sorted((r.line_number, r.value) for r in got if r.source_file.endswith("a.jsonl"))
    assert [n for n, _ in a] == list(range(1, 400))
    assert all(v == ("" if n % 5 == 0 else f'{{"n": {n}}}') for n, v in a)
    b = sorted((r.line_number, r.value) for r in got if r.source_file.endswith("b.jsonl"))
    assert b == [(1, "x"), (2, ""), (3, "y")]


def test_ingest_edges(spark, tmp_path):
    lines = [
        "", "not json",
        '{"step_index":"3","task":"Open Gmail","action":{"type":"CLICK ","coordinates":["0.5",0.2,9]}}',
        '{"step_index":1,"task":"  ","action":{"type":"click"}}',
        '{"step_index":1,"task":"Open Gmail","action":"x"}',
        '{"step_index":1,"task":"Open Gmail","action":{}}',
        "[1,2]",
        '{"task":"Open Gmail","action":{"type":"click"}}',
    ]
    (tmp_path / "session_x.jsonl").write_text("\n".join(lines) + "\n")
    good, bad = C.read_jsonl(spark, str(tmp_path))
    assert [(r.value, r.line_number) for r in bad.collect()] == [("not json", 2)]
    rows = {r.line_number: r for r in Z.normalize(good).collect()}
    assert {n: r.ingest_error for n, r in rows.items()} == {
        3: None, 4: "missing_task", 5: "action_not_an_object", 6: "missing_action_type", 7: "not_an_object", 8: "bad_step_index",
    }
    assert rows[3].step_index == 3 and rows[3].action_type == "click" and rows[3].coordinates == [0.5, 0.2]
    assert rows[3].tags == ["email", "file", "action:click"] and rows[3].session_id == "unknown"
    total = Z.ingest_summary(Z.label_ingested(C.parse_lines(C.scan_lines(spark, str(tmp_path))))).first()
    assert (total.total_lines, total.ingested, total.failed) == (8, 1, 7)
    with pytest.raises(NotImplementedError):
        Z.normalize(good, "synthetic")


def test_annotation_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"image_path": "i.png", "task_instruction": "Do", "total_steps": 1, "action": {"type": "key", "key": "enter"}}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"total_steps": 4}))
    rows = C.read_annotation_documents(spark, str(tmp_path))
    split = Z.split_legacy_stages(rows).select("action_type", "stage_file").collect()
    assert sorted(map(tuple, split)) == [("click", "stage3_planning"), ("key", "stage1_grounding"), ("key", "stage2_action")]


def noise(seed, h=320, w=420):
    return np.random.RandomState(seed).randint(0, 255, (h, w, 3)).astype(np.uint8)


def smooth(seed, h=320, w=420):
    rnd = np.random.RandomState(seed)
    small = rnd.randint(0, 255, (8, 8, 3))
    return np.kron(small, np.ones((h // 8, w // 8 + 1, 1)))[:, :w].astype(np.uint8)


def test_image_facts(spark, tmp_path, write_png):
    import hashlib

    rgb = noise(1)
    path = write_png("shots/a.png", rgb)
    (tmp_path / "shots/broken.png").write_bytes(b"no image")
    shots = str(tmp_path / "shots")
    facts = {r.path.split("/")[-1]: r for r in I.image_facts(I.read_files(spark, shots), I.read_pixels(spark, shots)).collect()}
    a = facts["a.png"]
    assert (a.width, a.height) == (420, 320) and a.variance == pytest.approx(rgb.astype(float).var())
    assert a.sha256 == hashlib.sha256(open(path, "rb").read()).hexdigest()
    assert a.phash == X.perceptual_hash_of(rgb) and len(a.phash) == 64
    assert facts["broken.png"].width is None


def test_hash_is_stable_under_small_changes():
    base = smooth(3)
    touched = base.copy()
    touched[:6, :6] = 255
    bits = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1")
    assert bits(X.perceptual_hash_of(base), X.perceptual_hash_of(touched)) <= 16
    assert bits(X.perceptual_hash_of(base), X.perceptual_hash_of(smooth(4))) > 40


def test_screen_pairs(spark):
    white = np.full((100, 200, 3), 255, np.uint8)
    def box(y0, y1, x0, x1):
        out = white.copy()
        out[int(y0 * 100):int(y1 * 100), int(x0 * 200):int(x1 * 200)] = 0
        return out

    few = white.copy()
    few[0, :3] = 0
    cases = {
        "same": (white, white), "black": (white, np.zeros_like(white)), "centre": (white, box(0.4, 0.6, 0.4, 0.6)),
        "few": (white, few), "corner": (white, box(0.7, 1.0, 0.7, 1.0)), "shape": (white, np.zeros((50, 50, 3), np.uint8)),
    }
    rows = [(n, 0, *a.shape, bytearray(a.tobytes()), *b.shape, bytearray(b.tobytes())) for n, (a, b) in cases.items()]
    kind = "session_id string, pos long, " + ", ".join(
        f"{side}_{c}" for side in ("before", "after") for c in ("height int", "width int", "channels int", "data binary")
    )
    got = {r.session_id: r for r in S.compare(spark.createDataFrame(rows, kind)).collect()}
    assert got["same"].change_type == "no_change" and got["same"].change_ratio == 0 and not got["same"].is_significant
    assert got["black"].change_type == "full_screen" and got["black"].change_ratio > 0.9
    assert got["centre"].change_type == "text_update" and got["centre"].change_ratio == pytest.approx(0.04)
    assert "center" in got["centre"].changed_regions
    assert got["few"].change_type in ("no_change", "minor_change")
    assert got["corner"].most_changed == "bottom_right"
    assert got["shape"].change_type == "full_screen" and got["shape"].changed_regions == ["entire_screen"]
    checked = S.verify_effect(S.compare(spark.createDataFrame(rows, kind)).withColumn("action_type", F.lit("done")))
    assert all(r.effect_ok and r.effect_ratio == 0 for r in checked.collect())


def recordings(folder, shots):
    """Two sessions, seven steps; two steps share a screenshot."""
    def step(session, i, kind, shot, **action):
        return json.dumps(
            {"step_index": i, "task": f"Open {session} and reply to all mail", "session_id": session,
             "action": {"type": kind, "description": f"Use the {kind} here", **action},
             "screenshot_path": shots[shot], "ocr_text": "Inbox Compose", "timestamp": "2024-01-01T00:00:00"}
        )

    mail = [step("email_001", 0, "click", 0, coordinates=[0.5, 0.2]), step("email_001", 1, "click", 0, coordinates=[0.4, 0.9]), step("email_001", 2, "done", 1)]
    web = [step("browser_001", 0, "click", 2, coordinates=[0.1, 0.1]), step("browser_001", 1, "type", 3, text="cats"),
           step("browser_001", 2, "key", 4, key="enter"), step("browser_001", 3, "done", 5)]
    folder.mkdir(exist_ok=True)
    (folder / "session_email_001.jsonl").write_text("\n".join(mail) + "\n\nbroken\n")
    (folder / "session_browser_001.jsonl").write_text("\n".join(web) + "\n")


@pytest.fixture
def recorded(tmp_path, write_png):
    shots = [write_png(f"shots/{i}.png", noise(10 + i)) for i in range(6)]
    recordings(tmp_path / "rec", shots)
    return tmp_path


def test_full_run_and_rerun(spark, recorded):
    options = E.RunOptions(quality_threshold=0.40, work_dir=str(recorded / "work"), agent_name="Helper")
    run = lambda: E.run(spark, str(recorded / "rec"), str(recorded / "out"), "2026.0603.1", options, str(recorded / "shots"))
    first = run()
    m = first["metrics"]
    assert m["lines:ingested"] == 7 and m["lines:failed"] == 2
    assert m["failed:dedup"] == 1 and m["status:approved"] == 6
    assert first["version"] == "2026.603.1"
    lines = [json.loads(r.value) for r in spark.read.text(str(recorded / "out/v2026_603_1")).collect()]
    assert len(lines) == sum(first["exported"].values())
    for example in lines:
        human, answer = example["conversations"]
        assert (human["from"], answer["from"]) == ("human", "gpt")
        assert "<think>" in answer["value"] and "<action>" in answer["value"]
        assert example["system"].startswith("You are Helper") and len(example["images"]) == 1
    info = json.loads((recorded / "out/dataset_info.json").read_text())
    assert sum(v["num_samples"] for v in info.values()) == len(lines)

    second = run()
    assert second["metrics"] == m and second["exported"] == first["exported"]
    work = str(recorded / "work")
    assert StoredIndex(spark, f"{work}/duplicate_index", "reader").rows().count() == 6
    registry = spark.read.parquet(f"{work}/registry")
    assert registry.count() == 7 and registry.select("sample_id").distinct().count() == 7
    assert spark.read.parquet(f"{work}/datasets").count() == 1
    runs = spark.read.parquet(f"{work}/membership").groupBy("sample_id").count().collect()
    assert all(r["count"] == 2 for r in runs)


def test_run_uses_responses_and_cache(spark, recorded):
    options = E.RunOptions(work_dir=str(recorded / "work"))
    plain = E.process(
        C.scan_lines(spark, str(recorded / "rec"), "session_*.jsonl"),
        I.image_facts(I.read_files(spark, str(recorded / "shots")), I.read_pixels(spark, str(recorded / "shots"))),
        options=options,
    )
    ids = [r.sample_id for r in plain.scored.select("sample_id").collect()]
    answer = json.dumps({"reasoning": "I can see everything that I need to see right here.", "intent": "Finish the job"})
    rows = [(i, "groq", "rubbish") for i in ids] + [(i, "openrouter", answer) for i in ids[:3]]
    responses = spark.createDataFrame(rows, "sample_id string, provider string, raw_response string")
    args = (spark, str(recorded / "rec"), str(recorded / "out"), "1.0.0", options, str(recorded / "shots"))
    first = E.run(*args, responses=responses)
    assert first["metrics"]["annotation:openrouter"] == 3 and first["metrics"]["annotation:fallback"] == 3
    second = E.run(*args, responses=responses)
    assert second["metrics"]["annotation:cache_hits"] == 3
    assert spark.read.parquet(f"{recorded}/work/annotation_cache").count() == 3


def test_options(tmp_path):
    (tmp_path / "o.json").write_text(json.dumps({"quality_threshold": 0.7, "unknown": 1, "export_stages": ["stage2_action"]}))
    o = E.RunOptions.from_json(tmp_path / "o.json")
    assert o.quality_threshold == 0.7 and o.export_stages == ("stage2_action",)


def test_locked_version_stays(spark):
    base = R.version_row(spark, "1.2.0", 5, 3, "a", "t0")
    locked = R.lock_version(base, "1.02.0")
    again = R.create_version(locked, R.version_row(spark, "1.2.0", 9, 9, "b", "t1")).first()
    assert (again.total_samples, again.locked) == (5, True)
    open_again = R.create_version(base, R.version_row(spark, "1.2.0", 9, 9, "b", "t1")).first()
    assert open_again.total_samples == 9
    listed = R.list_versions(base.unionByName(R.version_row(spark, "1.10.0", 1, 1, "", "t")))
    assert [r.version for r in listed.collect()] == ["1.10.0", "1.2.0"]


def test_annotator_function(spark):
    requests = spark.createDataFrame([(f"s{i}", "p") for i in range(5)], "sample_id string, user_prompt string")

    def annotate(batches):
        for b in batches:
            yield b.assign(provider="google", raw_response='{"reasoning": "' + "z" * 40 + '"}')[["sample_id", "provider", "raw_response"]]

    assert O.choose_response(O.run_annotator(requests, annotate, 2)).count() == 5


def test_lineage_lines(spark, tmp_path):
    rows = [
        {"sample_id": "a", "source_file": "f", "source_line": 1},
        {"sample_id": "a", "source_file": "f", "source_line": 2, "included_in_runs": ["r1"]},
        {"sample_id": "b", "source_file": "f"},
    ]
    (tmp_path / "lineage.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\nbroken\n\n")
    got = L.load_lineage(spark, str(tmp_path)).collect()
    assert [(r.sample_id, r.source_line, r.included_in_runs) for r in got] == [("a", 2, ["r1"])]


def test_session_sink_round_trip(spark, tmp_path):
    steps = spark.createDataFrame([("s1", i, "t") for i in range(5)] + [("s2", 0, "t")], "session_id string, step_index int, task string")
    W.append_session_steps(steps, str(tmp_path / "rec"))
    back = spark.read.json(str(tmp_path / "rec"))
    assert sorted(r.step_index for r in back.where("session_id = 's1'").collect()) == [0, 1, 2, 3, 4]
    assert (tmp_path / "rec/session_file=session_s1.jsonl").is_dir()


def test_sessions_share_a_bounded_number_of_folders(spark, tmp_path):
    steps = spark.range(300).selectExpr("concat('s', id % 100) AS session_id", "id AS step_index")
    W.append_session_steps(steps, str(tmp_path / "rec"), folders=4)
    folders = list((tmp_path / "rec").glob("session_file=session_*.jsonl"))
    assert 1 < len(folders) <= 4
    back = spark.read.json(str(tmp_path / "rec"))
    assert sorted(r.step_index for r in back.collect()) == list(range(300))
    assert back.groupBy("session_id").agg({"session_file": "count"}).count() == 100
    assert back.select("session_id", "session_file").distinct().count() == 100


def test_variance_on_an_edge_equals_the_running_mean(spark):
    rnd = np.random.default_rng(3)
    frames = [rnd.integers(0, 256, 192, dtype=np.uint8) for _ in range(50)]

    def running(values):
        mean = squares = 0.0
        for i, v in enumerate(map(float, values)):
            after = mean + (v - mean) / (i + 1)
            squares, mean = squares + (v - after) * (v - mean), after
        return squares / len(values)

    rows = [(i, 8, 8, 3, bytearray(f.tobytes())) for i, f in enumerate(frames)] + [(50, 8, 8, 3, None), (51, 8, 8, 3, bytearray(b"x"))]
    df = spark.createDataFrame(rows, "i int, h int, w int, c int, d binary")
    got = {r.i: r.v for r in df.select("i", X.pixel_variance("h", "w", "c", "d").alias("v")).collect()}
    assert got == {i: running(f) for i, f in enumerate(frames)} | {50: None, 51: None}
    assert any(running(f) != float(f.astype(np.float64).var()) for f in frames)


def test_live_feed(spark, tmp_path):
    def write(name, rows):
        spark.createDataFrame(rows, feed.STEP_SCHEMA).coalesce(1).write.parquet(str(tmp_path / "tmp" / name))
        for f in (tmp_path / "tmp" / name).glob("*.parquet"):
            (tmp_path / "steps").mkdir(exist_ok=True)
            f.rename(tmp_path / "steps" / f"{name}.parquet")

    def drain():
        q = feed.start_feed(spark, str(tmp_path / "steps"), str(tmp_path / "events"), str(tmp_path / "cp"), {"availableNow": True})
        q.awaitTermination()
        rows = spark.read.parquet(str(tmp_path / "events")).collect()
        return sorted((r.task_id, r.event, r.step if r.step is not None else -1, r.status) for r in rows)

    step = lambda t, i, a, e=None: (t, i, a, True, e, "why", "p.png")
    write("b0", [step("a", 0, "click"), step("a", 1, "type"), step("b", 0, "key")])
    one = [("a", "step_update", 1, "running"), ("b", "step_update", 0, "running")]
    assert drain() == one
    write("b1", [step("a", 2, "done"), step("b", 0, "key")])
    two = sorted(one + [("a", "step_update", 2, "completed"), ("a", "task_finished", -1, "completed")])
    assert drain() == two
    write("b2", [step("a", 3, "click"), step("b", 1, "click", "boom")])
    three = sorted(two + [("b", "step_update", 1, "failed"), ("b", "task_finished", -1, "failed")])
    assert drain() == three


def test_incremental_equals_batch(spark, recorded):
    facts = I.image_facts(I.read_files(spark, str(recorded / "shots")), I.read_pixels(spark, str(recorded / "shots")))
    work = str(recorded / "stream")
    drain = lambda: incremental.start_incremental(
        spark, str(recorded / "rec"), work, facts, pattern="session_*.jsonl", files_per_batch=1, trigger={"availableNow": True}
    ).awaitTermination()
    drain()
    batch = E.process(C.scan_lines(spark, str(recorded / "rec"), "session_*.jsonl"), facts)
    ids = lambda df: sorted(r.sample_id for r in df.select("sample_id").collect())
    assert ids(spark.read.parquet(f"{work}/scored")) == ids(batch.scored)
    drain()
    assert ids(spark.read.parquet(f"{work}/scored")) == ids(batch.scored)


@pytest.fixture
def every_stage(monkeypatch):
    for stage in D.STAGE_MIN_SCORE:
        monkeypatch.setitem(D.STAGE_MIN_SCORE, stage, 0.0)


def test_runs_and_batches_share_one_index(spark, recorded, every_stage):
    """A run, two batches, a run again: what was kept once stays known to all of them."""
    facts = I.image_facts(I.read_files(spark, str(recorded / "shots")), I.read_pixels(spark, str(recorded / "shots")))
    work, rec = str(recorded / "work"), recorded / "rec"
    options = E.RunOptions(quality_threshold=0.40, work_dir=work)
    run = lambda folder: E.run(spark, str(folder), str(recorded / "out"), "1.0.0", options, str(recorded / "shots"))
    drain = lambda: incremental.start_incremental(
        spark, str(recorded / "more"), work, facts, options=options, pattern="session_*.jsonl", files_per_batch=1,
        trigger={"availableNow": True}, out_dir=str(recorded / "out")
    ).awaitTermination()
    known = lambda: {(r.run.split("-")[0], r.id) for r in StoredIndex(spark, f"{work}/duplicate_index", "reader").rows().collect()}
    run(rec)
    first = known()
    assert len(first) == 6
    # the same steps under other names are duplicates of the run's, whatever file they come in
    more = recorded / "more"
    more.mkdir()
    (more / "session_copy_1.jsonl").write_text((rec / "session_email_001.jsonl").read_text())
    drain()
    (more / "session_copy_2.jsonl").write_text((rec / "session_browser_001.jsonl").read_text())
    drain()
    assert known() == first
    gated = spark.read.parquet(f"{work}/registry").where("status = 'rejected'")
    assert gated.where("rejection_reason LIKE 'dedup: Duplicate of %'").count() == 1 + 7
    again = run(rec)
    assert again["metrics"]["failed:dedup"] == 1 and known() == first
    assert spark.read.parquet(f"{work}/lineage").select("run_id").distinct().count() == 4
    assert spark.read.parquet(f"{work}/membership").select("run_id").distinct().count() == 2
    assert spark.read.parquet(f"{work}/datasets").first().total_samples == 7 + 7


def test_batches_leave_what_a_run_leaves(spark, recorded, every_stage):
    facts = I.image_facts(I.read_files(spark, str(recorded / "shots")), I.read_pixels(spark, str(recorded / "shots")))
    options = E.RunOptions(quality_threshold=0.40)
    E.run(spark, str(recorded / "rec"), str(recorded / "a"), "1.0.0", E.RunOptions(quality_threshold=0.40, work_dir=str(recorded / "run")), str(recorded / "shots"))
    incremental.start_incremental(
        spark, str(recorded / "rec"), str(recorded / "batches"), facts, options=options, pattern="session_*.jsonl", files_per_batch=1,
        trigger={"availableNow": True}, out_dir=str(recorded / "b")
    ).awaitTermination()
    table = lambda work, name, *columns: sorted(tuple(r) for r in spark.read.parquet(str(recorded / work / name)).select(*columns).collect())
    for name, columns in (("registry", ("sample_id", "status", "approved", "training_stage", "quality_score")),
                          ("lineage", ("sample_id", "seq", "event", "stage", "result")), ("membership", ("sample_id",))):
        assert table("run", name, *columns) == table("batches", name, *columns)
    lines = lambda out: sorted(r.value for r in spark.read.option("recursiveFileLookup", "true").text(str(recorded / out / "v1_0_0")).collect())
    assert lines("a") == lines("b") and lines("a")
