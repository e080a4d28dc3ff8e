"""Session analysis on literal trajectories, whole and cut into parts."""

import pytest
from pyspark.sql import functions as F

from stepforge.operators import skew
from stepforge.operators import trajectory as R

SCHEMA = "session_id string, line long, step_index int, task string, action_type string, coordinates array<double>, has_coordinates boolean, text string"
CASES = {
    "good": [("key",), ("type",), ("click", 0.5), ("done",)],
    "loop": [("click", 0.5), ("type",), ("click", 0.5), ("type",), ("done",)],
    "straight": [("key",), ("type",), ("scroll",), ("click", 0.5), ("done",)],
    "again": [("click", 0.5), ("click", 0.5), ("done",)],
    "same": [("click", 0.5)] * 9 + [("done",)],
    "outside": [("click", 1.5), ("done",)],
    "keys": [("key",), ("key",)],
    "scrolls": [("scroll",), ("scroll",)],
    "types": [("type",), ("type",)],
}


def steps(spark, cases=CASES):
    rows = []
    for name, actions in cases.items():
        for i, a in enumerate(actions):
            point = [a[1], 0.5] if len(a) > 1 else None
            rows.append((name, i + 1, i, f"task {name}", a[0], point, point is not None, None))
    return spark.createDataFrame(rows, SCHEMA)


def flagged(df, hot_rows=skew.HOT_ROWS):
    placed = skew.in_order(df, ["line"], R.PAYLOAD, R.LOOKAHEAD, hot_rows=hot_rows)
    return R.flag_steps(placed)


def test_reports(spark):
    report = {r.session_id: r for r in R.quality_report(flagged(steps(spark))).collect()}
    assert report["good"].quality_score == 1.0 and report["good"].use_for_training
    assert report["loop"].n_loops == 1 and report["loop"].quality_score == 0.9
    assert report["straight"].n_loops == 0
    assert report["again"].n_redundant == 1 and report["again"].n_low_diversity == 1 and report["again"].quality_score == 0.8
    assert (report["same"].n_loops, report["same"].n_redundant, report["same"].n_low_diversity) == (3, 8, 1)
    assert report["same"].quality_score == 0.0 and not report["same"].use_for_training
    assert report["outside"].n_errors == 1
    assert [report[n].n_redundant for n in ("keys", "scrolls", "types")] == [0, 1, 1]
    assert report["loop"].task == "task loop"
    assert [(c.action_type, c.n) for c in report["loop"].action_counts] == [("click", 2), ("type", 2), ("done", 1)]


def test_issue_texts(spark):
    issues = R.all_issues(flagged(steps(spark))).collect()
    text = {(i.session_id, i.issue_type): i.description for i in issues}
    assert text["loop", "loop_detected"] == "Steps 0–3 repeat sequence: ['click', 'type']"
    assert text["again", "redundant_actions"] == "Steps 0 and 1: consecutive click at same coordinates [0.5, 0.5]"
    assert text["outside", "impossible_coordinates"] == "Step 0: coordinates [1.500, 0.500] are outside valid range [0.0, 1.0]"
    assert text["again", "low_diversity"] == "Action 'click' appears 2/2 times (100%) — model may overfit to this action"


@pytest.mark.parametrize("lines", [1, 2, 3, 5])
def test_hot_sessions_give_the_same_flags(spark, monkeypatch, lines):
    """Cutting sessions into parts of a few lines must not change anything."""
    import random

    monkeypatch.setattr(skew, "CUT_SAMPLES", lines)
    random.seed(lines)
    kinds = [("click", 0.5), ("type",), ("key",), ("scroll",)]
    cases = {f"s{i}": [random.choice(kinds[: random.randint(1, 4)]) for _ in range(random.randint(1, 60))] for i in range(8)}
    df = steps(spark, cases)
    # gaps: dropped lines leave parts that are short or empty
    df = df.where("line % 7 != 3 or session_id = 's0'")
    order = ["session_id", "pos"]
    whole = flagged(df).orderBy(*order).collect()
    cut = flagged(df, hot_rows=1).orderBy(*order).collect()
    assert whole == cut
    assert [r.pos for r in whole if r.session_id == "s0"] == list(range(len(cases["s0"])))


def test_a_second_with_all_steps_is_cut(spark):
    steps = spark.range(2_000).select(
        F.when(F.col("id") < 1_900, "hot").otherwise("cold").alias("session_id"), F.lit(7).alias("ts"), (F.col("id") * 37 % 2_003).alias("event_id"))
    order = ["ts", "event_id"]
    cuts = {r["session_id"]: [c["event_id"] for c in r["_cuts"]] for r in skew._cut_points(steps, order, "session_id", 200).collect()}
    assert list(cuts) == ["hot"] and cuts["hot"] == sorted(cuts["hot"])
    ids = sorted(i * 37 % 2_003 for i in range(1_900))
    bounds = [0, *cuts["hot"], 2_003]
    assert max(sum(a <= i < b for i in ids) for a, b in zip(bounds, bounds[1:])) <= 600 and len(cuts["hot"]) >= 5
    placed = skew.in_order(steps, order, ["event_id"], 3, hot_rows=200).where("session_id = 'hot'").orderBy("pos").collect()
    assert [r["event_id"] for r in placed] == ids and [r["pos"] for r in placed] == list(range(1_900))
    assert all([f["event_id"] for f in r["following"]] == ids[i + 1 : i + 4] for i, r in enumerate(placed))


def test_empty_sessions(spark):
    report = R.quality_report(flagged(steps(spark)))
    sessions = spark.createDataFrame([("good",), ("nothing",)], "session_id string")
    got = {r.session_id: r for r in R.with_empty_sessions(sessions, report).collect()}
    assert got["nothing"].quality_score == 0.0 and got["nothing"].n_errors == 1 and not got["nothing"].use_for_training
    assert got["good"].quality_score == 1.0


def test_summary(spark):
    s = R.batch_summary(R.quality_report(flagged(steps(spark)))).first()
    assert s.sessions == 9 and s.approved + s.flagged == 9
    assert s.perfect + s.good + s.marginal + s.poor == 9
