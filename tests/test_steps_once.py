import random
import re

from pyspark.sql import functions as F

from stepforge.functions import parsing as P
from stepforge.functions import regions as R
from stepforge.functions import text as T
from stepforge.operators import enrich
from stepforge.plans import factory_run


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_task_is_lowered_once_for_all_keywords(spark):
    tasks = spark.createDataFrame([("Open GMAIL and save", "click"), (None, "key")], "task string, action string")
    tags = tasks.select(T.infer_tags(F.col("task"), F.col("action")).alias("tags"))
    assert _plan(tags).count("lower(") == 1
    assert [r.tags for r in tags.collect()] == [["email", "file", "action:click"], ["action:key"]]


def test_long_texts_are_stripped_as_short_ones(spark):
    ends = ["", *T.WHITESPACE, " \n", "\u3000\t"]
    rows = [(a + b + c,) for a in ends for b in ("", "x", "é y\u0434") for c in ends] + [(None,)]
    df = spark.createDataFrame(rows, "s string")
    assert df.where(~T.strip_long(F.col("s")).eqNullSafe(T.strip(F.col("s")))).collect() == []


def test_fences_are_taken_by_one_pattern(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["`", "``", "```", "json", " ", "\n", "{", "a"]) for _ in range(rng.randrange(12))) for _ in range(400)]
    both = lambda s: re.sub(r"\s*```", "", re.sub(r"```(?:json)?\s*", "", s)).strip(" \n")
    bare = spark.createDataFrame([(t,) for t in texts], "s string").select("s", P.unfence(F.col("s")).alias("bare"))
    assert [(r.s, r.bare) for r in bare.collect() if r.bare != both(r.s)] == []
    assert _plan(bare).count("regexp_replace") == 1


def test_regions_are_cleaned_once_per_screenshot(spark, monkeypatch):
    """Cleaning is not done again for each sample of a screenshot."""
    cleaned = []
    clean = R.clean_regions
    monkeypatch.setattr(R, "clean_regions", lambda column, *a, **k: cleaned.append(column) or clean(column, *a, **k))
    line = '{"step_index": %d, "task": "Open the file", "session_id": "s", "screenshot_path": "/a.png", ' \
           '"action": {"type": "key", "key": "%s", "description": "press it"}, "ocr_text": "raw"}'
    rows = [(line % (i, "abc"[i]), "f", i + 1) for i in range(2)] + [("{broken", "f", 3), (" ", "f", 4), ("[1]", "f", 5)]
    lines = spark.createDataFrame(rows, "value string, source_file string, line_number long")
    facts = spark.createDataFrame([("/a.png", 9000, "d", 900, 900, 90.0, None)], factory_run.NO_FACTS)
    seen = spark.createDataFrame([("/a.png", [("  Open now ", [0.1] * 4, 0.9, "?"), ("12", [0.1] * 4, 0.9, "?")])],
                                 f"path string, regions array<{R.REGION_TYPE}>")
    tables = factory_run.process(lines, facts, seen)
    assert len(cleaned) == 1
    assert "clean" not in enrich.add_cleaned_regions.__code__.co_names
    got = tables.scored.selectExpr("n_regions", "regions[0].text AS text", "regions[0].script AS script").collect()
    assert got and {tuple(r) for r in got} == {(1, "Open now", "latin")}
    assert sorted(r.ingested for r in tables.lines.collect()) == [False, False, False, True, True]
