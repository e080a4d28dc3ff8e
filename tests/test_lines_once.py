from stepforge.operators import normalize as Z
from stepforge.sources import recordings as C


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_each_line_is_parsed_once(spark):
    rows = [('{"step_index": 1, "task": "t", "action": {"type": "CLICK "}}', "f", 1), (" ", "f", 2), ("{broken", "f", 3), (None, "f", 4)]
    lines = spark.createDataFrame(rows, "value string, source_file string, line_number long")
    parsed = C.parse_lines(lines)
    assert [r.line_kind for r in parsed.orderBy("line_number").collect()] == ["parsed", "blank", "corrupt", "corrupt"]
    good = Z.normalize(parsed.where("line_kind = 'parsed'")).where("ingest_error is null")
    assert [r.action_type for r in good.select("action_type").collect()] == ["click"]
    for df in (good, C.recorded_steps(parsed.where("line_kind = 'parsed'"))):
        assert _plan(df.select("action_type")).count("parseJson") == 1
