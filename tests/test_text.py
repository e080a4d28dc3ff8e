"""Column functions against values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from stepforge.functions import parsing as P
from stepforge.functions import regions as G
from stepforge.functions import rendering as N
from stepforge.functions import scoring as S
from stepforge.functions import text as T


def column(spark, values, build, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in rows.withColumn("o", build(F.col("v"))).orderBy("i").collect()]


def test_language_branches(spark):
    texts = ["کریں نیا فائل", "خلاص وتل لیدل", "افتح ملف جديد", "ششش ششش", "खोलें फ़ाइल", "Open file", "12345 !!", ""]
    assert column(spark, texts, T.detect_language) == ["ur", "ps", "ar", "ur", "hi", "en", "unknown", "unknown"]


def test_language_tags(spark):
    tags = F.array(F.lit("email"))
    build = lambda v: F.array_join(T.language_tags(tags, v, T.detect_language(v)), ",")
    assert column(spark, ["12345 !!", "", "Open file"], build) == ["email,multilingual,lang:unknown", "email", "email"]


def test_clean_tokens(spark):
    tokens = ["ok", "xy", "a", "***", "PNG", "JSON", "cZEZE", "xXx@", "", None]
    assert column(spark, tokens, T.is_clean_token) == [True, False, False, False, False, True, True, True, False, False]


def test_exact_rounding(spark):
    import random

    random.seed(3)
    values = [0.125, 2.675, 1.0125, 1.005, 0.5, 1.5, -0.125, 1e-5] + [random.randint(-10**6, 10**6) / 2000 for _ in range(300)]
    for places in (0, 1, 2, 3, 4):
        assert column(spark, values, lambda v: T.nearest(v, places), "double") == [round(v, places) for v in values]
    assert column(spark, values[:3], lambda v: T.fixed(v, 2), "double") == ["%.2f" % v for v in values[:3]]


def test_decimal_text(spark):
    assert column(spark, [0.5, 1.0, 0.0001, 0.33333], T.decimal_text, "double") == ["0.5", "1.0", "0.0001", "0.3333"]


def test_json_strings(spark):
    import json

    values = ['a "b" \\ c', "line\nbreak\tx", "é😀ü", "plain"]
    assert column(spark, values, T.json_string) == [json.dumps(v, ensure_ascii=False) for v in values]
    assert column(spark, values, T.json_string_ascii) == [json.dumps(v) for v in values]


def test_versions(spark):
    build = lambda v: T.version_text(T.parse_version(v))
    got = column(spark, ["2026.0603.1321", " 1.10.0 ", "1.0", "1.0.0-rc"], build)
    assert got[:2] == ["2026.603.1321", "1.10.0"]
    order = spark.createDataFrame([("1.10.0",), ("1.9.0",)], "v string").orderBy(T.parse_version(F.col("v")).desc())
    assert [r.v for r in order.collect()] == ["1.10.0", "1.9.0"]
    with pytest.raises(ValueError):
        T.canonical_version("1.0")


def test_risk(spark):
    rows = spark.createDataFrame(
        [("scroll", "", ""), ("click", "", ""), ("click", "Delete it", ""), ("type", "", "password field"), ("done", "", ""), ("hover", "", "")],
        "a string, d string, c string",
    )
    got = rows.select(T.risk_name(T.risk_level(F.col("a"), F.col("d"), F.col("c")))).collect()
    assert [r[0] for r in got] == ["SAFE", "LOW", "HIGH", "HIGH", "SAFE", "MEDIUM"]


def test_parse_action(spark):
    outputs = [
        '<action>{"type":"click","coordinates":[0.5,0.3],"description":"OK"}</action>',
        '<action>{"type":"type","text":"hello"}</action>',
        '<action>{"type":"done","description":"fin"}</action>',
        "just text, no block", "<action>not json</action>", '<action>{"type":"fly"}</action>',
        '<action>{"type":"click","coordinates":[1.5,0.5]}</action>',
        '<action>\n{"type":\n"key"}\n</action><action>{"type":"fly"}</action>',
        '<action>{"type":"click","coordinates":[0.5]}</action>',
        '<action>{"type":"click","coordinates":null}</action>',
    ]
    got = column(spark, outputs, P.parse_action)
    assert [r.error for r in got] == [
        None, None, None, "no_action_block", "invalid_json", "unknown_type", "out_of_range", None, "bad_coordinates", None,
    ]
    assert got[0].action.coordinates == [0.5, 0.3] and got[0].action.confidence == 1.0
    assert got[1].action.text == "hello" and got[7].action.type == "key"


def test_parse_response(spark):
    long = "I can see the compose button here"
    responses = [
        '```json\n{"reasoning": "%s", "intent": "Write"}\n```' % long,
        'Sure: {"reasoning": "%s", "intent": "Write"} done' % long,
        '{"reasoning": "%s \\"quoted\\"", "inte' % long,
        '{"reasoning": "%s"}' % ("x" * 29),
        "nothing",
    ]
    got = column(spark, responses, P.parse_response)
    assert [None if r is None else r.intent for r in got] == ["Write", "Write", "", None, None]
    assert got[2].reasoning == long + ' "quoted"'
    older = column(spark, ['{"reasoning": "short", "verified": true}', '{"reasoning": ""}'], P.parse_response_plain)
    assert older[0].verified is True and older[1] is None


def test_long_broken_response(spark):
    text = '{"reasoning": "' + "word " * 20000 + '", "broken'
    assert column(spark, [text], P.parse_response)[0].reasoning.startswith("word word")


def test_verification(spark):
    regions = F.array(F.struct(F.lit("Send now").alias("text")), F.struct(F.lit("Inbox").alias("text")))
    claims = ["no quotes", 'a "send" b "absent"', 'a "send" b "absent" c "gone"', ""]
    assert column(spark, claims, lambda v: P.verify_reasoning(v, regions)) == [True, True, False, False]
    empty = F.array().cast(f"array<{G.REGION_TYPE}>")
    assert column(spark, ["no quotes"], lambda v: P.verify_reasoning(v, empty)) == [False]
    strict = column(spark, claims, lambda v: P.verify_reasoning_strict(v, F.lit("Send now Inbox")))
    assert strict == [True, False, False, False]


def test_coordinates(spark):
    got = spark.range(1).select(
        G.normalize_point(F.lit(640), F.lit(360), F.lit(1280), F.lit(720)),
        G.denormalize_point(F.lit(0.25), F.lit(1 / 3), F.lit(1280), F.lit(720)),
        G.box_center(F.array(F.lit(0.1), F.lit(0.1), F.lit(0.5), F.lit(0.5))),
        G.in_unit_range(F.lit(1.1), F.lit(0.5)), G.in_unit_range(F.lit(float("nan")), F.lit(0.5)),
        G.in_unit_range(F.lit(0.0), F.lit(1.0)),
    ).first()
    assert got[0] == [0.5, 0.5] and got[1] == [320, 240] and got[2] == pytest.approx([0.3, 0.3])
    assert list(got[3:]) == [False, False, True]


def test_change_types(spark):
    cases = [(0.0005, 0), (0.019, 1), (0.03, 1), (0.05, 1), (0.05, 3), (0.10, 3), (0.30, 4), (0.30, 5), (0.51, 9)]
    rows = spark.createDataFrame(cases, "r double, n int").select(N.change_type(F.col("r"), F.col("n")))
    assert [r[0] for r in rows.collect()] == [
        "no_change", "minor_change", "text_update", "new_element", "text_update", "minor_change", "minor_change",
        "layout_shift", "full_screen",
    ]


def test_rich_sample_scores(spark):
    l = F.lit
    got = spark.range(1).select(
        S.reasoning_score(l("Click the reply button"), l("x" * 167), l("Reply to the mail"), l(True)),
        S.ocr_score(l(5), l(0.968)),
        S.diversity_score(l("en"), l(False), l(3), l("click")),
        S.validation_score(l(True), l(True), l(True), l(True), l(True)),
        S.difficulty(l("Open Gmail and reply"), l(3), l(5), l("click"), l("en")),
        S.route_stage(l(0.905), l(3), l("click"), F.array(l(0.5), l(0.5)), l("Click it now"), l("x" * 167), l("Reply to the mail"), l(True), l(5)),
        S.route_stage(l(0.905), l(6), l("click"), F.array(l(0.5), l(0.5)), l("Click it now"), l("x" * 167), l("Reply to the mail"), l(True), l(5)),
        S.route_stage(l(0.61), l(6), l("click"), F.array(l(0.5), l(0.5)), l(""), l(""), l(""), l(False), l(2)),
    ).first()
    assert got[0] == pytest.approx(0.90) and got[1] == 1.0 and got[2] == pytest.approx(0.6) and got[3] == 1.0
    assert got[4] == 2
    assert list(got[5:]) == ["stage2_action", "stage3_planning", "stage1_grounding"]
    total = 0.30 * got[3] + 0.35 * got[0] + 0.20 * got[1] + 0.15 * got[2]
    assert total == pytest.approx(0.905)
