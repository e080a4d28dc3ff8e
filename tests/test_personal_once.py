from pyspark.sql import functions as F

from stepforge.functions import personal as P

TEXTS = [
    "a@b.cd", "@b.cd", "a@b.c", "x%@-.zz", "call +1555-555-0132", "call 1555-555-0132", "(415)555-0199", "+1(415) 555-0199x", "555-01321",
    "415 555 01999", "415.555.0199.", "PASSWD: 12345", "Api-Key=abcd", "secret_key : abcd", "secretkey abcd", "apikey", "password =abc", "paſſword: 1234",
    "my Key", "", None,
]


def test_short_tests_agree_with_the_whole_patterns(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    for kind, pattern in (("email", P.EMAIL), ("phone", P.PHONE), ("secret", P.SECRET)):
        whole = F.coalesce(F.regexp_like("text", F.lit(pattern)), F.lit(False))
        assert rows.where(P.flags(F.col("text"))[f"has_{kind}"] != whole).collect() == []


def test_texts_are_put_together_once(spark):
    rows = spark.createDataFrame([("a", "b@c.de"), ("a", None)], "x string, y string")
    clean = rows.select(P.none_found(F.col("x"), F.col("y")).alias("clean"))
    assert clean._jdf.queryExecution().optimizedPlan().toString().count("concat_ws") == 1
    assert [r.clean for r in clean.collect()] == [False, True]


def test_clean_lines_are_left_out_before_places_are_looked_for(spark):
    docs = spark.createDataFrame([(1, "plain\nann@example.com\n"), (2, "nothing"), (3, None)], "doc_id long, text string")
    found = P.findings(docs)
    # only a filter above the exploded lines keeps the clean ones from the search
    assert "concat_ws" in found._jdf.queryExecution().optimizedPlan().toString().split("posexplode")[0]
    assert [tuple(r) for r in found.collect()] == [(1, 1, "email", 0, "ann@example.com")]
    masked = docs.select(P.masked_text(F.col("text")).alias("m"))
    assert [r.m for r in masked.collect()] == ["plain\n[email]\n", "nothing", None]
