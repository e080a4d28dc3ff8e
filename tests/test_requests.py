from pyspark.sql import functions as F

from stepforge.functions import rendering as N
from stepforge.plans import table_queries as Q

SCREENS = {1: "", 2: None, 24: "x", 9: "a\tb", 17: 'it\'s\ta "q"\nnext', 25: "back\\slash's", 33: "\n\n", 8: "", 32: "y"}


def test_requests_show_texts_as_the_sql_does(spark, tmp_path):
    documents = [(i, t, "en", "web", None if i == 24 else len(t or "")) for i, t in SCREENS.items()]
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {int(r.sample_id[2:]): r.user_prompt for r in Q.requests(spark, str(tmp_path)).collect()}
    assert set(got) == set(SCREENS) and got[2] is None and got[24] is None
    shown = {i: p.split("(OCR text detected):\n")[1].split("\n\nACTION TAKEN:\n")[0] for i, p in got.items() if p is not None}
    assert shown == {1: "", 9: "a\tb", 17: 'it\'s\ta "q" | next', 25: "back\\slash's", 33: " |  | ", 8: "", 32: "y"}
    typed = {i: p.split("\n  Description: ")[0].rsplit("\n  ", 1)[1] for i, p in got.items() if p is not None and i % 8 == 1}
    assert typed == {
        1: "Text: N/A", 9: "Text: 'a\tb'", 17: "Text: 'it\\'s\ta \"q\"'", 25: 'Text: "back\\\\slash\'s"', 33: "Text: N/A",
    }


def test_requests_of_the_annotator_escape_and_name_an_empty_screen(spark):
    rows = spark.createDataFrame([("", "a\tb"), (None, None)], "screen string, typed string")
    lit = F.lit
    request = N.reasoning_request(lit("t"), F.col("screen"), lit("type"), lit(1), lit(5), lit("d"), lit(None).cast("array<double>"), F.col("typed"))
    first, second = [r.r for r in rows.select(request.alias("r")).collect()]
    assert "\nNo OCR text available\n" in first and "\nNo OCR text available\n" in second
    assert "  Text: 'a\\tb'\n" in first and "  Text: N/A\n" in second
