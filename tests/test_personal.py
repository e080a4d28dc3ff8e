"""Personal data: check digits, places and masks, against plain Python."""

import random
import re

from pyspark.sql import functions as F

from stepforge.functions import personal as P
from stepforge.functions import scoring
from stepforge.operators import enrich
from stepforge.plans import audit_queries  # noqa: F401
from stepforge.plans import catalog as Q

TEXTS = [
    "card 4539 1488 0343 6467, not 4539 1488 0343 6468",
    "4539148803436467,4111-1111-1111-1111 and 378282246310005",
    "3782 822463 10005 then 0000 0000 0000 0000",
    "12 4111 1111 1111 1111 7",
    "pay GB82 WEST 1234 5698 7654 32 NOW or DE89370400440532013000 or DE89370400440532013001",
    "host 10.0.0.255. or 10.0.0.256 or 1.2.3.4.5 or 1234.1.1.1",
    "write ann@example.com (bob.b@mail.example.org) or +1 415-555-0132, (415) 555-0199",
    "api_key = abcd1234 and [card] 4111111111111111 stays",
    "", "nothing here 123", None,
]
EXPECTED = {
    0: [("card", "4539 1488 0343 6467")],
    1: [("card", "4539148803436467"), ("card", "4111-1111-1111-1111"), ("card", "378282246310005")],
    2: [("card", "3782 822463 10005")],
    3: [("card", "4111 1111 1111 1111")],
    4: [("account", "GB82 WEST 1234 5698 7654 32"), ("account", "DE89370400440532013000")],
    5: [("address", "10.0.0.255")],
    6: [("email", "ann@example.com"), ("email", "bob.b@mail.example.org"), ("phone", "+1 415-555-0132"), ("phone", "(415) 555-0199")],
    7: [("secret", "api_key = abcd1234"), ("card", "4111111111111111")],
    8: [], 9: [], 10: [],
}


def test_findings_have_place_and_value(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = {i: [] for i in EXPECTED}
    for r in P.findings(docs).orderBy("doc_id", "line", "start").collect():
        assert TEXTS[r["doc_id"]][r["start"]:].startswith(r["value"])
        found[r["doc_id"]].append((r["kind"], r["value"]))
    assert found == EXPECTED


def test_flags_agree_with_findings(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    flags = P.flags(F.col("text"))
    rows = docs.select("doc_id", *[f.alias(k) for k, f in flags.items()], P.none_found(F.col("text")).alias("none")).collect()
    for r in rows:
        kinds = {f"has_{k}" for k, _ in EXPECTED[r["doc_id"]]}
        assert {k for k in flags if r[k]} == kinds and r["none"] == (not kinds)


def test_masks_are_reversible(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS) if t is not None], "doc_id long, text string")
    rows = docs.withColumn("found", P.found_in(F.col("text"))).withColumn("masked", P.masked(F.col("text"), F.col("found")))
    rows = rows.withColumn("again", P.restored(F.col("masked"), F.col("found"))).collect()
    assert all(r["again"] == r["text"] for r in rows)
    masked = {r["doc_id"]: r["masked"] for r in rows}
    assert masked[0] == "card [card], not 4539 1488 0343 6468"
    assert masked[7] == "[secret] and [card] [card] stays"


def test_check_digits_against_plain_python(spark):
    draw = random.Random(5)
    cards = ["".join(draw.choices("0123456789", k=draw.randint(13, 19))) for _ in range(300)]
    accounts = ["".join(draw.choices("ABCXYZ", k=2)) + "".join(draw.choices("0123456789ABZ", k=20)) for _ in range(300)]

    def luhn(x):
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(x))]
        return sum(d - 9 if d > 9 else d for d in twice) % 10 == 0

    got = spark.createDataFrame([(c, a) for c, a in zip(cards, accounts)], "c string, a string").select(
        "c", "a", P.luhn(F.col("c")).alias("luhn"), P.mod97(F.col("a")).alias("mod97")).collect()
    for r in got:
        assert r["luhn"] == luhn(r["c"])
        assert r["mod97"] == (int(re.sub("[A-Z]", lambda m: str(ord(m[0]) - 55), r["a"][4:] + r["a"][:4])) % 97 == 1)
    assert any(r["luhn"] for r in got) and any(r["mod97"] for r in got)


def test_masked_documents_hold_nothing(spark):
    rows = Q.QUERIES["X7_masks"](spark, "/root/testdata/sf0.001").collect()
    flagged = Q.QUERIES["X7"](spark, "/root/testdata/sf0.001").where("NOT no_pii").count()
    assert len(rows) == flagged > 0 and all(r["clean"] and r["n_findings"] > 0 for r in rows)


def test_personal_data_costs_a_fifth_of_the_validation_score(spark):
    rows = [(True, "call 415-555-0132 now", ""), (True, "call me", ""), (True, None, "mail ann@example.com")]
    samples = spark.createDataFrame(rows, "flag boolean, text string, ocr_text_raw string").select(
        "*", *[F.lit("").alias(c) for c in ("task", "description", "reasoning")], F.array().cast(f"array<{enrich.R.REGION_TYPE}>").alias("regions"))
    flag = F.col("flag")
    scored = enrich.add_personal_flag(samples).select(scoring.validation_score(flag, flag, flag, F.col("no_pii"), flag).alias("v"))
    assert [r["v"] for r in scored.collect()] == [0.8, 1.0, 0.8]
