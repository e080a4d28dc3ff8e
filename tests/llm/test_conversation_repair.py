"""Conversation repair against a search over all edits."""

import hashlib
import random
import zlib
from collections import defaultdict

import regex
from helpers import words
from pyspark.sql import functions as F

from stepforge.llm import conversation_repair as repair
from stepforge.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string, conv string, edit string"
PATTERN = regex.compile(r"(s?(ua)+)?")


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], md5(r[2])))


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        found = words(text)
        kind = "blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1][-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(kind)
    return out


def searched(rows):
    """(cost, audit, repaired lines) of the best of all edit sequences, by depth-first search."""
    marks = faults(rows)
    best = [(4 * len(rows), "D" * len(rows), [])]

    def go(i, cost, audit, roles, lines):
        if cost > best[0][0] or not PATTERN.fullmatch(roles, partial=True):
            return
        if i == len(rows) and PATTERN.fullmatch(roles):
            best[0] = min(best[0], (cost, audit, lines), key=lambda x: x[:2])
        for role in ("user", "assistant"):
            go(i, cost + 3, audit + "I", roles + role[0], [*lines, f"{role}:"])
        if i == len(rows):
            return
        _, role, text = rows[i]
        go(i + 1, cost + 4, audit + "D", roles, lines)
        if marks[i] in ("blank", "duplicate"):
            return
        more = 3 if marks[i] == "truncated" else 0
        if role:
            go(i + 1, cost + more, audit + "K", roles + role[0], [*lines, f"{role}:{text}"])
        for other in ("user", "assistant"):
            go(i + 1, cost + 3 + more, audit + "R", roles + other[0], [*lines, f"{other}:{text}"])

    go(0, 0, "", "", [])
    return best[0]


def expected(conv, rows, search=searched):
    rows = in_order(rows)
    turns = [t for t, _, _ in rows if t is not None]
    marks = faults(rows)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit, lines = search(rows)
    return (
        conv,
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(marks.count(k) for k in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def made_up(seed, n):
    rnd = random.Random(seed)
    texts = ["all fine.", "cut off", "", " \n ", "really?", "Yes! ", "no end,", "same.", None]
    rows = []
    for conv in range(n):
        for turn in range(rnd.randint(1, 6)):
            place = None if rnd.random() < 0.1 else turn * rnd.choice([1, 1, 1, 3])
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv if conv else None, place, role, rnd.choice(texts), "x", "y"))
    return rows


def by_conversation(rows):
    held = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        held[conv].append((turn, " " if role is None else role, " " if text is None else text))
    return held


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_repair_equals_a_search_over_all_edits(spark):
    rows = made_up(1, 250)
    turns = spark.createDataFrame(rows, SCHEMA)
    want = sorted((expected(c, r) for c, r in by_conversation(rows).items()), key=str)
    assert got(repair.report(turns, turns)) == want
    assert got(repair.report(turns, turns, chunk_turns=2)) == want


def test_edited_turns_come_in_order(spark):
    rows = [(1, 0, "user", "hello there.", "", ""), (1, 1, "user", "a question?", "", ""), (1, 2, "assistant", "", "", "")]
    turns = spark.createDataFrame(rows, SCHEMA)
    edited = repair.repair(turns, repair.plan(turns)).collect()
    assert [tuple(r)[1:] for r in edited] == [
        (0, "K", "user", "hello there."), (1, "R", "assistant", "a question?"), (2, "D", "assistant", "")]


def damaged(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def test_query_on_odd_rows(spark):
    rows = made_up(2, 120) + [(1000 + i, i, "user", "kept.", "", "") for i in range(60)]
    turns = spark.createDataFrame(rows, SCHEMA)
    held = by_conversation(damaged(rows))
    want = [expected(c, held.get(c, [])) for c in {r[0] for r in rows}]
    assert got(repair.report(repair.damaged(turns), turns)) == sorted(want, key=str)
    assert any(not held.get(r[0]) for r in rows)


def test_giant_conversation_over_many_chunks(spark):
    n = 60_000
    turns = spark.range(n).select(
        F.lit(7).alias("conv_id"), F.col("id").alias("turn"), F.expr("if(id % 2 = 0, 'user', 'assistant')").alias("role"),
        F.expr("if(id % 1000 = 998, '', concat('number ', id, '.'))").alias("text"))
    row = repair.report(turns, turns, chunk_turns=1000).first()
    # Each blank user turn goes and an empty one takes its place.
    assert (row["blank"], row["cost"], len(row["audit"])) == (60, 60 * 7, n + 60)
    assert row["audit"].count("DI") == 60 and set(row["audit"]) == set("DIK")


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(5, 0, "user", "a.", "", "")], SCHEMA)
    assert repair.report(none, none).count() == 0
    assert [tuple(r) for r in repair.report(none, some).collect()] == [expected(5, [])]


def test_registered_query_has_every_conversation(spark):
    sf = "/root/testdata/sf0.001"
    found = queries.QUERIES["op12_conversation_repair"](spark, sf)
    assert found.count() == queries.table(spark, sf, "conversations").select("conv_id").distinct().count()
