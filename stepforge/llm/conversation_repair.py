"""Repair of conversation structure at least cost: two streams over sorted turns.

The roles of a repaired conversation read ``(s?(ua)+)?`` by their initials.  A turn is
kept (0), gets the role that fits (3) or is deleted (4); an empty turn may be added
anywhere (3).  Blank turns and repeats must go; a truncated turn that stays costs 3
more.  Of the cheapest repairs the one whose edits spell the ASCII-least string is made.

Turns are dealt by conversation and sorted by turn, and ``mapInPandas`` carries the
state of a conversation from one Arrow batch to the next.  The first stream sees no
texts and runs backwards: its state is the cost of finishing from each of the four
states of the pattern, and for every turn it leaves a byte, the best edit by state (two
bits each).  The bytes go out as rows of at most ``CHUNK_TURNS`` turns, so a giant
conversation is never held; they are written to the shared folder.  The second stream
runs forwards over texts and bytes in one sort, follows the bytes, and puts out the
edited turns as they come.

Defined results: null roles and texts are one space; a null turn comes first; turns of
one number are ordered by role, then by the md5 of the text; rows of a null
conversation id are one conversation; a role counts by its first character; repeated
rows are repeats; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepforge.storage import materialize

CHUNK_TURNS = 65_536
WHITE = " \t\n\x0b\f\r"
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
EDITS = "DIKR"

# The pattern: 0 nothing yet, 1 after s, 2 after u, 3 after a; it may end in 0 and 3.
_KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ADD = (2, 2, 3, 2)
_ADDED = ("user", "user", "assistant", "user")
_ORDERLY = {"su", "ua", "au"}
_END = (0, 6, 3, 0)
_MOST = (1 << 63) - 1


@functools.lru_cache(maxsize=1 << 16)
def _before(after: tuple[int, ...], initial: str, fault: int) -> tuple[int, tuple[int, ...], int]:
    """Costs of finishing before a turn from those behind it: their least, the rest above it, and the edits."""
    own = []
    for q in range(4):
        moves = [(4 + after[q], "D")]
        if fault not in (BLANK, DUPLICATE):
            more = 3 if fault == TRUNCATED else 0
            moves.append((3 + more + after[_ADD[q]], "R"))
            if (q, initial) in _KEEP:
                moves.append((more + after[_KEEP[q, initial]], "K"))
        own.append(min(moves))
    cost = [c for c, _ in own]
    for _ in range(3):
        cost = [min(cost[q], 3 + cost[_ADD[q]]) for q in range(4)]
    code = 0
    for q in range(4):
        best = min(e for c, e in (own[q], (3 + cost[_ADD[q]], "I")) if c == cost[q])
        code |= EDITS.index(best) << 2 * q
    least = min(cost)
    return least, tuple(c - least for c in cost), code


def _key(turns: DataFrame) -> DataFrame:
    """conv, turn, role, text, mark: the order inside a conversation is (turn, role, mark)."""
    return turns.select(
        F.col("conv_id").cast("string").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    ).withColumn("mark", F.md5("text"))


def _judged(keyed: DataFrame) -> DataFrame:
    """conv, turn, role, mark, again (rows like it before it), fault; without texts."""
    ends = F.substring(F.rtrim("text", F.lit(WHITE)), -1, 1)
    light = keyed.select("conv", "turn", "role", "mark", ends.alias("ends"))
    same = Window.partitionBy("conv", "role", "mark").orderBy(F.col("turn").asc_nulls_first())
    seen = light.withColumn("again", F.row_number().over(same) - 1)
    fault = F.when(F.col("ends") == "", BLANK).when(F.col("again") > 0, DUPLICATE).when(~F.col("ends").isin(*".!?"), TRUNCATED)
    return seen.select("conv", "turn", "role", "mark", "again", F.coalesce(fault, F.lit(OK)).alias("fault"))


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_CHUNK = (
    "conv string, turn long, known boolean, role string, mark string, number long, edits binary, last boolean, "
    + ", ".join(f"{c} long" for c in _COUNTS)
)


class _Backward:
    """A conversation read from its end."""

    def __init__(self, conv: str | None):
        self.conv = conv
        self.costs, self.total = _END, 0
        self.codes, self.number = bytearray(), 0
        self.counts = [0, 0, 0, 0]
        self.illegal, self.next = 0, ""
        self.high = self.low = None
        self.distinct = 0
        self.at: tuple = ()

    def add(self, turn: int, known: bool, role: str, mark: str, fault: int) -> None:
        initial = role[:1]
        least, self.costs, code = _before(self.costs, initial if initial in ("s", "u", "a") else "", fault)
        self.total += least
        self.codes.append(code)
        self.counts[fault] += 1
        if self.at and initial + self.next not in _ORDERLY:
            self.illegal += 1
        self.next = initial
        if known and turn != self.low:
            self.high = turn if self.high is None else self.high
            self.low = turn
            self.distinct += 1
        self.at = (turn, known, role, mark)

    def chunk(self, last: bool) -> tuple:
        """The edits held, in reading order, placed before their first turn."""
        gaps = 0 if self.high is None else min(self.high - self.low + 1 - self.distinct, _MOST)
        counts = (gaps, *self.counts[1:], self.illegal, self.total + self.costs[0])
        out = (self.conv, *self.at, self.number, bytes(self.codes[::-1]), last, *counts)
        self.codes, self.number = bytearray(), self.number + 1
        return out


def plan(turns: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """The edits of all conversations as chunks ``_CHUNK``; counts and cost are whole where ``last``."""
    columns = [c.split()[0] for c in _CHUNK.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: _Backward | None = None
        for batch in batches:
            out = []
            rows = zip(*(batch[c].tolist() for c in ("conv", "turn", "known", "role", "mark", "fault")))
            for conv, *row in rows:
                if held is None or conv != held.conv:
                    if held is not None:
                        out.append(held.chunk(True))
                    held = _Backward(conv)
                elif len(held.codes) >= chunk_turns:
                    out.append(held.chunk(False))
                held.add(*row)
            yield pd.DataFrame(out, columns=columns)
        if held is not None:
            yield pd.DataFrame([held.chunk(True)], columns=columns)

    backwards = [F.col("conv"), F.col("turn").desc_nulls_last(), *(F.col(c).desc() for c in ("role", "mark", "again"))]
    dealt = _judged(_key(turns)).repartition("conv").sortWithinPartitions(*backwards)
    light = dealt.select("conv", F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNotNull().alias("known"), "role", "mark", "fault")
    return light.mapInPandas(run, _CHUNK)


_EDITED = "conv string, place long, edit string, role string, text string"


class _Forward:
    """A conversation being edited."""

    def __init__(self, conv: str | None):
        self.conv, self.state, self.place = conv, 0, 0
        self.codes, self.used = b"", 0

    def _out(self, edit: str, role: str, text: str) -> tuple:
        self.place += 1
        return (self.conv, self.place - 1, edit, role, text)

    def _insert(self) -> tuple:
        role = _ADDED[self.state]
        self.state = _ADD[self.state]
        return self._out("I", role, "")

    def take(self, edits: bytes) -> None:
        self.codes, self.used = self.codes[self.used :] + edits, 0

    def turn(self, role: str, text: str) -> Iterator[tuple]:
        code = self.codes[self.used]
        self.used += 1
        while (edit := EDITS[code >> 2 * self.state & 3]) == "I":
            yield self._insert()
        if edit == "K":
            self.state = _KEEP[self.state, role[:1]]
        elif edit == "R":
            role, self.state = _ADDED[self.state], _ADD[self.state]
        yield self._out(edit, role, text)

    def end(self) -> Iterator[tuple]:
        while self.state in (1, 2):
            yield self._insert()


def repair(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """All edits in order, conversation by conversation: ``_EDITED``.

    Rows with ``edit`` D are the deleted turns; the others are the repaired conversation.
    """
    columns = [c.split()[0] for c in _EDITED.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: _Forward | None = None
        for batch in batches:
            out = []
            for conv, role, text, edits in zip(*(batch[c].tolist() for c in ("conv", "role", "text", "edits"))):
                if held is None or conv != held.conv:
                    if held is not None:
                        out.extend(held.end())
                    held = _Forward(conv)
                if edits is not None:
                    held.take(edits)
                else:
                    out.extend(held.turn(role, text))
            yield pd.DataFrame(out, columns=columns)
        if held is not None:
            yield pd.DataFrame(held.end(), columns=columns)

    none = F.lit(None)
    texts = _key(turns).select("conv", "turn", "role", "mark", F.lit(0).cast("long").alias("number"), "text", none.cast("binary").alias("edits"))
    chunks = planned.select(
        "conv", F.when(F.col("known"), F.col("turn")).alias("turn"), "role", "mark", "number", none.cast("string").alias("text"), "edits"
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("mark"), F.col("text").isNotNull(), F.col("number").desc()]
    dealt = texts.unionByName(chunks).repartition("conv").sortWithinPartitions(*order)
    return dealt.select("conv", "role", "text", "edits").mapInPandas(run, _EDITED)


def digests(edited: DataFrame) -> DataFrame:
    """Per conversation of ``repair``'s ordered rows: conv, audit, repaired_sha256."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["conv", "audit", "repaired_sha256"]
        conv, audit, text, first, started = None, [], hashlib.sha256(), True, False
        for batch in batches:
            out = []
            for key, edit, role, body in zip(*(batch[c].tolist() for c in ("conv", "edit", "role", "text"))):
                if started and key != conv:
                    out.append((conv, "".join(audit), text.hexdigest()))
                if not started or key != conv:
                    conv, audit, text, first, started = key, [], hashlib.sha256(), True, True
                audit.append(edit)
                if edit != "D":
                    text.update(f"{'' if first else chr(10)}{role}:{body}".encode())
                    first = False
            audit = ["".join(audit)]
            yield pd.DataFrame(out, columns=columns)
        if started:
            yield pd.DataFrame([(conv, "".join(audit), text.hexdigest())], columns=columns)

    return edited.mapInPandas(run, "conv string, audit string, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """The turns with planted faults, by the crc32 of ``conv_id:turn`` modulo 20."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    kind = F.col("kind")
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("kind"))
    return rows.where("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def report(turns: DataFrame, conversations: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """Per id of ``conversations`` (conv_id): the counts, cost, audit and digest of the repair of ``turns``."""
    planned = materialize(plan(turns, chunk_turns), "edits")
    counts = planned.where("last").select(F.col("conv").alias("c1"), *_COUNTS)
    read = digests(repair(turns, planned)).withColumnRenamed("conv", "c2")
    own = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn("c0", F.col("conv_id").cast("string"))
    found = own.join(counts, F.col("c0").eqNullSafe(F.col("c1")), "left").join(read, F.col("c0").eqNullSafe(F.col("c2")), "left")
    return found.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).alias(c) for c in _COUNTS),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _sql_edit(cost: str, edit: str, line: str, rest: str) -> str:
    """A state (cost, edits, chr(1), lines) with one more edit in front."""
    at = f"instr({rest}, chr(1))"
    return (
        f"lpad((left({rest}, 9)::INT + {cost})::VARCHAR, 9, '0') || '{edit}' || substr({rest}, 10, {at} - 10) || chr(1) || {line} || substr({rest}, {at} + 1)"
    )


def sql() -> str:
    """The report of the damaged table in SQL; states are compared as strings, cost first."""
    add = lambda q, rest: _sql_edit("3", "I", f"chr(10) || '{_ADDED[q]}:'", rest)

    def row(q: int) -> str:
        more = "CASE WHEN fault = 3 THEN 3 ELSE 0 END"
        kept = " ".join(
            f"WHEN initial = '{c}' THEN {_sql_edit(more, 'K', 'line', f's{to}')}" for (at, c), to in _KEEP.items() if at == q
        )
        rerole = _sql_edit(f"(3 + {more})", "R", f"chr(10) || '{_ADDED[q]}:' || text", f"s{_ADD[q]}")
        return (
            f"least({_sql_edit('4', 'D', chr(39) * 2, f's{q}')}, CASE WHEN fault NOT IN (1, 2) THEN {rerole} ELSE 'x' END,"
            f" CASE WHEN fault NOT IN (1, 2) THEN CASE {kept} ELSE 'x' END ELSE 'x' END)"
        )

    crc_step = "(CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(name, (i // 8 + 1)::INT, 1))) ELSE c END)"
    crc = f"xor(list_reduce(range(8 * len(name)), lambda c, i: xor({crc_step} >> 1, 3988292384 * ({crc_step} & 1)), 4294967295::BIGINT), 4294967295)"
    closing = f"""SELECT conv, i, least(b0, {add(0, 't2')}) AS s0, least(b1, {add(1, 't2')}) AS s1, t2 AS s2, least(b3, {add(3, 'b2')}) AS s3
  FROM (SELECT *, least(b2, {add(2, 'b3')}) AS t2 FROM"""
    return f"""
WITH RECURSIVE named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
kinds AS (SELECT *, {crc} % 20 AS kind FROM named),
hurt AS (SELECT coalesce(conv_id::VARCHAR, '') AS conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM kinds WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
  left(role, 1) AS initial, chr(10) || role || ':' || text AS line FROM hurt),
judged AS MATERIALIZED (SELECT *, lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS pair,
  CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1 WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 2
  WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 3 ELSE 0 END AS fault FROM placed),
counts AS (SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
  count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv),
walk AS (
  {closing} (SELECT conv, n + 1 AS i, '000000000' || chr(1) AS b0, '900000000' || chr(1) AS b1, '900000000' || chr(1) AS b2,
    '000000000' || chr(1) AS b3 FROM counts))
  UNION ALL
  {closing} (SELECT w.conv, r.i, {row(0)} AS b0, {row(1)} AS b1, {row(2)} AS b2, {row(3)} AS b3
    FROM walk w JOIN judged r ON r.conv = w.conv AND r.i = w.i - 1))),
best AS (SELECT conv, left(s0, 9)::BIGINT AS cost, substr(s0, 10, instr(s0, chr(1)) - 10) AS audit,
  sha256(substr(s0, instr(s0, chr(1)) + 2)) AS repaired_sha256 FROM walk WHERE i = 1)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, '') AS conv FROM conversations) LEFT JOIN counts USING (conv) LEFT JOIN best USING (conv)"""
