"""Personal data in texts: validated findings with their places, flags and reversible masks.

A pattern only proposes.  Card numbers (13 to 19 digits in one group, 4-4-4-4 or 4-6-5,
groups parted by a space or a dash) must start with 2 to 6 and have the Luhn check digit,
account numbers (IBAN, compact or in groups of four) the remainder 1 modulo 97, network
addresses four parts up to 255; mail addresses, telephone numbers and secrets are taken
as they match.  Patterns have no look-around, so any regular-expression engine reads
them alike.  A null text holds nothing.

``flags`` needs no places and is linear in the text.  Places are counted in characters
of a line (no pattern goes over a line's end), so ``findings`` works on lines.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge.functions import text as T

# ---- fixed values ----
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(^|[^0-9])(\+[0-9]{1,3}[ .-]?)?(\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}($|[^0-9])"
SECRET = r"(?i)(password|passwd|api[_-]?key|secret[_-]?key)[\"']? ?[:=] ?[^ \n]{4,}"
DIGITS = r"[0-9]([ -]?[0-9]){12,}"
DOTTED = r"[0-9]+(\.[0-9]+){3,}"
ACCOUNT = r"[A-Z]{2}[0-9]{2}([A-Z0-9]{11,30}|( [A-Z0-9]{4}){2,7}( [A-Z0-9]{1,3})?)"
_FOUND = "array<struct<kind:string,start:int,value:string>>"


def luhn(digits: Column) -> Column:
    """The last digit is the Luhn check digit."""
    def weighed(i):
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).try_cast("int")
        return F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    places = F.transform(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), weighed)
    return F.aggregate(places, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """The first four characters moved to the end and letters read as 10 to 35, the number is 1 modulo 97."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))
    codes = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(turned), F.lit(1))), lambda i: F.ascii(F.substr(turned, i, F.lit(1)))
    )
    step = lambda a, c: F.when(c < 65, a * 10 + c - 48).otherwise(a * 100 + c - 55) % 97
    return F.aggregate(codes, F.lit(0), step) == 1


def _cards(run: Column) -> Column:
    """(start, value) of the card numbers in a run of digit groups."""
    groups = F.split(run, "[ -]")

    def of_size(n, fits):
        def at(_, i):
            part = F.slice(groups, i + 1, n)
            start = F.length(F.array_join(F.slice(groups, F.lit(1), i), "-")) + F.when(i > 0, 1).otherwise(0)
            size = F.length(F.array_join(part, "-"))
            return F.struct(start.alias("start"), F.substr(run, start + 1, size).alias("value"), part.alias("part"))

        taken = F.filter(F.transform(groups, at), lambda x: (F.size(x["part"]) == n) & fits(x["part"]))
        digits = lambda x: F.array_join(x["part"], "")
        good = F.filter(taken, lambda x: digits(x).rlike("^[2-6]") & luhn(digits(x)))
        return F.transform(good, lambda x: F.struct(x["start"].alias("start"), x["value"].alias("value")))

    sized = lambda *n: lambda p: F.transform(p, F.length) == F.array(*map(F.lit, n))
    return F.concat(of_size(1, lambda p: F.length(p[0]).between(13, 19)), of_size(4, sized(4, 4, 4, 4)), of_size(3, sized(4, 6, 5)))


def _accounts(run: Column) -> Column:
    """(start, value) of the account number; the last group of a grouped one may be a word after it."""
    shorter = F.regexp_replace(run, " [A-Z0-9]{1,4}$", "")
    options = F.array_distinct(F.array(run, shorter))
    plain = lambda x: F.regexp_replace(x, " ", "")
    good = F.filter(options, lambda x: F.length(plain(x)).between(15, 34) & mod97(plain(x)))
    return F.transform(F.slice(good, 1, 1), lambda x: F.struct(F.lit(0).alias("start"), x.alias("value")))


def _address(run: Column) -> Column:
    parts = F.split(run, r"\.")
    good = (F.size(parts) == 4) & F.forall(parts, lambda p: (F.length(p) <= 3) & (p.try_cast("int") <= 255))
    return F.filter(F.array(_whole(run)), lambda _: good)


def _whole(run: Column) -> Column:
    return F.struct(F.lit(0).alias("start"), run.alias("value"))


_RULES = {
    "email": (EMAIL, lambda run: F.array(_whole(run))),
    "phone": (PHONE, lambda run: F.array(F.struct(
        F.when(run.rlike("^[0-9+(]"), 0).otherwise(1).alias("start"), F.regexp_replace(run, "^[^0-9+(]|[^0-9]$", "").alias("value")))),
    "card": (DIGITS, _cards),
    "account": (ACCOUNT, _accounts),
    "address": (DOTTED, _address),
    "secret": (SECRET, lambda run: F.array(_whole(run))),
}


def _has_email(text: Column) -> Column:
    """One character before and two letters at the end decide as well as all of them; a scan need not go back over words."""
    return F.contains(text, F.lit("@")) & F.regexp_like(text, F.lit(r"[A-Za-z0-9._%+-]@[A-Za-z0-9.-]+\.[A-Za-z]{2}"))


def _has_phone(text: Column) -> Column:
    """The whole pattern can begin at nearly every character; it is only tried where its last digits are."""
    return F.regexp_like(text, F.lit(r"[0-9]{3}[ .-][0-9]{4}")) & F.regexp_like(text, F.lit(PHONE))


def _has_secret(text: Column) -> Column:
    """The whole pattern is only tried on texts with a part of its words."""
    given = F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))
    named = T.once(F.lower(text), lambda x: F.contains(x, F.lit("passw")) | F.contains(x, F.lit("key")))
    return given & named & F.regexp_like(text, F.lit(SECRET))


_AS_THEY_MATCH = {"email": _has_email, "phone": _has_phone, "secret": _has_secret}


def flags(text: Column) -> dict[str, Column]:
    """One test per kind, ``has_<kind>``."""
    out = {}
    for kind, (pattern, within) in _RULES.items():
        if kind in _AS_THEY_MATCH:
            found = _AS_THEY_MATCH[kind](text)
        else:
            found = F.exists(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda run: F.size(within(run)) > 0)
        out[f"has_{kind}"] = F.coalesce(found, F.lit(False))
    return out


# a part of every telephone, card, account number and address
NUMBERS = r"[0-9]{3}[ .-][0-9]{4}|[0-9](?:[ -]?[0-9]){12}|[0-9]\.[0-9]+\.[0-9]+\.[0-9]|[A-Z]{2}[0-9]{2}"
_OF_NUMBERS = ("has_phone", "has_card", "has_account", "has_address")


def none_found(*texts: Column) -> Column:
    """No text holds personal data.  The texts are put together once for all tests; those of numbers share a first test."""

    def found(text: Column) -> Column:
        tests = flags(text)
        numbers = reduce(or_, [tests.pop(name) for name in _OF_NUMBERS])
        return reduce(or_, tests.values()) | (F.regexp_like(text, F.lit(NUMBERS)) & numbers)

    return T.once(F.concat_ws("\n", *texts), lambda text: ~found(text))


def found_in(line: Column) -> Column:
    """Findings (kind, start, value) of a line by place; of two that overlap the earlier, then longer one."""
    everything = []
    for kind, (pattern, within) in _RULES.items():
        runs = F.regexp_extract_all(line, F.lit(pattern), F.lit(0))
        pairs = F.arrays_zip(F.slice(F.split(line, pattern, -1), F.lit(1), F.size(runs)).alias("before"), runs.alias("run"))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("out"))

        def step(a, x):
            at = a["at"] + F.length(x["before"])
            new = F.transform(within(x["run"]), lambda f: F.struct(
                F.lit(kind).alias("kind"), (at + f["start"]).cast("int").alias("start"), f["value"].alias("value")))
            return F.struct((at + F.length(x["run"])).alias("at"), F.concat(a["out"], new.cast(_FOUND)).alias("out"))

        everything.append(F.aggregate(pairs, start, step, lambda a: a["out"]))
    by_place = F.array_sort(F.transform(F.concat(*everything), lambda f: F.struct(
        f["start"].alias("start"), (-F.length(f["value"])).alias("size"), f["kind"].alias("kind"), f["value"].alias("value"))))
    first = F.struct(F.lit(0).alias("end"), F.array().cast(_FOUND).alias("out"))
    return F.aggregate(by_place, first, lambda a, f: F.when(f["start"] < a["end"], a).otherwise(F.struct(
        (f["start"] - f["size"]).alias("end"), F.concat(a["out"], F.array(F.struct(f["kind"], f["start"], f["value"])).cast(_FOUND)).alias("out"))),
        lambda a: a["out"])


def findings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line, kind, start, value) of every finding; line and start count from 0."""
    lines = docs.select(key, F.posexplode(F.split(text, "\n", -1)).alias("line", "_text"))
    return lines.where(~none_found(F.col("_text"))).select(key, "line", F.inline(found_in(F.col("_text"))))


def masked(line: Column, found: Column) -> Column:
    """The line with a label for each finding."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda a, f: F.struct(
        (f["start"] + F.length(f["value"])).alias("at"),
        F.concat(a["out"], F.substr(line, a["at"] + 1, f["start"] - a["at"]), F.lit("["), f["kind"], F.lit("]")).alias("out"))
    return F.aggregate(found, start, step, lambda a: F.concat(a["out"], F.substr(line, a["at"] + 1)))


def masked_text(text: Column) -> Column:
    """A text of any number of lines with a label for each finding; null stays null."""
    lines = F.transform(
        F.split(text, "\n", -1), lambda line: F.when(none_found(line), line).otherwise(masked(line, found_in(line)))
    )
    return F.array_join(lines, "\n")


def restored(line: Column, found: Column) -> Column:
    """The inverse of ``masked``; labels are found by place, so a text may hold such labels of its own."""
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("own"), F.lit("").alias("out"))
    step = lambda a, f: F.struct(
        (a["at"] + f["start"] - a["own"] + F.length(f["kind"]) + 2).alias("at"),
        (f["start"] + F.length(f["value"])).alias("own"),
        F.concat(a["out"], F.substr(line, a["at"] + 1, f["start"] - a["own"]), f["value"]).alias("out"))
    return F.aggregate(found, start, step, lambda a: F.concat(a["out"], F.substr(line, a["at"] + 1)))
