"""String and language column functions.  All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stepforge import domains as D

WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85   　"


def strip(c: Column) -> Column:
    """Trim any whitespace, not only blanks."""
    return F.btrim(c, F.lit(WHITESPACE))


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once a row, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def strip_long(c: Column) -> Column:
    """As ``strip``, for long texts: the costly trim only runs where an end has whitespace."""
    at_end = lambda x: reduce(
        lambda a, b: a | b, [f(x, F.lit(w)) for w in WHITESPACE for f in (F.startswith, F.endswith)]
    )
    return once(c, lambda x: F.when(at_end(x), strip(x)).otherwise(x))


def is_blank(c: Column) -> Column:
    """Null or nothing but whitespace; stops at the first other character."""
    return F.coalesce(~F.regexp_like(c, F.lit(f"[^{WHITESPACE}]")), F.lit(True))


def words(c: Column) -> Column:
    """Whitespace-separated tokens; an empty array for blank text."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def contains_any(c: Column, keywords: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(k)) for k in keywords])


def count_contained(c: Column, keywords: list[str]) -> Column:
    """How many of the keywords occur in the text as substrings."""
    return reduce(
        lambda a, b: a + b, [F.contains(c, F.lit(k)).cast("int") for k in keywords]
    )


def json_string(c: Column) -> Column:
    """The text as a JSON string literal, non-ASCII characters kept."""
    document = F.to_json(F.struct(c.alias("v")))
    return F.substr(document, F.lit(6), F.length(document) - 6)


def json_string_ascii(c: Column) -> Column:
    """As ``json_string`` with every non-ASCII character as a \\u escape."""

    def unit(code: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(code), 4, "0")))

    def escape(ch: Column) -> Column:
        code = F.ascii(ch).cast("long")
        beyond = code - 0x10000
        pair = F.concat(
            unit(F.lit(0xD800) + F.shiftright(beyond, 10)),
            unit(F.lit(0xDC00) + beyond.bitwiseAND(F.lit(0x3FF))),
        )
        return F.when(code > 0xFFFF, pair).when(code > 127, unit(code)).otherwise(ch)

    literal = json_string(c)
    plain = literal.rlike(r"^[\x00-\x7f]*$")
    return F.when(plain, literal).otherwise(
        F.array_join(F.transform(F.split(literal, ""), escape), "")
    )


def nearest(c: Column, places: int) -> Column:
    """The double rounded as its exact binary value demands, ties to even.

    The built-in rounding works on the printed decimal, which turns 1.0125 (stored
    slightly below) into 1.013.  Here the scaled value carries its exact rounding
    error (Dekker's product), which decides the seeming ties.
    """
    scale = float(10**places)
    scaled = c * scale
    high = c * 134217729.0 - (c * 134217729.0 - c)
    error = (high * scale - scaled) + (c - high) * scale
    whole = F.floor(scaled).cast("double")
    part = scaled - whole
    up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (F.pmod(whole, F.lit(2.0)) == 1.0))))
    return (whole + F.when(up, 1.0).otherwise(0.0)) / scale


def fixed(c: Column, places: int) -> Column:
    """A double with a fixed number of decimals."""
    return F.format_string(f"%.{places}f", nearest(c, places))


def decimal_text(c: Column, places: int = 4) -> Column:
    """A double rounded to ``places``, printed without trailing zeros (1.0, 0.25)."""
    digits = F.rtrim(fixed(c, places), F.lit("0"))
    return F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)


def share_of_chars(c: Column, char_class: str) -> Column:
    """Part of all characters (blanks included) that belong to a regex class.

    Runs are cut out whole: far fewer matches than one for each character.
    """
    return (F.length(c) - F.length(F.regexp_replace(c, f"{char_class}+", ""))) / F.greatest(F.length(c), F.lit(1))


def detect_language(text: Column) -> Column:
    """en / ur / ps / ar / hi / unknown by script share, then marker words."""
    tokens = F.array_distinct(words(text))
    wide = F.octet_length(text) > F.length(text)  # other texts are ASCII only
    many = lambda char_class, share: (
        wide & F.regexp_like(text, F.lit(char_class)) & (share_of_chars(text, char_class) > share)
    )

    def score(markers: list[str]) -> Column:
        return F.size(F.array_intersect(tokens, F.array(*[F.lit(m) for m in markers])))

    urdu, pashto, arabic = score(D.URDU_WORDS), score(D.PASHTO_WORDS), score(D.ARABIC_WORDS)
    arabic_script = (
        F.when((urdu >= pashto) & (urdu >= arabic), "ur")
        .when(pashto > urdu, "ps")
        .otherwise("ar")
    )
    return (
        F.when(is_blank(text), "unknown")
        .when(many(r"[\x{0600}-\x{06FF}\x{0750}-\x{077F}]", 0.2), arabic_script)
        .when(many(r"[\x{0900}-\x{097F}]", 0.2), "hi")
        .when(share_of_chars(text, r"[A-Za-z\x{212A}]") > 0.3, "en")
        .otherwise("unknown")
    )


def language_tags(tags: Column, text: Column, language: Column) -> Column:
    """Tags after language detection: anything but English on non-blank text."""
    with_multi = F.when(
        F.array_contains(tags, "multilingual"), tags
    ).otherwise(F.array_append(tags, F.lit("multilingual")))
    tagged = F.when(F.array_contains(tags, language), with_multi).otherwise(
        F.array_append(with_multi, F.concat(F.lit("lang:"), language))
    )
    return F.when(is_blank(text) | (language == "en"), tags).otherwise(tagged)


def is_multilingual(language: Column) -> Column:
    return ~language.isin("en", "unknown")


def detect_script(text: Column) -> Column:
    arabic = r"[\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}]"
    return (
        F.when((F.octet_length(text) > F.length(text)) & (share_of_chars(text, arabic) > 0.3), "arabic")
        .when(share_of_chars(text, r"[A-Za-z\x{212A}0-9]") > 0.3, "latin")
        .otherwise("unknown")
    )


def infer_tags(task: Column, action_type: Column) -> Column:
    """Keyword categories in fixed order, then the action tag."""

    def tagged(lowered: Column) -> Column:
        categories = [
            F.when(contains_any(lowered, keys), F.lit(tag)) for tag, keys in D.TAG_KEYWORDS.items()
        ]
        return F.array_compact(F.array(*categories, F.concat(F.lit("action:"), action_type)))

    return once(F.lower(task), tagged)


def is_clean_token(text: Column) -> Column:
    """True when recognised text is likely readable and not a glyph artefact."""

    def tested(token: Column) -> Column:
        n = F.length(token)
        no_vowel = ~F.lower(token).rlike(f"[{D.SHORT_TOKEN_VOWELS}]")
        shouting = F.regexp_count(token, F.lit(r"[\p{Lu}]")) / n >= 0.5
        return (
            F.when(token.isNull() | (n <= 1), False)
            .when(n == 2, F.lower(token).isin(D.SHORT_TOKENS))
            .when(~token.rlike(r"[\p{L}\p{Nd}]"), False)
            .when(token.rlike(r"[\p{Cc}\p{Co}\p{Cn}]"), False)
            .when(n.between(3, 6) & shouting & no_vowel, False)
            .otherwise(True)
        )

    return once(strip(text), tested)


def task_plan(task: Column) -> Column:
    """Steps of the first plan whose keyword the task contains."""
    lowered = F.lower(task)
    plans = [
        F.when(F.contains(lowered, F.lit(k)), F.array(*[F.lit(s) for s in steps]))
        for k, steps in D.PLAN_STEPS.items()
    ]
    return F.coalesce(*plans, F.array(*[F.lit(s) for s in D.GENERIC_PLAN]))


def risk_level(action_type: Column, description: Column, context: Column) -> Column:
    """0 safe .. 3 high; only click and type can be promoted to high."""
    text = F.lower(F.concat(F.coalesce(description, F.lit("")), F.lit(" "), F.coalesce(context, F.lit(""))))
    base = F.coalesce(
        *[F.when(action_type == a, F.lit(level)) for a, level in D.RISK_BASE.items()],
        F.lit(2),
    )
    return (
        F.when((action_type == "click") & contains_any(text, D.RISKY_CLICK_WORDS), 3)
        .when((action_type == "type") & contains_any(text, D.RISKY_TYPE_WORDS), 3)
        .otherwise(base)
    )


def risk_name(level: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in D.RISK_NAMES]), level + 1)


def history_entry(step_index: Column, action_type: Column, success: Column) -> Column:
    done = F.when(success, "True").otherwise("False")
    action = F.when(
        action_type.isNotNull(), F.concat(action_type, F.lit(" | success="), done)
    ).otherwise("")
    return F.concat(F.lit("Step "), step_index.cast("string"), F.lit(": "), action)


def parse_version(text: Column) -> Column:
    """MAJOR.MINOR.PATCH as a struct whose ordering is version ordering; else NULL."""
    clean = strip(text)
    part = lambda i: F.regexp_extract(clean, r"^(\d+)\.(\d+)\.(\d+)$", i).cast("int")
    return F.when(
        clean.rlike(r"^\d+\.\d+\.\d+$"),
        F.struct(part(1).alias("major"), part(2).alias("minor"), part(3).alias("patch")),
    )


def version_text(version: Column) -> Column:
    return F.concat_ws(".", version["major"], version["minor"], version["patch"])


def bump_version(version: Column, part: str) -> Column:
    zero, one = F.lit(0), F.lit(1)
    major, minor, patch = version["major"], version["minor"], version["patch"]
    parts = {
        "patch": (major, minor, patch + one),
        "minor": (major, minor + one, zero),
        "major": (major + one, zero, zero),
    }[part]
    return F.struct(*[p.alias(n) for p, n in zip(parts, ("major", "minor", "patch"))])


def canonical_version(text: str) -> str:
    """Driver-side form of the same rule for option values."""
    parts = text.strip().split(".")
    if len(parts) != 3 or not all(p.isdigit() for p in parts):
        raise ValueError(f"not a MAJOR.MINOR.PATCH version: {text!r}")
    return ".".join(str(int(p)) for p in parts)
