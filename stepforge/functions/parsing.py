"""Parsing of model and annotator output held in a string column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.functions import regions as R
from stepforge.functions import text as T


def _get(variant: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(variant, path, kind)


def kind_of(variant: Column) -> Column:
    """Upper-case kind of a VARIANT: OBJECT, ARRAY, STRING, VOID, ... (NULL if absent)."""
    return F.regexp_extract(F.schema_of_variant(variant), r"^([A-Z]+)", 1)


def action_block(output: Column) -> Column:
    """Content of the first <action> block, NULL when there is none."""
    return F.when(
        output.rlike(r"(?s)<action>.*?</action>"),
        T.strip(F.regexp_extract(output, r"(?s)<action>(.*?)</action>", 1)),
    )


def think_block(output: Column) -> Column:
    return T.strip(F.regexp_extract(output, r"(?s)<think>(.*?)</think>", 1))


def parse_action(output: Column) -> Column:
    """``STRUCT<error, action>`` for one model output; error NULL means parsed."""
    block = action_block(output)
    data = F.try_parse_json(block)
    kind = kind_of(data)
    action_type = _get(data, "$.type", "string")
    coords = _get(data, "$.coordinates", "variant")
    has_coords = coords.isNotNull() & (kind_of(coords) != "VOID")
    pair = _get(data, "$.coordinates", "array<double>")
    x, y = F.get(pair, 0), F.get(pair, 1)
    confidence = F.coalesce(_get(data, "$.confidence", "double"), F.lit(1.0))
    error = (
        F.when(block.isNull(), "no_action_block")
        .when(data.isNull(), "invalid_json")
        .when((kind != "OBJECT") | ~F.coalesce(action_type.isin(D.ACTION_TYPES), F.lit(False)), "unknown_type")
        .when(has_coords & ((F.coalesce(F.size(pair), F.lit(-1)) != 2) | x.isNull() | y.isNull()), "bad_coordinates")
        .when(has_coords & ~R.in_unit_range(x, y), "out_of_range")
        .when(~confidence.between(0.0, 1.0), "bad_field")
    )
    action = F.struct(
        action_type.alias("type"),
        F.when(has_coords, pair).alias("coordinates"),
        _get(data, "$.text", "string").alias("text"),
        _get(data, "$.key", "string").alias("key"),
        _get(data, "$.direction", "string").alias("direction"),
        F.coalesce(_get(data, "$.amount", "int"), F.lit(0)).alias("amount"),
        F.coalesce(_get(data, "$.duration_ms", "int"), F.lit(0)).alias("duration_ms"),
        F.coalesce(_get(data, "$.description", "string"), F.lit("")).alias("description"),
        confidence.alias("confidence"),
    )
    return F.struct(error.alias("error"), F.when(error.isNull(), action).alias("action"))


def _annotation(data: Column, min_chars: int) -> Column:
    """reasoning / intent / verified of a JSON object, NULL when too short."""
    own = T.strip_long(F.coalesce(_get(data, "$.reasoning", "string"), F.lit("")))
    intent = T.strip(F.coalesce(_get(data, "$.intent", "string"), F.lit("")))
    verified = F.coalesce(_get(data, "$.verified", "boolean"), F.lit(False))
    given = lambda reasoning: F.when(
        F.length(reasoning) >= min_chars,
        F.struct(reasoning.alias("reasoning"), intent.alias("intent"), verified.alias("verified")),
    )
    return F.when(kind_of(data) == "OBJECT", T.once(own, given))


def _parsed_annotation(text: Column, min_chars: int) -> Column:
    """Only an object can be an annotation; other texts are not parsed."""
    data = lambda text: F.when(F.startswith(text, F.lit("{")), F.try_parse_json(text))
    return T.once(T.once(text, data), lambda data: _annotation(data, min_chars))


def unfence(response: Column) -> Column:
    """The response without markdown code fences; most have none and are not searched.

    One pattern takes opening and closing fences, and no new fence can form where one was.
    """
    bare = F.regexp_replace(response, r"```(?:json)?\s*", "")
    return T.strip_long(F.when(F.contains(response, F.lit("```")), bare).otherwise(response))


def parse_response(response: Column, min_chars: int = D.MIN_REASONING_CHARS) -> Column:
    """``STRUCT<reasoning, intent, verified>`` or NULL, by three strategies, each parsed once.

    1. the unfenced text is a JSON object; 2. the first flat ``{...}`` block is;
    3. a reasoning string can be cut out of broken JSON (intent stays '').
    """
    whole = _parsed_annotation(unfence(response), min_chars)
    flat = _parsed_annotation(F.regexp_extract(response, r"(?s)(\{[^{}]*\})", 1), min_chars)
    # possessive quantifiers: the alternatives are disjoint, so nothing is lost and
    # long texts cannot overflow the regex engine's stack
    raw = F.regexp_extract(
        response, r'(?s)"reasoning"\s*:\s*"((?:[^"\\]++|\\.)*+)"', 1
    )
    unescaped = lambda raw: F.coalesce(
        F.try_variant_get(
            F.try_parse_json(F.concat(F.lit('"'), raw, F.lit('"'))), "$", "string"
        ),
        raw,
    )
    long_enough = lambda text: F.when(
        F.length(text) >= min_chars,
        F.struct(text.alias("reasoning"), F.lit("").alias("intent"), F.lit(False).alias("verified")),
    )
    cut = T.once(T.once(raw, unescaped), long_enough)
    return F.coalesce(whole, flat, cut)


def parse_response_plain(response: Column, min_chars: int = 1) -> Column:
    """Older variants: only the whole unfenced JSON object is accepted.

    ``min_chars=1`` takes any reasoning, ``min_chars=21`` only more than 20 characters.
    """
    return _parsed_annotation(unfence(response), min_chars)


def verify_reasoning(reasoning: Column, regions: Column) -> Column:
    """At least half of the quoted phrases (2-40 chars) occur on the screen."""
    texts = F.transform(regions, lambda r: F.lower(F.coalesce(r["text"], F.lit(""))))
    phrases = F.regexp_extract_all(reasoning, F.lit(r'"([^"]{2,40})"'), F.lit(1))
    blank = ~F.exists(regions, lambda r: ~T.is_blank(r["text"]))

    def enough(quoted: Column) -> Column:
        shown = lambda screen: F.size(F.filter(quoted, lambda p: F.contains(screen, F.lower(p))))
        found = T.once(F.array_join(texts, " "), shown)
        return F.when(F.size(quoted) == 0, True).otherwise(found / F.size(quoted) >= 0.5)

    return (
        F.when(F.coalesce(reasoning, F.lit("")) == "", False)
        .when(F.coalesce(F.size(regions), F.lit(0)) <= 0, False)
        .when(blank, False)
        .otherwise(T.once(phrases, enough))
    )


def verify_reasoning_strict(reasoning: Column, screen_text: Column) -> Column:
    """Every quoted phrase longer than two characters occurs on the screen."""
    screen = F.lower(screen_text)
    quoted = F.regexp_extract_all(F.lower(reasoning), F.lit(r'"([^"]+)"'), F.lit(1))
    return F.when(
        (F.coalesce(reasoning, F.lit("")) == "") | (F.coalesce(screen_text, F.lit("")) == ""),
        False,
    ).otherwise(F.forall(quoted, lambda p: (F.length(p) <= 2) | F.contains(screen, p)))
