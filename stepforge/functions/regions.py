"""Column functions over recognised text regions.

A region is ``STRUCT<text, bbox ARRAY<DOUBLE>, confidence, script>``; a screen
holds an array of them, so every function works inside one row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.functions import text as T

REGION_TYPE = "struct<text:string,bbox:array<double>,confidence:double,script:string>"


def joined_text(regions: Column, raw_text: Column) -> Column:
    """All region texts with blanks between, else the recorded text, else ''."""
    return F.when(
        F.size(regions) > 0, F.array_join(F.transform(regions, lambda r: r["text"]), " ")
    ).otherwise(F.coalesce(raw_text, F.lit("")))


def request_text(regions: Column, raw_text: Column) -> Column:
    """Text shown to an annotator: the first 30 regions with bars between."""
    first = F.transform(F.slice(regions, 1, 30), lambda r: r["text"])
    return F.when(F.size(regions) > 0, F.array_join(first, " | ")).otherwise(
        F.coalesce(raw_text, F.lit(""))
    )


def mean_confidence(regions: Column) -> Column:
    """Arithmetic mean over the regions; NULL without regions."""
    total = F.aggregate(
        regions, F.lit(0.0), lambda acc, r: acc + F.coalesce(r["confidence"], F.lit(0.0))
    )
    return F.when(F.size(regions) > 0, total / F.size(regions))


def keep_region(text: Column, confidence: Column, min_confidence: float = D.OCR_MIN_CONFIDENCE,
                min_length: int = D.OCR_MIN_LENGTH, noise_rules: bool = True) -> Column:
    """Engine-side filter; the noise rules belong to one of the two engines."""

    def kept(clean: Column) -> Column:
        keep = (confidence >= min_confidence) & (clean != "") & (F.length(clean) >= min_length)
        if noise_rules:
            keep = (
                keep
                & ~F.contains(clean, F.lit("{"))
                & ~F.contains(clean, F.lit("$"))
                & ~clean.rlike(r"^\p{N}+$")
                & clean.rlike(r"(?s)\p{L}.*\p{L}")  # two letters
            )
        return F.coalesce(keep, F.lit(False))

    return T.once(T.strip(text), kept)


def clean_regions(regions: Column, min_confidence: float = D.OCR_MIN_CONFIDENCE,
                  min_length: int = D.OCR_MIN_LENGTH, max_regions: int = D.OCR_MAX_REGIONS,
                  noise_rules: bool = True) -> Column:
    """Engine filter, region limit, token cleanliness, script tag - in that order."""
    trimmed = F.transform(
        regions,
        lambda r: F.struct(
            T.strip(r["text"]).alias("text"), r["bbox"].alias("bbox"),
            r["confidence"].alias("confidence"),
        ),
    )
    kept = F.filter(
        trimmed,
        lambda r: keep_region(r["text"], r["confidence"], min_confidence, min_length, noise_rules),
    )
    readable = F.filter(F.slice(kept, 1, max_regions), lambda r: T.is_clean_token(r["text"]))
    return F.transform(
        readable,
        lambda r: F.struct(
            r["text"].alias("text"), r["bbox"].alias("bbox"),
            T.nearest(r["confidence"], 4).alias("confidence"),
            T.detect_script(r["text"]).alias("script"),
        ),
    )


def pixel_box(left: Column, top: Column, width: Column, height: Column,
              screen_w: Column, screen_h: Column) -> Column:
    """Pixel box (left, top, width, height) as normalised [x1, y1, x2, y2]."""
    return F.array(left / screen_w, top / screen_h, (left + width) / screen_w,
                   (top + height) / screen_h)


def quad_box(points: Column, screen_w: Column, screen_h: Column) -> Column:
    """Four corner points as the normalised enclosing box."""
    xs = F.transform(points, lambda p: p[0])
    ys = F.transform(points, lambda p: p[1])
    return F.array(F.array_min(xs) / screen_w, F.array_min(ys) / screen_h,
                   F.array_max(xs) / screen_w, F.array_max(ys) / screen_h)


def box_center(box: Column) -> Column:
    return F.array((box[0] + box[2]) / 2, (box[1] + box[3]) / 2)


def normalize_point(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.array(T.nearest(x / w, 4), T.nearest(y / h, 4))


def denormalize_point(nx: Column, ny: Column, w: Column, h: Column) -> Column:
    return F.array(F.bround(nx * w, 0).cast("int"), F.bround(ny * h, 0).cast("int"))


def in_unit_range(x: Column, y: Column) -> Column:
    """Both in [0, 1]; NULL and NaN are outside."""
    inside = x.between(0.0, 1.0) & y.between(0.0, 1.0)
    return F.coalesce(inside & ~F.isnan(x) & ~F.isnan(y), F.lit(False))


def prompt_regions(regions: Column, action_type: Column, coordinates: Column) -> Column:
    """The 20 regions for a prompt: nearest to the click first, otherwise in order.

    Blank or box-less regions are dropped after the cut, not before it.
    """
    indexed = F.transform(
        regions,
        lambda r, i: F.struct(
            F.sqrt(
                F.pow((F.coalesce(r["bbox"][0], F.lit(0.5)) + F.coalesce(r["bbox"][2], F.lit(0.5))) / 2.0 - coordinates[0], 2.0)
                + F.pow((F.coalesce(r["bbox"][1], F.lit(0.5)) + F.coalesce(r["bbox"][3], F.lit(0.5))) / 2.0 - coordinates[1], 2.0)
            ).alias("distance"),
            i.alias("position"),
            r.alias("region"),
        ),
    )
    near_first = F.transform(F.array_sort(indexed), lambda s: s["region"])
    grounded = action_type.isin(D.CLICK_FAMILY) & (F.size(coordinates) >= 2)
    ordered = F.when(F.coalesce(grounded, F.lit(False)), near_first).otherwise(regions)
    return F.filter(
        F.slice(ordered, 1, D.NEAREST_REGIONS),
        lambda r: (F.size(r["bbox"]) == 4) & (T.strip(r["text"]) != ""),
    )


def region_line(region: Column) -> Column:
    return F.concat(
        F.lit("  - '"), region["text"], F.lit("' at ["),
        F.array_join(F.transform(F.slice(region["bbox"], 1, 4), lambda v: T.fixed(v, 2)), ","), F.lit("]"),
    )


def observation_summary(regions: Column, elements: Column) -> Column:
    """Screen description: 30 text lines, 20 elements, or the empty sentence.

    ``elements`` is ``ARRAY<STRUCT<type, label, bounds>>`` (strings).
    """
    some_text, some_elements = F.size(regions) > 0, F.size(elements) > 0
    text_lines = F.concat(
        F.array(F.lit("Detected text on screen:")),
        F.transform(F.slice(regions, 1, 30), region_line),
    )
    element_lines = F.concat(
        F.array(F.lit("\nInteractive elements:")),
        F.transform(
            F.slice(elements, 1, 20),
            lambda e: F.format_string(
                "  - [%s] '%s' at %s", F.coalesce(e["type"], F.lit("?")),
                F.coalesce(e["label"], F.lit("")), F.coalesce(e["bounds"], F.lit("?")),
            ),
        ),
    )
    none = F.array().cast("array<string>")
    lines = F.concat(
        F.when(some_text, text_lines).otherwise(none),
        F.when(some_elements, element_lines).otherwise(none),
    )
    return F.when(F.size(lines) > 0, F.array_join(lines, "\n")).otherwise(
        "Screen appears empty or unreadable."
    )
