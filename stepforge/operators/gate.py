"""Ordered validation checks as columns: NULL passes, a text is the reason."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.functions import text as T


@dataclass(frozen=True)
class Check:
    """One registered check.  ``fatal`` decides between rejection and quarantine.

    ``failed`` is an optional cheap test for "the reason is not NULL": filters on the
    outcome are pushed down to the scan, and should not drag the texts along.
    """

    name: str
    reason: Callable[[], Column]
    fatal: bool = False
    enabled: bool = True
    failed: Callable[[], Column] | None = None

    def test(self) -> Column:
        return self.failed() if self.failed else self.reason().isNotNull()


@dataclass
class Gate:
    """Checks in registration order.

    The first fatal failure rejects the row and hides later checks; other
    failures quarantine it and are collected as warnings.
    """

    checks: list[Check] = field(default_factory=list)

    def register(self, name: str, reason: Callable[[], Column], fatal: bool = False,
                 enabled: bool = True, failed: Callable[[], Column] | None = None) -> "Gate":
        self.checks.append(Check(name, reason, fatal, enabled, failed))
        return self

    def run(self, df: DataFrame) -> DataFrame:
        active = [c for c in self.checks if c.enabled]
        flag, text = (lambda i: F.col(f"_failed_{i}")), (lambda i: F.col(f"_reason_{i}"))
        tested = df.select(
            "*",
            *[c.test().alias(f"_failed_{i}") for i, c in enumerate(active)],
            *[c.reason().alias(f"_reason_{i}") for i, c in enumerate(active)],
        )
        none = F.lit(None).cast("string")
        failed_gate, reason, stopped, doubtful = none, none, F.lit(False), F.lit(False)
        warnings, events = [], []
        for i, check in enumerate(active):
            events.append(
                F.when(
                    ~stopped,
                    F.struct(
                        F.lit(check.name).alias("stage"),
                        F.when(flag(i), "fail").otherwise("pass").alias("result"),
                        text(i).alias("reason"),
                        F.lit(check.fatal).alias("fatal"),
                    ),
                )
            )
            if check.fatal:
                failed_gate = F.coalesce(failed_gate, F.when(flag(i), F.lit(check.name)))
                reason = F.coalesce(reason, text(i))
                stopped = stopped | flag(i)
            else:
                warned = flag(i) & ~stopped
                warnings.append(F.when(warned, F.concat(F.lit(check.name + ": "), text(i))))
                doubtful = doubtful | warned
        no_texts = F.array().cast("array<string>")
        return (
            tested.withColumn("failed_gate", failed_gate)
            .withColumn("gate_reason", reason)
            .withColumn("warnings", F.array_compact(F.array(*warnings)) if warnings else no_texts)
            .withColumn("gate_events", F.array_compact(F.array(*events)))
            .withColumn(
                "gate_status",
                F.when(stopped, "rejected").when(doubtful, "quarantined").otherwise("enriching"),
            )
            .withColumn("was_quarantined", ~stopped & doubtful)
            .withColumn("schema_valid", ~stopped & ~doubtful)
            .drop(*[f"_{kind}_{i}" for kind in ("failed", "reason") for i in range(len(active))])
        )


def schema_failed() -> Column:
    empty = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")) == ""
    fields = ("sample_id", "session_id", "step_index", "source_type", "task", "screenshot_path",
              "action_type", "description")
    bad = (F.col("step_index") < 0) | (F.length(T.strip(F.col("task"))) < D.MIN_TASK_CHARS)
    for name in fields:
        bad = bad | empty(name)
    return F.coalesce(bad | ~F.col("action_type").isin(D.ACTION_TYPES), F.lit(True))


def coordinate_failed() -> Column:
    coords = F.col("coordinates")
    fine = (F.size(coords) == 2) & ~F.exists(coords, lambda v: v.isNull() | F.isnan(v) | ~v.between(0.0, 1.0))
    return F.coalesce(F.col("action_type").isin(D.CLICK_FAMILY), F.lit(False)) & ~F.coalesce(fine, F.lit(False))


def image_failed(min_kb: float = D.MIN_IMAGE_KB, min_width: int = D.MIN_IMAGE_WIDTH,
                 min_height: int = D.MIN_IMAGE_HEIGHT,
                 min_variance: float = D.MIN_PIXEL_VARIANCE) -> Column:
    fine = (
        F.col("file_exists") & (F.col("length") / 1024 >= min_kb) & (F.col("width") >= min_width)
        & (F.col("height") >= min_height)
        & ~F.coalesce(F.col("variance") < min_variance, F.lit(False))
    )
    return ~F.coalesce(fine, F.lit(False))


def schema_reason() -> Column:
    """Required fields, step number, task length, known action."""
    missing = lambda name, label: F.when(
        F.col(name).isNull() | (F.col(name).cast("string") == ""), F.lit(label)
    )
    required = [
        missing(f, f"Required field '{f}' is missing or empty")
        for f in ("sample_id", "session_id", "step_index", "source_type", "task")
    ]
    raw = [
        missing(f, f"Required raw field '{f}' is missing")
        for f in ("screenshot_path", "action_type", "description")
    ]
    known = ", ".join(f"'{a}'" for a in sorted(D.ACTION_TYPES))
    return F.coalesce(
        *required,
        F.when(
            F.col("step_index") < 0,
            F.concat(F.lit("step_index must be >= 0, got "), F.col("step_index").cast("string")),
        ),
        F.when(
            F.length(T.strip(F.col("task"))) < D.MIN_TASK_CHARS,
            F.concat(F.lit("Task instruction too short: '"), F.col("task"), F.lit("'")),
        ),
        *raw,
        F.when(
            ~F.col("action_type").isin(D.ACTION_TYPES),
            F.concat(F.lit("Unknown action_type: '"), F.col("action_type"), F.lit(f"'. Valid: [{known}]")),
        ),
    )


def coordinate_reason() -> Column:
    """Click family only: a point with both values in [0, 1] (NaN is outside)."""
    coords = F.col("coordinates")

    def outside(i: int, name: str) -> Column:
        value = coords[i]
        bad = value.isNull() | F.isnan(value) | ~value.between(0.0, 1.0)
        return F.when(
            bad,
            F.concat(
                F.lit(f"Coordinate {name}="), T.fixed(value, 4),
                F.lit(" is outside [0.0, 1.0]. This sample cannot produce valid click positions."),
            ),
        )

    problem = (
        F.when(
            coords.isNull(),
            F.concat(F.lit("Action type '"), F.col("action_type"), F.lit("' requires coordinates but none found")),
        )
        .when(
            F.size(coords) != 2,
            F.concat(F.lit("Coordinates must be [x, y], got: "), coords.cast("string")),
        )
        .otherwise(F.coalesce(outside(0, "x"), outside(1, "y")))
    )
    return F.when(F.col("action_type").isin(D.CLICK_FAMILY), problem)


def image_reason(min_kb: float = D.MIN_IMAGE_KB, min_width: int = D.MIN_IMAGE_WIDTH,
                 min_height: int = D.MIN_IMAGE_HEIGHT,
                 min_variance: float = D.MIN_PIXEL_VARIANCE) -> Column:
    """Needs file_exists, length, width, height, variance from the image join."""
    kb = F.col("length") / 1024
    return (
        F.when(~F.col("file_exists"), F.concat(F.lit("Screenshot not found: "), F.col("screenshot_path")))
        .when(
            kb < min_kb,
            F.concat(
                F.lit("Screenshot too small: "), T.fixed(kb, 1),
                F.lit(f"KB (minimum {min_kb}KB). Likely blank or corrupted."),
            ),
        )
        .when(F.col("width").isNull(), F.concat(F.lit("Cannot read screenshot: "), F.col("screenshot_path")))
        .when(
            (F.col("width") < min_width) | (F.col("height") < min_height),
            F.format_string(
                f"Screenshot resolution %dx%d below minimum {min_width}x{min_height}. "
                "Too small for reliable OCR.", F.col("width"), F.col("height"),
            ),
        )
        .when(
            F.col("variance") < min_variance,
            F.concat(
                F.lit("Screenshot appears blank (pixel variance="), T.fixed(F.col("variance"), 1),
                F.lit("). Likely a failed capture."),
            ),
        )
    )


def reason_code(failed_gate: Column, reason: Column) -> Column:
    """Low-cardinality form of a reason: the gate and the text before any value."""
    head = F.regexp_extract(F.coalesce(reason, F.lit("")), r"^([A-Za-z_ ]+)", 1)
    return F.when(failed_gate.isNotNull(), F.concat(failed_gate, F.lit(":"), F.lower(F.replace(T.strip(head), F.lit(" "), F.lit("_")))))
