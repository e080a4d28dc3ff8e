"""Audits beyond the basic gates: sessions, conversations, personal data, samples of a dataset.

All of them are column expressions and combining aggregates; where a rank inside a
stratum is needed, the order is cut into slots first, so a stratum of any size is
never one window group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.functions import personal
from stepforge.operators import automaton, skew
from stepforge.storage import Written, materialize

# ---- fixed values ----
TOO_FAST_SECONDS = 0.1
TOO_SLOW_SECONDS = 30.0
CLUSTER_PIXELS = 10
TERMINAL_ACTIONS = ("done", "fail")
SHARD_ROWS = 10_000
EXPERT_SHARE = 0.05
SCREEN = (1920, 1080)
STRICT_WIDTH, STRICT_HEIGHT, STRICT_KB, STRICT_REGIONS = 800, 600, 50, 2


def personal_data(text: Column) -> list[Column]:
    """One flag per kind and ``no_pii``; a null text holds nothing."""
    return [*[flag.alias(k) for k, flag in personal.flags(text).items()], personal.none_found(text).alias("no_pii")]


def _followed(steps: DataFrame, columns: list[str]) -> DataFrame:
    """Steps (session_id, ts, event_id, ...) with the step after each as ``next``."""
    placed = skew.in_order(steps, ["ts", "event_id"], columns, 1)
    return placed.withColumn("next", F.get("following", 0))


def velocity(steps: DataFrame) -> DataFrame:
    """Per session: gaps between steps, those too fast for a person and those too slow."""
    gap = (F.unix_micros(F.col("next.ts").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / 1e6
    gaps = _followed(steps, ["ts"]).withColumn("gap", gap)
    return gaps.groupBy("session_id").agg(
        F.count("gap").alias("n_gaps"),
        F.count_if(F.col("gap") < TOO_FAST_SECONDS).alias("n_fast"),
        F.count_if(F.col("gap") > TOO_SLOW_SECONDS).alias("n_slow"),
    )


def clustered_clicks(steps: DataFrame, screen: tuple[int, int] = SCREEN) -> DataFrame:
    """Sessions with two or more clicks, and whether all of them fall within a few pixels."""
    clicks = steps.where(F.col("action_type").isin(D.CLICK_FAMILY) & F.col("coordinates").isNotNull())
    spread = lambda i: (F.max(F.col("coordinates")[i]) - F.min(F.col("coordinates")[i])) * screen[i]
    return (
        clicks.groupBy("session_id")
        .agg(F.count(F.lit(1)).alias("n_clicks"), F.greatest(spread(0), spread(1)).alias("spread"))
        .where("n_clicks >= 2")
        .select("session_id", "n_clicks", (F.col("spread") <= CLUSTER_PIXELS).alias("clustered"))
    )


def sequence_duplicates(placed: DataFrame) -> DataFrame:
    """Sessions whose action sequence occurred before: session_id, original (the first by name), n_steps.

    Two sums of hashes of (place, action) identify a sequence; they combine before the
    shuffle, so a long session costs no more than a short one.
    """
    sums = [F.sum(F.xxhash64("pos", "action_type", F.lit(seed)).cast("decimal(20,0)")).alias(f"h{seed}") for seed in (1, 2)]
    sessions = placed.groupBy("session_id").agg(F.count(F.lit(1)).alias("n_steps"), *sums)
    keyed = sessions.withColumn("sequence", F.concat_ws("|", "n_steps", "h1", "h2"))
    first = keyed.groupBy("sequence").agg(F.min("session_id").alias("original"), F.count(F.lit(1)).alias("n"))
    joined = skew.attach_per_key(keyed, first.where("n > 1"), "sequence", "session_id")
    return joined.where("original <> session_id").select("session_id", "original", "n_steps")


def logic_gate(steps: DataFrame) -> DataFrame:
    """Per session: steps in sequential order, a terminal action at the end, and both."""
    order = _followed(steps, ["step_index"]).withColumn("wrong", F.col("next.step_index") <= F.col("step_index"))
    return (
        order.groupBy("session_id")
        .agg(
            (~F.coalesce(F.bool_or("wrong"), F.lit(False))).alias("in_order"),
            F.max_by("action_type", F.struct("ts", "event_id")).isin(*TERMINAL_ACTIONS).alias("terminal"),
        )
        .select("session_id", "in_order", "terminal", (F.col("in_order") & F.col("terminal")).alias("passed"))
    )


def goal_evidence(samples: DataFrame, min_letters: int = 4) -> DataFrame:
    """``done`` steps: how many of the task's longer words the screen text shows, and whether any."""
    screen = F.lower(F.coalesce("ocr_text_raw", F.lit("")))
    words = F.array_distinct(F.regexp_extract_all(F.lower("task"), F.lit(f"[a-z]{{{min_letters},}}"), 0))
    shown = F.size(F.filter("goal_words", lambda w: F.contains(screen, w)))
    return (
        samples.where("action_type = 'done'").withColumn("goal_words", words)
        .select("sample_id", F.size("goal_words").cast("long").alias("n_words"), shown.cast("long").alias("n_shown"))
        .withColumn("supported", F.col("n_shown") > 0)
    )


STRICT_ROLES = automaton.Automaton(
    states=("start", "asked", "user", "assistant", "wrong"),
    moves={
        ("start", "system"): "asked", ("start", "user"): "user", ("asked", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user",
    },
    otherwise="wrong",
)


def strict_conversations(turns: DataFrame, parseable: Column) -> DataFrame:
    """Per conversation (conv_id, turn, role): at least three turns, roles in alternation from a
    user on (after an optional system turn), an assistant at the end whose action parses.
    """
    ends = automaton.final_states(turns, "conv_id", ["turn"], "role", STRICT_ROLES)
    last = F.max_by(F.struct("role", parseable.alias("ok")), "turn")
    facts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), last.alias("last"))
    return (
        facts.join(ends, "conv_id")
        .select(
            "conv_id",
            (F.col("n") >= 3).alias("long_enough"),
            F.col("state").isin("user", "assistant").alias("roles_ok"),
            ((F.col("last.role") == "assistant") & F.col("last.ok")).alias("action_ok"),
        )
        .withColumn("passed", F.col("long_enough") & F.col("roles_ok") & F.col("action_ok"))
    )


def strict_image(n_regions: Column) -> Column:
    """Reason why a screenshot fails the stricter gate, or null; needs the image facts."""
    return (
        F.when(~F.col("file_exists"), "missing")
        .when((F.col("width") < STRICT_WIDTH) | (F.col("height") < STRICT_HEIGHT), "too small")
        .when(F.col("length") < STRICT_KB * 1024, "too few bytes")
        .when(n_regions < STRICT_REGIONS, "too few regions")
    )


def version_diff(before: DataFrame, after: DataFrame, key: str, compared: list[str]) -> DataFrame:
    """(key, change): added, removed, changed or same; a null equals a null."""
    a = before.select(F.col(key), F.struct(*compared).alias("a"))
    b = after.select(F.col(key), F.struct(*compared).alias("b"))
    change = (
        F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed")
        .when(F.col("a").eqNullSafe(F.col("b")), "same").otherwise("changed")
    )
    return a.join(b, key, "full").select(key, change.alias("change"))


def runs_of(membership: DataFrame) -> DataFrame:
    """Per sample the training runs that used it, in order of name."""
    return membership.groupBy("sample_id").agg(F.array_sort(F.collect_set("run_id")).alias("runs"))


def hash_key(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample_thresholds(rows: DataFrame, stratum: str, quotas: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """(stratum, top_hash, top_key): the last place inside each stratum's quota, null where all rows fit.

    Only summaries are shuffled: rows per (stratum, slot of the hash), and of the slots
    in which a quota ends the hashes and keys themselves, about a 4096th of a stratum.
    """
    hashed = rows.select(stratum, F.col(key).alias("_key"), hash_key(key, seed).alias("_hash"))
    slotted = hashed.withColumn("_slot", F.substring("_hash", 1, 3))
    before = Window.partitionBy(stratum).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slotted.groupBy(stratum, "_slot").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_base", F.coalesce(F.sum("_n").over(before), F.lit(0))
    )
    ends = materialize(
        quotas.join(slots, stratum).where("_base <= quota AND _base + _n > quota").select(stratum, "_slot", (F.col("quota") - F.col("_base")).alias("_rest")),
        "ends",
    )
    edge = slotted.join(ends, [stratum, "_slot"])
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy("_hash", "_key"))
    last = edge.withColumn("_rank", rank).where(F.col("_rank") == F.col("_rest")).select(stratum, F.struct("_hash", "_key").alias("_last"))
    first = F.struct(F.col("_slot").alias("_hash"), F.lit(None).cast(rows.schema[key].dataType).alias("_key"))
    cut = ends.join(last, stratum, "left").select(stratum, F.coalesce("_last", first).alias("_top"))
    full = quotas.join(cut, stratum, "left")
    return materialize(full.select(stratum, F.col("_top._hash").alias("top_hash"), F.col("_top._key").alias("top_key")), "thresholds")


def quota_sample(rows: DataFrame, stratum: str, quotas: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Rows whose hash rank within their stratum is at most the stratum's ``quota``.

    ``quotas``: (stratum, quota).  The rows meet one threshold per stratum, a table of
    known size, and are not shuffled where that is small.  Rows of equal key stay together.
    """
    limits = sample_thresholds(rows, stratum, quotas, key, seed)
    place = hash_key(key, seed)
    inside = F.col("top_hash").isNull() | (place < F.col("top_hash")) | ((place == F.col("top_hash")) & (F.col(key) <= F.col("top_key")))
    return rows.join(limits, stratum).where(inside).select(*rows.columns)


def balance(rows: DataFrame, stratum: str, shares: dict[str, float], key: str, seed: int = 0) -> DataFrame:
    """The largest sample that has the target shares: quotas follow the scarcest stratum."""
    share = F.lit(None).cast("double")
    for name, value in shares.items():
        share = F.when(F.col(stratum) == name, F.lit(value)).otherwise(share)
    counts = rows.groupBy(stratum).agg(F.count(F.lit(1)).alias("n")).withColumn("share", share).where("share > 0")
    total = Window.partitionBy(F.lit(0))  # one row per stratum
    quotas = counts.select(stratum, F.floor(F.min(F.col("n") / F.col("share")).over(total) * F.col("share")).alias("quota"))
    return quota_sample(rows, stratum, quotas, key, seed)


def expert_sample(rows: DataFrame, key: str, share: float = EXPERT_SHARE, seed: int = 0) -> DataFrame:
    """About ``share`` of the rows, the same ones in every run."""
    place = F.conv(F.substring(hash_key(key, seed), 1, 8), 16, 10).cast("long")
    return rows.where(place < int(share * 2**32))


def annotation_queue(rows: DataFrame, confidence: str, limit: int, key: str) -> DataFrame:
    """The ``limit`` rows the model is least sure of, most uncertain first."""
    return rows.orderBy(confidence, key).limit(limit)


def write_shards(rows: DataFrame, key: str, path: str, shard_rows: int = SHARD_ROWS) -> None:
    """One Parquet file per ``shard=N`` with exactly ``shard_rows`` rows in order of the key; the last has the rest.

    Places come from the sorted ranges: the ranges' sizes, one row each, are summed up,
    so any number of tasks gives the same shards.
    """
    placed = Written(
        rows.repartitionByRange(F.col(key)).sortWithinPartitions(key).withColumn("_at", F.monotonically_increasing_id()), "placed"
    )
    ranges = placed.table.groupBy(F.shiftright("_at", 33).alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranges.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    place = F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1)
    sharded = placed.table.withColumn("_range", F.shiftright("_at", 33)).join(materialize(bases, "ranges"), "_range")
    sharded = sharded.withColumn("_place", place).withColumn("shard", F.floor(F.col("_place") / shard_rows))
    dealt = sharded.repartition("shard").sortWithinPartitions("shard", "_place")
    dealt.select(*rows.columns, "shard").write.partitionBy("shard").parquet(path)
    placed.drop()


def shard_manifest(shards: DataFrame, key: str, digest: Column) -> DataFrame:
    """Per shard: rows, first and last key, files, and the digest of its rows' digests in order."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), digest.alias("d"))))  # a shard's rows, bounded
    return shards.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("first_key"), F.max(key).alias("last_key"),
        F.count_distinct(F.col("_metadata.file_path")).alias("n_files"),
        F.sha2(F.array_join(F.transform(listed, lambda x: x["d"]), ""), 256).alias("digest"),
    )
