"""Exact and near duplicates without comparing everything with everything.

Rows have: id (string), ord (any orderable value, the arrival order), sha, phash
(64 hex digits or NULL), action, words (task words), coordinates.

A near duplicate differs in at most ``distance`` of 256 bits.  Cut the bits into
``distance + 1`` bands: at least one band is equal in both hashes, so rows meet in
an equi-join on (action, band, band value).  Buckets with very many rows are cut
again by the same argument over their remaining bits.

Inside a bucket rows are compared with the bucket's earliest rows only (the
*heads*), so a bucket full of copies costs one comparison per row.  Rows that need
more are taken up again with more heads until all are decided: nothing is capped.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.functions import text as T
from stepforge.operators.components import components
from stepforge.operators.skew import HOT_ROWS, attach_per_key, split_counts
from stepforge.storage import materialize

FIRST_HEADS = 512
MORE_HEADS = 8
MOST_HEADS = 1000  # Spark prunes a rank up to spark.sql.optimizer.windowGroupLimitThreshold before its shuffle
BUCKET_ROWS = 100_000
ROUNDS = 3  # of simple decisions, before what is still open is folded by components
FOLD_ROWS = 200_000


def task_words(task: Column) -> Column:
    return F.array_sort(F.array_distinct(F.slice(T.words(F.lower(task)), 1, D.TASK_WORDS)))


def hash_words(phash: Column) -> Column:
    """The 256 bits as eight 32-bit integers."""
    return F.array(
        *[F.conv(F.substring(phash, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(8)]
    )


def hash_bits(phash: Column) -> Column:
    """The 256 bits as a text of 0 and 1, for cutting bands."""
    return F.concat(
        *[F.lpad(F.conv(F.substring(phash, 1 + 8 * i, 8), 16, 2), 32, "0") for i in range(8)]
    )


def hamming(a: Column, b: Column) -> Column:
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(8)), F.lit(0))


def jaccard(a: Column, b: Column) -> Column:
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, 1.0).otherwise(both / either)


def same_region(a: Column, b: Column) -> Column:
    """Within tolerance on both axes; a missing point counts as the same place."""
    unknown = a.isNull() | b.isNull() | (F.size(a) < 2) | (F.size(b) < 2)
    near = (F.abs(a[0] - b[0]) <= D.NEAR_COORDINATE) & (F.abs(a[1] - b[1]) <= D.NEAR_COORDINATE)
    return F.coalesce(unknown | near, F.lit(True))


def _context_agrees(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    grounded = a("action").isin(D.CLICK_FAMILY)
    return (
        (a("action") == b("action"))
        & (jaccard(a("words"), b("words")) >= D.NEAR_TASK_JACCARD)
        & (~grounded | same_region(a("coordinates"), b("coordinates")))
    )


def band_edges(bands: int, bits: int = D.HASH_BITS) -> list[tuple[int, int]]:
    """(start, length) of bands whose lengths differ by at most one."""
    base, longer = divmod(bits, bands)
    edges, start = [], 0
    for i in range(bands):
        length = base + (1 if i < longer else 0)
        edges.append((start, length))
        start += length
    return edges


def prepare(rows: DataFrame) -> DataFrame:
    return rows.withColumn("w", hash_words(F.col("phash"))).withColumn("bits", hash_bits(F.col("phash")))


def _band_keys(distance: int, by_action: bool) -> Column:
    scope = F.col("action") if by_action else F.lit("")
    keys = [
        F.struct(
            F.concat_ws("|", F.lit(f"b{i}"), scope, F.substring("bits", start + 1, length)).alias("key"),
            F.lit(i).alias("band"),
        )
        for i, (start, length) in enumerate(band_edges(distance + 1))
    ]
    return F.when(F.col("bits").isNotNull(), F.array(*keys))


def _refined(distance: int) -> Column:
    """Second-level keys of a crowded bucket: bands over the bits outside ``band``."""
    edges = band_edges(distance + 1)
    ints = lambda values: F.array(*[F.lit(v) for v in values])
    start = F.get(ints([s for s, _ in edges]), F.col("band"))
    length = F.get(ints([n for _, n in edges]), F.col("band"))
    rest = F.concat(
        F.substr("bits", F.lit(1), start), F.substr("bits", start + length + 1, F.lit(D.HASH_BITS))
    )
    # band lengths differ by at most one, so there are at most two ways to cut the rest
    cuts = {n: band_edges(distance + 1, D.HASH_BITS - n) for _, n in edges}
    pairs = lambda n: F.array(*[F.struct(F.lit(s).alias("s"), F.lit(m).alias("n")) for s, m in cuts[n]])
    cut = F.coalesce(*[F.when(length == n, pairs(n)) for n in cuts])
    return F.transform(
        cut,
        lambda c, j: F.concat_ws("|", F.col("key"), j.cast("string"), F.substr(rest, c["s"] + 1, c["n"])),
    )


def _banded(prepared: DataFrame, distance: int, by_action: bool) -> DataFrame:
    return prepared.select("*", F.explode(_band_keys(distance, by_action)).alias("_k")).select(
        *prepared.columns, F.col("_k.key").alias("key"), F.col("_k.band").alias("band")
    )


def coarse_keys(prepared: DataFrame, distance: int) -> DataFrame:
    """One row per (row, key): a key per band, and the digest (``band`` NULL)."""
    by_sha = prepared.where("sha is not null").withColumn("key", F.concat(F.lit("s|"), F.col("sha")))
    return _banded(prepared, distance, True).unionByName(by_sha.withColumn("band", F.lit(None).cast("int")))


def bucket_keys(prepared: DataFrame, distance: int, by_action: bool = True, with_sha: bool = True,
                bucket_rows: int = BUCKET_ROWS, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """One row per (row, bucket), and the hot buckets with their slices, None if there are none.

    Crowded band buckets are replaced by finer ones.  Both lists are short (a key of them
    has many rows) and broadcast, so the rows are not shuffled here; keys are hashed, as
    what meets in a bucket is compared anyway.
    """
    counted = _banded(prepared.select("id", "bits", *(["action"] if by_action else [])), distance, by_action)
    crowded = materialize(
        split_counts(counted.select("key"), "key", bucket_rows).select("key", F.lit(True).alias("_crowded")), "crowded"
    )
    keyed = _banded(prepared, distance, by_action)
    if not crowded.isEmpty():
        marked = keyed.join(F.broadcast(crowded), "key", "left")
        finer = F.when(F.col("_crowded"), _refined(distance)).otherwise(F.array("key"))
        keyed = marked.withColumn("key", F.explode(finer)).drop("_crowded")
        slim = keyed.select("key")
    else:
        # nothing to cut: only keys with more rows than that could be hot
        slim = keyed.select("key") if hot_rows < bucket_rows else None
    keyed = keyed.drop("band")
    if with_sha:
        by_sha = prepared.where("sha is not null").withColumn("key", F.concat(F.lit("s|"), F.col("sha")))
        keyed = keyed.unionByName(by_sha)
        slim = by_sha.select("key") if slim is None else slim.union(by_sha.select("key"))
    keyed = keyed.drop("bits").withColumn("key", F.xxhash64("key"))
    if slim is None:
        return keyed, None
    slices = materialize(split_counts(slim.select(F.xxhash64("key").alias("key")), "key", hot_rows), "slices")
    return keyed, None if slices.isEmpty() else slices


def _with_heads(keyed: DataFrame, heads: DataFrame, slices: DataFrame | None) -> DataFrame:
    """Equi-join of rows to the heads of their buckets; rows as r, heads as h.

    Rows of hot buckets are dealt out over slices, to which the (few) heads are
    copied, so no task gets a whole hot bucket.
    """
    earlier = F.col("h.ord") < F.col("r.ord")
    if slices is None:
        return keyed.alias("r").join(heads.alias("h"), (F.col("r.key") == F.col("h.key")) & earlier)
    slice_of = F.pmod(F.xxhash64("id"), F.coalesce("_slices", F.lit(1))).cast("int")
    few = F.broadcast(slices)
    rows = keyed.join(few, "key", "left").withColumn("_slice", slice_of).drop("_slices")
    copies = (
        heads.join(few, "key", "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1)))
        .drop("_slices")
    )
    return rows.alias("r").join(
        copies.alias("h"),
        (F.col("r.key") == F.col("h.key")) & (F.col("r._slice") == F.col("h._slice")) & earlier,
    )


def _heads(keyed: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows of each bucket, at most ``MOST_HEADS``; Spark prunes before the shuffle."""
    by_order = Window.partitionBy("key").orderBy("ord")
    return keyed.withColumn("rank", F.row_number().over(by_order)).where(F.col("rank") <= limit)


def _full(keyed: DataFrame, limit: int) -> DataFrame:
    """(key, last_ord): the buckets with ``limit`` heads or more, at most one for ``limit`` rows, and their last head."""
    heads = _heads(keyed.select("key", "ord"), limit)
    ends = heads.groupBy("key").agg(F.max("rank").alias("last"), F.max("ord").alias("last_ord"))
    return ends.where(F.col("last") >= limit).select("key", "last_ord")


def _r(name: str) -> Column:
    return F.col(f"r.{name}")


def _h(name: str) -> Column:
    return F.col(f"h.{name}")


def collapse_copies(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows plus ``first_id``: the earliest row with equal hash and equal context.

    Such copies can only be decided alike, so one row stands for all of them.
    """
    identity = F.when(
        F.col("sha").isNotNull() | F.col("phash").isNotNull(),
        F.concat_ws(
            "\u0001", F.coalesce("phash", F.concat(F.lit("s|"), F.col("sha"))), "action",
            F.array_join("words", " "), F.coalesce(F.col("coordinates").cast("string"), F.lit("-")),
        ),
    )
    keyed = rows.withColumn("_same", F.coalesce(identity, F.concat(F.lit("id|"), F.col("id"))))
    firsts = keyed.groupBy("_same").agg(
        F.min(F.struct("ord", "id"))["id"].alias("first_id"), F.count(F.lit(1)).alias("n")
    )
    return attach_per_key(keyed, firsts, "_same", "id", "n", hot_rows).drop("_same", "n")


def earliest_match(rows: DataFrame, distance: int, context: bool = True,
                   hot_rows: int = HOT_ROWS, bucket_rows: int = BUCKET_ROWS,
                   first_heads: int = FIRST_HEADS) -> DataFrame:
    """(id, match_id, distance): the earliest earlier row that is a near duplicate.

    With ``context`` the action, task and point must agree too; without it only
    the hashes count.  One output row per duplicate, never all pairs.
    """
    prepared = prepare(rows).select("id", "ord", "w", "bits", *(["action", "words", "coordinates"] if context else []))
    keyed, slices = bucket_keys(prepared, distance, context, False, bucket_rows, hot_rows)
    near = hamming(_r("w"), _h("w")) <= distance
    agrees = near & _context_agrees(_r, _h) if context else near
    open_rows, done, after, limit = keyed, None, None, min(first_heads, MOST_HEADS)
    while True:
        # the next page of each bucket: rows above the last head compared with
        ahead = keyed if after is None else keyed.join(F.broadcast(after), "key").where("ord > last_ord").drop("last_ord")
        heads = _heads(ahead, limit)
        hits = (
            _with_heads(open_rows, heads, slices)
            .where(agrees)
            .groupBy(_r("key").alias("key"), _r("id").alias("id"))
            .agg(F.min(F.struct(_h("ord").alias("ord"), _h("id").alias("match_id"),
                                hamming(_r("w"), _h("w")).alias("distance"))).alias("hit"))
        )
        hits = materialize(hits, "near-hits")
        done = hits if done is None else done.unionByName(hits)
        after = materialize(_full(ahead, limit), "pages")
        if after.isEmpty():
            break
        full = F.broadcast(after.select("key"))
        rest = open_rows.join(full, "key", "left_semi").join(hits.select("key", "id"), ["key", "id"], "left_anti")
        rest = materialize(rest, "near-open")
        if rest.isEmpty():
            break
        open_rows, limit = rest, min(limit * MORE_HEADS, MOST_HEADS)
    best = done.groupBy("id").agg(F.min("hit").alias("hit"))
    return best.select("id", F.col("hit.match_id").alias("match_id"), F.col("hit.distance").alias("distance"))


def near_duplicates(rows: DataFrame, distance: int = D.NEAR_DISTANCE, hot_rows: int = HOT_ROWS,
                    **options) -> DataFrame:
    """(id, match_id, distance): earliest earlier near duplicate of each row.

    Copies with equal hash and context are resolved through their first row.
    """
    marked = materialize(collapse_copies(rows.where("phash is not null"), hot_rows), "copies")
    firsts = marked.where("id = first_id").drop("first_id")
    matched = earliest_match(firsts, distance, hot_rows=hot_rows, **options)
    per_first = (
        marked.groupBy(F.col("first_id")).agg(F.count(F.lit(1)).alias("n"))
        .join(matched.withColumnRenamed("id", "first_id"), "first_id", "left")
        .select("first_id", "n", "match_id", F.col("distance").cast("long").alias("match_distance"))
    )
    resolved = attach_per_key(marked, per_first, "first_id", "id", "n", hot_rows)
    copy = F.col("id") != F.col("first_id")
    return resolved.where(copy | F.col("match_id").isNotNull()).select(
        "id",
        F.coalesce("match_id", "first_id").alias("match_id"),
        F.coalesce("match_distance", F.lit(0).cast("long")).alias("distance"),
    )


def keep_reason(rows: DataFrame, distance: int = D.NEAR_DISTANCE, **options) -> DataFrame:
    """For rows that look like an earlier row: the earliest such row and why both stay.

    ``duplicate`` means no condition separates the two.
    """
    looks_like = earliest_match(
        prepare(rows).drop("w", "bits").where("phash is not null"), distance, context=False, **options
    )
    a = rows.select([F.col(c).alias(f"a_{c}") for c in ("id", "action", "words", "coordinates")])
    b = rows.select([F.col(c).alias(f"b_{c}") for c in ("id", "action", "words", "coordinates")])
    pairs = looks_like.join(a, F.col("id") == F.col("a_id"))
    # one early row may be the look-alike of very many rows: it must not drag them together
    uses = looks_like.groupBy("match_id").agg(F.count(F.lit(1)).alias("n"))
    per_match = uses.join(b, F.col("match_id") == F.col("b_id")).drop("b_id")
    pairs = attach_per_key(pairs, per_match, "match_id", "id", "n", options.get("hot_rows", HOT_ROWS))
    similarity = jaccard(F.col("a_words"), F.col("b_words"))
    grounded = F.col("a_action").isin(D.CLICK_FAMILY)
    reason = (
        F.when(F.col("a_action") != F.col("b_action"), "action_differs")
        .when(similarity < D.NEAR_TASK_JACCARD, "task_differs")
        .when(grounded & ~same_region(F.col("a_coordinates"), F.col("b_coordinates")), "coordinates_differ")
        .otherwise("duplicate")
    )
    return pairs.select(
        "id", "match_id", F.col("distance").cast("long").alias("distance"), reason.alias("reason"),
        similarity.alias("jaccard"),
    )


def exact_duplicates(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(id, original_id): rows whose file digest was seen earlier."""
    firsts = rows.where("sha is not null").groupBy("sha").agg(
        F.min(F.struct("ord", "id"))["id"].alias("original_id"), F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    attached = attach_per_key(rows.where("sha is not null").select("id", "sha"), firsts, "sha", "id", "n", hot_rows)
    return attached.where(F.col("original_id") != F.col("id")).select("id", "original_id")


def _fold_segment(frame: pd.DataFrame) -> pd.DataFrame:
    """Decides the rows of one segment along the order; rows that can't be decided yet stay open.

    ``before`` are the matches in earlier segments that were kept or are open, in order.
    """
    kept, still_open, out = set(), set(), []
    for row in frame.sort_values("place").itertuples(index=False):
        before = [] if row.before is None else [(e["earlier"], e["state"]) for e in row.before]
        inside = [] if row.inside is None else list(row.inside)
        original = next((e for e, state in before if state == "kept"), None)
        if original is None:
            original = next((e for e in inside if e in kept), None)
        if original is not None:
            out.append((row.id, original, "dropped"))
        elif row.sighted and not any(state == "open" for _, state in before) and not any(e in still_open for e in inside):
            kept.add(row.id)
            out.append((row.id, None, "kept"))
        else:
            still_open.add(row.id)
            out.append((row.id, None, "open"))
    return pd.DataFrame(out, columns=["id", "duplicate_of", "state"], dtype="object")


def _folded(edges: DataFrame, open_ids: DataFrame, order: DataFrame, fold_rows: int) -> DataFrame:
    """(id, duplicate_of) of the rows of the edges' components that the edges decide.

    A component is cut along the order into segments of ``fold_rows`` rows.  Segments
    of one number are folded together, each component's in a task; what they kept or
    left open is looked up by the segments after them.  So a task holds a segment,
    and the number of jobs follows the largest component's rows, not its chains.
    """
    comps = components(edges.select(F.col("id").alias("a"), F.col("earlier").alias("b")))
    place = F.row_number().over(Window.partitionBy("comp").orderBy("ord"))
    rows = materialize(
        comps.withColumnRenamed("node", "id").join(open_ids, "id").join(order, "id")
        .select("comp", "id", "sighted", place.alias("place"))
        .withColumn("segment", F.floor((F.col("place") - 1) / fold_rows).cast("int")),
        "segments",
    )
    later = rows.select("id", F.col("segment").alias("own"))
    earlier = rows.select(F.col("id").alias("earlier"), F.col("segment").alias("theirs"))
    placed = materialize(edges.join(later, "id").join(earlier, "earlier", "left"), "placed-edges")
    match = F.struct("earlier_ord", "earlier")
    verdicts: DataFrame | None = None
    for segment in range((rows.agg(F.max("segment")).first()[0] or 0) + 1):
        own = placed.where(F.col("own") == segment)
        inside = own.where(F.col("theirs") == segment).groupBy("id").agg(F.array_sort(F.collect_list(match)).alias("m"))
        here = rows.where(F.col("segment") == segment).join(
            inside.select("id", F.transform("m", lambda x: x["earlier"]).alias("inside")), "id", "left"
        )
        before = own.where((F.col("theirs") < segment) | F.col("theirs").isNull())
        if verdicts is None:
            known = before.withColumn("state", F.lit("open"))
        else:
            states = verdicts.where("state <> 'dropped'").select(F.col("id").alias("earlier"), "state")
            known = before.join(states, "earlier")
        listed = known.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("earlier_ord", "earlier", "state"))).alias("before"))
        folded = here.join(listed, "id", "left").select("comp", "id", "sighted", "place", "inside", "before").groupBy("comp")
        done = materialize(folded.applyInPandas(_fold_segment, "id string, duplicate_of string, state string"), "folded")
        verdicts = done if verdicts is None else verdicts.unionByName(done)
    return verdicts.where("state <> 'open'").select("id", "duplicate_of")


def _known_before(firsts: DataFrame, ids: DataFrame, index, distance: int, hot_rows: int, bucket_rows: int) -> DataFrame | None:
    """(id, duplicate_of): new rows that match a row of the index, which is kept for good.

    ``index`` gives the stored rows under the new rows' keys.  Crowded keys are cut finer
    on both sides; the stored rows of a hot key are dealt over slices.
    """
    new = materialize(coarse_keys(firsts, distance), "new-keys")
    found = index.lookup(new)
    if found is None:
        return None
    stored = materialize(found.join(ids, "id", "left_anti"), "stored-keys")
    crowded = split_counts(stored.where("band is not null"), "key", bucket_rows).select("key", F.lit(True).alias("_crowded"))

    def finer(keyed: DataFrame) -> DataFrame:
        marked = keyed.join(crowded, "key", "left")
        return marked.withColumn("key", F.explode(F.when(F.col("_crowded"), _refined(distance)).otherwise(F.array("key")))).drop("_crowded")

    old, rows = finer(prepare(stored)), finer(new)
    slices = split_counts(old, "key", hot_rows)
    count = F.coalesce("_slices", F.lit(1))
    old = old.join(slices, "key", "left").withColumn("_slice", F.pmod(F.xxhash64("id"), count).cast("int"))
    rows = rows.join(slices, "key", "left").withColumn("_slice", F.explode(F.sequence(F.lit(0), count - 1)))
    same_file = F.coalesce(_r("sha") == _h("sha"), F.lit(False))
    similar = F.coalesce((hamming(_r("w"), _h("w")) <= distance) & _context_agrees(_r, _h), F.lit(False))
    pairs = rows.alias("r").join(old.alias("h"), (_r("key") == _h("key")) & (_r("_slice") == _h("_slice")))
    best = pairs.where(same_file | similar).groupBy(_r("id").alias("id")).agg(F.min(F.struct(_h("ord").alias("ord"), _h("id").alias("id"))).alias("best"))
    return best.select("id", F.col("best.id").alias("duplicate_of"))


class TableIndex:
    """An index held as a plain table of kept rows."""

    def __init__(self, rows: DataFrame, distance: int):
        self.rows, self.distance = rows, distance

    def lookup(self, keys: DataFrame) -> DataFrame:
        wanted = ["id", "ord", "sha", "phash", "action", "words", "coordinates"]
        keyed = coarse_keys(prepare(self.rows.select(*wanted)), self.distance)
        return keyed.join(keys.select("key").distinct(), "key", "left_semi").select("key", "band", *wanted)


def survivors(rows: DataFrame, distance: int = D.NEAR_DISTANCE, index=None,
              hot_rows: int = HOT_ROWS, bucket_rows: int = BUCKET_ROWS,
              first_heads: int = FIRST_HEADS, fold_rows: int = FOLD_ROWS) -> DataFrame:
    """Rows plus ``duplicate_of`` (NULL for kept rows), as an arrival-order scan decides.

    A row is dropped iff it matches an earlier *kept* row by file digest or as a
    near duplicate.  Decisions are taken in rounds: a row whose buckets show no
    earlier undecided match is kept, the rows matching it are dropped.  What ``ROUNDS``
    rounds leave open (chains of rows each near the next) is decided component by
    component in a fold along the order, ``fold_rows`` rows at a time.

    ``index`` holds kept rows of earlier runs: a table with the same columns, or an
    object whose ``lookup`` gives the stored rows under given keys.  They precede every
    new row, except rows that are being processed again, which are no duplicates of
    themselves; a new row that matches one of them is dropped at once.  Rows without
    sha and phash (no screenshot) are kept as they are.
    """
    wanted = ["id", "ord", "sha", "phash", "action", "words", "coordinates"]
    hashed = rows.select(*wanted).where("sha is not null or phash is not null")
    marked = materialize(collapse_copies(hashed, hot_rows), "copies")
    undecided = prepare(marked.where("id = first_id").drop("first_id"))
    undecided = materialize(undecided, "undecided")
    dropped: DataFrame | None = None
    if index is not None:
        stored = TableIndex(index, distance) if isinstance(index, DataFrame) else index
        dropped = _known_before(undecided, rows.select("id"), stored, distance, hot_rows, bucket_rows)
        if dropped is not None:
            dropped = materialize(dropped, "known")
            undecided = materialize(undecided.join(dropped.select("id"), "id", "left_anti"), "undecided")

    same_file = _r("sha").isNotNull() & (_r("sha") == _h("sha"))
    similar = (hamming(_r("w"), _h("w")) <= distance) & _context_agrees(_r, _h)
    conflict = F.coalesce(same_file, F.lit(False)) | F.coalesce(similar, F.lit(False))

    limit = min(first_heads, MOST_HEADS)
    while not undecided.isEmpty():
        # the action parts hashes, not digests, so it stays in the rows; the hash is in ``w``
        keyed, slices = bucket_keys(undecided.drop("phash"), distance, bucket_rows=bucket_rows, hot_rows=hot_rows)
        heads = _heads(keyed, limit)
        edges = (
            _with_heads(keyed, heads, slices).where(conflict)
            .select(_r("id").alias("id"), _h("id").alias("earlier"), _h("ord").alias("earlier_ord"))
            .dropDuplicates(["id", "earlier"])
        )
        edges = materialize(edges, "edges")
        # only rows among the heads of all their buckets see every earlier row
        unseen = keyed.select("key", "id", "ord").join(F.broadcast(materialize(_full(keyed, limit), "full")), "key").where("ord > last_ord").select("id").distinct()
        open_ids = materialize(
            undecided.select("id").join(unseen.withColumn("_unseen", F.lit(True)), "id", "left")
            .select("id", F.col("_unseen").isNull().alias("sighted")),
            "open",
        )
        decided: DataFrame | None = None
        turn = 0
        while True:
            turn += 1
            if turn == ROUNDS + 1 and not edges.isEmpty():
                left = open_ids if decided is None else open_ids.join(decided, "id", "left_anti")
                folded = materialize(_folded(edges, left, undecided.select("id", "ord"), fold_rows), "verdicts")
                losers = folded.where("duplicate_of is not null")
                dropped = losers if dropped is None else dropped.unionByName(losers)
                decided = folded if decided is None else decided.unionByName(folded)
                gone = folded.select("id")
                edges = materialize(
                    edges.join(gone, "id", "left_anti")
                    .join(gone.withColumnRenamed("id", "earlier"), "earlier", "left_anti"),
                    "edges",
                )
            left = open_ids if decided is None else open_ids.join(decided, "id", "left_anti")
            keep = left.where("sighted").join(edges.select("id"), "id", "left_anti").select("id")
            hit = edges.join(keep.withColumnRenamed("id", "earlier"), "earlier", "left_semi")
            verdicts = keep.withColumn("duplicate_of", F.lit(None).cast("string")).unionByName(
                hit.groupBy("id").agg(
                    F.min(F.struct("earlier_ord", "earlier"))["earlier"].alias("duplicate_of")
                )
            )
            verdicts = materialize(verdicts, "verdicts")
            if verdicts.isEmpty():
                break
            losers = verdicts.where("duplicate_of is not null")
            dropped = losers if dropped is None else dropped.unionByName(losers)
            decided = verdicts if decided is None else decided.unionByName(verdicts)
            gone = verdicts.select("id")
            edges = materialize(
                edges.join(gone, "id", "left_anti")
                .join(gone.withColumnRenamed("id", "earlier"), "earlier", "left_anti"),
                "edges",
            )
        undecided = materialize(undecided.join(decided, "id", "left_anti"), "undecided")
        limit = min(limit * MORE_HEADS, MOST_HEADS)

    base = rows.sparkSession
    if dropped is None:
        dropped = base.createDataFrame([], "id string, duplicate_of string")
    per_first = (
        marked.groupBy("first_id").agg(F.count(F.lit(1)).alias("n"))
        .join(dropped.withColumnRenamed("id", "first_id"), "first_id", "left")
    )
    resolved = attach_per_key(
        marked.select("id", "first_id"), per_first, "first_id", "id", "n", hot_rows
    )
    decision = resolved.select(
        "id",
        F.coalesce(
            "duplicate_of", F.when(F.col("id") != F.col("first_id"), F.col("first_id"))
        ).alias("duplicate_of"),
    )
    return rows.join(decision, "id", "left")


# ---- persisted index ---------------------------------------------------------


def index_rows(kept: DataFrame) -> DataFrame:
    """Rows of the duplicate index for kept samples."""
    return kept.where("sha is not null or phash is not null").select(
        "id", "ord", "sha", "phash", "action", "words", "coordinates",
        F.lit(D.DEDUP_INDEX_VERSION).alias("index_version"),
    )


def load_index(spark: SparkSession, path: str) -> DataFrame:
    return migrate_index(spark.read.parquet(path))


def migrate_index(index: DataFrame) -> DataFrame:
    """Entries of an older version keep their digest but lose the perceptual hash,
    which had no context; entries without a sample id are dropped."""
    current = F.lit(D.DEDUP_INDEX_VERSION)
    version = F.col("index_version") if "index_version" in index.columns else F.lit(1)
    old = F.coalesce(version, F.lit(1)) < current
    return (
        index.withColumn("phash", F.when(old, F.lit(None).cast("string")).otherwise(F.col("phash")))
        .withColumn("index_version", current)
        .where("id is not null and (sha is not null or phash is not null)")
    )


def index_size(index: DataFrame) -> DataFrame:
    return index.agg(
        F.count_distinct("sha").alias("sha256"), F.count_distinct("phash").alias("phash")
    )
