"""Vectors that point the same way: an exact cosine join with bounded tasks.

Angles between directions are a metric.  A bounded sample of pivots divides the sphere:
a vector's group is its nearest pivot and the ring around it.  Every group knows, for
each pivot, the least and greatest angle of its members.  By the triangle inequality a
vector can have a partner in a group only if its angle to every pivot lies inside that
range, widened by the limit; only to such groups it is copied.  There members and
visitors are dealt over tasks of bounded size and compared by block products.

Around each pivot there is a core of half the limit's angle.  Any two vectors of a core
are surely linked, so they are counted and never compared: a dense cluster costs one
row per vector.  Vectors without structure (all angles near 90 degrees) are not told
apart by any pivot.  Where visits would leave more than a quarter of the pairs, the vectors
outside the cores are dealt over blocks that meet pairwise: products in proportion to the
square of their number, but each vector is copied to ``BLOCKS`` tasks only, until a block
would pass ``BLOCK_POINTS``.

Products are taken in single precision; pairs too near the limit for it are computed again
in double precision.

Equal directions are one point with a weight.  No link is lost and no pair is put out:
the result has one row per vector with its number of links and the smallest id of its
component.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepforge.operators.components import components
from stepforge.operators.skew import HOT_ROWS, attach_per_key
from stepforge.storage import Written, materialize

COSINE = 0.95
PIVOTS = 64  # at most; their angles and the groups' ranges travel with the tasks
POINTS_A_PIVOT = 256  # small tables need fewer
MEMBERS = 65536  # of a group in one task, about
VISITORS = 65536
BLOCKS = 16  # of vectors that pivots do not tell apart; small tables have fewer, very large ones more
BLOCK_LEAST, BLOCK_POINTS = 8192, 262144
SLACK = 1e-6  # far above the rounding of an angle
TILE = 1024


def directed(vectors: DataFrame, key: str, embedding: str, size: int) -> DataFrame:
    """(key, code, unit): the unit vector and its digest; null but for finite vectors of ``size`` that are not zero."""
    wanted = vectors.select(F.col(key).alias("key"), F.col(embedding).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            whole = pc.equal(pc.list_value_length(column), size)
            at = np.flatnonzero(pc.fill_null(whole, False).to_numpy(zero_copy_only=False))
            values = _matrix(column.take(pa.array(at)))  # nulls inside become NaN
            top = np.abs(values).max(axis=1)
            good = np.isfinite(top) & (top > 0)
            at, values = at[good], values[good] / top[good, None]
            units = values / np.sqrt((values * values).sum(axis=1))[:, None] + 0.0  # no negative zeros
            place = np.full(batch.num_rows, -1)
            place[at] = np.arange(len(at))
            pick = pa.array(place, mask=place < 0)
            codes = pa.array([hashlib.sha256(u).hexdigest() for u in units], pa.string())
            packed = pa.array([u.tobytes() for u in units], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), codes.take(pick), packed.take(pick)], names=["key", "code", "unit"])

    kind = wanted.schema["key"].dataType.simpleString()
    return wanted.mapInArrow(run, f"key {kind}, code string, unit binary")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _units(column: pa.Array) -> np.ndarray:
    """Rows of doubles from a binary column without nulls."""
    if not len(column):
        return np.zeros((0, 1))
    _, starts, data = column.buffers()
    start = np.frombuffer(starts, np.int32)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.float64, (start[-1] - start[0]) // 8, start[0])
    return flat.reshape(len(column), -1)


class _Sphere:
    """Pivots and the groups around them."""

    def __init__(self, pivots: np.ndarray, cosine: float):
        self.pivots, self.limit = pivots, math.acos(cosine)
        self.rings = math.ceil(math.pi / self.limit) + 2

    def angles(self, units: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(units @ self.pivots.T, -1.0, 1.0))

    def group(self, angles: np.ndarray) -> np.ndarray:
        """Ring 0 is the core; the cores come first."""
        home = angles.argmin(axis=1)
        near = angles[np.arange(len(angles)), home]
        ring = 1 + (near / self.limit).astype(np.int64)
        return np.where(near < self.limit / 2 - SLACK, home, len(self.pivots) + home * self.rings + ring)

    def is_core(self, group) -> np.ndarray:
        return np.asarray(group) < len(self.pivots)


_RANGES = "group long, pivot int, low double, high double, points long, copies long, first string"


def _ranges(points: DataFrame, sphere: _Sphere) -> pd.DataFrame:
    """Angles of each group by pivot, its size and smallest code: at most pivots x pivots x rings rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not batch.num_rows:
                continue
            angles = sphere.angles(_units(batch.column("unit")))
            group = sphere.group(angles)
            found, which = np.unique(group, return_inverse=True)
            low = np.full((len(found), angles.shape[1]), np.inf)
            high = np.full_like(low, -np.inf)
            np.minimum.at(low, which, angles)
            np.maximum.at(high, which, angles)
            copies = np.bincount(which, batch.column("copies").to_numpy()).astype(np.int64)
            first = pd.Series(batch.column("code").to_pylist()).groupby(which).min()
            pivots = angles.shape[1]
            yield pa.RecordBatch.from_pandas(
                pd.DataFrame({
                    "group": np.repeat(found, pivots),
                    "pivot": np.tile(np.arange(pivots, dtype=np.int32), len(found)),
                    "low": low.ravel(), "high": high.ravel(),
                    "points": np.repeat(np.bincount(which), pivots),
                    "copies": np.repeat(copies, pivots),
                    "first": np.repeat(first.to_numpy(dtype=object), pivots),
                }),
                preserve_index=False,
            )

    each = points.select("code", "copies", "unit").mapInArrow(run, _RANGES)
    return each.groupBy("group", "pivot").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("points").alias("points"),
        F.sum("copies").alias("copies"), F.min("first").alias("first"),
    ).toPandas()


class _Groups:
    """Groups in order, with ranges of angles, sizes and numbers of tasks."""

    def __init__(self, ranges: pd.DataFrame, sphere: _Sphere):
        self.sphere = sphere
        wide = ranges.sort_values(["group", "pivot"])
        self.names = wide["group"].unique()
        shape = (len(self.names), -1)
        self.low = wide["low"].to_numpy().reshape(shape) - sphere.limit - SLACK
        self.high = wide["high"].to_numpy().reshape(shape) + sphere.limit + SLACK
        one = wide.drop_duplicates("group")
        self.points, self.copies = one["points"].to_numpy(), one["copies"].to_numpy()
        self.first = one["first"].to_numpy()
        self.core = sphere.is_core(self.names)
        self.blocks = 0  # of the points outside the cores, where their groups are of no use

    def own(self, angles: np.ndarray) -> np.ndarray:
        """Places of the points' groups."""
        return np.searchsorted(self.names, self.sphere.group(angles))

    def visits(self, angles: np.ndarray, own: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(group, points that must look there); a pair of groups meets in the first of them."""
        for g in range(self.core.sum() if self.blocks else len(self.names)):
            later = np.flatnonzero((own > g) | ((own == g) & ~self.core[g]))
            seen = angles[later]
            later = later[((seen >= self.low[g]) & (seen <= self.high[g])).all(axis=1)]
            if len(later):
                yield g, later

    def divide(self, visitors: dict[int, int], members: int, visits: int, block_least: int) -> None:
        loose = int(self.points[~self.core].sum())
        pairs = sum(int(self.points[g]) * n for g, n in visitors.items() if not self.core[g])
        if pairs * 8 > loose * loose:
            self.blocks = max(-(-loose // BLOCK_POINTS), min(BLOCKS, -(-loose // block_least)))
        self.parts = -(-self.points // members)
        self.slices = np.array([-(-visitors.get(g, 0) // visits) for g in range(len(self.names))])

    def tasks(self) -> int:
        one = self.core if self.blocks else np.ones(len(self.names), bool)
        return max(1, int((self.parts * self.slices)[one].sum()) + self.blocks * (self.blocks + 1) // 2)


def _visitors(points: DataFrame, groups: _Groups) -> dict[int, int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(groups.names), np.int64)
        for batch in batches:
            if batch.num_rows:
                angles = groups.sphere.angles(_units(batch.column("unit")))
                for g, who in groups.visits(angles, groups.own(angles)):
                    total[g] += len(who)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["g", "n"])

    counted = points.select("unit").mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
    return {r.g: r.n for r in counted.collect()}  # one row per group at most


_DEALT = "g long, part long, slice long, member boolean, own boolean, code string, copies long, unit binary"


def _deal(points: DataFrame, groups: _Groups) -> DataFrame:
    def copies_of(batch: pa.RecordBatch, who: np.ndarray, g, part, slice_, member: bool, own) -> pa.RecordBatch:
        n = len(who)
        kept = batch.take(pa.array(who))
        fixed = [pa.array(np.broadcast_to(np.asarray(x, np.int64), n)) for x in (g, part, slice_)]
        flags = [pa.array(np.broadcast_to(np.asarray(x, bool), n)) for x in (member, own)]
        return pa.RecordBatch.from_arrays(
            [*fixed, *flags, *(kept.column(c) for c in ("code", "copies", "unit"))],
            names=["g", "part", "slice", "member", "own", "code", "copies", "unit"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            angles = groups.sphere.angles(_units(batch.column("unit")))
            own = groups.own(angles)
            code = np.array([int(c[:15], 16) for c in batch.column("code").to_pylist()], np.int64)
            if groups.blocks:
                loose = np.flatnonzero(~groups.core[own])
                block = code[loose] % groups.blocks
                for other in range(groups.blocks):
                    low, high = len(groups.names) + np.minimum(block, other), np.maximum(block, other)
                    yield copies_of(batch, loose, low, high, 0, block <= other, block == other)
                    same = block == other
                    yield copies_of(batch, loose[same], low[same], high[same], 0, False, True)
            for g in np.unique(own):
                if groups.blocks and not groups.core[g]:
                    continue
                who = np.flatnonzero(own == g)
                for s in range(groups.slices[g]):
                    yield copies_of(batch, who, g, code[who] % groups.parts[g], s, True, True)
            for g, who in groups.visits(angles, own):
                for part in range(groups.parts[g]):
                    slice_ = (code[who] >> 20) % groups.slices[g]
                    yield copies_of(batch, who, g, part, slice_, False, own[who] == g)

    return points.select("code", "copies", "unit").mapInArrow(run, _DEALT)


_FOUND = "code string, other string, links long"


class _Forest:
    """Trees of linked rows of a task; keeps the links that joined two of them."""

    def __init__(self, size: int):
        self.tree, self.links = np.arange(size), []

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        _, first = np.unique(a, return_index=True)  # one link a row joins most of what is dense
        for some in (first, slice(None)):
            left, right = a[some], b[some]
            apart = self.tree[left] != self.tree[right]
            left, right = left[apart], right[apart]
            if not len(left):
                continue
            names, which = np.unique(self.tree[np.r_[left, right]], return_inverse=True)
            up = list(range(len(names)))

            def root(x: int) -> int:
                while up[x] != x:
                    up[x] = x = up[up[x]]
                return x

            for i, (x, y) in enumerate(which.reshape(2, -1).T.tolist()):
                x, y = root(x), root(y)
                if x != y:
                    up[y] = x
                    self.links.append((int(left[i]), int(right[i])))
            to = np.arange(len(self.tree))
            to[names] = names[[root(x) for x in range(len(names))]]
            self.tree = to[self.tree]


def _compared(dealt: DataFrame, cosine: float, tasks: int) -> DataFrame:
    """Numbers of links (``other`` null) and a forest of links, from each task's members and visitors."""

    def run(table):
        units, code = _units(table["unit"].combine_chunks()), table["code"].to_numpy()
        copies, own, member = (table[c].to_numpy() for c in ("copies", "own", "member"))
        m, v = np.flatnonzero(member), np.flatnonzero(~member)
        same, place = np.unique(code.astype("S64"), return_inverse=True)  # a point can be both member and visitor
        short = units.astype(np.float32)
        doubt = 1e-6 + 2e-7 * units.shape[1]  # above the rounding of a product in single precision
        links = np.zeros(len(same))
        forest = _Forest(len(same))
        across = [(who, np.ascontiguousarray(short[who].T)) for who in (m[at : at + TILE] for at in range(0, len(m), TILE))]
        for at in range(0, len(v), TILE):
            some = v[at : at + TILE]
            left = short[some]
            for who, right in across:
                near = left @ right
                hit = np.flatnonzero(near.ravel() > cosine - doubt)
                if not len(hit):
                    continue
                i, j = np.divmod(hit, len(who))
                sure = near[i, j] > cosine + doubt
                i, j = some[i], who[j]
                ask = np.flatnonzero(~sure)
                sure[ask] = np.einsum("ij,ij->i", units[i[ask]], units[j[ask]]) > cosine
                sure &= ~own[i] | (place[i] > place[j])
                i, j = i[sure], j[sure]
                links += np.bincount(place[i], copies[j], len(same)) + np.bincount(place[j], copies[i], len(same))
                forest.join(place[i], place[j])
        used = np.flatnonzero(links)
        named = lambda at: [same[x].decode() for x in at]
        return pa.table({
            "code": pa.array([*named(used), *named(a for a, _ in forest.links)], pa.string()),
            "other": pa.array([None] * len(used) + named(b for _, b in forest.links), pa.string()),
            "links": pa.array([*links[used].astype(np.int64).tolist(), *[0] * len(forest.links)], pa.int64()),
        })

    keys = ("g", "part", "slice")
    return dealt.repartition(min(tasks, 4096), *keys).groupBy(*keys).applyInArrow(run, _FOUND)


def _cores(points: DataFrame, groups: _Groups) -> DataFrame:
    """Links inside the cores: everything there is linked, through the core's first point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = groups.own(groups.sphere.angles(_units(batch.column("unit"))))
            who = np.flatnonzero(groups.core[own])
            code = batch.column("code").take(pa.array(who))
            links = groups.copies[own[who]] - batch.column("copies").to_numpy()[who]
            yield pa.RecordBatch.from_arrays([code, pa.nulls(len(who), pa.string()), pa.array(links)], names=["code", "other", "links"])
            first = pa.array(groups.first[own[who]], pa.string())
            yield pa.RecordBatch.from_arrays([code, first, pa.array(np.zeros(len(who), np.int64))], names=["code", "other", "links"])

    return points.select("code", "copies", "unit").mapInArrow(run, _FOUND)


def links(vectors: DataFrame, cosine: float = COSINE, key: str = "vec_id", embedding: str = "embedding",
          pivots: int = PIVOTS, members: int = MEMBERS, visitors: int = VISITORS, hot_rows: int = HOT_ROWS,
          block_least: int = BLOCK_LEAST) -> DataFrame:
    """Per vector: its key, ``n_links`` (others at a cosine above the limit) and ``group_id``.

    ``group_id`` is the smallest key that links reach.  A vector without a direction, or
    of another length than most, has no links.  Repeated rows are vectors of their own.
    """
    most = vectors.where(F.size(embedding) > 0).groupBy(F.size(embedding).alias("size")).count()
    common = most.orderBy(F.desc("count"), "size").first()
    found = directed(vectors, key, embedding, common["size"] if common else 1)
    rows = materialize(found.withColumn("row", F.monotonically_increasing_id()), "directions")
    points = materialize(
        rows.where("code IS NOT NULL").groupBy("code").agg(
            F.count("*").alias("copies"), F.min("key").alias("least"), F.any_value("unit").alias("unit")
        ),
        "points",
    )
    wanted = min(pivots, 1 + points.count() // POINTS_A_PIVOT)
    chosen = [np.frombuffer(r.unit) for r in points.orderBy("code").limit(wanted).select("unit").collect()]
    if not chosen:
        return rows.select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("key").alias("group_id"))
    sphere = _Sphere(np.array(chosen), cosine)
    groups = _Groups(_ranges(points, sphere), sphere)
    groups.divide(_visitors(points, groups), members, visitors, block_least)
    found = Written(_compared(_deal(points, groups), cosine, groups.tasks()).unionByName(_cores(points, groups)), "links")
    counts = found.table.where("other IS NULL").groupBy("code").agg(F.sum("links").alias("links"))
    reached = components(found.table.where("other IS NOT NULL").select(F.col("code").alias("a"), F.col("other").alias("b")))
    placed = points.join(reached.withColumnRenamed("node", "code"), "code", "left").withColumn("comp", F.coalesce("comp", "code"))
    placed = materialize(placed.select("code", "copies", "least", "comp"), "placed")
    smallest = placed.groupBy("comp").agg(F.min("least").alias("group_id"), F.count("*").alias("n"))
    known = attach_per_key(placed, smallest, "comp", "code", "n", hot_rows).join(counts, "code", "left")
    per_code = known.select("code", "copies", "group_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    full = attach_per_key(rows.select("key", "row", "code"), per_code, "code", "row", "copies", hot_rows)
    return full.select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("code").isNull(), F.col("key")).otherwise(F.col("group_id")).alias("group_id"),
    )
