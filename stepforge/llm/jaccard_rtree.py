"""Near-duplicate join on 5-word shingles: a count-vector R-tree over shared rare shingles.

Two documents link when 100 * |A & B| >= percent * |A | B| of their shingle sets.

1. Documents with the same set form one class (its id: a 64-bit fingerprint of the set).
2. All shingles get one fixed order, with shingles that many documents hold last.  Linked
   sets share a shingle among their first ``n - ceil(percent * n / 100) + 1``, so classes
   meet in blocks, one per shingle in those prefixes; nothing is missed whatever the order.
3. The shingles of a set are hashed into ``GROUPS`` groups.  The group counts are a point;
   two points bound the overlap by the sum of their coordinate minima, and so do the upper
   corners of two boxes of an R-tree.  Pairs bounded below the threshold are left out;
   the sets themselves are fetched and compared for the surviving pairs only.
4. To be done with most blocks early, the classes of every ``STAR_KEYS``-th block are
   compared with the block's smallest class.  The links found so far are closed to
   components; blocks inside one component are done.
5. The other blocks' points are loaded into R-trees.  A walk over pairs of nodes skips
   pairs that are bounded below the threshold and pairs inside one component.

Large blocks are cut into chunks and joined chunk by chunk.  Only links that join two
components leave a task, never all pairs of a group, and no link between components is
lost: a pair goes unverified only if its classes are in one component already.

Defined results: null and empty texts have no shingles and link with nothing; a text of
fewer than five words is one shingle; rows with a null id take part, but are a
component's label only as null when no other row is in it; repeated rows come out as often
as they came in; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepforge.llm import arrays
from stepforge.storage import Written, materialize

PERCENT = 75
GROUPS = 256  # of every point in the R-trees; points of large sets are kept finer for single pairs
GROUP_SHINGLES = 4
LEAF = 16
CHUNK = 2048  # classes of one block that are joined in one piece
COMMON_CHUNK = 1 << 22  # shingles among which a task looks for common ones
COMMON_HINTS = 1 << 17  # common shingles placed last; only the order depends on it
BLOCK_ENTRIES = 500_000
SALT_ROWS = 1 << 16
STAR_KEYS = 4  # every so manieth shingle serves the first comparison; all serve the last


def _sets(part: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The sorted shingle set of each text of a slice."""
    offsets, data = arrays.utf8(part.column("text"))
    words = arrays.Words(offsets, arrays.lowered(data))
    for grams in words.text_grams(words.hashes()):
        grams = np.sort(grams)
        if len(grams) > 1:
            fresh = np.empty(len(grams), bool)
            fresh[0] = True
            np.not_equal(grams[1:], grams[:-1], out=fresh[1:])
            grams = grams[fresh]
        yield grams


def _fingerprint(grams: np.ndarray) -> int:
    total = arrays.mix(grams * np.uint64(0xD1342543DE82EF95)).sum(dtype=np.uint64)
    return int(arrays.mix(np.array([total + np.uint64(len(grams))], np.uint64)).view(np.int64)[0])


def _runs(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values, and the end."""
    return np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)])).astype(np.int64)


def _common(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(np.concatenate(held))
    at = _runs(values)
    counts = np.diff(at)
    often = counts >= max(3, len(held) // 4000)
    return values[at[:-1]][often], counts[often]


def counts_of(grams: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    return np.bincount((grams % np.uint64(groups)).astype(np.int64), minlength=groups).astype(np.int32)


def pack_point(grams: np.ndarray) -> bytes:
    """Group counts, with as many groups (a power of two, ``GROUPS`` at least) as a set of this size needs.

    The first byte is the width of a count: 1, 2 or 4 bytes.
    """
    groups = GROUPS
    while groups * GROUP_SHINGLES < len(grams):
        groups *= 2
    counts = counts_of(grams, groups)
    most = int(counts.max())
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def unpack_points(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """The points in ``GROUPS`` groups as rows, and each in all its groups."""
    fine = []
    for x in column:
        raw = x.as_buffer()
        fine.append(np.frombuffer(raw, f"<u{raw[0]}", offset=1) if raw is not None else np.zeros(GROUPS, np.uint8))
    coarse = np.zeros((len(fine), GROUPS), np.int32)
    for i, x in enumerate(fine):
        coarse[i] = x if len(x) == GROUPS else x.reshape(-1, GROUPS).sum(axis=0, dtype=np.int32)
    return coarse, fine


def allows(a: np.ndarray, b: np.ndarray, n: int, m: int, percent: int) -> bool:
    """Whether two points in all their groups, of sets of n and m shingles, allow a link."""
    if len(a) != len(b):
        a, b = (x if len(x) == min(len(a), len(b)) else x.reshape(-1, min(len(a), len(b))).sum(axis=0) for x in (a, b))
    return (100 + percent) * int(np.minimum(a, b).sum(dtype=np.int64)) >= percent * (n + m)


_PROFILE = "kind int, doc_id long, set_id long, n long, counts binary"


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0: a document's class and set size; kind 1: a shingle common in a part of the task and its count."""

    def rows(kind, ids, sets, sizes, points):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(sets), kind, np.int32)), ids, pa.array(sets, pa.int64()), pa.array(sizes, pa.int64()), points],
            names=["kind", "doc_id", "set_id", "n", "counts"],
        )

    def common(held):
        values, counts = _common(held)
        return rows(1, pa.nulls(len(values), pa.int64()), values.view(np.int64), counts, pa.nulls(len(values), pa.binary()))

    held, size, met = [], 0, set()
    for part in arrays.slices(batches, "text"):
        prints, counts, points = [], [], []
        for grams in _sets(part):
            prints.append(_fingerprint(grams))
            counts.append(len(grams))
            points.append(pack_point(grams))
            if len(grams) and prints[-1] not in met:
                met.add(prints[-1])
                held.append(grams)
                size += len(grams)
            if size >= COMMON_CHUNK:
                yield common(held)
                held, size, met = [], 0, set()
        yield rows(0, part.column("doc_id"), prints, counts, pa.array(points, pa.binary()))
    if held:
        yield common(held)


class Order:
    """The fixed order of shingles: rare ones by hash, common ones last by count."""

    def __init__(self, common: np.ndarray, counts: np.ndarray):
        by_value = np.argsort(common)
        self.values, self.ranks = common[by_value], np.argsort(np.argsort(counts, kind="stable"))[by_value]
        self.counts = counts[by_value]
        self.near = np.zeros(1 << 20, bool)
        self.near[(common >> np.uint64(44)).astype(np.int64)] = True

    def keys(self, grams: np.ndarray) -> np.ndarray:
        out = grams >> np.uint64(1)
        maybe = np.flatnonzero(self.near[(grams >> np.uint64(44)).astype(np.int64)])
        if len(maybe) and len(self.values):
            at = np.minimum(np.searchsorted(self.values, grams[maybe]), len(self.values) - 1)
            hit = self.values[at] == grams[maybe]
            out[maybe[hit]] = np.uint64(1 << 63) | self.ranks[at[hit]].astype(np.uint64)
        return out

    def parts(self) -> np.ndarray:
        """By rank: into how many parts the entries of a common shingle are dealt."""
        out = np.ones(len(self.ranks), np.uint64)
        out[self.ranks] = 1 + self.counts // SALT_ROWS
        return out


def _prefixes(order: Order, percent: int, buckets: int):
    """Rows (bucket, keys, sets) of packed prefix entries."""

    def packed(keys: np.ndarray, sets: np.ndarray) -> pa.RecordBatch:
        parts = order.parts()
        salt = np.zeros(len(keys), np.uint64)
        high = np.flatnonzero(keys >> np.uint64(63))
        if len(high):
            rank = (keys[high] & np.uint64((1 << 63) - 1)).astype(np.int64)
            salt[high] = sets[high].view(np.uint64) % parts[rank]
        bucket = (arrays.mix(keys + salt * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(buckets)).astype(np.int64)
        turn = np.argsort(bucket, kind="stable")
        at = _runs(bucket[turn])
        offsets = pa.array(at.astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[turn][at[:-1]]),
                pa.ListArray.from_arrays(offsets, pa.array(keys[turn].view(np.int64))),
                pa.ListArray.from_arrays(offsets, pa.array(sets[turn])),
            ],
            names=["bucket", "keys", "sets"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sets, size = [], [], 0
        for part in arrays.slices(batches, "text"):
            for grams in _sets(part):
                n = len(grams)
                if not n:
                    continue
                length = n - -(-percent * n // 100) + 1
                own = order.keys(grams)
                keys.append(np.partition(own, length - 1)[:length] if length < n else own)
                sets.append(np.full(length, _fingerprint(grams), np.int64))
                size += length
            if size >= 1 << 20:
                yield packed(np.concatenate(keys), np.concatenate(sets))
                keys, sets, size = [], [], 0
        if keys:
            yield packed(np.concatenate(keys), np.concatenate(sets))

    return run


_BLOCKS = "kind int, block long, sets array<long>"


def _blocks(group: pa.Table) -> pa.Table:
    """kind 0: classes to compare with the class ``block``; kind 1: (a chunk of) a block's classes."""
    keys = group["keys"].combine_chunks().flatten().to_numpy()
    sets = group["sets"].combine_chunks().flatten().to_numpy()
    turn = np.lexsort((sets, keys))
    keys, sets = keys[turn], sets[turn]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (sets[1:] != sets[:-1])
    keys, sets = keys[fresh], sets[fresh]
    kinds, blocks, lists = [], [], []
    at = _runs(keys) if len(keys) else np.zeros(1, np.int64)
    sizes = np.diff(at)
    starred = arrays.mix(keys[at[:-1]].view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(STAR_KEYS) == 0
    shared = np.flatnonzero((sizes > 1) | (keys[at[:-1]] < 0))  # a common key may have its partners in other parts
    stars: dict[int, list[np.ndarray]] = {}
    seen: set[bytes] = set()
    for i in shared.tolist():
        members = sets[at[i] : at[i + 1]]
        key = int(keys[at[i]])
        if key >= 0:
            raw = members.tobytes()
            if raw in seen:
                continue
            seen.add(raw)
        if len(members) > 1 and starred[i]:
            stars.setdefault(int(members[0]), []).append(members[1:])
        for a in range(0, len(members), CHUNK):
            kinds.append(1)
            blocks.append(key)
            lists.append(members[a : a + CHUNK])
    for pivot, found in stars.items():
        kinds.append(0)
        blocks.append(pivot)
        lists.append(np.unique(np.concatenate(found)))
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
    values = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    return pa.table(
        {
            "kind": pa.array(kinds, pa.int32()),
            "block": pa.array(blocks, pa.int64()),
            "sets": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
        }
    )


def _encode_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in arrays.slices(batches, "text"):
        ids, raw = [], []
        for grams in _sets(part):
            ids.append(_fingerprint(grams))
            raw.append(grams.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(raw, pa.binary())], names=["set_id", "grams"])


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate((a, b))
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    return (100 + percent) * overlap(a, b) >= percent * (len(a) + len(b))


def _bounded(percent: int):
    """Pairs whose group counts allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (a, fine_a), (b, fine_b) = unpack_points(batch.column("counts_a")), unpack_points(batch.column("counts_b"))
            n, m = a.sum(axis=1), b.sum(axis=1)
            good = (100 + percent) * np.minimum(a, b).sum(axis=1) >= percent * (n + m)
            good &= 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
            for i in np.flatnonzero(good).tolist():
                good[i] = allows(fine_a[i], fine_b[i], int(n[i]), int(m[i]), percent)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                for x, y in zip(batch.column("grams_a"), batch.column("grams_b"))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


class Node:
    """A box of the R-tree: upper corner, range of set sizes, and the rows or two halves below it."""

    __slots__ = ("rows", "corner", "least", "most", "halves")

    def __init__(self, points: np.ndarray, sizes: np.ndarray, rows: np.ndarray):
        own = points[rows]
        self.rows, self.corner, self.halves = rows, own.max(axis=0), ()
        self.least, self.most = int(sizes[rows].min()), int(sizes[rows].max())
        if len(rows) > LEAF:
            axis = int((self.corner - own.min(axis=0)).argmax())
            turn = rows[np.argsort(own[:, axis], kind="stable")]
            middle = len(turn) // 2
            self.halves = (Node(points, sizes, turn[:middle]), Node(points, sizes, turn[middle:]))


class Forest:
    """Components of the rows of one piece of work."""

    def __init__(self, labels: np.ndarray):
        self.label, self.of = np.unique(labels, return_inverse=True)
        self.parent = list(range(len(self.label)))

    def find(self, row: int) -> int:
        x = int(self.of[row])
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def roots(self, rows: np.ndarray) -> np.ndarray:
        return np.array([self.find(r) for r in rows.tolist()])


def pairs_within(points: np.ndarray, sizes: np.ndarray, forest: Forest, left: np.ndarray, right: np.ndarray,
                 percent: int) -> Iterator[tuple[int, int]]:
    """Pairs (row of left, row of right) in different components that the bound can't exclude.

    The consumer may join components between two pairs; later pairs respect it.
    """
    same = left is right
    root = Node(points, sizes, left)
    stack = [(root, root if same else Node(points, sizes, right))]
    while stack:
        x, y = stack.pop()
        if 100 * min(x.most, y.most) < percent * max(x.least, y.least):
            continue
        if (100 + percent) * int(np.minimum(x.corner, y.corner).sum()) < percent * (x.least + y.least):
            continue
        if x.halves and (not y.halves or len(x.rows) >= len(y.rows)):
            if x is y:
                a, b = x.halves
                stack += [(a, a), (a, b), (b, b)]
            else:
                stack += [(half, y) for half in x.halves]
            continue
        if y.halves:
            stack += [(x, half) for half in y.halves]
            continue
        near, far = forest.roots(x.rows), forest.roots(y.rows)
        apart = near[:, None] != far[None, :]
        if not apart.any():
            continue
        bound = np.minimum(points[x.rows][:, None, :], points[y.rows][None, :, :]).sum(axis=2)
        total = sizes[x.rows][:, None] + sizes[y.rows][None, :]
        for i, j in np.argwhere(apart & ((100 + percent) * bound >= percent * total)).tolist():
            a, b = int(x.rows[i]), int(y.rows[j])
            if (x is not y or i < j) and forest.find(a) != forest.find(b):
                yield a, b


def _pieces(group: pa.Table):
    """Row numbers of each (block, left chunk, right chunk) of a task's rows, as two sides."""
    block, i, j, side = (group[c].to_numpy() for c in ("block", "i", "j", "side"))
    turn = np.lexsort((side, j, i, block))
    change = (np.diff(block[turn]) != 0) | (np.diff(i[turn]) != 0) | (np.diff(j[turn]) != 0)
    cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(turn)]
    for a, b in zip(cuts, cuts[1:]):
        rows = turn[a:b]
        if i[rows[0]] == j[rows[0]]:
            yield rows, rows
        else:
            left, right = rows[side[rows] == 0], rows[side[rows] == 1]
            if len(left) and len(right):
                yield left, right


def _may_link(percent: int):
    """Members with a partner that the bound on points can't exclude, each with one member of its chain of partners."""

    def run(group: pa.Table) -> pa.Table:
        points, fine = unpack_points(group["counts"])
        sizes = points.sum(axis=1)
        ids = group["set_id"].to_numpy()
        forest = Forest(group["comp"].to_numpy())
        rows, roots = [], []
        for left, right in _pieces(group):
            chains: dict[int, int] = {}
            for a, b in pairs_within(points, sizes, forest, left, right, percent):
                if not allows(fine[a], fine[b], int(sizes[a]), int(sizes[b]), percent):
                    continue
                x, y = _root(chains, a), _root(chains, b)
                chains[x] = y
            for row in chains:
                rows.append(row)
                roots.append(int(ids[_root(chains, row)]))
        own = group.select(["set_id", "comp"]).take(pa.array(rows, pa.int64()))
        return own.append_column("root", pa.array(roots, pa.int64()))

    return run


def _root(chains: dict[int, int], row: int) -> int:
    chains.setdefault(row, row)
    while chains[row] != row:
        chains[row] = chains[chains[row]]
        row = chains[row]
    return row


def _links(percent: int):
    """Verified links that join two components."""

    def run(group: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group["grams"].combine_chunks()]
        packed = pa.array([pack_point(x) for x in sets], pa.binary())
        points, fine = unpack_points(packed)
        sizes = points.sum(axis=1)
        comp, found = group["comp"].to_numpy(), []
        for left, right in _pieces(group):
            rows = np.union1d(left, right)
            local = np.full(len(sizes), -1)
            local[rows] = np.arange(len(rows))
            forest = Forest(comp[rows])
            a_side = local[left]
            b_side = a_side if left is right else local[right]
            for a, b in pairs_within(points[rows], sizes[rows], forest, a_side, b_side, percent):
                one, other = rows[a], rows[b]
                if allows(fine[one], fine[other], len(sets[one]), len(sets[other]), percent) and linked(
                    sets[one], sets[other], percent
                ):
                    found.append((int(comp[one]), int(comp[other])))
                    forest.parent[forest.find(a)] = forest.find(b)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of the edges (a, b).

    Each round hooks every node to its smallest neighbour, follows two hooks and
    contracts the edges; ids are hashes, so a logarithmic number of rounds is expected.
    """
    edges = materialize(edges.where("a <> b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    placed = nodes.select("node", F.col("node").alias("comp"))
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        hooks = materialize(both.groupBy("a").agg(F.min("b").alias("to")).select("a", F.least("a", "to").alias("to")), "hooks")
        jump = hooks.select(F.col("a").alias("to"), F.col("to").alias("next"))
        moved = materialize(hooks.join(jump, "to").select(F.col("a").alias("old"), F.col("next").alias("new")), "moved")
        placed = materialize(
            placed.join(moved, F.col("comp") == F.col("old"), "left").select("node", F.coalesce("new", "comp").alias("comp")),
            "placed",
        )
        to_a = moved.select(F.col("old").alias("a"), F.col("new").alias("new_a"))
        to_b = moved.select(F.col("old").alias("b"), F.col("new").alias("new_b"))
        edges = materialize(
            edges.join(to_a, "a").join(to_b, "b").where("new_a <> new_b")
            .select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).distinct(),
            "edges",
        )
    return placed


def _chunked(members: DataFrame) -> DataFrame:
    """Rows (block, set_id, comp, chunks) dealt to all pairs (i, j) of their block's chunks; side 1 is the later chunk."""
    own = members.withColumn("own", F.pmod(F.hash("set_id"), "chunks"))
    return materialize(
        own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
            "block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "set_id", "comp",
        ),
        "work",
    )


def _dealt(members: DataFrame, rows_in_task: int, partitions: int, fn, schema: str) -> DataFrame:
    """Apply ``fn`` to pieces of work packed into tasks of about ``rows_in_task`` rows."""
    tasks = max(partitions, members.count() // rows_in_task + 1)
    return (
        members.withColumn("task", F.pmod(F.xxhash64("block", "i", "j"), F.lit(tasks)))
        .groupBy("task")
        .applyInArrow(fn, schema)
    )


def link(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document row: doc_id, n_shingles, set_id (its class), component_id."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profile = materialize(texts.mapInArrow(_profile, _PROFILE), "profile")
    info = profile.where("kind = 0").select("doc_id", "set_id", "n")
    hints = (
        profile.where("kind = 1").groupBy("set_id").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "set_id").limit(COMMON_HINTS).toPandas()
    )
    order = Order(hints["set_id"].to_numpy(np.int64).view(np.uint64), hints["n"].to_numpy(np.int64))
    entries = info.agg(F.sum(F.floor(F.col("n") * (100 - percent) / 100) + 1)).first()[0] or 0
    buckets = max(partitions, int(entries) // BLOCK_ENTRIES + 1)
    blocks = Written(
        texts.mapInArrow(_prefixes(order, percent, buckets), "bucket long, keys array<long>, sets array<long>")
        .groupBy("bucket").applyInArrow(_blocks, _BLOCKS),
        "blocks",
    )
    members = blocks.table.where("kind = 1").select("block", F.explode("sets").alias("set_id"))
    stars = (
        blocks.table.where("kind = 0").select(F.col("block").alias("b"), F.explode("sets").alias("a"))
        .distinct()
    )
    # one document and the point of each class met in blocks
    classes = Written(
        profile.where("kind = 0").join(members.select("set_id").distinct(), "set_id", "left_semi")
        .groupBy("set_id").agg(F.min("doc_id").alias("chosen"), F.first("counts").alias("counts")),
        "classes",
    )

    def with_sets(ids: DataFrame) -> DataFrame:
        """(set_id, grams) of the given classes, from the text of one document each."""
        chosen = materialize(classes.table.join(ids.distinct(), "set_id", "left_semi").select("chosen").distinct(), "chosen")
        rows = texts.join(chosen, F.col("doc_id").eqNullSafe(F.col("chosen"))).select("text")
        return materialize(rows.mapInArrow(_encode_sets, "set_id long, grams binary").dropDuplicates(["set_id"]), "sets")

    def both(pairs: DataFrame, one: DataFrame, column: str) -> DataFrame:
        first = one.select(F.col("set_id").alias("a"), F.col(column).alias(f"{column}_a"))
        second = one.select(F.col("set_id").alias("b"), F.col(column).alias(f"{column}_b"))
        return pairs.join(first, "a").join(second, "b").select("a", "b", f"{column}_a", f"{column}_b")

    pair = "a long, b long"
    near = materialize(both(stars, classes.table, "counts").mapInArrow(_bounded(percent), pair), "near")
    sets = with_sets(near.select(F.col("a").alias("set_id")).union(near.select("b")))
    placed = components(both(near, sets, "grams").mapInArrow(_verify(percent), pair))

    # blocks that still hold two components
    labelled = members.join(placed.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "block", "set_id", F.coalesce("comp", "set_id").alias("comp")
    )
    labelled = Written(labelled, "labelled")
    open_blocks = (
        labelled.table.groupBy("block")
        .agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("low"), F.max("comp").alias("high"))
        .where("low <> high")
        .select("block", F.ceil(F.col("m") / CHUNK).cast("int").alias("chunks"))
    )
    work = _chunked(labelled.table.join(open_blocks, "block"))
    points = classes.table.select("set_id", "counts")
    close = materialize(
        _dealt(work.join(points, "set_id"), 20_000, partitions, _may_link(percent), "set_id long, comp long, root long"),
        "close",
    )
    # classes chained by possible links meet once, whatever the number of blocks they share
    chains = components(close.select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    chained = (
        close.select("set_id", "comp").distinct()
        .join(chains.select(F.col("node").alias("set_id"), F.col("comp").alias("block")), "set_id")
    )
    chain_sizes = chained.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    last = _chunked(chained.join(chain_sizes, "block"))
    sets = with_sets(close.select("set_id"))
    joined = components(_dealt(last.join(sets, "set_id"), 10_000, partitions, _links(percent), pair))
    comp = (
        placed.join(joined.select(F.col("node").alias("comp"), F.col("comp").alias("later")), "comp", "left")
        .select("node", F.coalesce("later", "comp").alias("comp"))
        .union(joined.join(placed.select("node"), "node", "left_anti").select("node", "comp"))
    )
    return _label(info, comp)


def _label(info: DataFrame, comp: DataFrame) -> DataFrame:
    placed = info.join(comp.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "doc_id", "set_id", "n", F.coalesce("comp", "set_id").alias("comp")
    )
    several = (
        placed.where("n > 0").groupBy("comp").agg(F.min("doc_id").alias("smallest"), F.count(F.lit(1)).alias("m"))
        .where("m > 1").select("comp", "smallest")
    )
    return placed.join(several, "comp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "set_id",
        F.when(F.col("n") > 0, F.coalesce("smallest", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest id stays.

    Null ids come last; rows of one id go by the hash of their text.  Rows equal in id
    and text are one document.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = dict(zip(docs.columns, names))
    doc_id, text = F.col(own["doc_id"]).cast("long"), F.col(own["text"])
    # rows are told apart by id and text, as one id may have several texts, or be null
    plain = docs.toDF(*names).withColumn("row_key", F.xxhash64(doc_id, text))
    linked = link(plain.select(F.col("row_key").alias("doc_id"), text.alias("text")), percent)
    components_of = linked.select(F.col("doc_id").alias("row_key"), "component_id").distinct()
    place = F.struct(doc_id.isNull(), doc_id, F.xxhash64(text), "row_key")
    first = plain.select("row_key", place.alias("place")).join(components_of, "row_key").groupBy("component_id").agg(F.min("place").alias("place"))
    kept = first.select(F.col("place.row_key").alias("row_key"))
    return plain.join(kept, "row_key", "left_semi").dropDuplicates(["row_key"]).select(*names).toDF(*docs.columns)
