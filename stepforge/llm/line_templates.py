"""Line dedup with a fixed-depth tree of line templates.

A line is cut into words; words with a digit, an ``@`` or ``://`` are variable fields and
become ``<*>``.  The tree has two fixed levels: the number of words, then the first
``DEPTH`` words.  In a leaf two lines are similar if at least ``SIMILAR`` percent of their
words are equal at their place; lines linked by steps of similar lines are one template,
whose differing words become ``<*>``.  The rule has no order and no sizes in it, so the
templates depend on the lines alone.

A template found in ``MIN_DOCS`` or more documents recurs, one of more than ``LONG_WORDS``
words in ``LONG_DOCS`` documents; its lines are dropped from all documents but the one
with the smallest id, so no content is lost altogether.

Lines are compared in blocks of at most ``BLOCK_ROWS`` lines and ``BLOCK_WORDS`` words.  A
larger leaf is dealt over blocks, every two of which meet in a task; where that would
send more copies of a line than there are bands, the leaf is cut into bands instead: at
most *d* words of similar lines differ, so they agree on a whole one of *d* + 1 groups of
places.  Both lose no link.  Leaves that can't recur and leaves with one distinct line
need no comparison and their words are not shuffled.

Defined results: null and empty texts have no lines and stay as they are; lines without
a word are kept; rows equal in id and text are one document; rows with a null id count
as one document and never keep a recurring line; an empty table gives an empty table;
extra columns are kept by ``clean`` and ignored by ``recurring``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepforge.llm import arrays
from stepforge.operators.components import components
from stepforge.storage import Written

DEPTH = 4
SIMILAR = 60
MIN_DOCS = 10
LONG_WORDS = 50
LONG_DOCS = 2
BLOCK_ROWS = 8_192
BLOCK_WORDS = 500_000
MAP_BITS = 23  # of the map of leaves that goes to all tasks
FIELD = "<*>"
NO_ID = -(1 << 62)  # holder of the rows with a null id

_DIGIT_OR_AT = np.isin(np.arange(256), [*range(48, 58), 64])
_FIELD_HASH = np.uint64(0x2545F4914F6CDD1D)


class Lines:
    """Lines with words of a slice's texts: number in the text, leaf, hash, words."""

    def __init__(self, column: pa.Array):
        offsets, data = arrays.utf8(column)
        words = arrays.Words(offsets, data)
        hashes = words.hashes()
        flags = _DIGIT_OR_AT[data]
        flags[:-2] |= (data[:-2] == 58) & (data[1:-1] == 47) & (data[2:] == 47)
        seen = np.concatenate(([0], np.cumsum(flags)))
        self.field = seen[words.ends] > seen[words.starts]
        hashes[self.field] = _FIELD_HASH
        self.coded = hashes.view(np.int64)
        breaks = np.concatenate(([0], np.cumsum(data == 10)))
        text = np.repeat(np.arange(len(column)), np.diff(words.first))
        number = breaks[words.starts] - breaks[offsets[text]]
        change = np.ones(len(hashes), bool)
        change[1:] = (text[1:] != text[:-1]) | (number[1:] != number[:-1])
        self.lead = np.flatnonzero(change)
        self.sizes = np.diff(np.append(self.lead, len(hashes)))
        self.text, self.number = text[self.lead], number[self.lead]
        self.words, self.data = words, data
        self.first = np.searchsorted(self.text, np.arange(len(column) + 1))
        if len(hashes):
            place = np.arange(len(hashes)) - np.repeat(self.lead, self.sizes)
            weighted = hashes * arrays.places(int(self.sizes.max()))[place]
            self.hashes = arrays.mix(np.add.reduceat(weighted, self.lead)).view(np.int64)
            top = np.add.reduceat(np.where(place < DEPTH, weighted, np.uint64(0)), self.lead)
            count = self.sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            self.leaves = arrays.mix(top ^ arrays.mix(count)).view(np.int64) & -2 | (self.sizes > LONG_WORDS)  # the last bit: a long line
        else:
            self.hashes = self.leaves = np.zeros(0, np.int64)

    def once(self, leaves: np.ndarray) -> np.ndarray:
        """One line of each hash among those whose leaf is on the map."""
        chosen = np.flatnonzero(leaves[self.leaves >> 1 & (1 << MAP_BITS) - 1])
        return chosen[np.unique(self.hashes[chosen], return_index=True)[1]]

    def masked(self, i: int) -> str:
        out = []
        for w in range(int(self.lead[i]), int(self.lead[i] + self.sizes[i])):
            own = self.data[self.words.starts[w] : self.words.ends[w]]
            out.append(FIELD if self.field[w] else own.tobytes().decode())
        return " ".join(out)


_PLACED = "doc_id long, text_key long, numbers array<int>, leaves array<long>, hashes array<long>"


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in arrays.slices(batches, "text"):
        lines = Lines(part.column("text"))
        at = pa.array(lines.first.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                part.column("text_key"),
                pa.ListArray.from_arrays(at, pa.array(lines.number.astype(np.int32))),
                pa.ListArray.from_arrays(at, pa.array(lines.leaves)),
                pa.ListArray.from_arrays(at, pa.array(lines.hashes)),
            ],
            names=["doc_id", "text_key", "numbers", "leaves", "hashes"],
        )


def _map_of(leaves: DataFrame) -> np.ndarray:
    """A bit for each hash value of the leaves; at most 2 ** (MAP_BITS - 6) rows come to the driver."""
    bit = F.shiftright("leaf", 1).bitwiseAND((1 << MAP_BITS) - 1)
    rows = (
        leaves.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).cast("int").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits")).toPandas()
    )
    out = np.zeros(1 << MAP_BITS - 6, np.int64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out


def _unpacked(leaves: np.ndarray) -> np.ndarray:
    return np.unpackbits(leaves.view(np.uint8), bitorder="little").astype(bool)


def _coded(leaves: np.ndarray):
    """(leaf, line, words: hashes) of the lines whose leaf may be on the map, once for each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = _unpacked(leaves)
        for part in arrays.slices(batches, "text"):
            lines = Lines(part.column("text"))
            chosen = lines.once(on)
            sizes = lines.sizes[chosen]
            at = np.concatenate(([0], np.cumsum(sizes)))
            word = np.arange(at[-1]) + np.repeat(lines.lead[chosen] - at[:-1], sizes)
            words = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(lines.coded[word]))
            columns = [pa.array(lines.leaves[chosen]), pa.array(lines.hashes[chosen]), words]
            yield pa.RecordBatch.from_arrays(columns, names=["leaf", "line", "words"])

    return run


def _spelled(leaves: np.ndarray):
    """(leaf, line, masked) of the same lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = _unpacked(leaves)
        for part in arrays.slices(batches, "text"):
            lines = Lines(part.column("text"))
            chosen = lines.once(on)
            masked = pa.array([lines.masked(i) for i in chosen.tolist()], pa.string())
            columns = [pa.array(lines.leaves[chosen]), pa.array(lines.hashes[chosen]), masked]
            yield pa.RecordBatch.from_arrays(columns, names=["leaf", "line", "masked"])

    return run


def linked(lines: np.ndarray) -> np.ndarray:
    """Number of the first line of each line's template (rows: lines of one leaf, columns: words)."""
    n = lines.shape[1]
    first = np.arange(len(lines))
    left, rest = first.copy(), np.ascontiguousarray(lines.T)
    while len(left):
        root, reached = left[0], [left[0]]
        left, rest = left[1:], rest[:, 1:]
        while reached and len(left):
            near = np.count_nonzero(rest == lines[reached.pop()][:, None], axis=0) * 100 >= SIMILAR * n
            if near.any():
                first[left[near]] = root
                reached.extend(left[near].tolist())
                left, rest = left[~near], rest[:, ~near]
    return first


_LINKS = "leaf long, whole boolean, line long, first long"


def _link(group: pa.Table) -> pa.Table:
    """(leaf, whole, line, first) of the lines that are linked to an earlier line of their block."""
    group = group.combine_chunks()
    block = [group[c].to_numpy() for c in ("leaf", "key", "a", "b")]
    line, whole, words = group["line"].to_numpy(), group["whole"].to_numpy(zero_copy_only=False), group["words"].chunk(0)
    at, flat = words.offsets.to_numpy().astype(np.int64), words.values.to_numpy()
    order = np.lexsort((line, *reversed(block)))
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[order[1:]] != c[order[:-1]] for c in block], axis=0)
    starts = np.flatnonzero(new)
    leaf, firsts, later = [], [], []
    for rows in np.split(order, starts[1:]):
        n = int(at[rows[0] + 1] - at[rows[0]])
        table = flat[at[rows][:, None] + np.arange(n)]
        _, codes = np.unique(table, return_inverse=True)
        first = linked(codes.reshape(table.shape).astype(np.int32))
        moved = first != np.arange(len(rows))
        leaf.append(rows[moved])
        firsts.append(line[rows[first[moved]]])
    moved, firsts = np.concatenate(leaf), np.concatenate(firsts)
    return pa.table({"leaf": block[0][moved], "whole": whole[moved], "line": line[moved], "first": firsts})


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows (leaf, key, line, words, parts) once for each block that they are compared in."""
    own = F.pmod(F.xxhash64("line"), F.col("parts"))
    return (
        rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .where("parts = 1 OR other <> own")
        .select("leaf", "key", "whole", "line", "words", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    )


def templates_of(lines: DataFrame) -> DataFrame:
    """(leaf, line, first) of the distinct lines (leaf, line, words) that share a template with a smaller line hash."""
    spark = lines.sparkSession
    n, rows = F.col("n"), F.col("rows")
    parts = lambda: F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(rows * n / BLOCK_WORDS)).cast("long")
    sizes = Written(
        lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"), F.first(F.size("words")).cast("long").alias("n"), F.min("line").alias("first"))
        .withColumn("differ", F.expr(f"n * {100 - SIMILAR} div 100")).withColumn("parts", parts())
        .withColumn("alike", F.expr(f"differ >= n - {DEPTH}"))  # only the leading words must agree
        .withColumn("banded", F.expr("NOT alike AND parts > differ + 1")),
        "sizes",
    )
    held = lines.join(sizes.table, "leaf")
    alike = held.where("alike AND line <> first").select("leaf", "line", "first")
    compared = _blocks(
        held.where("NOT alike AND NOT banded").select("leaf", F.lit(0).cast("long").alias("key"), (F.col("parts") == 1).alias("whole"), "line", "words", "parts")
    )
    if not sizes.table.where("banded").isEmpty():
        tail = F.slice("words", DEPTH + 1, F.size("words") - DEPTH)
        band = held.where("banded").withColumn("band", F.explode(F.sequence(F.lit(0).cast("long"), "differ")))
        places = F.filter(tail, lambda w, i: F.pmod(i, F.col("differ") + 1) == F.col("band"))
        keyed = Written(band.select("leaf", F.xxhash64("band", places).alias("key"), "line", "words", "n"), "bands")
        crowd = keyed.table.groupBy("leaf", "key").agg(F.count(F.lit(1)).alias("rows"), F.first("n").alias("n")).where("rows > 1")
        crowd = crowd.select("leaf", "key", parts().alias("parts"))
        compared = compared.unionByName(_blocks(
            keyed.table.join(crowd, ["leaf", "key"]).select("leaf", "key", F.lit(False).alias("whole"), "line", "words", "parts")
        ))
    sent = sizes.table.where("NOT alike").agg(F.sum(rows * n * F.least("parts", F.col("differ") + 1))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sent // BLOCK_WORDS + 1)
    found = Written(
        compared.withColumn("task", F.pmod(F.xxhash64("leaf", "key", "a", "b"), F.lit(tasks))).groupBy("task").applyInArrow(_link, _LINKS),
        "links",
    ).table
    joined = alike.unionByName(found.where("whole").drop("whole"))
    parted = found.where("NOT whole")
    if parted.isEmpty():
        return joined
    node = lambda c: F.concat_ws(":", F.col("leaf").cast("string"), F.col(c).cast("string"))
    groups = components(parted.select(node("line").alias("a"), node("first").alias("b"))).select(
        "comp", F.split("node", ":")[0].cast("long").alias("leaf"), F.split("node", ":")[1].cast("long").alias("line")
    )
    firsts = groups.groupBy("comp").agg(F.min("line").alias("first"))
    return joined.unionByName(groups.join(firsts, "comp").where("line <> first").select("leaf", "line", "first"))


def recurring(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """The lines to drop, (doc_id, text_key, n_lines, dropped: line numbers), of every document, and the templates.

    Templates: leaf, template (smallest hash of its lines), n_docs, keeper (the document that
    keeps its lines), spelled (its words, ``<*>`` where its lines differ; computed on use).
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    placed = Written(texts.mapInArrow(_place, _PLACED).dropDuplicates(["doc_id", "text_key"]), "lines").table
    held = placed.select("doc_id", "text_key", F.explode(F.arrays_zip("numbers", "leaves", "hashes")).alias("x")).select(
        "doc_id", "text_key", F.col("x.numbers").alias("number"), F.col("x.leaves").alias("leaf"), F.col("x.hashes").alias("line")
    )
    holder = F.coalesce("doc_id", F.lit(NO_ID))
    least = F.when(F.col("leaf").bitwiseAND(1) == 1, LONG_DOCS).otherwise(min_docs)
    live = Written(
        held.groupBy("leaf").agg(
            F.count(F.lit(1)).alias("m"), (F.min(holder) < F.max(holder)).alias("shared"), (F.min("line") < F.max("line")).alias("several")
        )
        .where((F.col("m") >= least) & F.col("shared")).select("leaf", "several"),
        "leaves",
    )
    several = live.table.where("several").select("leaf")
    lines = Written(
        texts.select("text").mapInArrow(_coded(_map_of(several)), "leaf long, line long, words array<long>")
        .join(several, "leaf").groupBy("leaf", "line").agg(F.first("words").alias("words")),
        "words",
    )
    grown = Written(templates_of(lines.table), "grown")
    lines.drop()
    in_docs = Written(
        held.join(live.table, "leaf").join(grown.table, ["leaf", "line"], "left")
        .select("doc_id", "text_key", "number", "leaf", F.coalesce("first", "line").alias("template")),
        "held",
    )
    templates = Written(
        in_docs.table.groupBy("leaf", "template").agg(F.count_distinct(holder).alias("n_docs"), F.min("doc_id").alias("keeper"))
        .where(F.col("n_docs") >= least),
        "recurring",
    ).table
    dropped = Written(
        in_docs.table.join(templates, ["leaf", "template"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias("d_id"), F.col("text_key").alias("d_key"))
        .agg(F.collect_set("number").alias("dropped")),
        "dropped",
    ).table
    for spent in (in_docs, live):
        spent.drop()
    same = F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("text_key") == F.col("d_key"))
    judged = placed.join(dropped, same, "left").select(
        "doc_id", "text_key", F.size("numbers").cast("long").alias("n_lines"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )
    words = (
        texts.select("text").mapInArrow(_spelled(_map_of(templates)), "leaf long, line long, masked string")
        .join(grown.table, ["leaf", "line"], "left")
        .select("leaf", F.coalesce("first", "line").alias("template"), F.posexplode(F.split("masked", " ")).alias("place", "word"))
        .join(templates.select("leaf", "template"), ["leaf", "template"])
        .groupBy("leaf", "template", "place").agg(F.min("word").alias("word"), F.max("word").alias("last"))
        .select("leaf", "template", F.struct("place", F.when(F.col("word") == F.col("last"), F.col("word")).otherwise(FIELD).alias("word")).alias("x"))
        .groupBy("leaf", "template").agg(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x.word), " ").alias("spelled"))
    )
    return judged, templates.join(words, ["leaf", "template"])


def _strip(text_at: int, dropped_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            for i, gone in enumerate(batch.column(dropped_at).to_pylist()):
                if gone:
                    out = set(gone)
                    texts[i] = "\n".join(x for k, x in enumerate(texts[i].split("\n")) if k not in out)
            columns = [c for k, c in enumerate(batch.columns) if k != dropped_at]
            columns[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=[n for k, n in enumerate(batch.schema.names) if k != dropped_at])

    return run


def clean(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """All documents with their own columns, without the recurring lines; then n_lines and n_dropped of each."""
    judged, _ = recurring(docs, min_docs)
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = dict(zip(docs.columns, names))
    same = F.col(own["doc_id"]).cast("long").eqNullSafe(F.col("doc_id")) & (F.xxhash64(own["text"]) == F.col("text_key"))
    plain = docs.toDF(*names)
    joined = plain.join(judged, same).select(*names, "n_lines", F.size("dropped").cast("long").alias("n_dropped"), "dropped")
    schema = joined.drop("dropped").schema
    return joined.mapInArrow(_strip(docs.columns.index("text"), len(names) + 2), schema).toDF(*docs.columns, "n_lines", "n_dropped")
