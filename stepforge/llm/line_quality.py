"""Quality rules by cross-document line frequency.

Lines are normalised (A-Z lower-cased, white space collapsed) and hashed; for each
host the distinct documents that hold a line are counted.  A line held by more than
``HOST_SHARE`` of its host's documents (``FEW_DOCS`` at least, ``max_line_docs`` at
most) is boilerplate: it is removed from all of them but the one with the smallest
id, so no content is lost altogether.  A document
left with fewer than ``min_words`` words, or with less than ``min_left`` of its
words, is depleted and rejected.  Documents that fail the base rules (too few words,
too many words in repeated 5-word windows) are rejected at once.

Defined results: a null text has no words and fails the base rules; a null host is a
host of its own; rows with the same id and host count as one document in the line
counts, and each gets its own verdict; rows with a null id count for no line and
lose every boilerplate line; an empty table gives an empty table; extra columns, of
any name, are passed by in ``judge`` and kept in ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepforge.llm import arrays
from stepforge.storage import materialize

MAX_LINE_DOCS = 100
FEW_DOCS = 5
HOST_SHARE = 0.02
MIN_LEFT = 0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SLICE_BYTES = 1 << 20

_SYMBOL = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])
_METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCHEMA = ("doc_id long, host string, text_hash long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           "n_repeat_words long, line_hashes array<long>, line_words array<long>")


def repeated_words(grams: np.ndarray, n_words: int, width: int = arrays.SHINGLE) -> int:
    """Words inside windows whose content occurs twice or more among ``grams``."""
    if len(grams) < 2:
        return 0
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    equal = ranked[1:] == ranked[:-1]
    if not equal.any():
        return 0
    twice = np.zeros(len(grams), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    at = np.flatnonzero(twice)
    edge = np.zeros(n_words + width, np.int64)
    edge[at] += 1
    edge[at + width] -= 1
    return int((np.cumsum(edge) > 0).sum())


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in arrays.slices(batches, "text", SLICE_BYTES):
        offsets, data = arrays.utf8(part.column("text"))
        n = part.num_rows
        words = arrays.Words(offsets, arrays.lowered(data))
        cased = arrays.Words(offsets, data).hashes()
        hashes = words.hashes()
        lines = arrays.Words(offsets, data, arrays.NEWLINE)
        raw = lines.hashes()
        lead = np.searchsorted(words.starts, lines.starts)
        sizes = np.searchsorted(words.starts, lines.ends) - lead
        filled = sizes > 0
        raw, lead, sizes = raw[filled], lead[filled], sizes[filled]
        line_of_text = np.concatenate(([0], np.cumsum(filled)))[lines.first]
        if len(lead):
            factor = arrays.places(int(sizes.max()))
            place = np.arange(len(hashes)) - np.repeat(lead, sizes)
            normal = arrays.mix(np.add.reduceat(hashes * factor[place], lead))
        else:
            normal = np.zeros(0, np.uint64)
        points = (data & 0xC0) != 0x80
        grams = arrays.Words.grams(words, cased)
        counts = np.diff(words.first)
        repeats, doubles = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for i in range(n):
            a, b = int(words.first[i]), int(words.first[i + 1])
            if b - a > arrays.SHINGLE:
                repeats[i] = repeated_words(grams[a : b - arrays.SHINGLE + 1], b - a)
            c, d = int(line_of_text[i]), int(line_of_text[i + 1])
            doubles[i] = d - c - len(set(raw[c:d].tolist()))
        lists = pa.array(line_of_text.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                part.column("host"),
                part.column("text_hash"),
                pa.array(counts.astype(np.int64)),
                pa.array(arrays.per_text(points & words.inner, offsets)),
                pa.array(arrays.per_text(_SYMBOL[data], offsets)),
                pa.array(doubles),
                pa.array(repeats),
                pa.ListArray.from_arrays(lists, pa.array(normal.view(np.int64))),
                pa.ListArray.from_arrays(lists, pa.array(sizes.astype(np.int64))),
            ],
            names=["doc_id", "host", "text_hash", *_METRICS, "line_hashes", "line_words"],
        )


def judge(docs: DataFrame, host: str = "source", max_line_docs: int = MAX_LINE_DOCS,
          min_left: float = MIN_LEFT, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document row: doc_id, host, text_hash, the five metrics, n_removed_words,
    removed (line hashes), base_failed, kept.
    """
    measured = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col(host).cast("string").alias("host"),
            F.xxhash64("text").alias("text_hash"),
            "text",
        )
        .mapInArrow(_measure, _SCHEMA),
        "measured",
    )
    held = measured.select("doc_id", "host", F.explode(F.array_distinct("line_hashes")).alias("line"))
    sizes = measured.groupBy(F.col("host").alias("sized_host")).agg(F.count_distinct("doc_id").alias("host_docs"))
    most = F.least(F.lit(max_line_docs), F.greatest(F.lit(FEW_DOCS), F.col("host_docs") * HOST_SHARE))
    common = (
        held.groupBy("host", "line")
        .agg(F.count_distinct("doc_id").alias("n_docs"), F.min("doc_id").alias("keeper"))
        .where(F.col("n_docs") > min(FEW_DOCS, max_line_docs))
        .join(sizes, F.col("host").eqNullSafe(F.col("sized_host")))
        .where(F.col("n_docs") > most)
        .select(F.col("host").alias("common_host"), F.col("line").alias("common_line"), "keeper")
    )
    removed = (
        held.join(common, (F.col("line") == F.col("common_line")) & F.col("host").eqNullSafe(F.col("common_host")))
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias("removed_id"), F.col("host").alias("removed_host"))
        .agg(F.collect_set("line").alias("removed"))
    )
    joined = measured.join(
        removed,
        F.col("doc_id").eqNullSafe(F.col("removed_id")) & F.col("host").eqNullSafe(F.col("removed_host")),
        "left",
    ).withColumn("removed", F.coalesce("removed", F.array().cast("array<long>")))
    lost = F.aggregate(
        F.arrays_zip("line_hashes", "line_words"),
        F.lit(0).cast("long"),
        lambda total, x: total + F.when(F.array_contains("removed", x["line_hashes"]), x["line_words"]).otherwise(0),
    )
    left = F.col("n_words") - F.col("n_removed_words")
    return (
        joined.withColumn("n_removed_words", F.when(F.size("removed") > 0, lost).otherwise(F.lit(0).cast("long")))
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
        .withColumn("kept", ~F.col("base_failed") & (left >= min_words) & (left >= min_left * F.col("n_words")))
        .select("doc_id", "host", "text_hash", *_METRICS, "n_removed_words", "removed", "base_failed", "kept")
    )


def _strip(text_at: int, removed_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            for i, gone in enumerate(batch.column(removed_at).to_pylist()):
                if gone:
                    texts[i] = without_lines(texts[i], set(gone))
            columns = [c for k, c in enumerate(batch.columns) if k != removed_at]
            columns[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                columns, names=[n for k, n in enumerate(batch.schema.names) if k != removed_at]
            )

    return run


def line_hashes(lines: list[str]) -> list[int]:
    """Hash of each normalised line (as in ``judge``)."""
    offsets, data = arrays.utf8(pa.array(lines, pa.string()))
    words = arrays.Words(offsets, arrays.lowered(data))
    hashes, out = words.hashes(), []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        total = (hashes[a:b] * arrays.places(b - a)[: b - a]).sum(dtype=np.uint64)
        out.append(int(arrays.mix(np.array([total], np.uint64)).view(np.int64)[0]))
    return out


def without_lines(text: str, removed: set[int]) -> str:
    lines = text.split("\n")
    return "\n".join(x for x, h in zip(lines, line_hashes(lines)) if not x.strip(" \t\n\v\f\r") or h not in removed)


def clean(docs: DataFrame, **options) -> DataFrame:
    """The kept documents with their own columns; boilerplate lines are gone from the texts."""
    host = options.get("host", "source")
    verdicts = (
        judge(docs, **options)
        .where("kept")
        .groupBy(F.col("doc_id").alias("v_id"), F.col("host").alias("v_host"), F.col("text_hash").alias("v_hash"))
        .agg(F.first("removed").alias("removed"))
    )
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    own = dict(zip(docs.columns, names))
    same = (
        F.col(own["doc_id"]).cast("long").eqNullSafe(F.col("v_id"))
        & F.col(own[host]).cast("string").eqNullSafe(F.col("v_host"))
        & (F.xxhash64(own["text"]) == F.col("v_hash"))
    )
    kept = plain.join(verdicts, same).select(*names, "removed")
    return kept.mapInArrow(_strip(docs.columns.index("text"), len(names)), plain.schema).toDF(*docs.columns)
