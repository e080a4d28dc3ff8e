"""Benchmark decontamination: rare word pairs seed Smith-Waterman alignments.

Texts are read as words (A-Z lower-cased; ASCII white space and punctuation separate).
An alignment scores match +2, mismatch and gap -1; its score is the share of a perfect
one.  A passage is a copy of an item, edited or not, from ``MIN_SCORE`` on, and of a
short item only if it is worth ``WORTH`` words (or all of the item).

Seeds lose no copy.  With m words in the item and least points p, an alignment of k
matches has at most 2k - p errors, so at least k - (2k - p) - 1 >= p - m - 1 = b of its
matches follow a match: b of the item's word pairs stand in the text unbroken.  So any
m - b of its m - 1 pairs hold one of them, and the rarest are taken, by the number of
documents that hold a pair.  Around each seed in a text lies a window of bounded length
that any alignment through the seed stays in; windows that hold too few of the item's
words are passed by, the others are aligned in two rows of memory.

The items are broadcast in blocks of at most ``BLOCK_BYTES`` of text; a larger
benchmark is taken block by block, each against all documents.  Nothing but the pairs'
counts is shuffled.

Defined results: null or empty texts match nothing; items of fewer than three words are
no evidence and match nothing; texts of any length are read whole; items or documents
that occur twice are matched twice; an empty table on either side gives no match; extra
columns are ignored by ``matches`` and kept by ``clean``; null ids are carried along.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepforge.llm import arrays
from stepforge.storage import materialize

WIDTH = 2
LEAST_WORDS = 3
MIN_SCORE = 0.6
WORTH = 5
BLOCK_BYTES = 4 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
SLICE_BYTES = 1 << 20
MERGED = 6  # windows of seeds are aligned together up to so many times the item's length

APART = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def least_points(m: int, min_score: float) -> float:
    """Points that make an alignment with an item of ``m`` words a copy."""
    return max(MATCH * min_score * m, min(MATCH * m, MATCH * WORTH))


def unbroken(m: int, min_score: float) -> int:
    """Word pairs of the item that stand unbroken in every copy, at least."""
    return math.ceil(least_points(m, min_score) - m - 1 - 1e-9)


@dataclass
class Items:
    """Items of one block: their word hashes and pairs, and the pairs' sorted distinct hashes with their items."""

    ids: list
    words: list[np.ndarray]
    pairs: list[np.ndarray]
    seeds: np.ndarray
    owners: list[list[int]]  # by seed: the items that it is a seed of

    def rarest(self, counts: dict[int, int], min_score: float) -> "Items":
        """The same with as many of the rarest pairs as seeds as lose no copy."""
        kept = []
        for words, pairs in zip(self.words, self.pairs):
            order = sorted(pairs.tolist(), key=lambda g: (counts.get(g, 0), g))
            kept.append(np.array(order[: len(words) - unbroken(len(words), min_score)] if len(words) >= LEAST_WORDS else [], np.uint64))
        return Items(self.ids, self.words, self.pairs, *_owned(kept))


def _owned(chosen: list[np.ndarray]) -> tuple[np.ndarray, list[list[int]]]:
    held: dict[int, list[int]] = {}
    for i, pairs in enumerate(chosen):
        for g in np.unique(pairs).tolist():
            held.setdefault(g, []).append(i)
    seeds = np.array(sorted(held), np.uint64)
    return seeds, [held[g] for g in seeds.tolist()]


def read_items(ids: list, texts: list) -> Items:
    offsets, data = arrays.utf8(pa.array(texts, pa.string()))
    words = arrays.Words(offsets, arrays.lowered(data), APART)
    hashes = words.hashes()
    bounds = list(zip(words.first[:-1].tolist(), words.first[1:].tolist()))
    grams = words.grams(hashes, WIDTH)
    pairs = [grams[a : b - 1] if b - a >= LEAST_WORDS else grams[:0] for a, b in bounds]
    return Items(ids, [hashes[a:b] for a, b in bounds], pairs, *_owned(pairs))


def align(item: np.ndarray, part: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment: share of a perfect score, first and last + 1 word of ``part`` in it.

    Rows go over the item's words; gaps along a row are closed by a running maximum.
    Each cell carries the place its alignment began at, so two rows are all that is held.
    """
    m, n = len(item), len(part)
    place = np.arange(n + 1)
    ramp = (place * -GAP).astype(np.int32)
    above, begin = np.zeros(n + 1, np.int32), place.copy()
    best = (0, 0, 0)
    for word in item:
        row, start = above + GAP, begin.copy()
        across = above[:-1] + np.where(part == word, MATCH, MISMATCH)
        closer = across >= row[1:]
        row[1:] = np.where(closer, across, row[1:])
        start[1:] = np.where(closer, begin[:-1], start[1:])
        empty = row <= 0
        row[empty], start[empty] = 0, place[empty]
        level = row + ramp
        top = np.maximum.accumulate(level)
        # the last place up to here that reached the maximum by itself
        source = np.maximum.accumulate(np.where(level == top, place, 0))
        above, begin = (top - ramp).astype(np.int32), start[source]
        end = int(above.argmax())
        if above[end] > best[0]:
            best = (int(above[end]), int(begin[end]), end)
    return best[0] / (MATCH * m), best[1], best[2]


def _hits(part: pa.RecordBatch, seeds: np.ndarray, near: np.ndarray):
    """Per text with seeds: its number, word hashes, seed positions and seed numbers."""
    offsets, data = arrays.utf8(part.column("text"))
    words = arrays.Words(offsets, arrays.lowered(data), APART)
    hashes = words.hashes()
    grams = words.grams(hashes, WIDTH)
    at = np.flatnonzero(near[(grams >> np.uint64(44)).astype(np.int64)])
    if not len(at):
        return
    which = np.minimum(np.searchsorted(seeds, grams[at]), len(seeds) - 1)
    hit = seeds[which] == grams[at]
    at, which = at[hit], which[hit]
    text = np.searchsorted(words.first, at, side="right") - 1
    inside = at + WIDTH <= words.first[text + 1]
    at, which, text = at[inside], which[inside], text[inside]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(text)) + 1, [len(text)])).astype(int)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b > a:
            t = int(text[a])
            lead = int(words.first[t])
            yield t, hashes[lead : int(words.first[t + 1])], at[a:b] - lead, which[a:b]


def _near(seeds: np.ndarray) -> np.ndarray:
    near = np.zeros(1 << 20, bool)
    near[(seeds >> np.uint64(44)).astype(np.int64)] = True
    return near


def windows(at: np.ndarray, m: int, min_score: float, n: int) -> Iterator[tuple[int, int]]:
    """Parts of a text of ``n`` words around the seeds at the sorted places ``at``.

    An alignment through a seed covers ``m`` words of the item and at most 2m - p gaps,
    so it stays within ``reach`` words.  Each seed's surroundings lie whole in a part.
    """
    reach = m + int(MATCH * m - least_points(m, min_score)) + WIDTH
    begin, end = None, 0
    for p in at.tolist():
        if begin is not None and p + reach - begin > MERGED * m + 2 * reach:
            yield begin, end
            begin = None
        if begin is None:
            begin = max(0, p - reach)
        end = min(n, p + reach)
    if begin is not None:
        yield begin, end


def passages(words: np.ndarray, at: np.ndarray, item: np.ndarray, min_score: float) -> Iterator[tuple[float, int, int]]:
    """Alignments (score, begin, end) that make a copy of the item, at most one for each window."""
    m = len(item)
    least = least_points(m, min_score) / MATCH
    for begin, end in windows(at, m, min_score, len(words)):
        if np.isin(item, words[begin:end]).sum() < least - 1e-9:
            continue
        score, first, last = align(item, words[begin:end])
        if score * m >= least - 1e-9:
            yield score, begin + first, begin + last


def _counts(texts: DataFrame, items: Items) -> dict[int, int]:
    """Documents that hold each of the block's pairs; as many numbers as the block has pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, total = _near(items.seeds), np.zeros(len(items.seeds), np.int64)
        for part in arrays.slices(batches, "text", SLICE_BYTES):
            for _, _, _, which in _hits(part, items.seeds, near):
                total[np.unique(which)] += 1
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["seed", "n"])

    counted = texts.select("text").mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    return {int(items.seeds[r.seed]): r.n for r in counted.collect()}


_MATCHES = "row_key long, doc_id long, item_id long, score double, first_word long, end_word long, n_seeds long"


def _match(items: Items, min_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = _near(items.seeds)
        for part in arrays.slices(batches, "text", SLICE_BYTES):
            found = []
            for t, words, at, which in _hits(part, items.seeds, near):
                by_item: dict[int, list[int]] = {}
                for k, seed in enumerate(which.tolist()):
                    for i in items.owners[seed]:
                        by_item.setdefault(i, []).append(k)
                for i, places in by_item.items():
                    best = max(passages(words, at[places], items.words[i], min_score), default=None)
                    if best:
                        found.append((part.column("row_key")[t].as_py(), part.column("doc_id")[t].as_py(), items.ids[i],
                                      *best, len(set(which[places].tolist()))))
            columns = list(zip(*found)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["row_key", "doc_id", "item_id", "score", "first_word", "end_word", "n_seeds"],
            )

    return run


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items in blocks of bounded size; each block is read by its own query."""
    sized = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), "text", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")
    )
    total = sized.agg(F.sum("size")).first()[0] or 0
    blocks = int(total) // BLOCK_BYTES + 1
    for k in range(blocks):
        rows = sized.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).select("item_id", "text").toPandas()
        yield read_items(
            [None if x != x else int(x) for x in rows["item_id"].tolist()], [x or "" for x in rows["text"].tolist()]
        )


def matches(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word, n_seeds, row_key) of every copied item.

    ``row_key`` hashes the document's text: it tells rows of one id apart.  Of several
    copies in a document the best is told.
    """
    if min_score <= 0.5:
        raise ValueError("below a score of 0.5 an alignment may hold no unbroken word pair")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("row_key"))
    found = docs.sparkSession.createDataFrame([], _MATCHES)
    for items in _blocks(benchmark):
        if not len(items.seeds):
            continue
        rare = items.rarest(_counts(texts, items), min_score)
        found = found.unionByName(texts.mapInArrow(_match(rare, min_score), _MATCHES))
    return found


def clean(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents without a copied item, with their own columns."""
    found = materialize(matches(docs, benchmark, min_score), "matches")
    hit = found.select(F.col("doc_id").alias("hit_id"), "row_key").distinct()
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = dict(zip(docs.columns, names))
    plain = docs.toDF(*names)
    same = F.col(own["doc_id"]).cast("long").eqNullSafe(F.col("hit_id")) & (F.xxhash64(own["text"]) == F.col("row_key"))
    return plain.join(hit, same, "left_anti").toDF(*docs.columns)
