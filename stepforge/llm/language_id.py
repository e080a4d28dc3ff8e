"""Language identification: multinomial naive Bayes over hashed character n-grams.

Features are the runs of one to three characters of the lower-cased letters of a text,
with every stretch of other characters as one blank; they are hashed into ``BUCKETS``.
Counts by language are summed over all learning documents, in parts of the buckets, so
no task holds more than a part of every language.  The matrix of log probabilities
(languages x buckets) is broadcast: its size is checked against ``MODEL_BYTES``.
Whole texts are scored in numpy, each slice as a sparse matrix of documents by buckets.

Defined results: null texts, and texts without a letter, are ``und`` with score 0; so is
every text if there is nothing to learn from; ties go to the first language by name;
rows are scored each for itself, repeated or not; documents with a null id are scored
and not learned from; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge.llm import arrays
from stepforge.storage import materialize

BUCKETS = 1 << 16
PARTS = 16
SMOOTHING = 0.5
WIDTHS = (1, 2, 3)
MODEL_BYTES = 256 << 20
SLICE_BYTES = 1 << 20
HELD_LANGS = 32  # languages a task counts before it hands the counts on
UNKNOWN = "und"

_FACTOR = (arrays.stream(3, 71) | np.uint64(1)).astype(np.uint32)
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """By code point: the lower-case letter, or 0 for anything that is no letter."""
    global _letters
    if _letters is None:
        table = np.zeros(0x110000, np.uint32)
        for point in range(0x110000):
            if (c := chr(point)).isalpha():
                small = c.lower()
                table[point] = ord(small) if len(small) == 1 else point
        _letters = table
    return _letters


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and bucket of every n-gram, and by text whether it has a letter."""
    offsets, data = arrays.utf8(column)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    sizes = np.diff(lead[offsets])
    text = np.repeat(np.arange(len(column)), sizes)
    chars = letters()[points]
    kept = chars > 0
    if len(chars):
        after = np.zeros(len(chars), bool)  # the first other character behind a letter stays, as a blank
        after[1:] = kept[:-1] & ~kept[1:]
        first = np.ones(len(chars), bool)
        first[1:] = text[1:] != text[:-1]
        kept = kept | (after & ~first)
    chars, text = chars[kept], text[kept]
    has_letter = np.zeros(len(column), bool)
    has_letter[text[chars > 0]] = True
    texts, buckets = [], []
    for width in WIDTHS:
        n = len(chars) - width + 1
        if n <= 0:
            continue
        value = np.full(n, np.uint32(0x9E3779B1 * width & 0xFFFFFFFF), np.uint32)
        filled = np.zeros(n, bool)
        for k in range(width):
            value += (chars[k : k + n] + np.uint32(1)) * _FACTOR[k]
            filled |= chars[k : k + n] > 0
        value = (value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        value = (value ^ (value >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        inside = filled & (text[:n] == text[width - 1 :])
        texts.append(text[:n][inside])
        buckets.append((value >> np.uint32(16))[inside].astype(np.int64))
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has_letter
    return np.concatenate(texts), np.concatenate(buckets), has_letter


_COUNTS = "lang string, part int, counts array<long>"


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}

    def handed() -> pa.RecordBatch:
        rows = [(lang, p, c) for lang, total in held.items() for p, c in enumerate(total.reshape(PARTS, -1))]
        rows += [(lang, -1, np.array([n], np.int64)) for lang, n in docs.items()]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.string()),
                pa.array([r[1] for r in rows], pa.int32()),
                pa.array([r[2] for r in rows], pa.list_(pa.int64())),
            ],
            names=["lang", "part", "counts"],
        )

    for part in arrays.slices(batches, "text", SLICE_BYTES):
        text, bucket, has_letter = features(part.column("text"))
        langs = np.array(part.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs[has_letter].tolist())):
            own = langs == lang
            counts = np.bincount(bucket[own[text]], minlength=BUCKETS)
            held[lang] = held[lang] + counts if lang in held else counts
            docs[lang] = docs.get(lang, 0) + int((own & has_letter).sum())
        if len(held) > HELD_LANGS:
            yield handed()
            held, docs = {}, {}
    yield handed()


def _sum(group: pa.Table) -> pa.Table:
    total = np.zeros(0, np.int64)
    for counts in group["counts"]:
        own = counts.values.to_numpy()
        total = total + own if len(total) else own
    return pa.table(
        {"lang": group["lang"][:1], "part": group["part"][:1], "counts": pa.array([total], pa.list_(pa.int64()))}
    )


@dataclass
class Model:
    langs: list[str]
    prior: np.ndarray
    weights: np.ndarray  # buckets x languages, log probabilities


def learn(docs: DataFrame) -> Model:
    """Learn from all documents (text, lang) with a language and a letter."""
    counted = (
        docs.where("lang IS NOT NULL").select("text", F.col("lang").cast("string").alias("lang"))
        .mapInArrow(_learn, _COUNTS)
        .groupBy("lang", "part").applyInArrow(_sum, _COUNTS)
    )
    summed = materialize(counted, "language-counts")
    langs = [r["lang"] for r in summed.where("part = -1").select("lang").orderBy("lang").toLocalIterator()]
    if len(langs) * BUCKETS * 8 > MODEL_BYTES:
        raise ValueError(f"{len(langs)} languages make a model of more than {MODEL_BYTES} bytes")
    counts = np.zeros((len(langs), BUCKETS))
    docs_of = np.zeros(len(langs))
    number = {lang: i for i, lang in enumerate(langs)}
    width = BUCKETS // PARTS
    for row in summed.toLocalIterator():
        if row["part"] < 0:
            docs_of[number[row["lang"]]] = row["counts"][0]
        else:
            counts[number[row["lang"]], row["part"] * width : (row["part"] + 1) * width] = row["counts"]
    total = counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS
    weights = np.log((counts + SMOOTHING) / total) if langs else counts
    return Model(langs, np.log(docs_of / docs_of.sum()) if langs else docs_of, np.ascontiguousarray(weights.T, np.float32))


def posteriors(model: Model, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of the best language (-1: unknown) and its posterior, by text."""
    text, bucket, has_letter = features(column)
    n = len(column)
    if not model.langs or not len(text):
        return np.full(n, -1), np.zeros(n)
    cells = np.sort(text * BUCKETS + bucket)
    at = np.concatenate(([0], np.flatnonzero(cells[1:] != cells[:-1]) + 1, [len(cells)]))
    cell, times = cells[at[:-1]], np.diff(at)
    row = cell // BUCKETS
    lead = np.concatenate(([0], np.flatnonzero(row[1:] != row[:-1]) + 1))
    total = np.add.reduceat(model.weights[cell % BUCKETS] * times[:, None].astype(np.float64), lead, axis=0) + model.prior
    best = total.argmax(axis=1)
    share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    langs, scores = np.full(n, -1), np.zeros(n)
    langs[row[lead]], scores[row[lead]] = best, share
    langs[~has_letter], scores[~has_letter] = -1, 0.0
    return langs, scores


def predict(docs: DataFrame, model: Model, passed: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``passed`` columns with lang_pred and score, from the texts alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*passed, "text")
    names = [*passed, "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        called = np.array([*model.langs, UNKNOWN], dtype=object)
        limit = max(1 << 16, min(SLICE_BYTES, SLICE_BYTES * 16 // max(1, len(model.langs))))
        for part in arrays.slices(batches, "text", limit):
            langs, scores = posteriors(model, part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in passed], pa.array(called[langs], pa.string()), pa.array(scores)], names=names
            )

    schema = kept.drop("text").schema.add("lang_pred", "string").add("score", "double")
    return kept.mapInArrow(run, schema)


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the key as text falls into the fold; a null key doesn't."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(folds)) == fold, F.lit(False))
