"""Token ids in files: frequency-ranked, in variable-length bytes with separate control bytes.

Within a file ids are replaced by their frequency rank (0: the file's most frequent id),
so most of them fit one byte; the file starts with its table of ranks and can be read
alone.  Values are stored as two runs of bytes: control bytes hold, for four values
each, two bits with the length - 1 of every value; data bytes hold the values,
little-endian.  Decoding looks the control bytes up in a table of lengths, all in
numpy.  A file is one row of a Parquet table in the shared folder, written by Spark's
committer, so a lost executor leaves no half file and any store works:

    magic "SFT1" | u32 ids in the rank table | u64 values | ids by rank (u32)
    | control bytes | data bytes

beside the columns ``doc_ids`` and ``lengths`` of the documents it holds.

Defined results: a null text is empty and yields the end id alone; texts of any length
are encoded whole; rows with the same doc_id stay separate rows, next to each other;
a null doc_id sorts first; an empty table gives no file; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepforge.llm import arrays
from stepforge.storage import materialize

END_ID = 2
MEMO_WORDS = 400_000  # encoded words a worker remembers; the memo is emptied beyond it
SLICE_BYTES = 8 << 20
FILE_VALUES = 1 << 22  # values after which a file ends
_HEAD = struct.Struct("<4sIQ")

# By control byte: the lengths of its four values and the offset behind each.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
_TOTAL = _LENGTHS.sum(axis=1).astype(np.int64)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of uint32 values."""
    values = np.ascontiguousarray(values, "<u4")
    lengths = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = lengths - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    taken = np.arange(4, dtype=np.uint8) < lengths[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[taken].tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values behind control and data bytes."""
    codes = np.frombuffer(control, np.uint8)
    lengths = _LENGTHS[codes].reshape(-1)[:n]
    out = np.zeros((n, 4), np.uint8)
    out[np.arange(4, dtype=np.uint8) < lengths[:, None]] = np.frombuffer(data, np.uint8)
    return out.reshape(-1).view("<u4")


def pack(ids: np.ndarray) -> bytes:
    """A whole file of the given ids."""
    counts = np.bincount(ids)
    used = np.flatnonzero(counts)
    by_rank = used[np.argsort(-counts[used], kind="stable")]
    rank_of = np.zeros(len(counts), np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    control, data = encode_values(rank_of[ids])
    return _HEAD.pack(b"SFT1", len(by_rank), len(ids)) + by_rank.astype("<u4").tobytes() + control + data


def unpack(file: bytes) -> np.ndarray:
    """The ids of a file; ValueError if it is not whole."""
    magic, ranks, n = _HEAD.unpack_from(file)
    if magic != b"SFT1":
        raise ValueError("not a token file")
    table_end = _HEAD.size + 4 * ranks
    data_at = table_end + -(-n // 4)
    control = file[table_end:data_at]
    if len(file) - data_at != int(_LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n].sum()):
        raise ValueError("token file is cut")
    return np.frombuffer(file[_HEAD.size : table_end], "<u4")[decode_values(control, file[data_at:], n)]


_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
_MARK = np.isin(np.arange(256), [ord(c) for c in ".,;:!?#*$%&>"])
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """The tokenizer's printable stand-ins of bytes: printable Latin-1 stays, the rest moves up from 256."""
    shown = [b for b in range(256) if chr(b).isprintable() and b != 32]
    moved = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(moved)}


class Encoder:
    """Encodes texts word by word with a tokenizer of the tokenizers library.

    The tokenizer drops white space and never joins across it, nor across the place
    between a letter and the marks above, so a text's ids are those of its words in
    order; a distinct word is encoded once.  Words of plain letters go to the
    tokenizer's model directly, all others through its whole chain.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.stand_ins = _byte_letters()
        self.memo: dict[str, bytes] = {}

    def _encode(self, words: list[str]) -> list[bytes]:
        out, rest = [b""] * len(words), []
        for i, word in enumerate(words):
            if _PLAIN.fullmatch(word):
                small = word.lower()
                shown = small if small.isascii() else small.encode().decode("latin-1").translate(self.stand_ins)
                out[i] = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            else:
                rest.append(i)
        found = self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)
        for i, e in zip(rest, found):
            out[i] = array("I", e.ids).tobytes()
        return out

    def _parts(self, words: list[str]) -> list[bytes]:
        """The ids of each of the distinct words."""
        parts = [self.memo.get(x) for x in words]
        missing = [i for i, x in enumerate(parts) if x is None]
        new = [words[i] for i in missing]
        for i, ids in zip(missing, self._encode(new)):
            parts[i] = ids
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo.clear()
        if len(new) <= MEMO_WORDS:
            self.memo.update((words[i], parts[i]) for i in missing)
        return parts

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and the number of each text's."""
        offsets, data = arrays.utf8(column)
        cut = np.flatnonzero(_LETTER[data[:-1]] & _MARK[data[1:]]) + 1
        cut = cut[~np.isin(cut, offsets)]
        spread = np.insert(data, cut, np.uint8(32))
        spread[spread == 10] = 32
        places = (offsets + np.searchsorted(cut, offsets)).astype(np.int64)
        texts = pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(places), pa.py_buffer(spread))
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        parts = self._parts(coded.dictionary.to_pylist())
        table = np.frombuffer(b"".join(parts), np.uint32)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        which = coded.indices.to_numpy()
        lead, each = np.cumsum(sizes) - sizes, sizes[which]
        total = np.concatenate(([0], np.cumsum(each)))
        at = np.arange(total[-1]) + np.repeat(lead[which] - total[:-1], each)
        first = lists.offsets.to_numpy().astype(np.int64)
        return table[at], np.diff(total[first - first[0]])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process, so that its memo serves later tasks too."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _with_end(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.full(len(ids) + len(counts), END_ID, np.uint32)
    inner = np.ones(len(out), bool)
    inner[np.cumsum(counts + 1) - 1] = False
    out[inner] = ids
    return out


_FILES = "place int, part long, doc_ids array<long>, lengths array<long>, file binary"


def _write(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_no, held, size, place = 0, [], 0, 0
        for part in arrays.slices(batches, "text", SLICE_BYTES):
            ids, counts = encoder(path).ids(part.column("text"))
            held.append((part.column("doc_id").to_pylist(), counts + 1, _with_end(ids, counts)))
            place = part.column("place")[0].as_py()
            size += len(held[-1][2])
            if size >= FILE_VALUES:
                yield _file(place, part_no, held)
                part_no, held, size = part_no + 1, [], 0
        if held:
            yield _file(place, part_no, held)

    return run


def _file(place: int, part_no: int, held: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([place], pa.int32()),
            pa.array([part_no], pa.int64()),
            pa.array([[x for d, _, _ in held for x in d]], pa.list_(pa.int64())),
            pa.array([np.concatenate([c for _, c, _ in held])], pa.list_(pa.int64())),
            pa.array([pack(np.concatenate([i for _, _, i in held]))], pa.binary()),
        ],
        names=["place", "part", "doc_ids", "lengths", "file"],
    )


def write(docs: DataFrame, path: str) -> DataFrame:
    """Encode and write all texts in ascending doc_id order.

    Returns the files: place, part, doc_ids, lengths, file; ordered by place, then part.
    """
    spark = docs.sparkSession
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(
            int(spark.conf.get("spark.sql.shuffle.partitions")), F.col("doc_id").asc_nulls_first()
        )
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first())
        .withColumn("place", F.spark_partition_id())
    )
    return materialize(ordered.mapInArrow(_write(path), _FILES), "tokens")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(row["file"])
            lengths = np.array(row["lengths"], np.int64)
            start = np.cumsum(lengths) - lengths
            crcs = [zlib.crc32(ids[a : a + n]) for a, n in zip(start.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(start + row["base"]),
                    pa.array(lengths),
                    pa.array(crcs, pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_index(files: DataFrame) -> DataFrame:
    """Per document, from the files read back: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it.  The window runs over one
    row per file, not per document.
    """
    sizes = files.select("place", "part", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    places = sizes.groupBy("place").agg(F.sum("n").alias("n"))
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    bases = places.select("place", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("place_base"))
    inside = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.join(bases, "place").select(
        "place", "part", (F.col("place_base") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("base")
    )
    located = files.join(starts, ["place", "part"]).select("base", "doc_ids", "lengths", "file")
    return located.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
