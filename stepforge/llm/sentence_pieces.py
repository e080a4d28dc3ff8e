"""SentencePiece ids of whole texts by backtracking over longest matches, and back to texts.

Merging by score gives each text one segmentation, and it is the only one whose
neighbouring pieces all keep to their border when the two are merged again alone.  So a
text need not be merged: an Aho-Corasick automaton finds every piece at every place, the
longest is tried first, a pair of neighbours is tested once by merging the two, and a
place from which nothing leads on is marked in a bit field and never entered again.
Pieces that merging cannot build are no candidates; a character without a piece is one
by itself and becomes its bytes.

Two characters that stand side by side in no piece never merge, so texts are cut there
and a distinct part is segmented once while a worker remembers it.  Texts are never
shortened: a part has the length it has.

Models: merge type with byte pieces, the identity normalizer with a dummy prefix, no
user-defined or unused pieces, and distinct scores but for pieces that repeat one
character; others raise ValueError.

Defined results: a null or empty text has no ids and decodes to the empty text; equal
rows stay rows of their own; a null ``doc_id`` stays null; an empty table gives an empty
table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge.llm import arrays

SPACE = "▁"
MEMO_PARTS = 300_000  # parts, and pairs, a worker remembers; a memo is emptied beyond it
SLICE_BYTES = 8 << 20
DECODE_IDS = 1 << 20


class Pieces:
    """Segmentation by one model; texts are given with plain spaces and their dummy prefix."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.processor = model = sentencepiece.SentencePieceProcessor(model_file=path)
        _check(model)
        size = model.get_piece_size()
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) for i in range(size)]
        self.ids = {model.id_to_piece(i).replace(SPACE, " "): i for i in range(size) if not special[i]}
        self.scores = {piece: model.get_score(i) for piece, i in self.ids.items()}
        single = [s for piece, s in self.scores.items() if len(piece) > 1 and len(set(piece)) > 1]
        if len(set(single)) < len(single):
            raise ValueError("pieces with equal scores")
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.matcher = ahocorasick.Automaton()
        self.beside = np.zeros((256, 256), bool)
        for piece in self.ids:
            raw = piece.encode()
            self.beside[list(raw[:-1]), list(raw[1:])] = True
            if self.merged(piece) == [piece]:
                self.matcher.add_word(piece, len(piece))
        self.matcher.make_automaton()
        self.beside[:, 0x80:0xC0] = True  # inside a character
        self.known: dict[str, bytes] = {}
        self.borders: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging: highest score first, leftmost of equals."""
        parts = list(text)
        pairs = [self.scores.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best = max((s for s in pairs if s is not None), default=None)
            if best is None:
                return parts
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = self.scores.get(parts[at - 1] + parts[at])
            if at < len(pairs):
                pairs[at] = self.scores.get(parts[at] + parts[at + 1])

    def fit(self, left: str, right: str) -> bool:
        """Whether merging the two pieces' text again gives these two."""
        pair = (left, right)
        found = self.borders.get(pair)
        if found is None:
            if len(self.borders) >= MEMO_PARTS:
                self.borders.clear()
            found = self.borders[pair] = self.merged(left + right) == [left, right]
        return found

    def segment(self, part: str) -> list[str]:
        """The pieces of a text of any length."""
        n = len(part)
        lengths: list[list[int]] = [[] for _ in range(n)]
        for last, length in self.matcher.iter(part):
            lengths[last + 1 - length].append(length)  # grows with the end, so it ascends
        for found in lengths:
            if not found or found[0] != 1:
                found.insert(0, 1)
        failed = bytearray((n >> 3) + 1)
        taken: list[str] = []
        tried: list[int] = []
        at, k = 0, len(lengths[0]) - 1 if n else -1
        while at < n:
            here = lengths[at]
            while k >= 0:
                end = at + here[k]
                if not failed[end >> 3] >> (end & 7) & 1 and (not taken or self.fit(taken[-1], part[at:end])):
                    break
                k -= 1
            if k >= 0:
                taken.append(part[at:end])
                tried.append(k)
                at = end
                k = len(lengths[at]) - 1 if at < n else -1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(taken.pop())
                k = tried.pop() - 1
        return taken

    def part_ids(self, part: str) -> bytes:
        """Ids of a part as 32-bit integers."""
        out: list[int] = []
        for piece in self.segment(part):
            found = self.ids.get(piece)
            out += [found] if found is not None else [self.bytes[b] for b in piece.encode()]
        return np.array(out, np.int32).tobytes()

    def encode(self, column: pa.Array) -> pa.ListArray:
        """The ids of every text."""
        # A text with the mark that stands for a space is the text with a space there.
        plain = pc.replace_substring(pc.fill_null(column, ""), SPACE, " ")
        led = pc.if_else(pc.equal(pc.binary_length(plain), 0), "", pc.binary_join_element_wise(" ", plain, ""))
        offsets, data = arrays.utf8(led)
        starts = np.concatenate(([False], ~self.beside[data[:-1], data[1:]])) if len(data) else np.zeros(0, bool)
        starts[offsets[:-1][np.diff(offsets) > 0]] = True
        cuts = np.append(np.flatnonzero(starts), len(data)).astype(np.int64)
        parts = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data))
        coded = parts.dictionary_encode()
        found = self._remembered(coded.dictionary.to_pylist())
        table = np.frombuffer(b"".join(found), np.int32)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        which = coded.indices.to_numpy()
        lead, each = np.cumsum(sizes) - sizes, sizes[which]
        total = np.concatenate(([0], np.cumsum(each)))
        ids = table[np.arange(total[-1]) + np.repeat(lead[which] - total[:-1], each)]
        ends = total[np.searchsorted(cuts, offsets)]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))

    def _remembered(self, parts: list[str]) -> list[bytes]:
        found = [self.known.get(x) for x in parts]
        missing = [i for i, x in enumerate(found) if x is None]
        if len(self.known) + len(missing) > MEMO_PARTS:
            self.known.clear()
        for i in missing:
            found[i] = self.part_ids(parts[i])
            if len(self.known) < MEMO_PARTS:
                self.known[parts[i]] = found[i]
        return found


def _check(model) -> None:
    """Raise ValueError for a model the segmentation does not hold for."""
    size = model.get_piece_size()
    if any(model.piece_to_id(f"<0x{b:02X}>") == model.unk_id() for b in range(256)):
        raise ValueError("the model has no byte pieces")
    if any(model.is_unused(i) for i in range(size)):
        raise ValueError("the model has unused pieces")
    for text in ("a  b", " ﬁ ", "é \n\t"):
        if model.normalize(text) != SPACE + text.replace(" ", SPACE):
            raise ValueError("the model changes texts before it cuts them")


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """One per worker process, so that its memo serves later tasks too."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): the ids of every whole text, without begin and end ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches, "text", SLICE_BYTES):
            ids = pieces(path).encode(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], names=["doc_id", "ids"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return wanted.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text): the texts that the model's library reads from the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column("ids")).to_numpy(zero_copy_only=False)
            turn = np.cumsum(sizes) // DECODE_IDS
            cuts = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    part = batch.slice(a, b - a)
                    texts = pieces(path).processor.decode(part.column("ids").to_pylist(), num_threads=1)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def ids_digest(ids: Column) -> Column:
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)


def digests(decoded: DataFrame) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
