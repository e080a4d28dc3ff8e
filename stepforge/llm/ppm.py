"""Language-model scores by prediction by partial matching over bytes.

A text is read as its words (A-Z lower-cased), one blank after each and a line end after
the last; a document starts in a context of line ends.  Training counts every byte
with its ``ORDER`` bytes of context over all documents; shorter contexts are sums of
longer ones, so the counts form a trie in which a symbol seen after a context was also
seen after every shorter one.  The model is the whole trie, whatever its size.  The most
frequent entries, at most ``MAX_ENTRIES``, are broadcast; if that is not all, the bytes
they do not settle are looked up by a join: their distinct keys meet the whole trie,
dealt by the last ``LEAD`` bytes of context (shorter contexts travel whole).

A byte is coded in the longest context the trie has: with probability (c - 1/2) / T if it
was seen there (T all counts, D distinct symbols), else an escape, (D / 2) / T, leads to
the next shorter context, whose counts leave out the symbols just excluded.  Below the
empty context all bytes left are equally likely.  The score is the sum of log10.

``unigram`` gives the plain word model for comparison.  Words are told apart by 64-bit
hashes; the most frequent ones are broadcast, all others looked up by a join.

Defined results: null and empty texts are the end alone; without anything learned every
byte has probability 1/256; rows are scored each for itself, repeated or not; a null id
is carried along; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepforge.llm import arrays
from stepforge.storage import materialize

ORDER = 5
MAX_ENTRIES = 1_500_000  # frequent entries that travel with the task; the rest is joined
LEAD = 3
GROUP_ENTRIES = 500_000  # of the longest contexts, in one group of the join
BROADCAST_WORDS = 300_000  # frequent words that travel with the task; the rest is joined
MERGE_AT = 2_000_000
SLICE_BYTES = 2 << 20
BLANK, END = 32, 10


def stream(words: arrays.Words, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes to be coded, each text led by ``order`` line ends, and where each text's own bytes start (n + 1)."""
    sizes = words.ends - words.starts
    counts = np.diff(words.first)
    extra = order + (counts == 0)  # the leading context, and the lone end of an empty text
    at = np.repeat(words.first[:-1], extra)
    sizes = np.insert(sizes, at, 0)
    stops = np.cumsum(sizes + 1) - 1
    out = np.full(int(stops[-1]) + 1 if len(stops) else 0, BLANK, np.uint8)
    own = np.ones(len(out), bool)
    own[stops] = False
    out[own] = words.data[words.inner]
    last = np.cumsum(counts + extra)  # items up to each text's end
    out[stops[np.insert(last[:-1], 0, 0)[:, None] + np.arange(order)]] = END
    out[stops[last - 1]] = END
    begins = np.concatenate(([0], stops[last - 1] + 1))
    return out, begins


def coded(begins: np.ndarray, order: int) -> np.ndarray:
    """Positions of the bytes to be coded (all but the leading contexts)."""
    keep = np.ones(int(begins[-1]), bool)
    keep[(begins[:-1, None] + np.arange(order)).reshape(-1)] = False
    return np.flatnonzero(keep)


def contexts(data: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """Key of each position: its ``order`` bytes of context, then the byte itself."""
    key = np.zeros(len(data), np.uint64)
    for back in range(order + 1):
        key[back:] |= data[: len(data) - back].astype(np.uint64) << np.uint64(8 * back)
    return key[at]


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        keys = np.sort(keys)
    else:
        turn = np.argsort(keys)
        keys, counts = keys[turn], counts[turn]
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    at = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
    total = np.diff(np.append(at, len(keys))) if counts is None else np.add.reduceat(counts, at)
    return keys[at], total.astype(np.int64)


class _Counter:
    """Counts of 64-bit keys, merged when many have gathered."""

    def __init__(self, kind: int):
        self.kind, self.parts, self.size = kind, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(_summed(keys))
        self.size += len(self.parts[-1][0])
        if self.size > MERGE_AT:
            self.parts = [_summed(*(np.concatenate(x) for x in zip(*self.parts)))]
            self.size = len(self.parts[0][0])
            if self.size > MERGE_AT // 2:
                yield from self.handed()

    def handed(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            keys, counts = _summed(*(np.concatenate(x) for x in zip(*self.parts)))
            self.parts, self.size = [], 0
            for a in range(0, len(keys), 1 << 17):
                own = keys[a : a + (1 << 17)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(own), self.kind, np.int32)),
                        pa.array(own.view(np.int64)),
                        pa.array(counts[a : a + (1 << 17)]),
                    ],
                    names=["kind", "key", "n"],
                )


def _train(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, words_seen, texts = _Counter(0), _Counter(1), 0
        for part in arrays.slices(batches, "text", SLICE_BYTES):
            offsets, data = arrays.utf8(part.column("text"))
            words = arrays.Words(offsets, arrays.lowered(data))
            out, begins = stream(words, order)
            yield from grams.add(contexts(out, coded(begins, order), order))
            yield from words_seen.add(words.hashes())
            texts += part.num_rows
        yield from grams.handed()
        yield from words_seen.handed()
        yield pa.RecordBatch.from_arrays(
            [pa.array([2], pa.int32()), pa.array([0], pa.int64()), pa.array([texts], pa.int64())], names=["kind", "key", "n"]
        )

    return run


@dataclass
class Trie:
    """By order k: sorted keys (k context bytes, symbol) with counts, and the contexts with what coding needs."""

    order: int
    keys: list[np.ndarray]
    counts: list[np.ndarray]
    nodes: list[np.ndarray]
    whole: list[np.ndarray]  # T of a context
    kinds: list[np.ndarray]  # D of a context
    after_whole: list[np.ndarray]  # of the next shorter context, without this one's symbols: T
    after_kinds: list[np.ndarray]  # ... and D
    first: np.ndarray  # log10 probability of each entry of the longest contexts, where most bytes end

    @staticmethod
    def build(order: int, keys: list[np.ndarray], counts: list[np.ndarray], each: np.ndarray | None = None) -> Trie:
        """``each``: T by entry of the longest contexts, where the entries given are not all."""
        nodes, whole, kinds, after_whole, after_kinds = [], [], [], [], []
        for k in range(order + 1):
            own, c = keys[k], counts[k].astype(np.float64)
            ctx = own >> np.uint64(8)
            at = np.concatenate(([0], np.flatnonzero(ctx[1:] != ctx[:-1]) + 1)) if len(own) else np.zeros(0, np.int64)
            total = np.add.reduceat(c, at) if len(own) else np.zeros(0)
            distinct = np.diff(np.append(at, len(own))).astype(np.float64)
            nodes.append(ctx[at])
            whole.append(total)
            kinds.append(distinct)
            if k and len(own):
                shorter = counts[k - 1][np.searchsorted(keys[k - 1], own & np.uint64((1 << (8 * k)) - 1))].astype(np.float64)
                mask = np.uint64((1 << (8 * (k - 1))) - 1)
                parent = np.searchsorted(nodes[k - 1], ctx[at] & mask)
                after_kinds.append(kinds[k - 1][parent] - distinct)
                after_whole.append(whole[k - 1][parent] - np.add.reduceat(shorter, at))
            else:
                after_kinds.append(np.zeros(len(at)))
                after_whole.append(np.zeros(len(at)))
        if each is None:
            each = whole[order][np.searchsorted(nodes[order], keys[order] >> np.uint64(8))] if len(keys[order]) else np.zeros(0)
        first = np.log10((counts[order] - 0.5) / each)
        return Trie(order, keys, counts, nodes, whole, kinds, after_whole, after_kinds, first)

    def logs(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each key after its context."""
        entry, hit = _find(self.keys[self.order], keys)
        out = np.where(hit, _take(self.first, entry), 0.0)
        todo = np.flatnonzero(~hit)
        came = np.full(len(todo), -1)  # node of the next longer context that was escaped from
        for k in range(self.order, -1, -1):
            own = keys[todo] & np.uint64((1 << (8 * (k + 1))) - 1)
            node, known = _find(self.nodes[k], own >> np.uint64(8))
            entry, hit = _find(self.keys[k], own)
            whole = np.where(known, _take(self.whole[k], node), 1.0)
            kinds = np.where(known, _take(self.kinds[k], node), 0.0)
            if k < self.order:
                escaped = came >= 0
                whole = np.where(escaped, _take(self.after_whole[k + 1], came), whole)
                kinds = np.where(escaped, _take(self.after_kinds[k + 1], came), kinds)
            out[todo[hit]] += np.log10((_take(self.counts[k], entry[hit]) - 0.5) / whole[hit])
            escape = ~hit & known & (kinds > 0)
            out[todo[escape]] += np.log10(0.5 * kinds[escape] / whole[escape])
            came = np.where(known, node, -1)[~hit]
            todo = todo[~hit]
            if not len(todo):
                return out
        left = 256 - len(self.keys[0])
        out[todo] -= np.log10(max(1, left))
        return out


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def _take(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return values[np.maximum(at, 0)] if len(values) else np.zeros(len(at))


@dataclass
class Words:
    """Frequent words (sorted hashes and counts); ``all_tokens`` and ``distinct`` include the ends."""

    hashes: np.ndarray
    counts: np.ndarray
    ends: int
    all_tokens: int
    distinct: int


@dataclass
class Learned:
    trie: Trie  # the frequent entries; its ``first`` is exact even if they are not all
    words: Words
    rare: DataFrame  # (word, c): the words beyond the frequent ones
    longest: DataFrame | None  # (key, n): all entries of the longest contexts, None if the trie has them all
    n_longest: int
    shorter: list[tuple[np.ndarray, np.ndarray]]  # by order below LEAD: all keys and counts


def learn(docs: DataFrame, order: int = ORDER, max_entries: int = MAX_ENTRIES,
          broadcast_words: int = BROADCAST_WORDS) -> Learned:
    """Count contexts and words of all the given documents."""
    counted = materialize(
        docs.select("text").mapInArrow(_train(order), "kind int, key long, n long")
        .groupBy("kind", "key").agg(F.sum("n").alias("n")),
        "counts",
    )
    longest = counted.where("kind = 0").select("key", "n")
    trie_rows = longest.select(F.lit(order).alias("k"), "key", "n")
    for k in range(order - 1, -1, -1):
        shorter = F.col("key").bitwiseAND(F.lit((1 << (8 * (k + 1))) - 1).cast("long"))
        longest = longest.groupBy(shorter.alias("key")).agg(F.sum("n").alias("n"))
        trie_rows = trie_rows.unionByName(longest.select(F.lit(k).alias("k"), "key", "n"))
    entries = materialize(trie_rows, "trie")
    least = _least_count(entries, max_entries)
    found = [_fetched(entries.where((F.col("k") == k) & (F.col("n") >= least)).select("key", "n")) for k in range(order + 1)]
    longest, n_longest, shorter_ones, each = None, 0, [], None
    if least > 1:
        longest = entries.where(F.col("k") == order).select("key", "n")
        n_longest = longest.count()
        shorter_ones = [_fetched(entries.where(F.col("k") == k).select("key", "n")) for k in range(min(order, LEAD))]
        whole = longest.groupBy(F.shiftrightunsigned("key", 8).alias("context")).agg(F.sum("n").alias("whole"))
        frequent = longest.where(F.col("n") >= least).select("key", F.shiftrightunsigned("key", 8).alias("context"))
        each = _fetched(frequent.join(whole, "context").select("key", F.col("whole").alias("n")))[1].astype(np.float64)
    words = counted.where("kind = 1").select(F.col("key").alias("word"), F.col("n").alias("c"))
    sums = words.agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n")).first()
    ends = counted.where("kind = 2").agg(F.sum("n")).first()[0] or 0
    floor = _least_count(words.select(F.col("c").alias("n")), broadcast_words)
    hashes, times = _fetched(words.where(F.col("c") >= floor).select(F.col("word").alias("key"), F.col("c").alias("n")))
    turn = np.argsort(hashes.view(np.int64))
    return Learned(
        Trie.build(order, [keys for keys, _ in found], [counts for _, counts in found], each),
        Words(hashes.view(np.int64)[turn], times[turn], ends,
              (sums["n"] or 0) + ends, sums["v"] + (ends > 0)),
        words.where(F.col("c") < floor),
        longest, n_longest, shorter_ones,
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, counts = (batch.column(c).to_numpy().tobytes() for c in range(2))
        yield pa.RecordBatch.from_arrays([pa.array([keys]), pa.array([counts])], names=["keys", "counts"])


def _fetched(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys (ascending) and counts of a table of bounded length, passed to the driver as packed bytes."""
    rows = table.mapInArrow(_packed, "keys binary, counts binary").collect()
    keys = np.frombuffer(b"".join(r["keys"] for r in rows), np.uint64)
    turn = np.argsort(keys)
    return keys[turn], np.frombuffer(b"".join(r["counts"] for r in rows), np.int64)[turn]


def _least_count(entries: DataFrame, most: int) -> int:
    """The least count n such that at most ``most`` entries have n or more.

    Counts are gathered by their two leading digits, so the table is short.
    """
    scale = F.pow(F.lit(10.0), F.greatest(F.floor(F.log10("n")) - 1, F.lit(0)))
    steps = entries.select((F.floor(F.col("n") / scale) * scale).cast("long").alias("step"))
    table = steps.groupBy("step").count().orderBy(F.desc("step")).collect()
    total, least = 0, (table[0]["step"] * 2 + 1 if table else 1)
    for row in table:
        total += row["count"]
        if total > most:
            return least
        least = row["step"]
    return 1


_SCORED = ("doc_id long, held_out boolean, n_tokens long, known long, logs double, score double, "
           "rare array<long>, open array<long>")


def _score(model, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, (frequent, first), table = model.value
        for part in arrays.slices(batches, "text", SLICE_BYTES):
            offsets, data = arrays.utf8(part.column("text"))
            words = arrays.Words(offsets, arrays.lowered(data))
            out, begins = stream(words, order)
            at = coded(begins, order)
            keys = contexts(out, at, order)
            if trie is not None:
                logs, settled = trie.logs(keys), np.ones(len(keys), bool)
            else:
                entry, settled = _find(frequent, keys)
                logs = np.where(settled, _take(first, entry), 0.0)
            cuts = np.searchsorted(at, begins)
            score = np.add.reduceat(logs, cuts[:-1])  # every text has its end to code
            hashes = words.hashes().view(np.int64)
            found, hit = _find(table.hashes, hashes)
            value = np.where(hit, np.log10(_take(table.counts, found) + 1.0), 0.0)
            text = np.repeat(np.arange(part.num_rows), np.diff(words.first))
            plain = np.bincount(text, value, minlength=part.num_rows)
            rare = np.concatenate(([0], np.cumsum(~hit)))[words.first]
            unsettled = np.concatenate(([0], np.cumsum(~settled)))[cuts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("held_out"),
                    pa.array(np.diff(words.first) + 1),
                    pa.array(arrays.per_text(hit, words.first) + (table.ends > 0)),
                    pa.array(plain + np.log10(table.ends + 1.0)),
                    pa.array(score),
                    pa.ListArray.from_arrays(pa.array(rare.astype(np.int32)), pa.array(hashes[~hit])),
                    pa.ListArray.from_arrays(pa.array(unsettled.astype(np.int32)), pa.array(keys[~settled].view(np.int64))),
                ],
                names=["doc_id", "held_out", "n_tokens", "known", "logs", "score", "rare", "open"],
            )

    return run


def _chained(order: int, shorter):
    """log10 probability of each key asked for, from all entries that end in the same bytes of context."""

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        wanted = asked["key"].to_numpy().view(np.uint64)
        below = shorter.value
        longest = _summed(held["key"].to_numpy().view(np.uint64), held["n"].to_numpy())
        levels = [longest]
        for k in range(order - 1, len(below) - 1, -1):
            levels.append(_summed(levels[-1][0] & np.uint64((1 << (8 * (k + 1))) - 1), levels[-1][1]))
        levels = [*below, *levels[::-1]]
        trie = Trie.build(order, [keys for keys, _ in levels], [counts for _, counts in levels])
        return pa.table({"key": pa.array(wanted.view(np.int64)), "log": pa.array(trie.logs(wanted))})

    return run


def _looked_up(keys: DataFrame, learned: Learned) -> DataFrame:
    """(key, log): the log10 probability of each of the distinct keys under the whole trie."""
    session, order = keys.sparkSession, learned.trie.order
    groups = max(int(session.conf.get("spark.sql.shuffle.partitions")), learned.n_longest // GROUP_ENTRIES + 1)
    ending = F.shiftrightunsigned("key", 8).bitwiseAND(F.lit((1 << (8 * len(learned.shorter))) - 1).cast("long"))
    group = F.pmod(F.xxhash64(ending), F.lit(groups)).alias("part")
    shorter = session.sparkContext.broadcast(learned.shorter)
    asked, held = keys.select("key", group), learned.longest.select("key", "n", group)
    return asked.groupBy("part").cogroup(held.groupBy("part")).applyInArrow(_chained(order, shorter), "key long, log double")


def score(docs: DataFrame, learned: Learned) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of (doc_id, held_out, text)."""
    words = learned.words
    trie = learned.trie
    settles = (trie, (None, None)) if learned.longest is None else (None, (trie.keys[trie.order], trie.first))
    model = docs.sparkSession.sparkContext.broadcast((*settles, words))
    scored = materialize(
        docs.select("doc_id", "held_out", "text").mapInArrow(_score(model, trie.order), _SCORED)
        .withColumn("row", F.monotonically_increasing_id()),
        "scored",
    )
    rare = (
        scored.select("row", F.explode("rare").alias("word"))
        .join(learned.rare, "word")
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("more"), F.sum(F.log10(F.col("c") + 1)).alias("more_logs"))
    )
    joined, score_of = scored.join(rare, "row", "left"), F.col("score")
    if learned.longest is not None:
        keys = scored.select("row", F.explode("open").alias("key"))
        logs = materialize(_looked_up(keys.select("key").distinct(), learned), "logs")
        settled = keys.join(logs, "key").groupBy("row").agg(F.sum("log").alias("open_score"))
        joined = joined.join(settled, "row", "left")
        score_of = F.col("score") + F.coalesce("open_score", F.lit(0.0))
    whole = F.lit(float(np.log10(words.all_tokens + words.distinct + 1)))
    return joined.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(words.all_tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * whole).alias("base_score"),
        score_of.alias("score"),
    )
