"""Order tests by finite automata over sessions of any length.

A row moves every state to a state, and so does a range of rows: the maps of rows next
to each other compose.  Rows are sorted over ranges that know nothing of sessions; each
task leaves one map per session and range, and a session's few maps are composed in
order.  So a session of ten million rows is many tasks' work and no row is collected.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Automaton:
    """``states[0]`` is the start; a symbol without a move leads to ``otherwise``."""

    states: Sequence[str]
    moves: Mapping[tuple[str, str], str]
    otherwise: str

    def maps(self) -> tuple[dict[str, tuple[int, ...]], tuple[int, ...]]:
        """The map of each symbol that has moves, and that of all others."""
        place = {s: i for i, s in enumerate(self.states)}
        lost = place[self.otherwise]
        known = {symbol for _, symbol in self.moves}
        row = lambda symbol: tuple(place.get(self.moves.get((s, symbol)), lost) for s in self.states)
        return {symbol: row(symbol) for symbol in known}, (lost,) * len(self.states)


def range_maps(rows: DataFrame, session: str, order: list[str], symbol: str, automaton: Automaton) -> DataFrame:
    """(session, range, steps): one row per session and sorted range; ``steps[i]`` is where state i ends up."""
    known, lost = automaton.maps()
    start = tuple(range(len(automaton.states)))
    kind = rows.schema[session].dataType.simpleString()
    keys = [F.col(session), *map(F.col, order)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, current, steps, place = ["session", "range", "steps"], None, start, None
        for batch in batches:
            out = []
            for name, missing, at, role in zip(*(batch[c].tolist() for c in ("session", "missing", "range", "symbol"))):
                name = None if missing else name
                if place is not None and name != current:
                    out.append((current, place, list(steps)))
                    steps = start
                current, place = name, at
                move = known.get(role, lost)
                steps = tuple(move[s] for s in steps)
            yield pd.DataFrame(out, columns=names)
        if place is not None:
            yield pd.DataFrame([(current, place, list(steps))], columns=names)

    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    named = sorted_rows.select(
        F.col(session).cast("string").alias("session"), F.col(session).isNull().alias("missing"),
        F.spark_partition_id().alias("range"), F.col(symbol).alias("symbol"),
    )
    found = named.mapInPandas(run, "session string, range int, steps array<int>")
    return found.select(F.col("session").cast(kind).alias(session), "range", "steps")


def final_states(rows: DataFrame, session: str, order: list[str], symbol: str, automaton: Automaton) -> DataFrame:
    """(session, state): the state after all rows of each session, in the given order."""
    maps = range_maps(rows, session, order, symbol, automaton)
    listed = F.array_sort(F.collect_list(F.struct("range", "steps")))  # as many as ranges the session spans
    end = F.aggregate(listed, F.lit(0), lambda state, part: F.get(part["steps"], state))
    names = F.array(*[F.lit(s) for s in automaton.states])
    return maps.groupBy(session).agg(F.get(names, end).alias("state"))
