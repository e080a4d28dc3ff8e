"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepforge.storage import Written


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of the edges (a, b: strings).

    Each round hooks every node to its smallest neighbour, follows two hooks and
    contracts the edges.  Labels are ordered by a hash, so the rounds are expected to
    be logarithmic whatever the shape, a long chain included.
    """
    label = lambda c: F.concat(F.md5(c), F.lit("|"), F.col(c)).alias(c)
    links = Written(edges.where("a <> b").select(label("a"), label("b")).distinct(), "links")
    placed = Written(
        links.table.select(F.col("a").alias("node")).union(links.table.select("b")).distinct()
        .select("node", F.col("node").alias("comp")),
        "placed",
    )
    while not links.table.isEmpty():
        both = links.table.union(links.table.select("b", "a"))
        hooks = Written(both.groupBy("a").agg(F.min("b").alias("to")).select("a", F.least("a", "to").alias("to")), "hooks")
        jump = hooks.table.select(F.col("a").alias("to"), F.col("to").alias("new"))
        moved = Written(hooks.table.join(jump, "to").select(F.col("a").alias("old"), "new"), "moved")
        hooks.drop()
        later = Written(
            placed.table.join(moved.table, F.col("comp") == F.col("old"), "left")
            .select("node", F.coalesce("new", "comp").alias("comp")),
            "placed",
        )
        to = lambda c: moved.table.select(F.col("old").alias(c), F.col("new").alias(f"new_{c}"))
        fewer = Written(
            links.table.join(to("a"), "a").join(to("b"), "b").where("new_a <> new_b")
            .select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).distinct(),
            "links",
        )
        for spent in (moved, placed, links):
            spent.drop()
        placed, links = later, fewer
    return placed.table.select(F.substring("node", 34, 1 << 30).alias("node"), "comp")
