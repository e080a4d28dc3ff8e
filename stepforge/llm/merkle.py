"""Manifest of a dataset as a persistent hash tree; a changed leaf makes a version by path copying.

Each document is a leaf.  The leaves of a language are its tree: eight consecutive
nodes make one above until one is left, the subroot; the subroots, by language, are the
leaves of the root's tree.

A tree is kept in pages.  A page holds the inner nodes over an aligned block of 512
leaves (three levels), is made by the task that has the block, and its top is a leaf
among the page tops, which are paged alike, so any tree is a few layers of small pages.
A page knows the siblings on the way from its top to the root.

A version changes one leaf.  It owns copies of the ancestors and nothing else: in its
block they are made from the page's untouched nodes, above from the siblings the page
knows, so versions of one page, however many, never meet in a task.  The node of a
version is its copy where it has one, else the base tree's.

Defined results: a null field is ``-`` in a leaf; null languages are one tree, before
all others; a null id sorts first and is never changed by ``tampered``; rows of equal
id are ordered by leaf; a lone leaf is its own subroot and has no siblings there; texts
are hashed whole; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepforge.storage import Written, materialize, new_folder, temporary

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 8
PAGE_LEVELS = 3
RANGE_ROWS = 2_000_000  # leaves a task puts in order
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf(**changed: Column) -> Column:
    """The digest of a row; ``changed`` replaces fields."""

    def part(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(part, FIELDS)), 256)


def tampered() -> Column:
    """The leaf with its text's A-Z in lower case, where 3 divides the crc32 of the id; else null."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(hit, leaf(text=F.translate("text", UPPER, SMALL)))


def _in_order(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows (tree, ...) with ``place`` in their tree by ``order`` and ``n``, its size."""
    spark = rows.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE_ROWS))
    keys = [F.col("tree"), *order]
    ordered = Written(
        rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()),
        "ordered",
    ).table.withColumn("range", F.shiftright("at", 33))
    found = ordered.groupBy("tree", "range").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    tree = Window.partitionBy("tree")
    before = F.sum("rows").over(tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    starts = materialize(
        found.select("tree", "range", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(tree).alias("n")),
        "starts",
    )
    return ordered.join(starts, ["tree", "range"]).withColumn("place", F.col("at") + F.col("shift")).drop("at", "range", "shift")


def _levels(n: int, most: int) -> int:
    """Levels of a page in a layer of ``n`` nodes."""
    if n > FAN**most:
        return most
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _page(most: int) -> Column:
    return F.expr(f"place div {FAN**most}").alias("page")


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


_PAGE = "tree string, place long, n long, levels array<array<string>>, top string"


def _pages(nodes: DataFrame, most: int) -> DataFrame:
    """Pages of ``most`` levels over the nodes (tree, place, n, digest) of a layer: ``_PAGE``; ``n`` counts the tree's pages."""

    def run(key, table):
        row = table.sort_by("place")
        n = row["n"][0].as_py()
        here, levels = row["digest"].to_pylist(), []
        for _ in range(_levels(n, most)):
            here = [_h("".join(here[i : i + FAN])) for i in range(0, len(here), FAN)]
            levels.append(here)
        out = {"tree": [key[0].as_py()], "place": [key[1].as_py()], "n": [-(-n // FAN**most)], "levels": [levels], "top": [here[0]]}
        return pa.table(out, schema=_page_schema())

    keyed = nodes.select("tree", _page(most), "place", "n", "digest")
    return keyed.groupBy("tree", "page").applyInArrow(run, _PAGE)


def _page_schema() -> pa.Schema:
    lists = pa.list_(pa.list_(pa.string()))
    return pa.schema([("tree", pa.string()), ("place", pa.int64()), ("n", pa.int64()), ("levels", lists), ("top", pa.string())])


def _siblings(digests: list[str], levels: list[list[str]], at: int) -> tuple[list[str], list[str]]:
    """What stands left and right of a node and of its ancestors inside their runs, up to the page's top."""
    lefts, rights = [], []
    for row in [digests, *levels][: len(levels)]:
        run = at - at % FAN
        lefts.append("".join(row[run:at]))
        rights.append("".join(row[at + 1 : run + FAN]))
        at //= FAN
    return lefts, rights


_PATH = "tree string, place long, lefts array<string>, rights array<string>, root string"


def _paths(nodes: DataFrame, pages: DataFrame, most: int) -> DataFrame:
    """``_PATH`` of each node of a layer: the siblings on its way to the root of its tree, and the root."""
    above = pages.join(_above(pages, most), ["tree", "place"]).select("tree", F.col("place").alias("page"), "levels", "lefts", "rights", "root")

    def run(table, page):
        if not page.num_rows:
            raise ValueError("nodes without their page")
        row, up = table.sort_by("place"), page.to_pylist()[0]
        digests = row["digest"].to_pylist()
        own = [_siblings(digests, up["levels"], at) for at in range(len(digests))]
        return pa.table(
            {
                "tree": row["tree"],
                "place": row["place"],
                "lefts": pa.array([a + up["lefts"] for a, _ in own], pa.list_(pa.string())),
                "rights": pa.array([b + up["rights"] for _, b in own], pa.list_(pa.string())),
                "root": pa.array([up["root"]] * len(own), pa.string()),
            }
        )

    keyed = nodes.select("tree", _page(most), "place", "digest")
    return keyed.groupBy("tree", "page").cogroup(above.groupBy("tree", "page")).applyInArrow(run, _PATH)


def _above(pages: DataFrame, most: int) -> DataFrame:
    """``_PATH`` of the pages' tops."""
    tops = pages.select("tree", "place", "n", F.col("top").alias("digest"))
    if (pages.agg(F.max("n")).first()[0] or 1) == 1:
        none = F.array().cast("array<string>")
        return tops.select("tree", "place", none.alias("lefts"), none.alias("rights"), F.col("digest").alias("root"))
    return materialize(_paths(tops, materialize(_pages(tops, most), "pages"), most), "paths")


@dataclass(frozen=True)
class Manifest:
    """leaves: tree, place, n, doc_id, digest, changed; pages: ``_PAGE``, siblings to the root, subroot, root."""

    leaves: DataFrame
    pages: DataFrame
    page_levels: int


def build(docs: DataFrame, changed: Column | None = None, page_levels: int = PAGE_LEVELS) -> Manifest:
    """The manifest; ``changed`` is the leaf of a version of the row, or null where it has none."""
    spark, lang = docs.sparkSession, F.col("lang").cast("string")
    leaves_at, pages_at = new_folder(spark, "leaves"), new_folder(spark, "manifest")
    with temporary(spark):
        rows = materialize(
            docs.select(
                F.coalesce(F.concat(F.lit("="), lang), F.lit("")).alias("tree"),
                F.col("doc_id").cast("long").alias("doc_id"),
                leaf().alias("digest"),
                (F.lit(None).cast("string") if changed is None else changed).alias("changed"),
                F.monotonically_increasing_id().alias("row"),
            ),
            "rows",
        )
        order = [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("changed"), F.col("row")]
        _in_order(rows, order).drop("row").write.parquet(leaves_at)
        leaves = spark.read.parquet(leaves_at)
        pages = materialize(_pages(leaves, page_levels), "pages")
        above = materialize(_above(pages, page_levels), "paths")
        found = above.where("place = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
        subroots = materialize(_in_order(found, [F.col("name")]), "subroots")
        top = _paths(subroots, materialize(_pages(subroots, page_levels), "pages"), page_levels)
        top = top.drop("tree").join(subroots.select("place", F.col("name").alias("tree"), F.col("digest").alias("subroot")), "place")
        top = top.select("tree", "subroot", F.col("lefts").alias("l"), F.col("rights").alias("r"), "root")
        full = pages.join(above.drop("root"), ["tree", "place"]).join(top, "tree")
        full.withColumns({"lefts": F.concat("lefts", "l"), "rights": F.concat("rights", "r")}).drop("l", "r").write.parquet(pages_at)
    return Manifest(leaves, spark.read.parquet(pages_at), page_levels)


_VERSION = (
    "tree string, place long, doc_id long, leaf string, subroot string, root string, proof_sha256 string,"
    " folded_root string, copies array<string>"
)


def versions(manifest: Manifest) -> DataFrame:
    """Per leaf: ``_VERSION``.

    ``copies`` are the nodes a version owns, from the parent of its changed leaf to its
    root; null where nothing is changed.  ``folded_root`` is the root over the changed,
    else the own leaf and the siblings of the base tree.
    """

    def run(table, page):
        if not page.num_rows:
            raise ValueError("leaves without their page")
        row, base = table.sort_by("place"), page.to_pylist()[0]
        digests, proofs, folded, copies = row["digest"].to_pylist(), [], [], []
        for at, new in enumerate(row["changed"].to_pylist()):
            lefts, rights = _siblings(digests, base["levels"], at)
            lefts, rights = lefts + base["lefts"], rights + base["rights"]
            proofs.append(_h("".join(a + b for a, b in zip(lefts, rights))))
            path = [new or digests[at]]
            for a, b in zip(lefts, rights):
                path.append(_h(a + path[-1] + b))
            folded.append(path[-1])
            copies.append(path[1:] if new else None)
        same = lambda value: pa.array([value] * len(digests), pa.string())
        return pa.table(
            {
                "tree": row["tree"],
                "place": row["place"],
                "doc_id": row["doc_id"],
                "leaf": row["digest"],
                "subroot": same(base["subroot"]),
                "root": same(base["root"]),
                "proof_sha256": pa.array(proofs, pa.string()),
                "folded_root": pa.array(folded, pa.string()),
                "copies": pa.array(copies, pa.list_(pa.string())),
            }
        )

    keyed = manifest.leaves.select("tree", _page(manifest.page_levels), "place", "doc_id", "digest", "changed")
    pages = manifest.pages.withColumnRenamed("place", "page")
    return keyed.groupBy("tree", "page").cogroup(pages.groupBy("tree", "page")).applyInArrow(run, _VERSION)


def version_nodes(made: DataFrame) -> DataFrame:
    """The nodes that versions own, one row each: tree, place (the version's leaf), level (1: the leaf's parent), digest.

    Levels go on in the root's tree behind the subroot.
    """
    return made.where("copies IS NOT NULL").select(
        "tree", "place", F.posexplode("copies").alias("level", "digest")
    ).withColumn("level", F.col("level") + 1)


def audit(docs: DataFrame) -> DataFrame:
    """Every document's leaf and proof, and whether the root over its possibly tampered leaf is the manifest's."""
    made = versions(build(docs, tampered()))
    return made.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def _sql_tree(name: str, leaves: str, levels: int) -> str:
    """Nodes by level and siblings of ``leaves`` (tree, idx, digest, n)."""
    out = [f"{name}0 AS MATERIALIZED (SELECT tree, idx, digest, n FROM {leaves})"]
    for k in range(levels):
        out.append(
            f"""{name}run{k} AS MATERIALIZED (SELECT *, string_agg(digest, '') OVER (PARTITION BY tree, idx // {FAN} ORDER BY idx
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS run FROM {name}{k}),
{name}{k + 1} AS MATERIALIZED (SELECT tree, idx // {FAN} AS idx, CASE WHEN n = 1 THEN min(digest) ELSE sha256(min(run)) END AS digest,
  (n + {FAN - 1}) // {FAN} AS n FROM {name}run{k} GROUP BY tree, idx // {FAN}, n)"""
        )
    return ",\n".join(out)


def _sql_fold(name: str, tree: str, start: str, levels: int, extra: str) -> str:
    """Fold ``start`` (tree, idx, cur, proof and the columns ``extra``) over the siblings of a tree."""
    out = []
    for k in range(levels):
        left = f"CASE WHEN s.n = 1 THEN '' ELSE left(s.run, 64 * (s.idx % {FAN})) END"
        right = f"CASE WHEN s.n = 1 THEN '' ELSE substr(s.run, 64 * (s.idx % {FAN}) + 65) END"
        out.append(
            f"""{name}{k} AS MATERIALIZED (SELECT {extra}, f.tree, f.idx // {FAN} AS idx,
  CASE WHEN s.n = 1 THEN cur ELSE sha256({left} || cur || {right}) END AS cur, proof || {left} || {right} AS proof
  FROM {start if k == 0 else f'{name}{k - 1}'} f JOIN {tree}run{k} s USING (tree, idx))"""
        )
    return ",\n".join(out)


def sql(levels: int = 7, top_levels: int = 3) -> str:
    """``audit`` in SQL, for at most 8 ** levels documents of a language and 8 ** top_levels languages."""
    part = lambda c: f"coalesce(strlen({c}) || ':' || {c}, '-')"
    digest = lambda text: "sha256(" + " || ".join(part(text if f == "text" else f"{f}::VARCHAR") for f in FIELDS) + ")"
    crc = """xor(list_reduce(range(8 * len(doc_id::VARCHAR)), lambda c, i:
    xor((CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(doc_id::VARCHAR, (i // 8 + 1)::INT, 1))) ELSE c END) >> 1, 3988292384
      * ((CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(doc_id::VARCHAR, (i // 8 + 1)::INT, 1))) ELSE c END) & 1)), 4294967295::BIGINT), 4294967295)"""
    return f"""
WITH hashed AS MATERIALIZED (SELECT doc_id, coalesce('=' || lang, '') AS tree, {digest('text')} AS leaf,
  CASE WHEN {crc} % 3 = 0 THEN {digest(f"translate(text, '{UPPER}', '{SMALL}')")} END AS changed FROM documents),
leaves AS MATERIALIZED (SELECT *, leaf AS digest, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
  count(*) OVER (PARTITION BY tree) AS n FROM hashed),
{_sql_tree('low', 'leaves', levels)},
subroots AS MATERIALIZED (SELECT tree AS name, '' AS tree, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n
  FROM low{levels}),
{_sql_tree('top', 'subroots', top_levels)},
started AS (SELECT doc_id, leaf, tree, idx, coalesce(changed, leaf) AS cur, '' AS proof FROM leaves),
{_sql_fold('up', 'low', 'started', levels, 'doc_id, leaf')},
crossed AS (SELECT doc_id, leaf, s.digest AS subroot, '' AS tree, s.idx, cur, proof FROM up{levels - 1} u JOIN subroots s ON u.tree = s.name),
{_sql_fold('over', 'top', 'crossed', top_levels, 'doc_id, leaf, subroot')}
SELECT doc_id, leaf, subroot, r.digest AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = r.digest AS verified
FROM over{top_levels - 1}, top{top_levels} r"""
