"""The manifest against a plain tree, built and rebuilt in memory."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from helpers import no_docs, odd_docs, odd_rows
from pyspark.sql import functions as F

from stepforge import storage
from stepforge.llm import merkle, queries

SF = "/root/testdata/sf0.001"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    values = (doc_id, source, lang, n_chars, text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(tree, at):
    out = []
    for row in tree[:-1]:
        run = at - at % 8
        out.append(("".join(row[run:at]), "".join(row[at + 1 : run + 8])))
        at //= 8
    return out


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of all rows (doc_id, text, lang, source, n_chars)."""
    trees = defaultdict(list)
    for r in rows:
        trees[r[2]].append((r, leaf(*r)))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for name in names:
        trees[name].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        built[name] = levels([d for _, d in trees[name]])
    top = levels([built[name][-1][0] for name in names])
    out = []
    for k, name in enumerate(names):
        for at, (row, own) in enumerate(trees[name]):
            way = siblings(built[name], at) + siblings(top, k)
            start = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[1] is not None:
                small = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1])
                start = leaf(row[0], small, *row[2:])
            for a, b in way:
                start = h(a + start + b)
            root = top[-1][0]
            out.append((row[0], own, built[name][-1][0], root, h("".join(a + b for a, b in way)), start, start == root))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_a_plain_tree(spark):
    rows = [tuple(r) for r in queries.table(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    found = got(queries.QUERIES["op11_merkle_manifest"](spark, SF))
    assert found == plain(rows)
    assert {r[-1] for r in found} == {True, False}


def made_up(n):
    langs = ["en"] * 6 + ["de", "fr", None, "é"]
    return [(i * 3, f"Text {i} Of Many", langs[i % 10] if i % 97 else "alone", f"s{i % 4}", i) for i in range(n)]


@pytest.mark.parametrize("n,page_levels", [(1, 1), (9, 1), (700, 1), (700, 2)])
def test_trees_of_many_pages(spark, n, page_levels):
    rows = made_up(n)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    made = merkle.versions(merkle.build(docs, merkle.tampered(), page_levels))
    found = made.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", F.expr("folded_root = root"))
    assert got(found) == plain(rows)


def test_a_version_owns_its_ancestors_only(spark):
    rows = [r for r in made_up(300) if r[2] == "en"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    manifest = merkle.build(docs, merkle.tampered(), 1)
    base = levels([r["digest"] for r in manifest.leaves.orderBy("place").collect()])
    changed = {r["place"]: r["changed"] for r in manifest.leaves.where("changed IS NOT NULL").collect()}
    owned = defaultdict(dict)
    for r in merkle.version_nodes(merkle.versions(manifest)).collect():
        owned[r["place"]][r["level"]] = r["digest"]
    assert set(owned) == set(changed) and len(changed) > 30
    for place, new in changed.items():
        again = levels([new if i == place else d for i, d in enumerate(base[0])])
        for level in range(1, len(base)):
            read = [owned[place][level] if i == place // 8**level else d for i, d in enumerate(base[level])]
            assert read == again[level]


def test_odd_rows_and_empty_tables(spark):
    assert got(merkle.audit(odd_docs(spark))) == plain([r[:5] for r in odd_rows()])
    assert merkle.audit(no_docs(spark)).count() == 0


def test_only_the_manifest_is_left(spark):
    with storage.temporary(spark):
        manifest = merkle.build(odd_docs(spark))
        left = [p for p in storage._made.paths if storage.exists(spark, p)]
        assert len(left) == 2 and manifest.leaves.count() == len(odd_rows())
