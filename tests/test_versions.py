"""Stored versions: changes against a plain comparison, and how little is read."""

import pytest
from pyspark.sql import functions as F

from stepforge.operators import versions

SCHEMA = "k string, a string, b string"


def stored(spark, folder, name, rows, buckets):
    path = f"{folder}/{name}"
    versions.write_version(spark.createDataFrame(rows, SCHEMA), path, "k", ["a", "b"], buckets)
    return path


@pytest.mark.parametrize("sizes", [(16, 16), (64, 8), (1, 32)])
def test_changes_equal_a_plain_comparison(spark, tmp_path, sizes):
    old = {f"k{i}": ("x", str(i) if i % 3 else None) for i in range(200)}
    new = {k: v for k, v in old.items() if k not in ("k5", "k6")} | {"n1": ("x", "y"), "k7": ("z", "7"), "k9": (None, "x"), "k12": (None, "x")}
    old["k12"] = ("x", None)  # the same values, null in another place
    paths = [stored(spark, tmp_path, n, [(k, *v) for k, v in t.items()], s) for n, t, s in zip("ab", (old, new), sizes)]
    got = {r["k"]: r["change"] for r in versions.changes(spark, *paths, "k", ["a", "b"]).collect()}
    assert got == {"k5": "removed", "k6": "removed", "n1": "added", "k7": "changed", "k9": "changed", "k12": "changed"}


def test_nearly_equal_versions_read_few_files(spark, tmp_path):
    rows = [(f"k{i}", "x", str(i)) for i in range(3_000)]
    after = rows[:1_500] + [("k1500", "y", "1500")] + rows[1_501:]
    paths = [stored(spark, tmp_path, n, t, 64) for n, t in (("a", rows), ("b", after))]
    read = [part.select(F.input_file_name().alias("f")).distinct().count() for part in versions.unequal(spark, *paths)]
    assert read == [1, 1]
    assert [tuple(r) for r in versions.changes(spark, *paths, "k", ["a", "b"]).collect()] == [("k1500", "changed")]


def test_equal_and_empty_versions(spark, tmp_path):
    rows = [("k1", "x", None), (None, "x", "y"), (None, "x", "y")]
    a, b = (stored(spark, tmp_path, n, rows, 4) for n in "ab")
    empty = stored(spark, tmp_path, "e", [], None)
    assert versions.changes(spark, a, b, "k", ["a", "b"]).count() == 0
    assert {(r["k"], r["change"]) for r in versions.changes(spark, a, empty, "k", ["a", "b"]).collect()} == {("k1", "removed"), (None, "removed")}
    assert versions.changes(spark, empty, b, "k", ["a", "b"]).where("change = 'added'").count() == 3
    assert versions.changes(spark, empty, empty, "k", ["a", "b"]).count() == 0
    with pytest.raises(ValueError):
        versions.write_version(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/w", "k", ["a", "b"], 3)
