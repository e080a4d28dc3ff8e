"""The cosine join against all pairs."""

import numpy as np
import pytest

from stepforge.operators import semantic


def plain(vectors, cosine=0.95):
    ids = [i for i, _ in vectors]
    usable = [k for k, (_, v) in enumerate(vectors) if v is not None and len(v) == 16 and np.isfinite(v).all() and np.any(v)]
    near = {k: set() for k in range(len(ids))}
    units = {k: np.array(vectors[k][1]) / np.linalg.norm(vectors[k][1]) for k in usable}
    for i in usable:
        near[i] = {j for j in usable if j != i and units[i] @ units[j] > cosine}
    out = []
    for k in range(len(ids)):
        seen, todo = {k}, [k]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out.append((ids[k], len(near[k]), min(ids[j] for j in seen)))
    return sorted(out)


def clustered(seed, n):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 16))
    dense = centres[0] + rng.normal(size=(n // 3, 16)) * 0.05
    wide = centres[rng.integers(1, 6, n // 3)] + rng.normal(size=(n // 3, 16)) * 0.25
    chain = np.array([np.r_[np.cos(a), np.sin(a), np.zeros(14)] for a in np.arange(0, 3, 0.2)])
    every = np.vstack([dense, wide, chain, rng.normal(size=(n // 4, 16))])
    every = np.vstack([every, every[:20], every[20:30] * 3])
    return [(int(i), v.tolist()) for i, v in enumerate(every[rng.permutation(len(every))])]


@pytest.mark.parametrize("options", [{}, {"pivots": 5, "members": 13, "visitors": 17}, {"pivots": 1, "members": 50, "hot_rows": 10}])
def test_links_equal_all_pairs(spark, monkeypatch, options):
    monkeypatch.setattr(semantic, "POINTS_A_PIVOT", 4)
    vectors = clustered(4, 240)
    odd = [(9001, None), (9002, []), (9003, [0.0] * 16), (9004, [float("nan")] * 16), (9005, [1.0, 2.0]), (9006, [float("inf")] * 16)]
    df = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in semantic.links(df, **options).collect())
    want = plain(vectors + odd)
    assert got == want
    assert max(n for _, n, _ in want) >= 80 and any(n == 0 for _, n, _ in want)


def test_a_dense_cluster_is_counted_not_compared(spark):
    rng = np.random.default_rng(1)
    dense = rng.normal(size=16) * 4 + rng.normal(size=(3000, 16)) * 0.02
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(dense)], "vec_id long, embedding array<double>")
    sphere = semantic._Sphere(dense[:1] / np.linalg.norm(dense[0]), 0.95)
    points = semantic.directed(df, "vec_id", "embedding", 16).selectExpr("code", "1L as copies", "unit")
    groups = semantic._Groups(semantic._ranges(points, sphere), sphere)
    assert semantic._visitors(points, groups) == {}
    assert {(r.n_links, r.group_id) for r in semantic.links(df).collect()} == {(2999, 0)}


def test_empty_table(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert semantic.links(none).count() == 0


@pytest.mark.parametrize("least", [7, 40, 1000])
def test_vectors_that_pivots_do_not_tell_apart_meet_in_blocks(spark, monkeypatch, least):
    monkeypatch.setattr(semantic, "POINTS_A_PIVOT", 20)
    rng = np.random.default_rng(8)
    loose = rng.normal(size=(150, 16))
    dense = loose[0] * 4 + rng.normal(size=(30, 16)) * 0.02
    told = loose[:60] + 0.33 * loose[1:61]
    on_the_limit = [np.r_[1.0, np.zeros(15)], np.r_[0.95 + 1e-12, np.sqrt(1 - (0.95 + 1e-12) ** 2), np.zeros(14)],
                    np.r_[0.95 - 1e-12, np.zeros(3), np.sqrt(1 - (0.95 - 1e-12) ** 2), np.zeros(11)]]
    every = [(i, v.tolist()) for i, v in enumerate(np.vstack([loose, told, dense, loose[:9], on_the_limit]))]
    df = spark.createDataFrame(every, "vec_id long, embedding array<double>")
    seen = []
    deal = semantic._deal
    monkeypatch.setattr(semantic, "_deal", lambda points, groups: seen.append(groups.blocks) or deal(points, groups))
    assert sorted(tuple(r) for r in semantic.links(df, block_least=least).collect()) == plain(every)
    assert seen[0] >= (1 if least == 1000 else 3)


def test_copies_grow_as_the_vectors(spark):
    """Each loose vector is copied to at most a fixed number of tasks."""
    rng = np.random.default_rng(2)
    for n in (600, 2400):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(n, 64)))], "vec_id long, embedding array<double>")
        points = semantic.directed(df, "vec_id", "embedding", 64).selectExpr("code", "1L as copies", "unit")
        sphere = semantic._Sphere(np.array([np.frombuffer(r.unit) for r in points.orderBy("code").limit(32).collect()]), 0.95)
        groups = semantic._Groups(semantic._ranges(points, sphere), sphere)
        groups.divide(semantic._visitors(points, groups), semantic.MEMBERS, semantic.VISITORS, 30)
        assert groups.blocks == semantic.BLOCKS
        assert semantic._deal(points, groups).count() <= n * (semantic.BLOCKS + 3)
