"""Samples by thresholds, exact shards and order tests, against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from stepforge.operators import audit, automaton


def test_samples_are_the_first_hashes_of_each_stratum(spark):
    rows = [("big" if i % 3 else f"s{i % 9}", i) for i in range(6000)] + [(None, 9000)]
    quotas = {"big": 2345, "s0": 0, "s3": 5, "s6": 10**6}
    df = spark.createDataFrame(rows, "stratum string, id long")
    wanted = spark.createDataFrame(list(quotas.items()), "stratum string, quota long")
    want = set()
    for name, quota in quotas.items():
        ids = sorted((hashlib.md5(f"7:{i}".encode()).hexdigest(), i) for s, i in rows if s == name)
        want |= {i for _, i in ids[:quota]}
    sample = audit.quota_sample(df, "stratum", wanted, "id", seed=7)
    assert {r.id for r in sample.collect()} == want and sample.count() == len(want)


@pytest.mark.parametrize("n,size", [(1000, 128), (1000, 250), (7, 100), (0, 5)])
def test_shards_are_full(spark, tmp_path, n, size):
    rows = spark.range(n).select((F.col("id") * 7919 % 10007).alias("k"), F.lit("x").alias("v")).repartition(5)
    audit.write_shards(rows, "k", str(tmp_path / "out"), size)
    keys = sorted(i * 7919 % 10007 for i in range(n))
    read = spark.read.schema("k long, v string, shard long").parquet(str(tmp_path / "out"))
    got = {r.shard: r for r in audit.shard_manifest(read, "k", F.md5(F.col("k").cast("string"))).collect()} if n else {}
    assert len(got) == -(-n // size)
    for k, r in got.items():
        own = keys[k * size : (k + 1) * size]
        joined = "".join(hashlib.md5(str(x).encode()).hexdigest() for x in own)
        assert (r.n_rows, r.first_key, r.last_key, r.n_files) == (len(own), own[0], own[-1], 1)
        assert r.digest == hashlib.sha256(joined.encode()).hexdigest()


def test_final_states_of_sessions_over_many_ranges(spark):
    rnd, rows, want = random.Random(2), [], {}
    letters = {"system": "s", "user": "u", "assistant": "a", "tool": "t", None: "t"}
    for k in range(60):
        n = 4000 if k == 7 else rnd.randint(1, 9)
        roles = ["user", "assistant"] * (n // 2 + 1)
        roles = (["system"] if k % 3 == 0 else []) + roles[:n]
        if k % 4 == 1:
            roles[rnd.randrange(len(roles))] = rnd.choice(["tool", "system", "user", None])
        rows += [(k if k else None, i, r) for i, r in enumerate(roles)]
        want[k if k else None] = bool(re.fullmatch("s?u(au)*a?", "".join(letters[r] for r in roles)))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = automaton.final_states(df, "conv_id", ["turn"], "role", audit.STRICT_ROLES)
        assert {r.conv_id: r.state in ("user", "assistant") for r in got.collect()} == want
        ranges = automaton.range_maps(df, "conv_id", ["turn"], "role", audit.STRICT_ROLES)
        assert ranges.where("conv_id = 7").count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
