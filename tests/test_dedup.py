"""Duplicate detection against a plain sequential scan."""

import random
import re

import pytest
from pyspark.sql import functions as F

from stepforge.operators import dedup as U
from stepforge.operators.duplicate_index import StoredIndex

SCHEMA = "id string, ord long, sha string, phash string, action string, words array<string>, coordinates array<double>"


def conflict(a, b, distance):
    """Literal statement of the rule, for comparison."""
    if a["sha"] is not None and a["sha"] == b["sha"]:
        return True
    return near(a, b, distance) and same_context(a, b)


def near(a, b, distance):
    if a["phash"] is None or b["phash"] is None:
        return False
    return bin(int(a["phash"], 16) ^ int(b["phash"], 16)).count("1") <= distance


def same_context(a, b):
    if a["action"] != b["action"]:
        return False
    wa, wb = set(a["words"]), set(b["words"])
    similarity = 1.0 if not wa | wb else len(wa & wb) / len(wa | wb)
    if similarity < 0.5:
        return False
    if a["action"] != "click" or a["coordinates"] is None or b["coordinates"] is None:
        return True
    return all(abs(x - y) <= 0.15 for x, y in zip(a["coordinates"], b["coordinates"]))


def sequential(rows, distance):
    kept = []
    for r in sorted(rows, key=lambda r: r["ord"]):
        if r["sha"] is None and r["phash"] is None or not any(conflict(r, k, distance) for k in kept):
            kept.append(r)
    return {r["id"] for r in kept}


def random_rows(seed, n=120):
    rnd = random.Random(seed)
    bases = [rnd.getrandbits(256) for _ in range(5)]
    rows = []
    for i in range(n):
        value = rnd.choice(bases)
        for _ in range(rnd.randint(0, 9)):
            value ^= 1 << rnd.randint(0, 255)
        missing = rnd.random() < 0.05
        rows.append(
            {
                "id": f"r{i}", "ord": i,
                "sha": None if missing else f"sha{rnd.randint(0, 60)}",
                "phash": None if missing or rnd.random() < 0.05 else f"{value:064x}",
                "action": rnd.choice(["click", "type"]),
                "words": sorted(rnd.sample(["open", "save", "mail", "file", "sort"], rnd.randint(1, 3))),
                "coordinates": None if rnd.random() < 0.2 else [rnd.choice([0.1, 0.2, 0.5]), 0.5],
            }
        )
    return rows


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[f.split()[0]] for f in SCHEMA.split(", ")) for r in rows], SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_survivors_equal_sequential_scan(spark, seed):
    rows = random_rows(seed)
    got = U.survivors(frame(spark, rows), 8).where("duplicate_of is null")
    assert {r.id for r in got.collect()} == sequential(rows, 8)


def test_survivors_with_crowded_buckets(spark):
    """Tiny limits force finer buckets, slices and several rounds of heads."""
    rows = random_rows(3)
    got = U.survivors(frame(spark, rows), 8, hot_rows=5, bucket_rows=4, first_heads=2)
    assert {r.id for r in got.where("duplicate_of is null").collect()} == sequential(rows, 8)
    by_id = {r["id"]: r for r in rows}
    for r in got.where("duplicate_of is not null").collect():
        assert by_id[r.duplicate_of]["ord"] < by_id[r.id]["ord"]


def test_index_makes_runs_incremental(spark):
    rows = random_rows(4)
    first, second = rows[:60], rows[60:]
    kept = U.survivors(frame(spark, first), 8).where("duplicate_of is null")
    later = U.survivors(frame(spark, second), 8, index=U.index_rows(kept)).where("duplicate_of is null")
    got = {r.id for r in kept.collect()} | {r.id for r in later.collect()}
    assert got == sequential(rows, 8)
    # the same rows again are no duplicates of themselves
    again = U.survivors(frame(spark, first), 8, index=U.index_rows(kept)).where("duplicate_of is null")
    assert {r.id for r in again.collect()} == {r.id for r in kept.collect()}


@pytest.mark.parametrize("options", [{}, {"hot_rows": 5, "bucket_rows": 4, "first_heads": 2}])
def test_near_duplicates_and_reasons(spark, options):
    rows = [r for r in random_rows(5, 80) if r["phash"]]
    got = {r.id: (r.match_id, r.distance) for r in U.near_duplicates(frame(spark, rows), 8, **options).collect()}
    want, reasons = {}, {}
    for r in rows:
        for e in rows:
            if e["ord"] < r["ord"] and near(e, r, 8):
                d = bin(int(e["phash"], 16) ^ int(r["phash"], 16)).count("1")
                if r["id"] not in reasons:
                    reasons[r["id"]] = (e["id"], same_context(e, r))
                if r["id"] not in want and same_context(e, r):
                    want[r["id"]] = (e["id"], d)
    assert got == want
    why = {r.id: (r.match_id, r.reason == "duplicate") for r in U.keep_reason(frame(spark, rows), 8, **options).collect()}
    assert why == reasons


def test_boundaries(spark):
    base = {"sha": None, "phash": "0" * 64, "action": "click", "words": ["a", "b"], "coordinates": [0.0, 0.5]}
    def kept(*others):
        rows = [dict(base, id="a", ord=0, sha="s0")]
        rows += [dict(base, **o, id=f"b{i}", ord=i + 1, sha=f"t{i}") for i, o in enumerate(others)]
        return {r.id for r in U.survivors(frame(spark, rows), 8).where("duplicate_of is null").collect()}

    # bit-exact tolerance edge, one step over it, other action, half of the words, chain
    assert kept({"coordinates": [0.15, 0.5]}) == {"a"}
    assert kept({"coordinates": [0.16, 0.5]}) == {"a", "b0"}
    assert kept({"action": "type"}) == {"a", "b0"}
    assert kept({"words": ["a"]}) == {"a"}
    assert kept({"words": ["a", "c"]}) == {"a", "b0"}
    assert kept({"phash": f"{0xff:064x}"}, {"phash": f"{0xffff:064x}"}) == {"a", "b1"}


def test_bands_cover_all_bits():
    for bands in (9, 17):
        edges = U.band_edges(bands)
        assert edges[0][0] == 0 and sum(n for _, n in edges) == 256
        assert max(n for _, n in edges) - min(n for _, n in edges) <= 1


def test_exact_duplicates_hot_key(spark):
    rows = [dict(id=f"r{i}", ord=i, sha="hot" if i % 3 else f"s{i}", phash=None, action="click", words=[], coordinates=None) for i in range(60)]
    for hot in (2, 10**6):
        got = {r.id: r.original_id for r in U.exact_duplicates(frame(spark, rows), hot).collect()}
        assert got == {f"r{i}": "r1" for i in range(60) if i % 3 and i != 1}


def test_a_long_drifting_recording_is_decided_in_a_fold(spark):
    value, rows = 0, []
    for i in range(60):
        rows.append({"id": f"d{i}", "ord": i, "sha": f"s{i}", "phash": f"{value:064x}", "action": "key", "words": ["a"], "coordinates": None})
        for bit in range(5):  # each frame is near the next, not the one after
            value ^= 1 << (i * 5 + bit) % 256
    kept = {r["id"] for r in U.survivors(spark.createDataFrame(rows, SCHEMA), 8).where("duplicate_of is null").collect()}
    assert kept == sequential(rows, 8)
    assert 20 <= len(kept) <= 40


def test_pages_of_heads_find_matches_behind_many_distinct_rows(spark, monkeypatch):
    monkeypatch.setattr(U, "MOST_HEADS", 3)
    rows = random_rows(11)
    frame = spark.createDataFrame(rows, SCHEMA)
    found = {r["id"]: r["match_id"] for r in U.near_duplicates(frame, 8, first_heads=2).collect()}
    order = sorted((r for r in rows if r["phash"]), key=lambda r: r["ord"])
    wanted = {}
    for i, r in enumerate(order):
        match = next((k["id"] for k in order[:i] if near(r, k, 8) and same_context(r, k)), None)
        if match:
            wanted[r["id"]] = match
    assert set(found) == set(wanted)


def drifting(n):
    """A recording whose every frame is near the next, not the one after."""
    value, rows = 0, []
    for i in range(n):
        rows.append({"id": f"d{i}", "ord": i, "sha": f"s{i}", "phash": f"{value:064x}", "action": "key", "words": ["a"], "coordinates": None})
        for bit in range(5):
            value ^= 1 << (i * 37 + bit * 11) % 256
    return rows


def test_a_giant_chain_is_folded_in_segments(spark, monkeypatch):
    rows = drifting(400) + random_rows(6, 60)
    writes = []
    plain = U.materialize
    monkeypatch.setattr(U, "materialize", lambda df, label="table": writes.append(label) or plain(df, label))
    got = U.survivors(frame(spark, [dict(r, ord=i) for i, r in enumerate(rows)]), 8, fold_rows=50)
    want = sequential([dict(r, ord=i) for i, r in enumerate(rows)], 8)
    assert {r.id for r in got.where("duplicate_of is null").collect()} == want
    assert writes.count("folded") <= 10


@pytest.mark.parametrize("options", [{}, {"hot_rows": 5, "bucket_rows": 4}])
def test_stored_index_equals_one_scan(spark, tmp_path, options):
    rows = random_rows(9) + drifting(40)
    rows = [dict(r, ord=i) for i, r in enumerate(rows)]
    kept, path = set(), str(tmp_path / "index")
    parts = [rows[:50], rows[50:90], rows[90:]]
    for n, part in enumerate(parts):
        index = StoredIndex(spark, path, f"run-{n}", slots=16)
        got = U.survivors(frame(spark, part), 8, index=index, **options)
        index.add(got.where("duplicate_of is null"))
        kept |= {r.id for r in got.where("duplicate_of is null").collect()}
    assert kept == sequential(rows, 8)
    stored = {r.id for r in StoredIndex(spark, path, "reader", slots=16).rows().collect()}
    assert stored == {r["id"] for r in rows if r["id"] in kept and (r["sha"] or r["phash"])}
    # a part again: no duplicate of itself, nothing stored twice, its own earlier attempt unseen
    index = StoredIndex(spark, path, "run-2", slots=16)
    again = U.survivors(frame(spark, parts[2]), 8, index=index, **options).where("duplicate_of is null")
    assert {r.id for r in again.collect()} == kept & {r["id"] for r in parts[2]}
    index.add(again)
    assert StoredIndex(spark, path, "reader", slots=16).rows().count() == len(stored)


def test_a_lookup_reads_the_slots_it_hits(spark, tmp_path):
    index = StoredIndex(spark, str(tmp_path / "index"), "a", slots=64)
    index.add(frame(spark, random_rows(2)))
    reader = StoredIndex(spark, str(tmp_path / "index"), "b", slots=64)
    one = frame(spark, [r for r in random_rows(2) if r["phash"] and r["sha"]][:1])
    keys = U.coarse_keys(U.prepare(one), 8)
    hit = reader.hit_slots(keys)
    found = reader.lookup(keys)
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    filters = re.findall(r"PartitionFilters: \[(.*)\]", plan)
    assert 1 <= len(hit) <= 10 and any(all(f"{k}" in re.findall(r"\d+", f) for k in hit) and "slot" in f for f in filters)
    assert one.first().id in {r.id for r in found.collect()}
    assert reader.rows().count() == frame(spark, random_rows(2)).where("sha is not null or phash is not null").count()


def test_rows_of_uncrowded_buckets_are_narrow_and_not_shuffled_before_their_join(spark):
    rows = U.prepare(frame(spark, random_rows(5))).drop("phash")
    keyed, slices = U.bucket_keys(rows, 8)
    assert slices is None and keyed.schema["key"].dataType.simpleString() == "bigint"
    assert not {"bits", "phash", "band"} & set(keyed.columns)
    assert "Exchange" not in keyed._jdf.queryExecution().executedPlan().toString()
    _, slices = U.bucket_keys(rows, 8, bucket_rows=4, hot_rows=5)
    assert slices.where("_slices > 1").count() > 0
