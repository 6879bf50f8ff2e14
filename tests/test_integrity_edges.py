"""Nulls, blanks, ties, repeats, empty tables, hot keys and clashing names of the integrity operators."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from demesne.operators import changefeed, profile, spatial
from demesne.operators.orphans import orphan_references

T0, T1 = dt.datetime(2025, 1, 5), dt.datetime(2025, 2, 5)
EXT = "_id string, lid string, uid string, loaded_at timestamp_ntz, key int, at string"


def _orphans(spark, ext, leases=(), dead=(), **kw):
    e = spark.createDataFrame(ext, EXT)
    l = spark.createDataFrame(list(leases), "_id string, uid string, loaded_at timestamp_ntz, ref_field string")
    d = spark.createDataFrame(list(dead), "lease_id string, uid string")
    out = orphan_references(e, {"lid": [(l, "_id")], "uid": [(l, "uid")]}, {"lid": [(d, "lease_id")], "uid": [(d, "uid")]}, **kw)
    return {(r["record_id"], r["ref_field"]): r["kind"] for r in out.collect()}


def test_orphans_notations_kinds_and_blanks(spark):
    ext = [
        ("e1", 'ObjectId("AB12")', " u1 ", T0, 1, "x"),
        ("e2", '{"$oid": "ab 12"}', None, T0, 1, "x"),
        ("e3", "zz", "", T0, 1, "x"),
        ("e4", "dd", "\tU9", T0, 1, "x"),
        ("e5", "late", "u1", T0, 1, "x"),
        ("e5", "late", "u1", T1, 1, "x"),
        ("e6", "late", "u1", T1, 1, "x"),
    ]
    got = _orphans(spark, ext, [("ab12", "u1", T0, "q"), ("late", "u1", T1, "q")], [("dd", "u8")])
    assert got == {("e3", "lid"): "missing", ("e4", "lid"): "deleted", ("e4", "uid"): "missing", ("e5", "lid"): "late"}


def test_orphans_empty_tables(spark):
    assert _orphans(spark, []) == {}
    assert _orphans(spark, [("e", "a", None, None, 1, "x")]) == {("e", "lid"): "missing"}


def test_orphans_hot_key_and_brute_force(spark):
    rnd = random.Random(3)
    ext = [(f"e{i}", "hot" if i % 3 == 0 else f"k{rnd.randrange(40)}", f"u{rnd.randrange(40)}", T0, 0, "") for i in range(600)]
    leases = [(f"k{i}", f"u{i}", T1 if i % 5 == 0 else T0, "") for i in range(0, 40, 2)]
    have = {k: t for k, _, t, _ in leases}
    users = {u: t for _, u, t, _ in leases}
    want = {}
    for e, k, u, t, *_ in ext:
        for f, key, parents in (("lid", k, have), ("uid", u, users)):
            if key not in parents:
                want[e, f] = "missing"
            elif parents[key] > t:
                want[e, f] = "late"
    assert _orphans(spark, ext, leases, hot_refs=50) == want == _orphans(spark, ext, leases, ranges=3)


def _places(spark, rows):
    return spark.createDataFrame(rows, "_id string, loc struct<type:string,coordinates:array<double>>, lat double, lon double, code long, part int")


def test_near_pairs_brute_force(spark):
    rnd = np.random.default_rng(1)
    lat, lon = 55 + rnd.random(300) * 0.002, -1 + rnd.random(300) * 0.003
    rows = [(f"r{i:03}", None, float(a), float(b), 1, 2) for i, (a, b) in enumerate(zip(lat, lon))] + [("r000", None, float(lat[0]), float(lon[0]), 1, 2), ("same", None, float(lat[1]), float(lon[1]), 1, 2)]
    want = set()
    pts = [(r[0], r[2], r[3]) for r in rows]
    for i, a in enumerate(pts):
        for b in pts[i + 1 :]:
            if a[0] != b[0] and spatial.haversine_m(a[2], a[1], b[2], b[1]) <= 20:
                want.add((min(a[0], b[0]), max(a[0], b[0])))
    got = spatial.near_pairs(_places(spark, rows), 20.0).collect()
    assert {(r["id_a"], r["id_b"]) for r in got} == want and len(got) == len(want) > 50


def test_positions(spark):
    rows = [
        ("swapped", ("Point", [55.0, -1.0]), None, None, 0, 0),
        ("spoilt", ("Point", [0.0, 0.0]), 55.0, -1.0, 0, 0),
        ("short", ("Point", [1.0]), -1.0, 55.0, 0, 0),
        ("nan", ("Point", [float("nan"), 55.0]), float("nan"), -1.0, 0, 0),
        ("none", None, None, None, 0, 0),
        ("nulls", (None, [None, 55.0]), 0.0, 0.0, 0, 0),
    ]
    got = {r["id"] for r in spatial.coded_positions(_places(spark, rows)).collect()}
    assert got == {"swapped", "spoilt", "short"}


def test_regions_with_holes_and_bad_shapes(spark):
    square = '{"type":"Polygon","coordinates":[[[-2,54],[0,54],[0,56],[-2,56],[-2,54]],[[-1.5,54.5],[-0.5,54.5],[-0.5,55.5],[-1.5,55.5],[-1.5,54.5]]]}'
    multi = '{"type":"MultiPolygon","coordinates":[[[[-1.2,54.8],[-0.8,54.8],[-0.8,55.2],[-1.2,55.2]]]]}'
    regions = spark.createDataFrame([("ring", square), ("island", multi), ("bad", "{"), ("none", None), ("line", '{"type":"LineString","coordinates":[[0,0],[1,1]]}')], "code string, geometry string")
    rows = [("in", None, 54.2, -1.9, 0, 0), ("hole", None, 54.6, -1.4, 0, 0), ("isle", None, 55.0, -1.0, 0, 0), ("out", None, 57.0, -1.0, 0, 0)]
    got = {(r["id"], r["region"]) for r in spatial.containing_regions(_places(spark, rows), regions, "code").collect()}
    assert got == {("in", "ring"), ("isle", "island")}
    assert spatial.containing_regions(_places(spark, rows), regions.limit(0), "code").count() == 0
    assert spatial.near_pairs(_places(spark, []), 20.0).count() == 0


def _changes(spark, rows):
    full = [(i, v, n, T0 + dt.timedelta(minutes=i), k, u, r, a, "extra") for i, (v, n, k, u, r, a) in enumerate(rows)]
    return spark.createDataFrame(full, "change_id long, version string, row_no long, received_at timestamp_ntz, change_indicator string, unique_identifier string, reg_order string, associated_property_description_id string, op string")


def _state(df):
    return {(r["uid"], r["ro"], r["apid"]): (r["version"], r["row_no"]) for r in df.collect()}


def test_replay_order_keys_and_noise(spark):
    rows = [
        ("2025-02", 1, "D", "a", "1", "7"),  # deletions of a version precede its additions
        ("2025-01", 5, " a ", " A", "01", "7.0"),
        ("2025-02", 2, "A", "a", "1", "007"),
        ("2025-02", 2, "A", "a", "1", "7"),  # delivered again
        ("2025-01", 6, "A", "b", None, ""),
        ("2025-02", 3, "d", "B", " ", None),
        ("2025-02", 4, "U", "c", "1", "1"),
        ("2025-02", None, "A", "d", "1", "1"),
        (None, 9, "A", "d", "1", "1"),
        ("2025-01", 7, "A", "e", "1", "12X"),
        ("2025-01", 8, "D", "f", "0", "000"),
    ]
    df = _changes(spark, rows)
    assert _state(changefeed.replay(df)) == {("A", "1", "7"): ("2025-02", 2), ("E", "1", "12X"): ("2025-01", 7)}
    assert {r["reason"] for r in changefeed.quarantined(df).collect()} == {"version", "row_no", "indicator"}
    assert changefeed.replay(df.limit(0)).count() == 0


def test_replay_holds_gaps(spark):
    df = _changes(spark, [("2025-01", 1, "A", "a", "1", "1"), ("2025-03", 1, "D", "a", "1", "1")])
    assert _state(changefeed.replay(df)) == {("A", "1", "1"): ("2025-01", 1)}
    full = df.unionByName(_changes(spark, [("2025-02", 1, "A", "b", "1", "1")]))
    assert _state(changefeed.replay(full)) == {("B", "1", "1"): ("2025-02", 1)}
    manifest = spark.createDataFrame([("2025-01", 1), ("2025-02", 2), ("2025-03", 1)], "version string, n_changes long")
    assert _state(changefeed.replay(full, manifest)) == {("A", "1", "1"): ("2025-01", 1)}


def test_replay_brute_force(spark):
    rnd = random.Random(9)
    rows = [(f"2025-{rnd.randrange(1, 7):02}", n, rnd.choice("AADX"), rnd.choice("hot abc".split() + ["hot"]), str(rnd.randrange(3)), "1") for n in range(400)]
    rows += [(f"2025-{m:02}", 1000 + m, "X", "z", "1", "1") for m in range(1, 7)]
    state = {}
    for v in sorted({r[0] for r in rows}):
        mine = [r for r in rows if r[0] == v]
        for r in mine:
            if r[2] == "D":
                state.pop((r[3].upper(), r[4], r[5]), None)
        for r in sorted(mine, key=lambda r: r[1]):
            if r[2] == "A":
                state[r[3].upper(), r[4], r[5]] = (v, r[1])
    assert _state(changefeed.replay(_changes(spark, rows))) == state


def test_profile_finds_planted_shifts_only(spark):
    rnd = random.Random(2)
    rows = []
    for m in range(1, 5):
        for i in range(400):
            x = None if m == 3 and rnd.random() < 0.5 else rnd.randrange(100)
            c = "bad!" if m == 2 and rnd.random() < 0.3 else rnd.choice(["AA", "BB", " ", None])
            rows.append((f"{m}-{i}", f"2025-{m:02}", x, c, 1.0))
    df = spark.createDataFrame(rows, "id string, load string, x int, c string, n double")
    rules = [profile.ColumnRule("x", "number", 0, 200, 0.08, null_shift=0.18, top_shift=0.22, median_shift=30), profile.ColumnRule("c", "text", pattern="^[A-Z]+$", max_violating=0.1, null_shift=0.18, top_shift=0.5)]
    p = profile.profile_loads(df, F.col("load"), F.col("id"), rules)
    got = {(r["version"], r["column_name"], r["finding"]) for r in profile.findings(p).collect()}
    assert got == {("2025-03", "x", "nulls"), ("2025-02", "c", "pattern")}
    auc = {(r["version"], r["column_name"]): r["auc_alone"] for r in p.collect()}
    assert auc["2025-03", "x"] > 0.6 > auc["2025-01", "x"]
    assert profile.findings(profile.profile_loads(df.limit(0), F.col("load"), F.col("id"), rules)).count() == 0


def test_classifier_sees_what_no_aggregate_shows(spark):
    """One load has the values of the others pushed to both sides: same median, nulls, extremes, top share. The rest are alike."""
    rnd = random.Random(3)
    rows = []
    for m in range(1, 7):
        for i in range(1500):
            x = rnd.randrange(1, 100)
            if m == 4 and 25 < x < 75:
                x = x - 25 if x <= 50 else x + 24
            rows.append((f"{m}-{i}", f"2025-{m:02}", x, rnd.randrange(40), rnd.choice("AB"), 1))
    df = spark.createDataFrame(rows, "id string, load string, x int, y int, c string, version int")
    rules = [profile.ColumnRule("x", "number", 0, 200, 0.08, null_shift=0.18, top_shift=0.22, median_shift=30), profile.ColumnRule("y", "number"), profile.ColumnRule("c", "text")]
    p = profile.profile_loads(df, F.col("load"), F.col("id"), rules).collect()
    assert {(r["version"], r["column_name"]) for r in p if r["changed"]} == {("2025-04", "x")}
    assert not any(r["findings"] for r in p)


def test_cross_fitted_auc_against_brute_force(spark):
    """The AUC of a column alone, worked out row by row from the other fold's shares."""
    rnd = random.Random(8)
    rows = [(i, f"2025-{m:02}", rnd.choice("ABC" if m == 1 else "ABBC")) for m in (1, 2) for i in range(m * 1000, m * 1000 + 300)]
    df = spark.createDataFrame(rows, "id long, load string, c string")
    got = {r["version"]: r["auc_alone"] for r in profile.profile_loads(df, F.col("load"), F.col("id"), [profile.ColumnRule("c", "text")]).collect()}
    fold = {r[0]: r[1] for r in df.select("id", F.pmod(F.xxhash64("id"), F.lit(2))).collect()}
    for v in got:
        auc = 0.0
        own = [sum(1 for i, m, _ in rows if m == v and fold[i] == k) for k in (0, 1)]
        for k in (0, 1):
            train, held = [r for r in rows if fold[r[0]] != k], [r for r in rows if fold[r[0]] == k]
            score = {c: sum(r[1] == v for r in train if r[2] == c) / sum(r[2] == c for r in train) for c in "ABC"}
            pos, neg = [score[c] for _, m, c in held if m == v], [score[c] for _, m, c in held if m != v]
            auc += sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg) * own[k] / sum(own)
        assert abs(auc - got[v]) < 1e-9


@pytest.mark.parametrize("text,want", [("007", "7"), ("2.0", "2"), ("000", "0"), (" 12X ", "12X"), ("2.5", "2.5"), (None, ""), ("", ""), ("-03", "-3")])
def test_plain_number(spark, text, want):
    assert spark.createDataFrame([(text,)], "s string").select(changefeed.plain_number(F.col("s"))).first()[0] == want


def test_hot_positions_are_dealt_into_blocks(spark):
    """Twenty records at one position, some at others: the pairs are the same however small the blocks."""
    rows = [(f"h{i:02}", -1.5, 51.5) for i in range(20)] + [("n1", -1.5001, 51.5), ("n2", -1.5001, 51.5), ("far", -1.6, 51.5), ("h00", -1.5, 51.5)]
    df = spark.createDataFrame(rows, "_id string, lon double, lat double").withColumn("loc", F.lit(None).cast("struct<type:string,coordinates:array<double>>"))
    want = {(a, b) for a in {r[0] for r in rows} for b in {r[0] for r in rows} if a < b and "far" not in (a, b)}
    for block in (2_000, 7, 1):
        assert {tuple(r) for r in spatial.near_pairs(df, 20.0, block=block).collect()} == want
    assert {tuple(r) for r in spatial.near_pairs(df, 20.0, block=7, most_hot=0).collect()} == want
    members, pairs = spatial.near_places(df, 20.0)
    assert members.distinct().count() == 23 and pairs.count() == 1  # each two positions once
