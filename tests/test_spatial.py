"""Radius search and one-to-one claims against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from siteconcord.functions.geo import haversine_m
from siteconcord.operators import claim, skew
from siteconcord.operators.claim import greedy_claim
from siteconcord.operators.components import connected
from siteconcord.operators.ordinals import dense_ordinals
from siteconcord.operators.spatial import nearest_within

RADIUS = 175.0


def metres(lat1, lon1, lat2, lon2):
    a = (
        math.sin(math.radians(lat2 - lat1) / 2) ** 2
        + math.sin(math.radians(lon2 - lon1) / 2) ** 2 * math.cos(math.radians(lat1)) * math.cos(math.radians(lat2))
    )
    return 2 * 6_371_000.0 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def nearest_by_loop(left, right):
    found = {}
    for i, lat, lon in left:
        best = min(((round(metres(lat, lon, b, c), 6), j) for j, b, c in right), default=None)
        if best and best[0] <= RADIUS:
            found[i] = best[1]
    return found


def cloud(rng, n, lat, lon, spread_lat, spread_lon, start=0):
    rows = []
    for i in range(n):
        x = lon + rng.uniform(-spread_lon, spread_lon)
        rows.append((start + i, round(lat + rng.uniform(-spread_lat, spread_lat), 7), round((x + 180) % 360 - 180, 7)))
    return rows


PLACES = {
    "city": (60.0, 10.0, 0.006, 0.012),
    "north": (79.9, 20.0, 0.006, 0.03),
    "pole": (89.996, 0.0, 0.0039, 180.0),
    "south pole": (-89.997, 0.0, 0.0029, 180.0),
    "date line": (-17.0, 180.0, 0.006, 0.006),
    "equator": (0.0, 0.0, 0.006, 0.006),
}


@pytest.mark.parametrize("place, dense_cell", [*((place, 256) for place in PLACES), ("north", 1), ("date line", 1)])
def test_nearest_equals_loop(spark, place, dense_cell):
    rng = random.Random(place)
    left, right = cloud(rng, 150, *PLACES[place]), cloud(rng, 200, *PLACES[place])
    a = spark.createDataFrame(left, "a long, lat double, lon double")
    b = spark.createDataFrame(right, "b long, lat double, lon double")
    rows = nearest_within(a, b, RADIUS, left_id="a", right_id="b", dense_cell=dense_cell).collect()
    expected = nearest_by_loop(left, right)
    assert {r["a"]: r["b"] for r in rows} == expected
    assert expected


def test_nearest_with_copies_and_hot_cells(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    rng = random.Random(5)
    left = cloud(rng, 120, 60, 10, 0.0004, 0.0004) + cloud(rng, 80, 60, 10, 0.01, 0.02, 1000)
    right = [(i, 60.0001, 10.0002) for i in range(60)] + cloud(rng, 100, 60, 10, 0.001, 0.002, 1000)
    a = spark.createDataFrame(left, "a long, lat double, lon double")
    b = spark.createDataFrame(right, "b long, lat double, lon double")
    for dense_cell in (256, 4):
        rows = nearest_within(a, b, RADIUS, left_id="a", right_id="b", dense_cell=dense_cell).collect()
        assert {r["a"]: r["b"] for r in rows} == nearest_by_loop(left, right)


def claims_by_loop(distances, assets, nodes):
    taken, result = set(), {}
    for a, _, _ in sorted(assets):
        best = None
        for n, _, _, _ in sorted(nodes):
            d = distances.get((a, n))
            if n in taken or d is None or d > RADIUS:
                continue
            if best is None or d < best[0]:
                best = (d, n)
        if best is None:
            continue
        if next(x[3] for x in nodes if x[0] == best[1]):
            result[a] = (best[1], "opted_out")
        else:
            taken.add(best[1])
            result[a] = (best[1], "claimed")
    return result


def check_claims(spark, assets, nodes, **options):
    a = spark.createDataFrame(assets, "asset_ord long, lat double, lon double")
    n = spark.createDataFrame(nodes, "elem_ord long, lat double, lon double, opted_out boolean")
    pairs = a.crossJoin(n.withColumnsRenamed({"lat": "y", "lon": "x"})).select(
        "asset_ord", "elem_ord", F.expr(haversine_m("lat", "lon", "y", "x")).alias("d")
    )
    distances = {(r[0], r[1]): r[2] for r in pairs.collect()}
    rows = greedy_claim(a, n, RADIUS, **options).collect()
    assert {r["asset_ord"]: (r["elem_ord"], r["outcome"]) for r in rows} == claims_by_loop(distances, assets, nodes)
    assert len({r["asset_ord"] for r in rows}) == len(rows)


def with_opt_outs(rng, rows, share):
    return [(*r, rng.random() < share) for r in rows]


@pytest.mark.parametrize("dense_cell", [256, 3])
def test_claims_equal_loop(spark, dense_cell):
    rng = random.Random(11)
    assets = cloud(rng, 90, 60, 10, 0.004, 0.008)
    nodes = with_opt_outs(rng, cloud(rng, 70, 60, 10, 0.004, 0.008), 0.08)
    check_claims(spark, assets, nodes, dense_cell=dense_cell)


def test_claims_with_ties_on_a_line(spark):
    assets = [(i, 60 + i * 0.0004, 10.0) for i in (0, 2, 1, 4, 3, 5)]
    nodes = [(i, 60 + i * 0.0002, 10.0, False) for i in range(8)]
    check_claims(spark, assets, nodes)


@pytest.mark.parametrize("refuser, dense_cell", [(None, 256), (3, 256), (9, 2)])
def test_claims_in_a_crowded_position(spark, refuser, dense_cell):
    rng = random.Random(3)
    assets = [(i, 60.0, 10.0) for i in range(0, 16, 2)] + [(i, 60.0001, 10.0) for i in range(1, 16, 2)]
    nodes = [(i, 60.0003, 10.0, i == refuser) for i in range(12)]
    nodes += with_opt_outs(rng, cloud(rng, 6, 60, 10, 0.001, 0.002, 100), 0.2)
    check_claims(spark, assets, nodes, copies=3, dense_cell=dense_cell)


@pytest.mark.parametrize("fold_edges, refuser", [(200_000, None), (200_000, 17), (0, None)])
def test_claims_along_a_chain(spark, fold_edges, refuser):
    """Each asset prefers the node of the one before it, so refusals run down the street."""
    assets = [(i, 60.0, 10.0 + (i - (0.6 if i else 0)) * 0.0018) for i in range(24)]
    nodes = [(i, 60.0, 10.0 + i * 0.0018, i == refuser) for i in range(24)]
    check_claims(spark, assets, nodes, fold_edges=fold_edges)


def test_claims_in_a_crowd_of_one_cell(spark):
    rng = random.Random(5)
    assets = [(i, 60 + rng.random() * 0.0005, 10 + rng.random() * 0.001) for i in range(40)]
    nodes = with_opt_outs(rng, [(i, 60 + rng.random() * 0.0005, 10 + rng.random() * 0.001) for i in range(300)], 0.02)
    check_claims(spark, assets, nodes)
    check_claims(spark, assets, nodes[:30])


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 3), (3, 900), (50, 50), (1, 2), (2, 1)]
    found = connected(spark.createDataFrame(edges, "u long, v long")).collect()
    comps = {r["node"]: r["comp"] for r in found}
    assert len(found) == len(comps)
    assert comps == {**{i: 100 for i in range(100, 161)}, 7: 3, 3: 3, 900: 3, 1: 1, 2: 1}
    assert connected(spark.createDataFrame([], "u long, v long")).collect() == []


def test_dense_ordinals(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abbbbb"), i) for i in rng.sample(range(1000), 300)]
    df = spark.createDataFrame(rows, "g string, v long")
    got = sorted((r["n"], r["v"]) for r in dense_ordinals(df, "n", ["v"]).collect())
    assert got == list(enumerate(sorted(v for _, v in rows), start=1))
    grouped = {(r["g"], r["n"]): r["v"] for r in dense_ordinals(df, "n", ["v"], ["g"]).collect()}
    for g in "ab":
        members = sorted(v for k, v in rows if k == g)
        assert [grouped[(g, i + 1)] for i in range(len(members))] == members


def test_no_nested_loop_join(spark):
    a = spark.range(100).select(F.col("id").alias("a"), (60 + F.col("id") / 1000).alias("lat"), F.lit(10.0).alias("lon"))
    b = a.withColumnRenamed("a", "b")
    plan = nearest_within(a, b, RADIUS, left_id="a", right_id="b")._jdf.queryExecution().toString()
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in plan


def test_small_components_settle_from_points(spark, monkeypatch):
    """Crowds, also with opt-outs, write no edge and need no round; a crowd of more pairs than the bound goes on in rounds."""
    rng = random.Random(5)
    crowds = [(60 + g * 0.1, 10.0) for g in range(3)]
    assets = [(40 * g + k, lat + rng.random() * 5e-4, lon + rng.random() * 1e-3) for g, (lat, lon) in enumerate(crowds) for k in range(40)]
    nodes = [(40 * g + k, lat + rng.random() * 5e-4, lon + rng.random() * 1e-3, rng.random() < 0.05) for g, (lat, lon) in enumerate(crowds) for k in range(40)]
    check_claims(spark, assets, nodes, fold_edges=100)
    monkeypatch.setattr(claim, "_in_rounds", None)
    check_claims(spark, assets, nodes)


def test_repeated_ordinals_keep_to_the_rounds(spark):
    a = spark.createDataFrame([(1, 60.0, 10.0), (1, 60.5, 10.0), (2, 60.0, 10.0)], "asset_ord long, lat double, lon double")
    n = spark.createDataFrame([(7, 60.0, 10.001, False), (8, 60.5, 10.0, False)], "elem_ord long, lat double, lon double, opted_out boolean")
    found = {(r["asset_ord"], r["elem_ord"]) for r in greedy_claim(a, n, RADIUS).collect()}
    assert found == {(1, 8), (2, 7)}
