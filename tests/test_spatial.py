"""Polygon join: hand cases and a brute-force comparison."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberfold.operators import spatial
from emberfold.operators.spatial import points_near_polygons

RINGS = "poly_id INT, layer_revi STRING, rings ARRAY<ARRAY<STRUCT<lon: DOUBLE, lat: DOUBLE>>>"
RADIUS = 6378137.0


def lonlat(x, y):
    return (float(np.degrees(x / RADIUS)), float(np.degrees(2 * np.arctan(np.exp(y / RADIUS))) - 90))


def square(x, y, half):
    return [lonlat(x - half, y - half), lonlat(x + half, y - half), lonlat(x + half, y + half), lonlat(x - half, y + half)]


def layer(spark, polygons):
    return spark.createDataFrame([(i, f"p{i}", rings) for i, rings in enumerate(polygons)], RINGS)


def points(spark, xy):
    rows = [(i, *lonlat(x, y)) for i, (x, y) in enumerate(xy)]
    return spark.createDataFrame(rows, "id INT, longitude DOUBLE, latitude DOUBLE")


def hits(df):
    return sorted((r.id, r.layer_revi) for r in df.collect())


def test_inside_buffer_and_outside(spark):
    polygons = layer(spark, [[square(0, 0, 20_000)]])
    where = [(0, 0), (20_500, 0), (20_999, 0), (21_001, 0), (20_700, 20_700), (20_800, 20_800), (60_000, 0)]
    # The corner keeps a round buffer: 700 in both axes is 990 away, 800 is 1131.
    assert [i for i, _ in hits(points_near_polygons(points(spark, where), polygons))] == [0, 1, 2, 4]
    assert [i for i, _ in hits(points_near_polygons(points(spark, where), polygons, buffer=0.0))] == [0]


def test_hole_and_its_rim(spark):
    polygons = layer(spark, [[square(0, 0, 30_000), square(0, 0, 10_000)]])
    where = [(0, 0), (9_500, 0), (8_900, 0), (15_000, 0), (0, -9_100)]
    assert [i for i, _ in hits(points_near_polygons(points(spark, where), polygons))] == [1, 3, 4]


def test_overlap_fans_out_and_semi_does_not(spark):
    polygons = layer(spark, [[square(0, 0, 20_000)], [square(30_000, 0, 20_000)], [square(0, 0, 5_000), square(90_000, 0, 5_000)]])
    where = [(15_000, 0), (0, 0), (91_000, 0), (48_000, 0)]
    assert hits(points_near_polygons(points(spark, where), polygons)) == [
        (0, "p0"), (0, "p1"), (1, "p0"), (1, "p2"), (2, "p2"), (3, "p1"),
    ]
    semi = points_near_polygons(points(spark, where), polygons, semi=True)
    assert sorted(r.id for r in semi.collect()) == [0, 1, 2, 3] and "layer_revi" not in semi.columns


def test_features_may_share_a_key(spark):
    rows = [(1, "a", [square(0, 0, 20_000)]), (1, "b", [square(30_000, 0, 20_000)])]
    shared = spark.createDataFrame(rows, RINGS)
    where = points(spark, [(-15_000, 0), (15_000, 0), (45_000, 0), (90_000, 0)])
    want = [(0, "a"), (1, "a"), (1, "b"), (2, "b")]
    assert hits(points_near_polygons(where, shared)) == want
    stored, index = spatial.stored_index(shared)
    assert hits(points_near_polygons(where, stored, index=index)) == want
    assert "_feature" not in points_near_polygons(where, stored, index=index).columns


def test_edges_through_cell_centres_and_vertex_heights(spark):
    """Vertices on multiples of the half cell: rays and legs run along edges and corners."""
    diamond = [lonlat(0, -40_000), lonlat(40_000, 0), lonlat(0, 40_000), lonlat(-40_000, 0)]
    polygons = layer(spark, [[square(2_500, 2_500, 20_000)], [diamond]])
    grid = [(x, y) for x in range(-50_000, 50_001, 2_500) for y in range(-50_000, 50_001, 2_500)]
    got = set(hits(points_near_polygons(points(spark, grid), polygons, buffer=10.0)))
    for i, (x, y) in enumerate(grid):
        box = max(abs(x - 2_500), abs(y - 2_500))
        if abs(box - 20_000) > 100:
            assert ((i, "p0") in got) == (box < 20_000), (x, y)
        rhombus = abs(x) + abs(y)
        if abs(rhombus - 40_000) > 100:
            assert ((i, "p1") in got) == (rhombus < 40_000), (x, y)


def brute_force(xy, rings, buffer):
    """Even-odd rule and segment distance over all edges."""
    found = set()
    for i, (x, y) in enumerate(xy):
        inside, close = False, False
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
                if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                    inside = not inside
                t = np.clip(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2), 0, 1)
                close = close or np.hypot(x - x1 - t * (x2 - x1), y - y1 - t * (y2 - y1)) < buffer
        if inside or close:
            found.add(i)
    return found


@pytest.mark.parametrize("edges_per_row", [512, 1])
def test_random_stars_against_brute_force(spark, edges_per_row):
    rng = np.random.default_rng(5)
    rings = []
    for centre in ((0, 0), (3_000, 2_000)):
        angles = np.sort(rng.uniform(0, 2 * np.pi, 25))
        radii = rng.uniform(5_000, 60_000, 25)
        rings.append([(centre[0] + r * np.cos(a), centre[1] + r * np.sin(a)) for a, r in zip(angles, radii)])
    xy = [tuple(p) for p in rng.uniform(-70_000, 70_000, (800, 2))]
    polygons = layer(spark, [[[lonlat(*p) for p in ring] for ring in rings]])
    got = points_near_polygons(points(spark, xy), polygons, edges_per_row=edges_per_row)
    assert {r.id for r in got.collect()} == brute_force(xy, rings, 1000.0)
    assert got.count() == len({r.id for r in got.collect()})


def test_join_is_an_equi_join_and_broadcasts_by_size(spark, monkeypatch):
    polygons = layer(spark, [[square(0, 0, 20_000)]])
    where = points(spark, [(0, 0), (60_000, 0)])

    def plan_of(df):
        return df._jdf.queryExecution().executedPlan().toString()

    small = points_near_polygons(where, polygons, semi=True)
    assert "BroadcastHashJoin" in plan_of(small) and "Exchange hashpartitioning(_cx" not in plan_of(small)
    monkeypatch.setattr(spatial, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = points_near_polygons(where, polygons, semi=True)
        assert "SortMergeJoin" in plan_of(large) and "Exchange hashpartitioning(_cx" in plan_of(large)
        assert [r.id for r in large.collect()] == [0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in (plan_of(small), plan_of(large)):
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_points_without_a_place_match_nothing(spark):
    polygons = layer(spark, [[square(0, 0, 20_000)]])
    blank = spark.createDataFrame([(1, None, 0.0)], "id INT, longitude DOUBLE, latitude DOUBLE")
    assert points_near_polygons(blank, polygons).count() == 0
    assert points_near_polygons(blank, polygons.filter(F.lit(False))).count() == 0
