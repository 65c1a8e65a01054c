"""Density clustering against a brute-force reference on small fixtures."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberfold.operators import dbscan as module
from emberfold.operators.dbscan import Grid, dbscan


def brute_force(rows: pd.DataFrame, eps_km: float, min_samples: int) -> pd.DataFrame:
    """All pairs, then a scan in row order: the textbook algorithm."""
    lat, lon = np.radians(rows["latitude"].values), np.radians(rows["longitude"].values)
    half = np.sin((lat[:, None] - lat[None, :]) / 2) ** 2
    half = half + np.cos(lat)[:, None] * np.cos(lat)[None, :] * np.sin((lon[:, None] - lon[None, :]) / 2) ** 2
    near = 2 * 6371.0 * np.arcsin(np.minimum(1, np.sqrt(half))) <= eps_km
    core = near.sum(axis=1) >= min_samples
    label = np.full(len(rows), -1)
    number = 0
    for i in range(len(rows)):
        if not core[i] or label[i] >= 0:
            continue
        label[i], stack = number, [i]
        while stack:
            j = stack.pop()
            if not core[j]:
                continue
            for k in np.flatnonzero(near[j]):
                if label[k] < 0:
                    label[k] = number
                    stack.append(k)
        number += 1
    return rows.assign(cluster_id=label, is_core=core)


def check(spark, points: np.ndarray, eps_km: float = 5.0, min_samples: int = 5):
    rows = pd.DataFrame(points, columns=["latitude", "longitude"])
    rows["seq"] = np.arange(len(rows))
    expected = brute_force(rows, eps_km, min_samples)
    got = (
        dbscan(spark.createDataFrame(rows).repartition(5), eps_km, min_samples, order_by=[F.col("seq")])
        .toPandas().sort_values("seq")
    )
    assert got["is_core"].tolist() == expected["is_core"].tolist()
    assert got["cluster_id"].fillna(-1).astype(int).tolist() == expected["cluster_id"].tolist()
    return expected


def test_random_field(spark):
    rng = np.random.default_rng(1)
    centres = rng.uniform([-3, 100], [-1, 102], (40, 2))
    points = np.concatenate([centres[rng.integers(0, 40, 500)] + rng.normal(0, 0.03, (500, 2)),
                             rng.uniform([-3, 100], [-1, 102], (100, 2))])
    expected = check(spark, points)
    assert expected["cluster_id"].max() > 3 and (expected["cluster_id"] < 0).any()
    assert ((expected["cluster_id"] >= 0) & ~expected["is_core"]).any()


def test_dense_cells_are_split_not_paired(spark, monkeypatch):
    """Heavy neighbouring cells go through several refinement levels."""
    monkeypatch.setattr(module, "PAIRS_PER_BOX_PAIR", 4)
    levels = []
    original = module._split_pairs
    monkeypatch.setattr(module, "_split_pairs", lambda *a: levels.append(a[-1]) or original(*a))
    rng = np.random.default_rng(2)
    step = Grid(5.0).step
    # Two bands of points about epsilon apart, so that most boxes leave the question open.
    left = np.column_stack([rng.uniform(0.2, 0.8, 150) * step, 100 + rng.uniform(0.0, 0.1, 150) * step])
    gap = np.degrees(5.0 / 6371.0)
    right = left + [0, gap * 1.0005]
    far = np.column_stack([rng.uniform(0.2, 0.8, 150) * step, 101 + rng.uniform(0.0, 0.1, 150) * step])
    close = far + [0, gap * 0.99]
    check(spark, np.concatenate([left, right, far, close]))
    assert levels and max(levels) >= 2


def test_copies_count_as_points(spark):
    one_place = np.tile([[0.5, 110.0]], (5, 1))
    four_copies = np.tile([[1.5, 110.0]], (4, 1))
    expected = check(spark, np.concatenate([one_place, four_copies, [[1.53, 110.0]], [[2.5, 110.0]]]))
    assert expected["is_core"].tolist() == [True] * 10 + [False]


def test_border_point_goes_to_the_first_cluster_it_touches(spark):
    a = [[0.0, 100.0 + 0.001 * i] for i in range(5)]
    b = [[0.0, 100.08 + 0.001 * i] for i in range(5)]
    check(spark, np.array([[0.0, 100.042], *b, *a]))
    check(spark, np.array([*a, [0.0, 100.042], *b]))


@pytest.mark.parametrize("lat,lon", [(0.0, 180.0), (70.0, 20.0), (-84.0, -180.0)])
def test_antimeridian_and_high_latitudes(spark, lat, lon):
    rng = np.random.default_rng(3)
    spread = 0.15 / np.cos(np.radians(lat))
    points = np.column_stack([lat + rng.uniform(-0.15, 0.15, 120), lon + rng.uniform(-spread, spread, 120)])
    points[:, 1] = (points[:, 1] + 180) % 360 - 180
    check(spark, points)


@pytest.mark.parametrize("eps_km,min_samples", [(1.0, 1), (5.0, 2), (20.0, 12)])
def test_parameters(spark, eps_km, min_samples):
    rng = np.random.default_rng(4)
    check(spark, rng.uniform([-2, 100], [-1.5, 100.5], (150, 2)), eps_km, min_samples)


def test_groups_are_separate_and_numbered_from_zero(spark):
    rows = [(day, 0.0, 100.0 + 0.001 * i) for day in ("d1", "d2") for i in range(5)]
    rows += [("d3", 0.0, 100.0 + 0.001 * i) for i in range(4)] + [("d1", None, 100.0)]
    df = spark.createDataFrame(rows, "day STRING, latitude DOUBLE, longitude DOUBLE")
    out = dbscan(df, partition_by=["day"]).collect()
    assert {r.cluster_id for r in out if r.day in ("d1", "d2") and r.latitude is not None} == {0}
    assert [r.cluster_id for r in out if r.day == "d3"] == [None] * 4
    assert len(out) == len(rows)


def test_empty_input(spark):
    assert dbscan(spark.createDataFrame([], "latitude DOUBLE, longitude DOUBLE")).count() == 0


@pytest.mark.parametrize("min_samples,pairs_per_box_pair", [(4, 1024), (4, 16), (20, 9)])
def test_clusters_across_tiles(spark, monkeypatch, min_samples, pairs_per_box_pair):
    """Tiles of few cells, so that most clusters leave theirs; with and without big cells."""
    monkeypatch.setattr(module, "TILE", 3)
    monkeypatch.setattr(module, "PAIRS_PER_BOX_PAIR", pairs_per_box_pair)
    monkeypatch.setattr(module, "PAIRS_AT_ONCE", 50)
    rng = np.random.default_rng(5)
    centres = rng.uniform([-1, 179.6], [0, 180.4], (12, 2))
    points = np.concatenate([centres[rng.integers(0, 12, 400)] + rng.normal(0, 0.04, (400, 2)),
                             rng.uniform([-1, 179.6], [0, 180.4], (200, 2))])
    points[:, 1] = (points[:, 1] + 180) % 360 - 180
    expected = check(spark, points, 5.0, min_samples)
    assert expected["cluster_id"].max() > 1


def test_rows_written_follow_the_points(spark, monkeypatch):
    """In a field of three or four points to a cell no table of neighbour pairs is written."""
    written = []
    original = module.cut_lineage

    def counting(df):
        out = original(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(module, "cut_lineage", counting)
    side = 30 * Grid(5.0).step
    points = np.random.default_rng(6).uniform([0, 100], [side, 100 + side], (3000, 2))
    out = dbscan(spark.createDataFrame(points.tolist(), "latitude DOUBLE, longitude DOUBLE"))
    assert out.count() == 3000
    assert sum(written) < 5 * 3000
