from datetime import date, datetime, timezone

import numpy as np
from pyspark.sql import functions as F

from emberfold.operators import imagery as M
from emberfold.schemas import SCENES

REGION = "region_id STRING, run_date DATE, min_lon DOUBLE, min_lat DOUBLE, max_lon DOUBLE, max_lat DOUBLE"


def ms(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


def test_best_scene_rules(spark):
    regions = spark.createDataFrame([("r", date(2024, 1, 14), 100.2, 0.2, 100.4, 0.4)], REGION)
    scenes = [
        ("covering", "sentinel2", ms("2024-01-10T00:00:00"), 30.0, 99.0, -1.0, 102.0, 2.0),
        ("touching", "sentinel2", ms("2024-01-01T00:00:00"), 20.0, 100.4, 0.4, 100.9, 0.9),
        ("too old", "sentinel2", ms("2023-12-31T23:59:59"), 1.0, 99.0, -1.0, 102.0, 2.0),
        ("too new", "sentinel2", ms("2024-01-15T00:00:00"), 1.0, 99.0, -1.0, 102.0, 2.0),
        ("beside", "sentinel2", ms("2024-01-10T00:00:00"), 1.0, 100.5, 0.5, 100.9, 0.9),
        ("older", "landsat", ms("2024-01-14T23:59:59"), 5.0, 99.0, -1.0, 102.0, 2.0),
        ("no cloud value", "landsat", ms("2024-01-14T23:59:59"), None, 99.0, -1.0, 102.0, 2.0),
    ]
    out = M.best_scene(regions, spark.createDataFrame(scenes, SCENES)).collect()
    assert {r.data_source: r.original_id for r in out} == {"sentinel2": "touching", "landsat": "older"}
    assert [r.acquisition_date_utc for r in out if r.data_source == "landsat"] == ["2024-01-14T23:59:59+00:00"]


def test_best_scene_against_all_pairs(spark):
    rng = np.random.default_rng(7)
    regions = []
    for i in range(60):
        x, y = rng.uniform(100, 106), rng.uniform(-3, 3)
        regions.append((f"r{i}", date(2024, 1, int(rng.integers(10, 20))), float(x), float(y), float(x + rng.uniform(0, 1.5)), float(y + 0.2)))
    scenes = []
    for i in range(300):
        x, y, size = rng.uniform(99, 106), rng.uniform(-4, 3), rng.choice([0.3, 1.0, 3.0])
        time = ms("2023-12-28T00:00:00") + int(rng.integers(0, 25 * 86_400_000))
        scenes.append((f"s{i:03}", str(rng.choice(["sentinel2", "landsat"])), time, float(rng.integers(0, 40)), float(x), float(y), float(x + size), float(y + size)))
    expected = {}
    for rid, day, *a in regions:
        low = ms(f"{day.isoformat()}T00:00:00") - 13 * 86_400_000
        for sid, source, time, cloud, *b in scenes:
            if low <= time < low + 14 * 86_400_000 and b[0] <= a[2] and b[2] >= a[0] and b[1] <= a[3] and b[3] >= a[1]:
                key = (cloud, -time, sid)
                if (rid, source) not in expected or key < expected[rid, source]:
                    expected[rid, source] = key
    out = M.best_scene(spark.createDataFrame(regions, REGION), spark.createDataFrame(scenes, SCENES))
    assert {(r.region_id, r.data_source): r.original_id for r in out.collect()} == {k: v[2] for k, v in expected.items()}


def test_scenes_of_one_degree_are_few_entries(spark):
    """Every scene of 1 degree covers a finest cell; larger scenes take few, larger cells."""
    rng = np.random.default_rng(3)
    for size, most_covered, most_edges in ((1.0, 1, 8), (1.8, 9, 18), (6.0, 40, 48)):
        rows = [(i, float(x), float(y), float(x + size), float(y + size)) for i, (x, y) in enumerate(rng.uniform(-9, 120, (200, 2)))]
        df = spark.createDataFrame(rows, "i INT, min_lon DOUBLE, min_lat DOUBLE, max_lon DOUBLE, max_lat DOUBLE")
        counts, area = {}, {}
        for r in M._covered(df, M.TILE_DEGREES).collect():
            counts[r.i] = counts.get(r.i, 0) + 1
            area[r.i] = area.get(r.i, 0) + 4**r._level
        touched = M._touched(df, M.TILE_DEGREES)
        inside = touched.filter(M._covers(F.lit(M.TILE_DEGREES), F.col("_cx"), F.col("_cy"))).groupBy("i").count().collect()
        assert area == {r.i: r["count"] for r in inside} and len(area) == 200 and max(counts.values()) <= most_covered
        edges = touched.filter(~M._covers(F.lit(M.TILE_DEGREES), F.col("_cx"), F.col("_cy"))).groupBy("i").count().collect()
        assert max(r["count"] for r in edges) <= most_edges


def test_sliding_minimum_over_every_window(spark):
    """One covering scene a day: each window of 14 days finds the clearest of its own days."""
    rng = np.random.default_rng(4)
    clouds = [float(c) for c in rng.permutation(60)]
    start = date(2023, 12, 1).toordinal()
    scenes = [
        (f"s{i}", "landsat", ms(date.fromordinal(start + i).isoformat() + "T10:00:00"), clouds[i], 99.0, -1.0, 102.0, 2.0)
        for i in range(60) if i % 7
    ]
    regions = [(f"r{i}", date.fromordinal(start + i), 100.2, 0.2, 100.4, 0.4) for i in range(80)]
    got = {r.region_id: r.cloud_cover for r in M.best_scene(spark.createDataFrame(regions, REGION), spark.createDataFrame(scenes, SCENES)).collect()}
    want = {}
    for i in range(80):
        own = [clouds[k] for k in range(max(0, i - 13), min(60, i + 1)) if k % 7]
        if own:
            want[f"r{i}"] = min(own)
    assert got == want


def test_beaten_edges_fall_out_and_the_choice_stays(spark):
    """Of 600 scenes of one place and day few edges are left, and every region still has its best scene."""
    rng = np.random.default_rng(8)
    scenes = []
    for i in range(600):
        x, y, size = 100 + rng.uniform(-1, 1), rng.uniform(-1, 1), (1.0, 1.8, 5.0)[i % 3]
        at = ms(f"2024-01-{10 + i % 2}T10:00:00") + i * 1000
        cloud = None if i % 50 == 0 else float(rng.integers(0, 300))
        scenes.append((f"s{i}", "landsat", at, cloud, x - size / 2, y - size / 2, x + size / 2, y + size / 2))
    regions = [
        (f"r{i}", date(2024, 1, 10 + i % 16), float(x), float(y), float(x + 0.2), float(y + 0.2))
        for i, (x, y) in enumerate(zip(rng.uniform(97, 103, 60), rng.uniform(-3, 3, 60), strict=True))
    ]
    df = spark.createDataFrame(scenes, SCENES)
    got = M.best_scene(spark.createDataFrame(regions, REGION), df).collect()
    want = {}
    for rid, run, x0, y0, x1, y1 in regions:
        last = ms(f"{run.isoformat()}T00:00:00") + 86_400_000
        found = [
            (s[3] is None, s[3] or 0.0, -s[2], s[0]) for s in scenes
            if s[4] <= x1 and s[6] >= x0 and s[5] <= y1 and s[7] >= y0 and last - 14 * 86_400_000 <= s[2] < last
        ]
        if found:
            want[rid] = min(found)[3]
    assert {r.region_id: r.original_id for r in got} == want and len(want) > 30

    box = ["min_lon", "min_lat", "max_lon", "max_lat"]
    order = "row_number() OVER (ORDER BY cloud_cover IS NULL, cloud_cover, -time_start_ms, scene_id) AS _place"
    day = "time_start_ms DIV 86400000"
    dated = df.selectExpr("data_source", *box, order, f"{day} DIV 14 AS _block", f"{day} AS _day")
    daily = M._best_of_each_day(M._covered(dated, M.TILE_DEGREES))
    edges = M._touched(dated, M.TILE_DEGREES)
    assert 10 * M._unbeaten_edges(dated, daily, M.TILE_DEGREES).count() < edges.count()


def test_window_catalogue_bands(spark):
    scenes = spark.createDataFrame([("a", "landsat", ms("2024-01-01T00:00:00"), 1.0, 0.0, 0.0, 1.0, 1.0)], SCENES)
    assert M.scenes_in_window(scenes, "2024-01-14").count() == 1
    assert M.scenes_in_window(scenes, "2024-01-15").count() == 0
    listing = scenes.drop("data_source", "cloud_cover")
    merged = M.scene_catalogue(
        listing.withColumn("CLOUDY_PIXEL_PERCENTAGE", F.lit(3.0)),
        listing.withColumn("CLOUD_COVER", F.lit(4.0)), listing.withColumn("CLOUD_COVER", F.lit(5.0)),
    )
    assert sorted((r.data_source, r.cloud_cover) for r in merged.collect()) == [("landsat", 4.0), ("landsat", 5.0), ("sentinel2", 3.0)]
    assert M.harmonise_bands(spark.range(1).withColumn("SR_B3", F.lit(1))).columns == ["id", "B3"]
    bands = spark.range(1).select(F.lit(8000.0).alias("B4"), F.lit(19000.0).alias("B3"), F.lit(30000.0).alias("B2"))
    row = M.stretch_bands(bands, "landsat").collect()[0]
    assert (row.B4, row.B2) == (0.0, 255.0) and abs(row.B3 - 255 * 0.5 ** (1 / 1.4)) < 1e-9
