from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Context, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberfold.operators import air_quality as aq
from emberfold.operators.asof import WEATHER_FAILED, asof_nearest, with_weather
from emberfold.schemas import PIXELS, WEATHER


def ts(text):
    return datetime.fromisoformat(text)


def test_asof_ties_gaps_and_absent_keys(spark):
    hourly = spark.createDataFrame(
        [("a", ts("2024-01-01 05:00"), 1), ("a", ts("2024-01-01 07:00"), 2), ("a", ts("2024-01-09 00:00"), 3),
         ("a", ts("2024-01-09 00:00"), 9)],
        "k STRING, hour TIMESTAMP, v INT",
    )
    left = spark.createDataFrame(
        [(1, "a", ts("2024-01-01 06:00")), (2, "a", ts("2024-01-01 06:01")), (3, "a", ts("2024-01-04 23:00")),
         (4, "a", ts("2024-01-06 12:00")), (5, "a", ts("2023-06-01 00:00")), (6, "a", ts("2025-06-01 00:00")),
         (7, "b", ts("2024-01-01 06:00")), (8, "a", None)],
        "id INT, k STRING, t TIMESTAMP",
    )
    out = {r.id: r.nearest.v if r.nearest else None for r in asof_nearest(left, hourly, ["k"], "t").collect()}
    assert out == {1: 1, 2: 2, 3: 2, 4: 3, 5: 1, 6: 3, 7: None, 8: None}


def test_asof_does_not_multiply_rows_in_the_plan(spark):
    hourly = spark.createDataFrame([], "k STRING, hour TIMESTAMP, v INT")
    left = spark.createDataFrame([], "id INT, k STRING, t TIMESTAMP")
    plan = asof_nearest(left, hourly, ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_weather_guard(spark):
    values = [20.126, 55.0, 9.0, 0.0, 7.9, 155.77, 18.72]
    broken = [*values[:2], None, *values[3:]]
    not_a_number = [float("nan"), *values[1:]]
    rows = [(1.0, 100.0, ts("2024-01-01 05:00"), *values), (2.0, 100.0, ts("2024-01-01 05:00"), *broken),
            (3.0, 100.0, ts("2024-01-01 05:00"), *not_a_number)]
    incidents = spark.createDataFrame(
        [(lat, lat + 0.2, 99.8, ts("2024-01-01 05:20")) for lat in (1.0, 2.0, 3.0, 4.0)],
        "id DOUBLE, centroid_latitude DOUBLE, centroid_longitude DOUBLE, last_detected TIMESTAMP",
    )
    out = {r.id: r.weather for r in with_weather(incidents, spark.createDataFrame(rows, WEATHER)).collect()}
    assert out[1.0].temperature_celsius == 20.13 and out[1.0].error is None
    assert out[1.0].timestamp_utc == "2024-01-01T05:00:00+00:00"
    for broken_id in (2.0, 3.0, 4.0):
        assert out[broken_id].error == WEATHER_FAILED and out[broken_id].wind_speed_kmh is None


def incident(spark, lat=0.0, lon=100.0, when="2024-01-10 12:00"):
    return spark.createDataFrame(
        [("i", lat, lon, ts(when))],
        "cluster_id STRING, centroid_latitude DOUBLE, centroid_longitude DOUBLE, last_detected TIMESTAMP",
    )


def test_composite_is_mean_of_medians(spark):
    day = ts("2024-01-10 00:30")
    rows = [("CO", day + timedelta(days=d), 0.02, 100.02, v) for d, v in ((-1, 1.0), (0, 2.0), (1, 9.0))]
    rows += [("CO", day, 0.2, 100.2, 4.0), ("CO", day, 0.2, 100.2, 6.0)]  # same image and pixel: averaged
    rows += [("CO", day, 1.0, 100.0, 1000.0)]  # too far
    rows += [("CO", ts("2024-01-13 12:00"), 0.02, 100.02, 1000.0)]  # end of the window is open
    rows += [("CO", ts("2024-01-07 11:00"), 0.02, 100.02, 1000.0)]
    out = aq.composite_mean(incident(spark), spark.createDataFrame(rows, PIXELS), ["cluster_id"]).collect()
    assert [(r.product, r.images, r.composite) for r in out] == [("CO", 4, 3.5)]
    start = [("CO", ts("2024-01-07 12:00"), 0.02, 100.02, 3.0)]
    out = aq.composite_mean(incident(spark), spark.createDataFrame(start, PIXELS), ["cluster_id"]).collect()
    assert out[0].composite == 3.0


def test_work_does_not_grow_with_the_incidents_of_a_site(spark):
    """Pixels are read once, and medians taken per distinct window, whether 1 or 400 incidents ask."""
    rng, day = np.random.default_rng(2), ts("2024-01-10 00:00")
    rows = [
        ("CO", day + timedelta(hours=6 * int(h)), 0.1 * y, 100.0 + 0.1 * x, None if (h + x) % 9 == 0 else float(rng.uniform()))
        for h in range(-20, 20) for y in range(3) for x in range(3)
    ]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    pixels = spark.createDataFrame(rows, PIXELS)
    places = [(f"i{i}", 0.0, 100.0 + i / 4000, day + timedelta(minutes=7 * i)) for i in range(400)]
    kind = "cluster_id STRING, centroid_latitude DOUBLE, centroid_longitude DOUBLE, last_detected TIMESTAMP"
    results = {}
    for many in (1, 400):
        read.value = 0
        sites = spark.createDataFrame(places[:many], kind)
        out = aq.composite_mean(sites, pixels.mapInArrow(counted, PIXELS), ["cluster_id"]).collect()
        assert read.value == len(rows)
        results[many] = {r.cluster_id: (r.images, round(r.composite, 12)) for r in out}
    assert results[1]["i0"] == results[400]["i0"]
    for name, _, lon, at in places[::57]:
        medians, images = [], 0
        for y in range(3):
            for x in range(3):
                inside = [r[4] for r in rows if (r[2], r[3]) == (0.1 * y, 100.0 + 0.1 * x) and at - timedelta(3) <= r[1] < at + timedelta(3)]
                images += len(inside)
                medians.append(np.median([v for v in inside if v is not None]))
        assert results[400][name] == (images, round(float(np.mean(medians)), 12))
    series = aq.pixel_series(pixels)
    reach = aq._reach(spark.createDataFrame(places, kind).selectExpr(
        "cluster_id", "centroid_latitude AS _lat", "centroid_longitude AS _lon", "unix_micros(last_detected) AS _at"
    ), aq.RADIUS_KM, aq.WINDOW_DAYS)
    windows = aq.windows_seen(reach, series)
    assert windows.count() == 400 and aq.window_medians(series, windows).count() <= 9 * 2 * 2 * 40


def test_composite_across_the_antimeridian(spark):
    rows = [("CO", ts("2024-01-10 12:00"), 0.02, -179.98, 5.0)]
    out = aq.composite_mean(incident(spark, lon=179.9), spark.createDataFrame(rows, PIXELS), ["cluster_id"]).collect()
    assert [r.composite for r in out] == [5.0]


def test_record_status_and_indicators(spark):
    at = ts("2024-01-10 12:00")
    rows = [("CO", at, 0.02, 100.02, 0.16604), ("AEROSOL", at, 0.02, 100.02, 1.0), ("NO2", at, 0.02, 100.02, None)]
    out = aq.air_quality(incident(spark), spark.createDataFrame(rows, PIXELS), ["cluster_id"]).collect()[0]
    record = out.air_quality
    assert record.measurements["CO"].status == "success" and record.measurements["CO"].value == 166040.0
    assert record.measurements["NO2"].status == "no_valid_pixels"
    assert [(f.product, f.severity, f.message) for f in record.fire_indicators] == [
        ("CO", "severe", "Carbon Monoxide severely elevated")
    ]
    assert record.air_quality_severity == "high"
    none = aq.air_quality(incident(spark), spark.createDataFrame([], PIXELS), ["cluster_id"]).collect()[0]
    assert {m.status for m in none.air_quality.measurements.values()} == {"no_data"}
    assert none.air_quality.air_quality_severity == "low"


@pytest.mark.parametrize("severe,moderate,expected", [
    (2, 0, "severe"), (1, 1, "severe"), (1, 0, "high"), (0, 2, "high"), (0, 1, "moderate"), (0, 0, "low"),
])
def test_class(spark, severe, moderate, expected):
    got = spark.range(1).select(aq.air_quality_class(F.lit(severe), F.lit(moderate))).collect()[0][0]
    assert got == expected


def test_steps_are_two_an_image_whatever_windows_ask():
    rng = np.random.default_rng(5)
    series = np.sort(rng.integers(0, 4, 90))
    at = rng.integers(0, 60, 90)
    order = np.lexsort([at, series])
    series, at, value = series[order], at[order], np.where(rng.random(90) < 0.2, np.nan, rng.normal(size=90))
    owner, start, images, median = aq.window_steps(series, at, value, 12)
    assert len(owner) <= 2 * len(series)
    for one in range(4):
        for begin in range(-20, 80):
            inside = value[(series == one) & (at >= begin) & (at < begin + 12)]
            step = np.nonzero((owner == one) & (start <= begin))[0]
            found = (images[step[-1]], median[step[-1]]) if len(step) else (0, np.nan)
            there = inside[~np.isnan(inside)]
            assert found[0] == len(inside)
            assert np.array_equal([found[1]], [np.median(there) if len(there) else np.nan], equal_nan=True)


def test_sums_of_medians_are_exact():
    values = [0.1, -0.2, 1e-27, -3.3e-19, 5e-19, -5e-19, 9.9e19, -9.9e19, 1e20 / 3, 123456.789, -0.0, float("nan")]
    digits = Context(prec=76, rounding=ROUND_HALF_UP)
    exact = [Decimal(repr(v)).quantize(Decimal("1e-18"), context=digits) if v == v else Decimal(0) for v in values]
    total = Decimal(0)
    for v in exact:
        total = digits.add(total, v)
    parts = aq._limbs(np.array(values))
    assert aq._from_limbs(parts).to_pylist() == exact
    assert aq._from_limbs([np.array([p.sum()]) for p in parts]).to_pylist() == [total]
    assert aq._from_limbs(aq._limbs(np.array([]))).to_pylist() == []


def test_composite_equals_medians_per_window(spark):
    """Every incident has a window of its own: the same as taking each window's medians by themselves."""
    rng, day = np.random.default_rng(7), ts("2024-01-10 00:00")
    rows = [
        (("CO", "NO2", None)[i % 3], day + timedelta(minutes=int(rng.integers(-40000, 40000))), float(rng.normal(0, 0.4)),
         float(-179.9 + rng.normal(0, 0.4)), None if i % 11 == 0 else float(rng.normal()))
        for i in range(1500)
    ]
    rows += [("CO", None, 0.0, 180.0, 1.0), ("CO", day, None, 180.0, 1.0)]
    rows = [(p, t, y, x if x is None or x >= -180 else x + 360, v) for p, t, y, x, v in rows]
    pixels = spark.createDataFrame(rows, PIXELS)
    kind = "cluster_id STRING, centroid_latitude DOUBLE, centroid_longitude DOUBLE, last_detected TIMESTAMP"
    sites = [
        (f"i{i // 2}" if i % 7 else None, float(rng.normal(0, 0.3)), -179.9 + float(rng.normal(0, 0.1)),
         day + timedelta(minutes=int(rng.integers(-50000, 50000))))
        for i in range(80)
    ] + [("none", None, 180.0, day), ("never", 0.0, 180.0, None)]
    incidents = spark.createDataFrame(sites, kind)
    out = aq.composite_mean(incidents, pixels, ["cluster_id"]).collect()

    series = aq.pixel_series(pixels)
    placed = incidents.selectExpr(
        "cluster_id", "centroid_latitude AS _lat", "centroid_longitude AS _lon", "unix_micros(last_detected) AS _at"
    )
    reach = aq.windows_seen(aq._reach(placed, aq.RADIUS_KM, aq.WINDOW_DAYS), series)
    centre = [(F.col(c) + 0.5) * aq.PIXEL_DEGREES for c in ("pixel_y", "pixel_x")]
    plain = (
        reach.join(aq.window_medians(series, reach), ["tile_y", "tile_x", "span", "first", "last"])
        .filter(aq.hav_distance(F.col("_lat"), F.col("_lon"), *centre) <= np.sin(aq.RADIUS_KM / aq.EARTH_RADIUS_KM / 2) ** 2)
        .groupBy("cluster_id", "product").agg(F.sum("images").alias("images"), aq._mean("median").alias("composite"))
    )
    assert len(out) > 80

    def in_order(rows):
        return sorted(rows, key=repr)

    assert in_order(map(tuple, out)) == in_order(map(tuple, plain.collect()))
