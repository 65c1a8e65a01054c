import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from emberfold.functions import geo, nested, times


def one(spark, *columns, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(0).alias("_"))
    row = df.select(*columns).collect()[0]
    return row[0] if len(columns) == 1 else tuple(row)


def test_haversine_and_mercator(spark):
    km = geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))
    assert one(spark, km) == pytest.approx(6371.0 * math.pi / 180)
    x, y = one(spark, geo.mercator_x(F.lit(180.0)), geo.mercator_y(F.lit(85.0511287798066)))
    assert x == pytest.approx(20037508.342789244) and y == pytest.approx(20037508.342789244)


@pytest.mark.parametrize("value,expected", [(0.125, 0.12), (0.135, 0.14), (1.005, 1.0), (-1.445, -1.44), (2.675, 2.68)])
def test_rounding_scales_then_rounds_half_even(spark, value, expected):
    # numpy.round gives these; 1.005 * 100 is below the tie, 2.675 * 100 is on it.
    assert one(spark, geo.round_half_even(F.lit(value), 2)) == expected


def test_geo_to_pixel(spark):
    box = tuple(F.lit(v) for v in (100.0, -2.0, 102.0, 0.0))

    def pixel(lat, lon, box=box):
        return one(spark, *geo.geo_to_pixel(F.lit(lat), F.lit(lon), box, F.lit(800), F.lit(600)))

    assert pixel(-1.0, 101.0) == (400, 300)
    assert pixel(0.0, 100.0) == (0, 0)
    assert pixel(-2.0, 102.0) == (800, 600)
    assert pixel(5.0, 99.0) == (0, 0)
    flat = tuple(F.lit(v) for v in (100.0, -2.0, 100.0, 0.0))
    assert pixel(-1.0, 100.0, flat) == (None, None)


def test_sigmoid_and_stretch(spark):
    assert one(spark, geo.sigmoid(F.lit(2.6))) == pytest.approx(0.9308615796566531, abs=1e-15)
    low, mid, high = one(spark, *[geo.visual_stretch(F.lit(v), 0.0, 3500.0) for v in (-5.0, 1750.0, 9000.0)])
    assert (low, high) == (0.0, 255.0) and mid == pytest.approx(255 * 0.5 ** (1 / 1.4))


def test_hhmm(spark):
    got = [one(spark, times.hhmm_timestamp(F.lit("2024-01-05"), F.lit(v))) for v in (0, 5, 1659, 1700)]
    assert [(t.hour, t.minute) for t in got] == [(0, 0), (0, 5), (16, 59), (17, 0)]
    assert one(spark, times.hhmm_timestamp(F.lit("not a day"), F.lit(5))) is None


def test_local_day(spark):
    def inside(text):
        return one(spark, times.in_local_day(F.lit(text).cast("timestamp"), "2024-01-05"))

    assert not inside("2024-01-04 16:59:59") and inside("2024-01-04 17:00:00")
    assert inside("2024-01-05 16:59:59") and not inside("2024-01-05 17:00:00")
    assert times.candidate_utc_days("2024-01-01") == ["2023-12-31", "2024-01-01"]


def test_run_dates(spark):
    def run(text, days):
        return str(one(spark, times.run_date_of(F.lit(text).cast("timestamp"), days=days)))

    assert run("2024-01-04 17:00:00", 1) == "2024-01-05"
    assert run("2023-12-31 17:00:00", 7) == "2024-01-07"
    assert run("2024-01-07 16:59:00", 7) == "2024-01-07"
    assert run("2024-01-07 17:00:00", 7) == "2024-01-14"
    assert run("2023-12-31 16:59:00", 7) == "2023-12-31"


def test_floor_iso_and_paths(spark):
    ts = F.lit("2024-01-05 03:19:59.5").cast("timestamp")
    assert one(spark, F.date_format(times.floor_minutes(ts), "HH:mm:ss")) == "03:10:00"
    assert one(spark, times.iso_utc(ts)) == "2024-01-05T03:19:59.500000+00:00"
    assert one(spark, times.iso_utc(F.lit("2024-01-05 03:19:59").cast("timestamp"))) == "2024-01-05T03:19:59+00:00"
    assert one(spark, *times.hour_path(ts)) == ("202401/05", "H09_20240105_0300")


def test_dot_path(spark):
    df = spark.sql("SELECT named_struct('b', map('c', 3)) AS a, '{\"x\": {\"y\": 7}}' AS j")
    row = df.select(
        nested.dot_path(df.schema, "a.b.c").alias("v"), nested.dot_path(df.schema, "a.b.z").alias("w"),
        nested.dot_path(df.schema, "a.q.c").alias("x"), nested.json_path(F.col("j"), "x.y").alias("y"),
    ).collect()[0]
    assert tuple(row) == (3, None, None, "7")


def test_percent_and_nan(spark):
    assert one(spark, nested.percent_text(F.lit(0.9308))) == "93%"
    assert one(spark, nested.percent_text(F.lit(0.5), 1)) == "50.0%"
    assert one(spark, nested.nan_to_null(F.lit(float("nan")))) is None


def test_fixed_text_as_exact_formatting(spark):
    rng = random.Random(3)
    values = [0.0, -0.0, 0.125, 0.375, -2.675, 1.005, 1.015, -0.001, 0.005, 0.004999999999999999, 99.995, 179.999, 0.995, 104.745]
    values += [rng.randrange(-36000, 36000) / 200 for _ in range(400)] + [rng.uniform(-180, 180) for _ in range(200)]
    values += [math.nextafter(k / 200, side) for k in range(-401, 400, 2) for side in (-999.0, 999.0)]
    for places in (0, 2, 3):
        rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", nested.fixed_text(F.col("v"), places).alias("t"))
        assert [r.t for r in rows.collect()] == [f"{v:.{places}f}" for v in values]
    assert one(spark, nested.fixed_text(F.lit(None).cast("double"))) is None
