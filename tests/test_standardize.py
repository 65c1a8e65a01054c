from datetime import datetime

from pyspark.sql import functions as F

from emberfold.operators import standardize as S
from emberfold.plans.jobs import detect_hotspots
from emberfold.schemas import FIRMS, GOLDEN_COLUMNS, HIMAWARI

GOLDEN = (
    "latitude DOUBLE, longitude DOUBLE, acq_datetime TIMESTAMP, frp_mean DOUBLE, frp_max DOUBLE, "
    "confidence DOUBLE, n_detections INT, source STRING"
)


def firms(spark, *rows):
    return spark.createDataFrame(list(rows), FIRMS)


def at(hour, minute=0):
    return datetime(2024, 1, 5, hour, minute)


def test_firms(spark):
    df = firms(
        spark, (1.0, 100.0, 5.0, "2024-01-05", 5, "L"), (1.0, 100.0, 5.0, "2024-01-05", 1700, "h"),
        (1.0, 100.0, 5.0, "2024-01-05", 0, "n"), (1.0, 100.0, 5.0, "2024-01-05", 0, "?"),
    )
    rows = S.standardize_firms(df).collect()
    assert [r.confidence for r in rows] == [30, 100, 75, None]
    assert rows[0].frp_mean == 5.0 and rows[0].n_detections == 1 and rows[0].source == "FIRMS"
    assert "frp_max" not in S.standardize_firms(df).columns
    assert "frp_mean" not in S.standardize_firms(df.drop("frp")).columns


def test_himawari(spark):
    df = spark.createDataFrame(
        [(2024, 1, 5, 3, 1.5, 101.0, 7.0, 9.0, 80.0, 4), (2024, 13, 5, 3, 1.5, 101.0, 7.0, 9.0, float("nan"), 4)],
        HIMAWARI,
    )
    rows = S.standardize_himawari(df).withColumn("t", F.date_format("acq_datetime", "yyyy-MM-dd HH:mm")).collect()
    assert rows[0].t == "2024-01-05 03:00" and rows[0].frp_max == 9.0 and rows[0].source == "JAXA"
    assert rows[1].acq_datetime is None and rows[1].confidence is None
    assert S.standardize_himawari(df).columns == GOLDEN_COLUMNS


def test_confidence_filter(spark):
    df = firms(spark, *[(1.0, 1.0, 1.0, "2024-01-05", 0, c) for c in ("H", "n", "l", "x", None)])
    assert [r.confidence for r in S.keep_confident(df).collect()] == ["H", "n"]
    assert S.keep_confident(df.drop("confidence")).count() == 5


def test_fuse_skips_absent_feeds(spark):
    df = firms(spark, (1.0, 100.0, 5.0, "2024-01-05", 5, "h"))
    assert S.fuse({"FIRMS": None, "JAXA": None}) is None
    assert detect_hotspots({"FIRMS": None}) is None
    assert S.fuse({"FIRMS": df, "JAXA": None}).count() == 1
    empty = spark.createDataFrame([], HIMAWARI)
    both = S.fuse({"FIRMS": df, "JAXA": empty})
    assert both.count() == 1 and both.collect()[0].frp_max is None


def test_dedup_keeps_highest_confidence_nulls_last(spark):
    rows = [
        (1.001, 100.0, at(3, 1), 1.0, None, None, 1, "A"),
        (1.002, 100.0, at(3, 9), 2.0, None, 10.0, 1, "B"),
        (1.003, 100.0, at(3, 5), 3.0, None, 90.0, 1, "C"),
        (1.003, 100.0, at(3, 4), 4.0, None, 90.0, 1, "D"),
        (1.003, 100.0, at(3, 10), 5.0, None, 1.0, 1, "E"),
        (1.013, 100.0, at(3, 1), 6.0, None, None, 1, "F"),
    ]
    out = S.dedup_spatiotemporal(spark.createDataFrame(rows, GOLDEN)).collect()
    assert sorted(r.source for r in out) == ["D", "E", "F"]


def test_dedup_ties_do_not_follow_row_order(spark):
    rows = [(1.0, 100.0, at(3, 1), 1.0, m, 50.0, n, "A") for m, n in ((None, 2), (4.0, 1), (3.0, 7), (3.0, 5))]
    for some in (rows, rows[::-1]):
        [row] = S.dedup_spatiotemporal(spark.createDataFrame(some, GOLDEN).coalesce(1)).collect()
        assert (row.frp_max, row.n_detections) == (None, 2)


def test_dedup_reduces_before_the_shuffle(spark):
    df = spark.createDataFrame([], GOLDEN)
    plan = S.dedup_spatiotemporal(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_keep_one_and_idempotency(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 5, "z")], "k STRING, o INT, v STRING")
    assert sorted(r.v for r in S.keep_one(df, ["k"], F.col("o")).collect()) == ["x", "z"]
    assert sorted(r.v for r in S.keep_one(df, ["k"], F.col("o"), "last").collect()) == ["y", "z"]
    seen = spark.createDataFrame([("b",)], "k STRING")
    assert [r.v for r in S.drop_processed(df, seen, "k", F.col("o")).collect()] == ["x"]


def test_one_local_day_or_all_runs(spark):
    df = firms(
        spark, (1.0, 100.0, 5.0, "2024-01-04", 1659, "h"), (1.0, 100.0, 5.0, "2024-01-04", 1700, "h"),
        (1.0, 100.0, 5.0, "2024-01-05", 1659, "h"), (1.0, 100.0, 5.0, "2024-01-05", 1700, "h"),
    )
    assert detect_hotspots({"FIRMS": df}, run_date="2024-01-05").count() == 2
    runs = detect_hotspots({"FIRMS": df}).groupBy("run_date").count().collect()
    assert sorted((str(r.run_date), r["count"]) for r in runs) == [
        ("2024-01-04", 1), ("2024-01-05", 2), ("2024-01-06", 1),
    ]
