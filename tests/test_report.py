from datetime import datetime

from pyspark.sql import functions as F

from emberfold.operators import report as R
from emberfold.operators import scoring
from emberfold.plans.jobs import report
from emberfold.schemas import INCIDENT, PREDICTION


def test_prediction_choice(spark):
    rows = [("a", 0.9, 1.0, 2), ("a", 0.1, 0.0, 1), ("", 0.5, 0.0, 3), (None, 0.5, 0.0, 4)]
    df = spark.createDataFrame(rows, PREDICTION + ", o INT")
    assert [r.confidence_score for r in R.one_prediction_each(df, F.col("o")).collect()] == [0.1]
    assert [r.confidence_score for r in R.one_prediction_each(df, F.col("o"), "last").collect()] == [0.9]


def test_latest_job(spark):
    rows = [("j1", "2025-01-01T00:00:00Z"), ("j2", "2025-02-01T00:00:00Z"), ("j0", "2024-12-31T00:00:00Z")]
    assert R.latest_job(spark.createDataFrame(rows, "job_id STRING, created_at STRING")).collect()[0][0] == "j2"


def test_tiers(spark):
    values = [0.75, 0.7500001, 0.5, 0.51, None]
    df = spark.createDataFrame([(v,) for v in values], "s DOUBLE")
    rows = df.select(scoring.risk_tier(F.col("s")), scoring.risk_colour(F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [
        ("Moderate", "orange"), ("High", "red"), ("Low", "green"), ("Moderate", "orange"), ("Low", "green"),
    ]


def incidents(spark):
    rows = [("a", 34, -1.504118, 103.992353), ("b", 5, 0.0, 100.0), ("c", 7, 1.0, 101.0)]
    return spark.createDataFrame(
        rows, "cluster_id STRING, point_count BIGINT, centroid_latitude DOUBLE, centroid_longitude DOUBLE"
    )


def test_markers_and_totals(spark):
    predictions = spark.createDataFrame([("a", 0.93, 2.6), ("b", None, 0.0), ("z", 0.6, 0.0)], PREDICTION)
    markers, totals = report(incidents(spark), predictions)
    found = {r.cluster_id: r for r in markers.collect()}
    assert set(found) == {"a", "b"}
    a = found["a"]
    assert (a.risk_level, a.marker_color, a.tooltip) == ("High", "red", "a - High Risk")
    assert (a.popup_title, a.popup_place, a.popup_confidence) == ("HIGH RISK FIRE", "-1.50, 103.99", "93%")
    assert a.air_quality_severity is None and found["b"].score == 0.0
    assert tuple(totals.collect()[0]) == (3, 39, 1, 0, 1)
    lost = R.unmatched_predictions(predictions, incidents(spark)).collect()
    assert [r.instance_id for r in lost] == ["z"]


def test_markers_show_context(spark):
    row = '{"cluster_id": "a", "point_count": 5, "realtime_context": {"weather": {"relative_humidity_percent": 40.5}}}'
    df = spark.range(1).select(F.from_json(F.lit(row), INCIDENT).alias("i")).select("i.*")
    predictions = spark.createDataFrame([("a", 0.6, 0.0)], PREDICTION)
    marker = R.report_markers(df, predictions).collect()[0]
    assert marker.relative_humidity_percent == 40.5 and marker.air_quality_severity is None


def test_totals_of_nothing(spark):
    none = spark.createDataFrame([], PREDICTION)
    assert tuple(R.report_kpis(incidents(spark), none).collect()[0]) == (3, 0, 0, 0, 0)


def test_headline(spark):
    rows = [("k", 2, True, 0.9), ("k", 1, False, 0.123), ("m", 1, True, None)]
    df = spark.createDataFrame(rows, "k STRING, o INT, detected BOOLEAN, confidence DOUBLE")
    out = {r.k: (r.status_text, r.confidence_text) for r in R.headline(df, ["k"], F.col("o")).collect()}
    assert out == {"k": ("No Fire Detected", "Confidence: 12.3%"), "m": ("FIRE DETECTED", "Confidence: 0.0%")}
