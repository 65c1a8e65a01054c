"""Incident records, severity and score, with the values of the known sample incident."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from emberfold.operators import incidents as I
from emberfold.operators import scoring
from emberfold.operators.dbscan import dbscan
from emberfold.operators.imagery import incident_regions
from emberfold.schemas import AIR_QUALITY_CONTEXT, HOTSPOT, INCIDENT, WEATHER_CONTEXT
from emberfold.sources.records import read_hotspots, read_incidents, write_by_run

# Latitude, longitude and mean power of the sample incident's 34 hotspots.
SAMPLE = [
    (-1.44, 103.98, 454.39), (-1.44, 104.0, 923.1), (-1.46, 103.96, 70.59), (-1.46, 103.98, 809.36),
    (-1.46, 104.0, 1568.65), (-1.46, 104.02, 1196.42), (-1.46, 104.04, 1195.97), (-1.48, 103.94, 11.58),
    (-1.48, 103.96, 42.09), (-1.48, 103.98, 359.9), (-1.48, 104.0, 801.45), (-1.48, 104.02, 704.74),
    (-1.48, 104.04, 704.56), (-1.5, 103.94, 10.4), (-1.5, 103.96, 20.99), (-1.5, 103.98, 63.94),
    (-1.5, 104.0, 114.81), (-1.5, 104.02, 258.96), (-1.5, 104.04, 258.92), (-1.52, 103.94, 18.57),
    (-1.52, 103.98, 31.75), (-1.52, 104.0, 70.2), (-1.52, 104.02, 97.44), (-1.52, 104.04, 97.43),
    (-1.54, 103.94, 171.73), (-1.54, 103.96, 171.73), (-1.54, 103.98, 147.25), (-1.54, 104.0, 41.78),
    (-1.54, 104.02, 58.66), (-1.54, 104.04, 56.93), (-1.56, 103.96, 1210.24), (-1.56, 103.98, 802.65),
    (-1.56, 104.0, 70.89), (-1.56, 104.02, 63.5),
]
GOLDEN = (
    "run_date DATE, latitude DOUBLE, longitude DOUBLE, acq_datetime TIMESTAMP, frp_mean DOUBLE, "
    "frp_max DOUBLE, confidence DOUBLE, n_detections INT, source STRING"
)


@pytest.fixture(scope="module")
def clustered(spark):
    when = datetime(2019, 9, 21)
    rows = [(when.date(), lat, lon, when, frp, frp * 2, None, 1, "JAXA") for lat, lon, frp in SAMPLE]
    return dbscan(spark.createDataFrame(rows, GOLDEN), partition_by=["run_date"]).cache()


@pytest.fixture(scope="module")
def incident(spark, clustered):
    weather = F.from_json(F.lit(json.dumps({
        "temperature_celsius": 24.39, "relative_humidity_percent": 86.76, "dew_point_celsius": 22.04,
        "precipitation_mm": 0.0, "wind_speed_kmh": 7.9, "wind_direction_deg": 155.77, "wind_gusts_kmh": 18.72,
    })), WEATHER_CONTEXT)
    air = F.from_json(F.lit(json.dumps({"air_quality_severity": "severe", "fire_indicators": []})), AIR_QUALITY_CONTEXT)
    return I.with_severity(I.cluster_summary(clustered).withColumns({"weather": weather, "air_quality": air}))


def test_sample_clusters_as_one_incident(clustered):
    rows = clustered.collect()
    assert {r.cluster_id for r in rows} == {0} and all(r.is_core for r in rows)


def test_sample_summary(incident):
    row = incident.collect()[0]
    assert row.cluster_id == "fire_cluster_20190921_0" and row.point_count == 34
    assert (row.centroid_latitude, row.centroid_longitude) == (-1.504118, 103.992353)
    assert row.detected_by == ["JAXA"] and row.avg_frp == pytest.approx(372.98735294)
    severity = row.fire_severity_assessment
    assert (severity.overall_severity, severity.severity_score) == ("severe", 6)
    assert severity.contributing_factors == ["High hotspot density (>=15)", "Severe air quality impact"]
    assert severity.details.weather_severity == "low"


def test_sample_score(incident):
    row = scoring.score_incidents(incident).collect()[0]
    assert row.instance_id == "fire_cluster_20190921_0"
    assert row.raw_score == pytest.approx(2.6) and row.confidence_score == pytest.approx(0.9308615796566531, abs=1e-15)


def test_records_round_trip(spark, clustered, incident, tmp_path):
    documents, hotspots = I.incident_documents(incident), I.hotspot_records(clustered)
    write_by_run(documents, str(tmp_path / "out"))
    write_by_run(hotspots, str(tmp_path / "spots"))
    back, spots = read_incidents(spark, str(tmp_path / "out")), read_hotspots(spark, str(tmp_path / "spots"))
    assert back.count() == 1 and spots.count() == 34
    assert I.with_power(back).collect()[0].avg_frp == pytest.approx(372.98735294)
    nested = I.nest_hotspots(back, spots)
    assert len(nested.collect()[0].hotspots) == 34
    # The box of the record is that of its hotspots.
    for some in (back, nested.drop("min_lat", "max_lat", "min_lon", "max_lon").selectExpr(
            "*", *[f"CAST(NULL AS DOUBLE) AS {c}" for c in ("min_lat", "max_lat", "min_lon", "max_lon")]).withColumn(
            "hotspots", F.from_json(F.to_json("hotspots"), f"ARRAY<{HOTSPOT}>"))):
        box = incident_regions(some).collect()[0]
        assert [round(v, 2) for v in (box.min_lon, box.min_lat, box.max_lon, box.max_lat)] == [103.89, -1.61, 104.09, -1.39]
    # A rerun of another day leaves this one alone; a rerun of this day replaces it.
    other = documents.withColumn("run_date", F.lit("2019-09-22").cast("date"))
    write_by_run(other, str(tmp_path / "out"))
    write_by_run(documents, str(tmp_path / "out"))
    counts = {str(r.run_date): r["count"] for r in spark.read.json(str(tmp_path / "out")).groupBy("run_date").count().collect()}
    assert counts == {"2019-09-21": 1, "2019-09-22": 1}
    # A rerun that finds nothing any more leaves no incident of the day behind.
    write_by_run(documents.limit(0), str(tmp_path / "out"), runs=["2019-09-21"])
    left = read_incidents(spark, str(tmp_path / "out"))
    assert left.filter("run_date = DATE '2019-09-21'").count() == 0 and left.count() == 1


def test_three_file_forms_and_both_hotspot_shapes(spark, tmp_path):
    feature = {"cluster_id": "a", "hotspots": [
        {"properties": {"frp_mean": 10.0}, "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}}, {"properties": {}}]}
    flat = {"cluster_id": "b", "hotspots": [{"frp_mean": 4.0, "latitude": 2.0, "longitude": 1.0}, {"frp_mean": None}]}
    none = {"cluster_id": "c", "hotspots": []}
    forms = {
        "lines": "\n".join(json.dumps(d) for d in (feature, flat, none)),
        "document": json.dumps([feature, flat, none], indent=2),
        "concatenated": "\n".join(json.dumps(d, indent=2) for d in (feature, flat, none)),
    }
    for layout, text in forms.items():
        path = tmp_path / f"{layout}.jsonl"
        path.write_text(text)
        read = read_incidents(spark, str(path), layout)
        power = {r.cluster_id: r.avg_frp for r in I.with_power(read).collect()}
        assert power == {"a": 10.0, "b": 4.0, "c": 0.0}, layout
    regions = {r.region_id: r.min_lon for r in incident_regions(read).collect()}
    assert regions == pytest.approx({"a": 0.95, "b": 0.95})


def assess(spark, count, weather=None, air=None):
    column = I.assess_severity(
        F.lit(count), F.from_json(F.lit(json.dumps(weather) if weather is not None else None), WEATHER_CONTEXT),
        F.from_json(F.lit(json.dumps(air) if air is not None else None), AIR_QUALITY_CONTEXT),
    )
    return spark.range(1).select(column.alias("s")).collect()[0].s


def test_severity_rules(spark):
    dry_windy = {"relative_humidity_percent": 39.9, "wind_speed_kmh": 20.1}
    top = assess(spark, 15, dry_windy, {"air_quality_severity": "severe"})
    assert (top.severity_score, top.overall_severity) == (9, "critical")
    assert top.details.weather_severity == "high" and len(top.contributing_factors) == 4
    edge = assess(spark, 5, {"relative_humidity_percent": 40.0, "wind_speed_kmh": 20.0}, {"air_quality_severity": "moderate"})
    assert (edge.severity_score, edge.overall_severity) == (3, "moderate")
    failed = assess(spark, 4, {**dry_windy, "error": "x"})
    assert (failed.severity_score, failed.overall_severity) == (1, "low")
    assert failed.details.air_quality_severity == "unknown" and failed.details.weather_severity == "low"
    assert assess(spark, 5, {}, {"air_quality_severity": "high"}).overall_severity == "high"


def criterion(spark, spec, value):
    return spark.range(1).select(scoring.criterion_score(spec, F.lit(value))).collect()[0][0]


def test_criterion_rules(spark):
    by_name = {c["data_key"].split(".")[-1]: c for c in scoring.DEFAULT_CONFIG["criteria"]}
    assert [criterion(spark, by_name["avg_frp"], v) for v in (0.0, 100.0, 100.1, 1500.0, 1501.0, None)] == [2, 2, 5, 10, 10, 5]
    assert [criterion(spark, by_name["precipitation_mm"], v) for v in (0.0, 0.1, 5.0)] == [10, 1, 10]
    assert [criterion(spark, by_name["relative_humidity_percent"], v) for v in (30.0, 61.0, 150.0)] == [10, 3, 1]
    assert [criterion(spark, by_name["air_quality_severity"], v) for v in ("SEVERE", "odd", None)] == [10, 5, 5]
    with pytest.raises(ValueError):
        criterion(spark, {"type": "other", "mapping": {}}, 1.0)


def test_config_checks(spark, tmp_path):
    with pytest.raises(ValueError):
        scoring.validate_config({})
    with pytest.raises(ValueError):
        scoring.validate_config({"criteria": [{"weight": 0.5}]})
    path = tmp_path / "criteria.json"
    path.write_text(json.dumps(scoring.DEFAULT_CONFIG, indent=2))
    assert scoring.load_config(spark, str(path)) == scoring.DEFAULT_CONFIG
    assert scoring.load_config(spark, str(tmp_path / "none.json"), str(path)) == scoring.DEFAULT_CONFIG


def test_missing_fields_score_five_each(spark):
    row = scoring.score_incidents(spark.range(1).select(F.lit(None).cast("string").alias("cluster_id"))).collect()[0]
    assert (row.instance_id, row.raw_score, row.confidence_score) == ("unknown_instance", 0.0, 0.5)
