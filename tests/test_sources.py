import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from emberfold.functions import times
from emberfold.schemas import PREDICTION
from emberfold.sources import feeds, polygons, records

HEADER = "latitude,longitude,bright,acq_date,acq_time,confidence,frp\n"


def test_firms_by_header_name_and_empty_bodies(spark, tmp_path):
    root = tmp_path / "firms"
    bodies = {
        ("S1", "2024-01-04"): HEADER + "1.0,100.0,3.0,2024-01-04,1700,n,5.5\n1.0,100.0,3.0,2024-01-04,1659,h,5.5\n",
        ("S2", "2024-01-05"): HEADER + "1.0,100.0,3.0,2024-01-04,1700,n,5.5\n2.0,100.0,3.0,2024-01-05,5,l,1\n2.5,100.0,3.0,2024-01-05,5,H,1\n",
        ("S3", "2024-01-05"): "No fire data found for this area\n",
        ("S1", "2024-01-05"): "\n",
        ("S1", "2024-01-06"): HEADER + "9.0,100.0,3.0,2024-01-05,5,h,1\n",
    }
    for (sensor, day), body in bodies.items():
        folder = root / f"sensor={sensor}" / f"utc_day={day}"
        folder.mkdir(parents=True)
        (folder / "data.csv").write_text(body)
    everything = feeds.read_firms(spark, str(root))
    assert everything.count() == 6 and {"sensor", "utc_day"} <= set(everything.columns)
    day = feeds.firms_local_day(spark, str(root), "2024-01-05")
    # The copy in the second read goes, the low class goes, 16:59 UTC belongs to the day before.
    assert sorted((r.latitude, r.acq_time, r.confidence, r.frp) for r in day.collect()) == [
        (1.0, 1700, "n", 5.5), (2.5, 5, "H", 1.0),
    ]
    read = {f for f in day.inputFiles()}
    assert read and not any("2024-01-06" in f for f in read)
    (tmp_path / "none.csv").write_text("No fire data found\n")
    assert feeds.read_firms(spark, str(tmp_path / "none.csv")).count() == 0


def test_each_file_has_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("latitude,longitude,acq_date,acq_time,confidence,frp\n2.0,102.0,2024-01-05,5,h,1\n")
    (tmp_path / "b.csv").write_text("longitude,frp,latitude,acq_time,acq_date,confidence\n102.0,3,2.5,6,2024-01-05,n\n")
    (tmp_path / "c.csv").write_text("latitude,longitude,acq_date,acq_time,confidence\n3.0,103.0,2024-01-05,7,l\n")
    rows = feeds.read_firms(spark, str(tmp_path)).collect()
    assert sorted((r.latitude, r.longitude, r.acq_time, r.confidence, r.frp) for r in rows) == [
        (2.0, 102.0, 5, "h", 1.0), (2.5, 102.0, 6, "n", 3.0), (3.0, 103.0, 7, "l", None),
    ]


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Kolkata", "Pacific/Kiritimati", "UTC"])
def test_a_local_day_of_any_zone_is_whole(spark, tmp_path, zone):
    for day in ("2024-01-03", "2024-01-04", "2024-01-05", "2024-01-06"):
        folder = tmp_path / "firms" / "sensor=S" / f"utc_day={day}"
        folder.mkdir(parents=True)
        (folder / "x.csv").write_text(HEADER + "".join(f"1.{h:02d},100.0,3.0,{day},{h}30,h,{h}\n" for h in range(24)))
        hours = tmp_path / "him" / day[:7].replace("-", "") / day[8:]
        hours.mkdir(parents=True)
        for h in range(24):
            (hours / f"H09_{day.replace('-', '')}_{h:02d}00_a.csv").write_text(f"2024,1,{int(day[8:])},{h},1.0,100.0,5.0,9.0,80.0,3\n")
    assert feeds.firms_local_day(spark, str(tmp_path / "firms"), "2024-01-05", zone).count() == 24
    out = feeds.himawari_local_day(spark, str(tmp_path / "him"), "2024-01-05", zone).collect()
    start, end = times.utc_bounds("2024-01-05", zone)
    at = [datetime(r.year, r.month, r.day, r.hour, tzinfo=timezone.utc) for r in out]
    assert len(at) == 24 and all(start <= t < end for t in at)


def test_days_with_a_clock_change(spark):
    assert feeds.local_day_hours(spark, "2024-03-10", "America/Los_Angeles").count() == 23
    assert feeds.local_day_hours(spark, "2024-11-03", "America/Los_Angeles").count() == 25


def test_himawari_comments_and_hourly_choice(spark, tmp_path):
    def put(folder, name, text):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / name).write_text(text)

    row = "2024,1,{d},{h},{lat},100.0,5.0,9.0,80.0,3"
    put("202401/04", "H09_20240104_1700_a.csv", "# year,month\n" + row.format(d=4, h=17, lat=1.0) + " # note\n\n")
    put("202401/04", "H09_20240104_1700_b.csv", row.format(d=4, h=17, lat=2.0) + "\n")
    put("202401/04", "H09_20240104_1600_a.csv", row.format(d=4, h=16, lat=3.0) + "\n")
    put("202401/05", "H09_20240105_1600_a.csv", row.format(d=5, h=16, lat=4.0) + "\nbad,line\n")
    put("202401/05", "H09_20240105_1500_a.txt", row.format(d=5, h=15, lat=5.0) + "\n")
    out = feeds.himawari_local_day(spark, str(tmp_path), "2024-01-05")
    assert sorted((r.lat, r.hour, r.n) for r in out.collect()) == [(1.0, 17, 3), (4.0, 16, 3)]
    assert feeds.himawari_local_day(spark, str(tmp_path), "2023-01-05").count() == 0


def test_polygons(spark, tmp_path):
    ring = [[100.0, 0.0], [101.0, 0.0], [101.0, 1.0], [100.0, 0.0]]
    features = [
        {"type": "Feature", "properties": {"objectid": 7, "kind": "peat"}, "geometry": {"type": "Polygon", "coordinates": [ring]}},
        {"type": "Feature", "properties": {"objectid": 8, "kind": "peat"}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring, ring]]}},
        {"type": "Feature", "properties": {"objectid": 9, "kind": "peat"}, "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}},
    ]
    (tmp_path / "all.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    (tmp_path / "each.geojsonl").write_text("\n".join(json.dumps(f) for f in features))
    for name, layout in (("all.geojson", "collection"), ("each.geojsonl", "lines")):
        rows = polygons.read_polygons(spark, str(tmp_path / name), "objectid", ["kind"], layout).collect()
        assert {r.poly_id: len(r.rings) for r in rows} == {7: 1, 8: 3} and rows[0].kind == "peat"
    mercator = {"type": "Feature", "properties": {"objectid": 1}, "geometry": {"type": "Polygon", "coordinates": [[[20037508.342789244, 0.0]] * 4]}}
    (tmp_path / "m.geojsonl").write_text(json.dumps(mercator))
    corner = polygons.read_polygons(spark, str(tmp_path / "m.geojsonl"), "objectid", layout="lines", mercator=True).collect()[0].rings[0][0]
    assert abs(corner.lon - 180) < 1e-9 and abs(corner.lat) < 1e-9


def test_predictions_and_manifest(spark, tmp_path):
    out = tmp_path / "raw"
    out.mkdir()
    (out / "prediction.results-00000-of-00001").write_text('{"instance_id": "a", "confidence_score": 0.5, "raw_score": 0.0}\n\n')
    (out / "prediction.errors_stats").write_text("{}\n")
    rows = records.read_predictions(spark, str(out)).collect()
    assert [(r.instance_id, r.confidence_score) for r in rows] == [("a", 0.5)]
    (tmp_path / "manifest.json").write_text(json.dumps({"jobs": [
        {"job_id": "old", "created_at": "2025-01-01T00:00:00Z"}, {"job_id": "new", "created_at": "2025-01-02T00:00:00Z"}]}, indent=2))
    assert records.read_latest_job(spark, str(tmp_path / "manifest.json")).collect()[0].job_id == "new"
    records.write_predictions(spark.createDataFrame([("x", 0.1, 0.2)], PREDICTION), str(tmp_path / "written"))
    assert records.read_predictions(spark, str(tmp_path / "written"), glob="*.json").count() == 1


def test_sidecars(spark, tmp_path):
    scenes = spark.createDataFrame(
        [("r1", "2024-01-05", "landsat", "s1", 3.0)],
        "region_id STRING, run_date STRING, data_source STRING, original_id STRING, cloud_cover DOUBLE",
    )
    records.write_scene_sidecars(scenes, str(tmp_path / "imagery"))
    assert (tmp_path / "imagery/run_date=2024-01-05/region_id=r1/source=landsat").is_dir()
    back = spark.read.json(str(tmp_path / "imagery")).collect()[0]
    assert (back.original_id, back.data_source, back.region_id) == ("s1", "landsat", "r1")


def test_sidecars_of_an_emptied_run(spark, tmp_path):
    """A rerun that chooses nothing leaves no sidecar of its run, and those of other runs."""
    kind = "region_id STRING, run_date STRING, data_source STRING, original_id STRING"
    path = str(tmp_path / "imagery")
    for run in ("2024-01-05", "2024-01-06"):
        records.write_scene_sidecars(spark.createDataFrame([("r1", run, "landsat", "s1")], kind), path, [run])
    records.write_scene_sidecars(spark.createDataFrame([], kind), path, ["2024-01-05"])
    assert {str(r.run_date) for r in spark.read.json(path).collect()} == {"2024-01-06"}


def test_a_run_is_committed_whole(spark, tmp_path):
    """A write that fails between two outputs leaves the old version, whole; older versions go."""
    root, schema = str(tmp_path / "out"), "run_date STRING, v INT"

    def outputs(v, broken=False):
        good = spark.createDataFrame([("2024-01-05", v)], schema)
        bad = good.select("run_date", F.raise_error(F.lit("disk full")).cast("int").alias("v"))
        return {"records": good, "hotspots": bad if broken else good}

    def current():
        paths = [records.run_output(spark, root, "2024-01-05", n) for n in ("records", "hotspots")]
        return [spark.read.schema("v INT").json(p).collect()[0].v for p in paths]

    with pytest.raises(FileNotFoundError):
        records.run_output(spark, root, "2024-01-05", "records")
    records.write_run(outputs(1), root, "2024-01-05")
    assert current() == [1, 1]
    with pytest.raises(Exception, match="disk full"):
        records.write_run(outputs(2, broken=True), root, "2024-01-05")
    assert current() == [1, 1]
    records.write_run(outputs(3), root, "2024-01-05")
    assert current() == [3, 3]
    records.write_run(outputs(4), root, "2024-01-05")
    assert current() == [4, 4] and len(list((tmp_path / "out" / "run_date=2024-01-05").glob("version=*"))) == 2
    empty = {n: df.limit(0) for n, df in outputs(5).items()}
    records.write_run(empty, root, "2024-01-05")
    assert spark.read.schema("v INT").json(records.run_output(spark, root, "2024-01-05", "records")).count() == 0
