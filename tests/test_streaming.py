import json
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from emberfold.operators.standardize import dedup_spatiotemporal
from emberfold.sources.records import write_predictions
from emberfold.streaming import dedup as D
from emberfold.streaming.landing import (
    landing_stream,
    read_batches,
    read_reports,
    read_scored,
    report_arrivals,
    score_arrivals,
)

EVENTS = "event_id STRING, ts TIMESTAMP"


def put(df, folder):
    df.coalesce(1).write.mode("append").parquet(str(folder))


def test_each_event_once_over_several_arrivals(spark, tmp_path):
    landing, table, ckpt = (str(tmp_path / n) for n in ("in", "seen", "ckpt"))
    at = datetime(2024, 1, 5)
    put(spark.createDataFrame([("a", at), ("a", at), ("b", at)], EVENTS), landing)
    D.process_once(landing_stream(spark, landing, EVENTS), table, ckpt)
    put(spark.createDataFrame([("b", at), ("c", at)], EVENTS), landing)
    D.process_once(landing_stream(spark, landing, EVENTS), table, ckpt)
    D.process_once(landing_stream(spark, landing, EVENTS), table, ckpt)
    ids = [r.event_id for r in read_batches(spark, table, D.PROCESSED_EVENTS).collect()]
    assert sorted(ids) == ["a", "b", "c"]
    # A compacted table goes on where the old one stopped.
    compact = str(tmp_path / "compact")
    D.compact_processed(spark, table, compact)
    put(spark.createDataFrame([("c", at), ("d", at)], EVENTS), landing)
    D.process_once(landing_stream(spark, landing, EVENTS), compact, ckpt)
    assert sorted(r.event_id for r in read_batches(spark, compact, D.PROCESSED_EVENTS).collect()) == ["a", "b", "c", "d"]


def golden(spark, *rows):
    return spark.createDataFrame(
        [(lat, 100.0, datetime(2024, 1, 5, 3, m), 1.0, None, c, 1, s) for lat, m, c, s in rows], D.GOLDEN
    )


def test_best_of_bucket_accepts_late_better_rows(spark, tmp_path):
    landing, table, ckpt = (str(tmp_path / n) for n in ("in", "best", "ckpt"))
    first, late = golden(spark, (1.0, 1, 50.0, "A"), (2.0, 1, 50.0, "B")), golden(spark, (1.0, 2, 90.0, "C"), (2.0, 2, 10.0, "D"))
    put(first, landing)
    D.keep_best(landing_stream(spark, landing, D.GOLDEN), table, ckpt)
    put(late, landing)
    D.keep_best(landing_stream(spark, landing, D.GOLDEN), table, ckpt)
    assert sorted(r.source for r in D.read_best(spark, table).collect()) == ["B", "C"]
    batch = dedup_spatiotemporal(first.unionByName(late))
    assert sorted(map(tuple, D.read_best(spark, table).collect())) == sorted(map(tuple, batch.collect()))


def files_of(table):
    return {str(p): p.stat().st_mtime_ns for p in Path(table).rglob("*.parquet") if "bucket=" in str(p)}


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path, monkeypatch):
    """Rows stored are the distinct keys; files of other buckets stay as they are, also over a repeated batch."""
    landing, table, ckpt = (str(tmp_path / n) for n in ("in", "best", "ckpt"))
    put(golden(spark, *[(i / 10, 1, 50.0, f"s{i}") for i in range(300)]), landing)
    D.keep_best(landing_stream(spark, landing, D.GOLDEN), table, ckpt)
    before = files_of(table)
    late = golden(spark, (0.1, 2, 90.0, "better"), (0.2, 2, 10.0, "worse"), (99.0, 1, 5.0, "new"))
    put(late, landing)
    D.keep_best(landing_stream(spark, landing, D.GOLDEN), table, ckpt)
    after = files_of(table)
    assert spark.read.parquet(*after).count() == 301 == D.read_best(spark, table).count()
    touched = {r.bucket for r in D._place_bucket(late).select("bucket").distinct().collect()}
    kept = {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in touched}
    assert len(kept) >= D.BUCKETS - 3 and all(after[f] == before[f] for f in kept) and len(set(after) - kept) == len(touched)
    best = {round(r.latitude, 1): r.source for r in D.read_best(spark, table).collect()}
    assert (best[0.1], best[0.2], best[99.0]) == ("better", "s2", "new")
    # The second batch is handled once more, after it was complete and half of what it replaced is gone.
    seen = []
    monkeypatch.setattr(D, "run_available", lambda stream, handle, checkpoint: seen.append(handle))
    D.keep_best(landing_stream(spark, landing, D.GOLDEN), table, ckpt)
    seen[0](late, 1)
    assert files_of(table) == after


def run_folder(spark, root, run, name, rows):
    folder = root / f"run_date={run}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps(r) for r in rows))


def test_report_when_a_run_is_whole(spark, tmp_path):
    incidents, predictions = tmp_path / "incidents", tmp_path / "predictions"
    paths = [str(tmp_path / n) for n in ("incidents", "predictions", "state", "reports", "ckpt")]

    def arrive():
        report_arrivals(spark, *paths)
        rows = read_reports(spark, paths[3], "markers", "cluster_id STRING, score DOUBLE").collect()
        return sorted((r.run_date, r.cluster_id, r.score) for r in rows)

    place = {"centroid_latitude": 1.0, "centroid_longitude": 2.0, "point_count": 3}
    run_folder(spark, incidents, "2024-01-05", "a", [{"cluster_id": "a", **place}, {"cluster_id": "b", **place}])
    # Predictions of a run can be there before its incidents.
    run_folder(spark, predictions, "2024-01-06", "early", [{"instance_id": "c", "confidence_score": 0.3}])
    run_folder(spark, predictions, "2024-01-05", "first", [{"instance_id": "a", "confidence_score": 0.9}])
    assert arrive() == []
    run_folder(spark, predictions, "2024-01-05", "second", [{"instance_id": "b", "confidence_score": 0.1}])
    run_folder(spark, incidents, "2024-01-06", "c", [{"cluster_id": "c", **place}])
    whole = [("2024-01-05", "a", 0.9), ("2024-01-05", "b", 0.1), ("2024-01-06", "c", 0.3)]
    assert arrive() == whole
    # A late prediction of another incident makes its run be reported again; the first one of an incident counts.
    run_folder(spark, predictions, "2024-01-06", "late", [{"instance_id": "c", "confidence_score": 0.8}, {"instance_id": "d"}])
    versions = len(list(Path(paths[3]).glob("run_date=2024-01-06/version=*")))
    assert arrive() == whole
    assert versions == 1 and len(list(Path(paths[3]).glob("run_date=2024-01-06/version=*"))) == 2
    # A run that is no longer whole keeps its report until it is whole again.
    run_folder(spark, incidents, "2024-01-06", "d2", [{"cluster_id": "e", **place}])
    assert arrive() == whole
    run_folder(spark, predictions, "2024-01-06", "e", [{"instance_id": "e", "confidence_score": 0.5}])
    assert arrive() == [*whole, ("2024-01-06", "e", 0.5)]
    totals = read_reports(spark, paths[3], "totals", "total_incidents BIGINT, total_hotspots BIGINT").collect()
    assert sorted((r.run_date, r.total_incidents, r.total_hotspots) for r in totals) == [("2024-01-05", 2, 6), ("2024-01-06", 2, 6)]


def test_bounded_form(spark, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    at = datetime(2024, 1, 5)
    put(spark.createDataFrame([("a", at), ("a", at), ("b", at)], EVENTS), landing)
    stream = D.process_once_within(landing_stream(spark, landing, EVENTS), "ts")
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")) \
        .trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_arriving_incidents_are_scored(spark, tmp_path):
    landing = tmp_path / "incidents" / "run_date=2024-01-05"
    landing.mkdir(parents=True)
    record = {"cluster_id": "a", "point_count": 34, "hotspots": [{"frp_mean": 300.0}, {"frp_mean": 500.0}]}
    (landing / "x.json").write_text(json.dumps(record))
    out, ckpt = str(tmp_path / "predictions"), str(tmp_path / "ckpt")
    score_arrivals(spark, str(tmp_path / "incidents"), out, ckpt)
    # A record of its own arrives later and needs no hotspots.
    (landing / "y.json").write_text(json.dumps({"cluster_id": "b", "point_count": 2, "avg_frp": 75.0}))
    score_arrivals(spark, str(tmp_path / "incidents"), out, ckpt)
    got = {r.instance_id: round(r.raw_score, 9) for r in read_scored(spark, out).collect()}
    # Missing context scores 5; power 400 scores 5 and 75 scores 2; 34 hotspots 10 and 2 hotspots 2.
    assert got == {"a": round(0.3 * 5 + 0.25 * 10 + 0.45 * 5 - 5, 9), "b": round(0.3 * 2 + 0.25 * 2 + 0.45 * 5 - 5, 9)}


def test_glob_picks_result_files(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "prediction.results-1").write_text('{"instance_id": "a"}\n')
    (folder / "errors").write_text('{"instance_id": "b"}\n')
    stream = landing_stream(spark, str(folder), "instance_id STRING", "json", glob="*prediction.results*")
    seen = []
    stream.writeStream.foreachBatch(lambda df, n: seen.extend(r[0] for r in df.collect())) \
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert seen == ["a"]
