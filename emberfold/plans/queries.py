"""Registered queries: every operator over the whole of its input tables.

Results are flat, times are texts and doubles are rounded, so that they can be compared with
the SQL of ``oracles`` value by value.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfold.functions.geo import within_bbox
from emberfold.functions.times import in_local_day, local_date
from emberfold.operators import air_quality as aq
from emberfold.operators import imagery, quality, report, scoring
from emberfold.operators.asof import asof_nearest, snap, with_weather
from emberfold.operators.dbscan import dbscan
from emberfold.operators.incidents import (
    cluster_summary,
    incident_documents,
    nest_hotspots,
    run_summary,
    severity_histogram,
    with_power,
    with_severity,
)
from emberfold.operators.spatial import points_near_polygons
from emberfold.operators.standardize import (
    dedup_spatiotemporal,
    drop_processed,
    keep_confident,
)
from emberfold.plans import derive
from emberfold.plans.jobs import cluster_hotspots, detect_incidents, enrich, row_order, run_detect, run_imagery, run_report, run_score
from emberfold.schemas import AIR_QUALITY_CONTEXT, WEATHER_CONTEXT
from emberfold.session import cut_lineage, prepare, scratch_path
from emberfold.sources import feeds, polygons as polygon_files, records
from emberfold.streaming import dedup as stream_dedup
from emberfold.streaming.landing import landing_stream, read_reports, read_scored, report_arrivals, score_arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

REGION = [95.0, -11.0, 141.0, 6.0]
ONE_DAY = "2024-01-05"
EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _time(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def _r(column: str, places: int = 6) -> Column:
    return F.round(column, places).alias(column)


def _golden_row(*more: Column | str) -> list[Column | str]:
    return [
        _r("latitude", 9), _r("longitude", 9), _time("acq_datetime"), "frp_mean", _r("frp_max"),
        "confidence", "n_detections", "source", *more,
    ]


def _clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_hotspots(derive.hotspots(spark, sf_dir), derive.polygons(spark, sf_dir))


def _site_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(
        derive.site_incidents(spark, sf_dir), derive.weather(spark, sf_dir), derive.pixels(spark, sf_dir)
    )


# Feeds, filters, deduplication


@query
def golden_union(spark, sf_dir):
    return derive.golden(derive.events(spark, sf_dir)).select(*_golden_row())


@query
def golden_by_local_day(spark, sf_dir):
    df = derive.golden(derive.events(spark, sf_dir))
    day = F.date_format(local_date(F.col("acq_datetime")), "yyyy-MM-dd").alias("local_day")
    return df.groupBy(day, "source").agg(F.count("*").alias("n"), F.max("confidence").alias("top_confidence"))


@query
def local_day_window(spark, sf_dir):
    df = derive.golden(derive.events(spark, sf_dir))
    return df.filter(in_local_day(F.col("acq_datetime"), ONE_DAY)).select(*_golden_row())


@query
def confident_firms(spark, sf_dir):
    return keep_confident(derive.firms_feed(derive.events(spark, sf_dir))).select(
        _r("latitude", 9), _r("longitude", 9), "frp", "acq_date", "acq_time", "confidence"
    )


@query
def distinct_reads(spark, sf_dir):
    site = derive.events(spark, sf_dir).select(
        F.round(F.expr(derive.SITE_LATITUDE), 2).alias("latitude"),
        F.round(F.expr(derive.SITE_LONGITUDE), 2).alias("longitude"),
        F.date_format("ts", "yyyy-MM-dd").alias("acq_date"),
        F.col("event_type").alias("confidence"),
    )
    return site.dropDuplicates()


@query
def bbox_filter(spark, sf_dir):
    df = derive.golden(derive.events(spark, sf_dir))
    west = [REGION[0], REGION[1], 118.0, 0.0]
    return df.filter(within_bbox(F.col("latitude"), F.col("longitude"), west)).select(*_golden_row())


@query
def dedup_spacetime(spark, sf_dir):
    return dedup_spatiotemporal(derive.golden(derive.events(spark, sf_dir))).select(*_golden_row())


@query
def dedup_events(spark, sf_dir):
    seen = derive.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("event_id"))
    arrived = derive.events(spark, sf_dir).select(
        F.col("user_id").alias("event_id"), F.col("event_id").alias("message_no"), "event_type"
    )
    return drop_processed(arrived, seen, order=F.col("message_no"))


# Space


@query
def points_in_or_near(spark, sf_dir):
    near = points_near_polygons(derive.hotspots(spark, sf_dir), derive.polygons(spark, sf_dir))
    return near.select(*_golden_row("layer_revi"))


@query
def points_near_semi(spark, sf_dir):
    """With a buffer of 60 km neighbouring polygons overlap; each point is still kept once."""
    near = points_near_polygons(
        derive.hotspots(spark, sf_dir), derive.polygons(spark, sf_dir), buffer=60_000.0, cell=40_000.0, semi=True
    )
    return near.select(*_golden_row())


@query
def points_near_fanout(spark, sf_dir):
    near = points_near_polygons(
        derive.hotspots(spark, sf_dir), derive.polygons(spark, sf_dir), buffer=60_000.0, cell=40_000.0
    )
    return near.groupBy("layer_revi").agg(F.count("*").alias("points"), F.round(F.sum("frp_mean"), 3).alias("frp"))


@query
def dbscan_all(spark, sf_dir):
    """Clusters over all hotspots, without the polygon filter."""
    out = dbscan(derive.hotspots(spark, sf_dir), partition_by=["run_date"], order_by=row_order())
    return out.select(
        F.col("run_date").cast("string").alias("run_date"), _r("latitude", 9), _r("longitude", 9),
        _time("acq_datetime"), "source", "cluster_id", "is_core",
    )


@query
def dbscan_near_polygons(spark, sf_dir):
    return _clusters(spark, sf_dir).select(
        F.col("run_date").cast("string").alias("run_date"), _r("latitude", 9), _r("longitude", 9),
        _time("acq_datetime"), "source", "cluster_id", "is_core",
    )


@query
def core_point_counts(spark, sf_dir):
    """Rows with at least 3 and at least 8 rows within 2 km and 5 km, per run."""
    spots = derive.hotspots(spark, sf_dir)
    wide = dbscan(spots, eps_km=5.0, min_samples=8, partition_by=["run_date"])
    tight = dbscan(spots, eps_km=2.0, min_samples=3, partition_by=["run_date"])

    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col("run_date").cast("string").alias("run_date")).agg(
            F.lit(name).alias("density"), F.count_if("is_core").alias("core_rows"),
            F.count("cluster_id").alias("clustered_rows"), F.countDistinct("cluster_id").alias("clusters"),
        )

    return counts(wide, "8 in 5 km").unionByName(counts(tight, "3 in 2 km"))


@query
def cluster_summaries(spark, sf_dir):
    return cluster_summary(_clusters(spark, sf_dir)).select(
        "cluster_id", "point_count", _r("centroid_latitude"), _r("centroid_longitude"),
        F.array_join("detected_by", ",").alias("detected_by"), _time("first_detected"), _time("last_detected"),
        _r("avg_frp"), _r("min_lat"), _r("max_lat"), _r("min_lon"), _r("max_lon"),
    )


# Enrichment, severity, score


@query
def asof_weather(spark, sf_dir):
    spots = derive.golden(derive.events(spark, sf_dir)).withColumns(
        {"cell_lat": snap(F.col("latitude")), "cell_lon": snap(F.col("longitude"))}
    )
    joined = asof_nearest(spots, derive.weather(spark, sf_dir), ["cell_lat", "cell_lon"], "acq_datetime")
    return joined.select(
        _r("latitude", 9), _r("longitude", 9), _time("acq_datetime"), "frp_mean", "source",
        F.date_format("nearest.hour", "yyyy-MM-dd HH:mm:ss").alias("weather_hour"),
        F.round("nearest.temperature_2m", 6).alias("temperature"),
        F.round("nearest.dew_point_2m", 6).alias("dew_point"),
    )


@query
def weather_context(spark, sf_dir):
    out = with_weather(derive.site_incidents(spark, sf_dir), derive.weather(spark, sf_dir))
    return out.select("cluster_id", "weather.*")


@query
def aq_composite(spark, sf_dir):
    keys = ["cluster_id"]
    sites = derive.site_incidents(spark, sf_dir)
    rows = aq.measurements(sites, aq.composite_mean(sites, derive.pixels(spark, sf_dir), keys), keys)
    return rows.select("cluster_id", "product", "status", "images", F.round("scaled", 9).alias("value"), "severity")


@query
def aq_class(spark, sf_dir):
    out = aq.air_quality(derive.site_incidents(spark, sf_dir), derive.pixels(spark, sf_dir), ["cluster_id"])
    return out.select(
        "cluster_id", "severe_count", "moderate_count",
        F.col("air_quality.air_quality_severity").alias("air_quality_severity"),
        F.array_join(F.transform("air_quality.fire_indicators", lambda f: f["message"]), "; ").alias("messages"),
    )


@query
def severity(spark, sf_dir):
    return _site_incidents(spark, sf_dir).select(
        "cluster_id",
        "fire_severity_assessment.overall_severity",
        "fire_severity_assessment.severity_score",
        F.array_join("fire_severity_assessment.contributing_factors", "; ").alias("factors"),
        "fire_severity_assessment.details.weather_severity",
    )


@query
def criterion_scores(spark, sf_dir):
    return scoring.criterion_scores(_site_incidents(spark, sf_dir), scoring.DEFAULT_CONFIG, ["cluster_id"])


@query
def risk_score(spark, sf_dir):
    return scoring.score_incidents(_site_incidents(spark, sf_dir)).select(
        "instance_id", _r("confidence_score", 9), _r("raw_score", 9)
    )


def _linear_model(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        raw = rows["point_count"] / 10.0 - 2.0
        yield pd.DataFrame(
            {"instance_id": rows["cluster_id"], "confidence_score": (raw / 8.0).clip(0.0, 1.0), "raw_score": raw}
        )


@query
def plugged_in_model(spark, sf_dir):
    sites = derive.site_incidents(spark, sf_dir).select("cluster_id", "point_count")
    return scoring.score_incidents(sites, _linear_model).select(
        "instance_id", _r("confidence_score"), _r("raw_score")
    )


@query
def incidents_flat(spark, sf_dir):
    """The whole detection and scoring chain, one row per incident."""
    summary = cut_lineage(cluster_summary(_clusters(spark, sf_dir)))
    incidents = enrich(summary, derive.weather(spark, sf_dir), derive.pixels(spark, sf_dir))
    scored = incidents.withColumn("raw_score", scoring.raw_score(incidents, scoring.DEFAULT_CONFIG))
    confidence = 1.0 / (1.0 + F.exp(-F.col("raw_score")))
    return scored.select(
        "cluster_id", "point_count", _r("centroid_latitude"), _r("centroid_longitude"),
        _time("first_detected"), _time("last_detected"), _r("avg_frp"),
        "realtime_context.weather.temperature_celsius", "realtime_context.air_quality.air_quality_severity",
        "fire_severity_assessment.overall_severity", "fire_severity_assessment.severity_score",
        F.round("raw_score", 9).alias("raw_score"), F.round(confidence, 9).alias("confidence_score"),
        scoring.risk_tier(confidence).alias("risk_level"),
    )


# Reports


def _scored_sites(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    incidents = cut_lineage(_site_incidents(spark, sf_dir))
    return incidents, scoring.score_incidents(incidents)


@query
def report_markers(spark, sf_dir):
    incidents, predictions = _scored_sites(spark, sf_dir)
    return report.report_markers(incidents, predictions).select(
        "cluster_id", _r("centroid_latitude"), _r("centroid_longitude"), "point_count", _r("score", 9), "risk_level",
        "marker_color", "tooltip", "popup_title", "popup_place", "popup_confidence", "air_quality_severity", "relative_humidity_percent",
    )


@query
def report_kpis(spark, sf_dir):
    sites = derive.site_incidents(spark, sf_dir)
    return report.report_kpis(sites, _site_predictions(spark, sf_dir))


def _site_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prediction per customer, named after a site of the first run.

    Customers without a site and the sites of later runs stay unmatched.
    """
    customers = derive.table(spark, sf_dir, "customer").select(
        F.expr("concat('fire_cluster_20240107_', c_custkey)").alias("instance_id"),
        F.expr("abs(c_acctbal) / 10000.0D").alias("confidence_score"),
    )
    return customers.withColumn("raw_score", F.col("confidence_score"))


@query
def unmatched_predictions(spark, sf_dir):
    sites = derive.site_incidents(spark, sf_dir)
    return report.unmatched_predictions(_site_predictions(spark, sf_dir), sites).select(
        "instance_id", _r("confidence_score", 9)
    )


@query
def prediction_first(spark, sf_dir):
    return report.one_prediction_each(derive.predictions(spark, sf_dir), F.col("ingest_order")).select(
        "instance_id", _r("confidence_score", 9), "raw_score"
    )


@query
def prediction_last(spark, sf_dir):
    return report.one_prediction_each(derive.predictions(spark, sf_dir), F.col("ingest_order"), "last").select(
        "instance_id", _r("confidence_score", 9), "raw_score"
    )


@query
def latest_job(spark, sf_dir):
    jobs = derive.table(spark, sf_dir, "orders").select(
        F.expr("concat('job_', o_orderkey)").alias("job_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
    )
    return report.latest_job(jobs)


@query
def severity_counts(spark, sf_dir):
    return severity_histogram(_site_incidents(spark, sf_dir)).select(
        F.col("run_date").cast("string").alias("run_date"), "overall_severity", "incidents"
    )


@query
def run_summaries(spark, sf_dir):
    entries = F.transform(F.map_entries("severity_summary"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return run_summary(_site_incidents(spark, sf_dir)).select(
        "status", "incident_count", F.col("run_date").cast("string").alias("run_date"),
        F.array_join(F.array_sort(entries), ",").alias("severity_summary"),
    )


@query
def run_counts(spark, sf_dir):
    spots = derive.hotspots(spark, sf_dir)
    near = cut_lineage(points_near_polygons(spots, derive.polygons(spark, sf_dir)))
    clustered = dbscan(near, partition_by=["run_date"], order_by=row_order())
    return report.run_counts(spots, near, clustered).withColumn("run_date", F.col("run_date").cast("string"))


@query
def overlay_pixels(spark, sf_dir):
    site = derive.events(spark, sf_dir).select(
        "event_id", F.expr(derive.LATITUDE).alias("latitude"), F.expr(derive.LONGITUDE).alias("longitude"),
        *[
            F.expr(f"{base} {sign} 0.04D").alias(name)
            for name, base, sign in (
                ("min_lon", derive.SITE_LONGITUDE, "-"), ("min_lat", derive.SITE_LATITUDE, "-"),
                ("max_lon", derive.SITE_LONGITUDE, "+"), ("max_lat", derive.SITE_LATITUDE, "+"),
            )
        ],
    )
    return report.overlay_pixels(site).select("event_id", "pixel_x", "pixel_y")


@query
def headline(spark, sf_dir):
    detections = derive.events(spark, sf_dir).select(
        "user_id", "event_id", (F.col("event_type") == "error").alias("detected"),
        F.expr("(event_id % 1000) / 1000.0D").alias("confidence"),
    )
    return report.headline(detections, ["user_id"], F.col("event_id"))


# Imagery


@query
def incident_boxes(spark, sf_dir):
    summary = cluster_summary(_clusters(spark, sf_dir))
    return imagery.pad_box(summary.select("cluster_id", "min_lon", "min_lat", "max_lon", "max_lat")).select(
        "cluster_id", _r("min_lon"), _r("min_lat"), _r("max_lon"), _r("max_lat")
    )


@query
def best_scene(spark, sf_dir):
    sites = derive.site_incidents(spark, sf_dir).select(
        F.col("cluster_id").alias("region_id"), "run_date",
        *[
            (F.col(c) + sign * 0.1).alias(name)
            for name, c, sign in (
                ("min_lon", "centroid_longitude", -1), ("min_lat", "centroid_latitude", -1),
                ("max_lon", "centroid_longitude", 1), ("max_lat", "centroid_latitude", 1),
            )
        ],
    )
    return imagery.best_scene(sites, derive.scenes(spark, sf_dir)).select(
        "region_id", "data_source", "original_id", "acquisition_date_utc", _r("cloud_cover")
    )


@query
def scene_window(spark, sf_dir):
    chosen = imagery.scenes_in_window(derive.scenes(spark, sf_dir), "2024-01-14")
    return chosen.groupBy("data_source").agg(
        F.count("*").alias("scenes"), F.min("time_start_ms").alias("first_ms"), F.max("time_start_ms").alias("last_ms")
    )


@query
def band_stretch(spark, sf_dir):
    raw = derive.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag",
        F.col("l_extendedprice").alias("SR_B4"), (F.col("l_extendedprice") * 0.5).alias("SR_B3"),
        (F.col("l_quantity") * 600.0).alias("SR_B2"),
    )
    bands = imagery.harmonise_bands(raw)
    both = imagery.stretch_bands(bands.filter("l_returnflag = 'R'"), "sentinel2").unionByName(
        imagery.stretch_bands(bands.filter("l_returnflag <> 'R'"), "landsat")
    )
    return both.select("l_orderkey", "l_linenumber", _r("B4", 5), _r("B3", 5), _r("B2", 5))


# Quality


@query
def jsonl_audit(spark, sf_dir):
    return quality.audit_jsonl(derive.json_lines(spark, sf_dir))


@query
def jsonl_key_sets(spark, sf_dir):
    return quality.key_sets(derive.json_lines(spark, sf_dir))


@query
def jsonl_head(spark, sf_dir):
    return quality.head_lines(derive.json_lines(spark, sf_dir), 5, [F.col("line_id")]).select(
        "file", "line_no", "line_id", F.length("line").alias("characters")
    )


# Files: derived data is written to the shared folder and read back by the readers


@query
def firms_csv_scan(spark, sf_dir):
    out = scratch_path(prepare(spark), "firms")
    feed = derive.firms_feed(derive.events(spark, sf_dir))
    feed.select(F.lit("N").alias("satellite"), "acq_time", "acq_date", "confidence", "longitude", "latitude", "frp") \
        .write.option("header", "true").csv(out)
    return feeds.read_firms(spark, out).select(
        _r("latitude", 9), _r("longitude", 9), "frp", "acq_date", "acq_time", "confidence"
    )


@query
def firms_local_day_scan(spark, sf_dir):
    out = scratch_path(prepare(spark), "firms-days")
    feed = derive.firms_feed(derive.events(spark, sf_dir))
    feed.withColumns({"sensor": F.lower("confidence"), "utc_day": F.col("acq_date")}) \
        .write.option("header", "true").partitionBy("sensor", "utc_day").csv(out)
    return feeds.firms_local_day(spark, out, ONE_DAY).select(
        _r("latitude", 9), _r("longitude", 9), "frp", "acq_date", "acq_time", "confidence"
    )


@query
def himawari_csv_scan(spark, sf_dir):
    out = scratch_path(prepare(spark), "himawari")
    feed = derive.himawari_feed(derive.events(spark, sf_dir))
    line = F.concat(F.to_csv(F.struct(*feed.columns)), F.when(F.col("n") > 4, "  # tail").otherwise(""))
    feed.select(line.alias("value")).write.text(out)
    return feeds.read_himawari(spark, out).select(
        "year", "month", "day", "hour", _r("lat", 9), _r("lon", 9), "ave_frp", _r("max_frp"), "ave_confidence", "n"
    )


@query
def himawari_local_day_scan(spark, sf_dir):
    """One local day of an archive by hours, with an hour missing and second files at some."""
    out = scratch_path(prepare(spark), "himawari-hours")
    derive.write_hourly_archive(derive.events(spark, sf_dir), out)
    return feeds.himawari_local_day(spark, out, ONE_DAY).select(
        "year", "month", "day", "hour", _r("lat", 9), _r("lon", 9), "ave_frp", _r("max_frp"), "ave_confidence", "n"
    )


@query
def hourly_files(spark, sf_dir):
    ts = F.col("ts")
    files = derive.events(spark, sf_dir).select(
        F.concat(
            F.lit("feed/"), F.date_format(ts, "yyyyMM/dd"), F.lit("/H09_"), F.date_format(ts, "yyyyMMdd_HH"),
            F.lit("00_"), F.lpad(F.col("user_id").cast("string"), 6, "0"),
            F.when(F.col("event_type") == "view", ".csv").otherwise(".nc"),
        ).alias("path")
    )
    chosen = feeds.select_hourly_files(feeds.local_day_hours(spark, ONE_DAY), files)
    return chosen.select(_time("hour"), "path")


@query
def polygon_scan(spark, sf_dir):
    out = scratch_path(prepare(spark), "polygons")
    polygon_files.write_polygons(derive.polygons(spark, sf_dir), out)
    layer = polygon_files.read_polygons(spark, out, "poly_id", ["layer_revi"], layout="lines")
    return layer.select("poly_id", "layer_revi", F.explode("rings").alias("ring")).select(
        "poly_id", "layer_revi", F.posexplode("ring").alias("corner", "at")
    ).select("poly_id", "layer_revi", "corner", F.round("at.lon", 9).alias("lon"), F.round("at.lat", 9).alias("lat"))


@query
def incident_records(spark, sf_dir):
    """Incident records and their hotspots, written per run, read back and nested."""
    out = scratch_path(prepare(spark), "incidents")
    incidents, hotspots = detect_incidents(
        derive.hotspots(spark, sf_dir), derive.polygons(spark, sf_dir),
        derive.weather(spark, sf_dir), derive.pixels(spark, sf_dir),
    )
    records.write_by_run(incident_documents(incidents), f"{out}/records")
    records.write_by_run(hotspots, f"{out}/hotspots")
    read = with_power(records.read_incidents(spark, f"{out}/records"))
    return nest_hotspots(read, records.read_hotspots(spark, f"{out}/hotspots")).select(
        "cluster_id", "point_count", F.size("hotspots").cast("long").alias("nested"), _r("avg_frp"),
        "fire_severity_assessment.overall_severity", "first_detected_utc",
    )


@query
def emptied_rerun(spark, sf_dir):
    """Sites written by run; a rerun of the first run finds nothing any more."""
    out = scratch_path(prepare(spark), "rerun")
    sites = derive.site_incidents(spark, sf_dir).select("run_date", "cluster_id", "point_count")
    records.write_by_run(sites, out)
    records.write_by_run(sites.limit(0), out, runs=["2024-01-07"])
    left = spark.read.schema("cluster_id STRING, point_count BIGINT, run_date STRING").json(out)
    return left.groupBy("run_date").agg(F.count("*").alias("incidents"), F.sum("point_count").alias("points"))


def _first_run(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Detect the incidents of the first run into the folders below ``root``."""
    derive.weather(spark, sf_dir).write.parquet(f"{root}/weather")
    derive.pixels(spark, sf_dir).write.parquet(f"{root}/pixels")
    events = derive.events(spark, sf_dir)
    feeds_read = {"FIRMS": derive.firms_feed(events), "JAXA": derive.himawari_feed(events)}
    return run_detect(
        spark, root, {**feeds_read, "FIRMS": keep_confident(feeds_read["FIRMS"])}, derive.polygons(spark, sf_dir),
        f"{root}/weather", f"{root}/pixels", "2024-01-14", derive.RUN_DAYS,
    )


@query
def stages_through_folders(spark, sf_dir):
    """Detect, score and report the first run through folders; the written markers, read back."""
    root = scratch_path(prepare(spark), "stages")
    run = _first_run(spark, sf_dir, root)
    run_score(spark, root, run)
    run_report(spark, root, run)
    markers = spark.read.json(f"{root}/03_final_reports/markers/run_date={run}")
    return markers.select("cluster_id", _r("centroid_latitude"), _r("centroid_longitude"), "point_count", _r("score", 9), "risk_level")


@query
def imagery_through_folders(spark, sf_dir):
    """Detect the first run and choose its scenes from listings in folders; the sidecars, read back."""
    root = scratch_path(prepare(spark), "imagery")
    run = _first_run(spark, sf_dir, root)
    listed = derive.scenes(spark, sf_dir)
    second = F.col("scene_id").endswith("1")
    for name, rows, cloud in (
        ("sentinel2", F.col("data_source") == "sentinel2", "CLOUDY_PIXEL_PERCENTAGE"),
        ("landsat8", (F.col("data_source") == "landsat") & ~second, "CLOUD_COVER"),
        ("landsat9", (F.col("data_source") == "landsat") & second, "CLOUD_COVER"),
    ):
        listed.filter(rows).drop("data_source").withColumnRenamed("cloud_cover", cloud).write.parquet(f"{root}/{name}")
    run_imagery(spark, root, run, *[f"{root}/{name}" for name in ("sentinel2", "landsat8", "landsat9")])
    sidecars = spark.read.option("basePath", f"{root}/02_satellite_imagery/sidecars").json(
        f"{root}/02_satellite_imagery/sidecars/run_date={run}"
    )
    return sidecars.select("region_id", "source", "original_id", "acquisition_date_utc", _r("cloud_cover"))


@query
def manifest_job(spark, sf_dir):
    """The job created last, from manifest files of a month's jobs each."""
    out = scratch_path(prepare(spark), "manifest")
    jobs = derive.table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.struct(
            F.expr("concat('job_', o_orderkey)").alias("job_id"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        ).alias("job"),
    )
    jobs.groupBy("month").agg(F.collect_list("job").alias("jobs")).write.partitionBy("month").json(out)
    return records.read_latest_job(spark, out)


@query
def firms_mixed_headers(spark, sf_dir):
    """Two files in one call whose headers order the columns differently."""
    out = scratch_path(prepare(spark), "firms-mixed")
    feed = derive.firms_feed(derive.events(spark, sf_dir)).withColumn("late", F.col("acq_time") >= 1200)
    late = feed.filter("late").select("frp", "longitude", "latitude", "confidence", "acq_time", "acq_date")
    early = feed.filter("NOT late").select("latitude", "longitude", "acq_date", "acq_time", "confidence", "frp")
    late.write.option("header", "true").csv(f"{out}/late")
    early.write.option("header", "true").csv(f"{out}/early")
    return feeds.read_firms(spark, [f"{out}/late", f"{out}/early"]).select(
        _r("latitude", 9), _r("longitude", 9), "frp", "acq_date", "acq_time", "confidence"
    )


@query
def points_of_shared_keys(spark, sf_dir):
    """All features of the layer under one key: each is still matched by itself."""
    layer = derive.polygons(spark, sf_dir).withColumn("poly_id", F.lit(1))
    return points_near_polygons(derive.hotspots(spark, sf_dir), layer).select(*_golden_row("layer_revi"))


@query
def criteria_file(spark, sf_dir):
    """Scores by a criteria file that is found at the second place looked at."""
    out = scratch_path(prepare(spark), "criteria")
    spark.createDataFrame([(json.dumps(scoring.DEFAULT_CONFIG),)], "value STRING").coalesce(1).write.text(out)
    config = scoring.load_config(spark, f"{out}-absent.json", out)
    return scoring.criterion_scores(_site_incidents(spark, sf_dir), config, ["cluster_id"])


def _written_sites(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Site incidents written as records by run."""
    sites = _site_incidents(spark, sf_dir).withColumns(
        {
            "detected_by": F.array(F.lit("JAXA")),
            **{n: F.col("centroid_latitude") for n in ("min_lat", "max_lat")},
            **{n: F.col("centroid_longitude") for n in ("min_lon", "max_lon")},
        }
    )
    records.write_by_run(incident_documents(sites), path)
    return records.read_incidents(spark, path)


@query
def scored_on_arrival(spark, sf_dir):
    """Site incidents written as records and scored by the stream that waits for them."""
    root = scratch_path(prepare(spark), "arrivals")
    _written_sites(spark, sf_dir, f"{root}/incidents")
    score_arrivals(spark, f"{root}/incidents", f"{root}/predictions", f"{root}/checkpoint")
    return read_scored(spark, f"{root}/predictions").select("instance_id", _r("confidence_score", 9), _r("raw_score", 9))


@query
def report_on_arrival(spark, sf_dir):
    """Markers of the runs that are whole after predictions came in two arrivals; one run lacks some."""
    root = scratch_path(prepare(spark), "reports")
    found = _written_sites(spark, sf_dir, f"{root}/incidents")
    scored = scoring.score_incidents(with_power(found)).withColumn(
        "run_date", F.date_format(F.to_date(F.split("instance_id", "_")[2], "yyyyMMdd"), "yyyy-MM-dd")
    )
    late = F.pmod(F.xxhash64("instance_id"), F.lit(2)) == 1
    scored = scored.filter(~F.col("instance_id").rlike("_20240114_[0-9]*0$"))
    for arrival in (scored.filter(~late), scored.filter(late)):
        arrival.write.mode("append").partitionBy("run_date").json(f"{root}/predictions")
        report_arrivals(spark, *[f"{root}/{n}" for n in ("incidents", "predictions", "state", "reports", "checkpoint")])
    markers = read_reports(
        spark, f"{root}/reports", "markers", "cluster_id STRING, point_count BIGINT, score DOUBLE, risk_level STRING, popup_title STRING"
    )
    return markers.select("run_date", "cluster_id", "point_count", _r("score", 9), "risk_level", "popup_title")


@query
def regions_of_records(spark, sf_dir):
    """Padded boxes from written incident records, as the scene choice takes them."""
    out = scratch_path(prepare(spark), "regions")
    records.write_by_run(incident_documents(_clusters_as_incidents(spark, sf_dir)), out)
    return imagery.incident_regions(records.read_incidents(spark, out)).select(
        F.col("region_id").alias("cluster_id"), _r("min_lon"), _r("min_lat"), _r("max_lon"), _r("max_lat")
    )


def _clusters_as_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_severity(
        cluster_summary(_clusters(spark, sf_dir)).withColumns(
            {"weather": F.from_json(F.lit("{}"), WEATHER_CONTEXT), "air_quality": F.from_json(F.lit("{}"), AIR_QUALITY_CONTEXT)}
        )
    )


@query
def prediction_files(spark, sf_dir):
    out = scratch_path(prepare(spark), "predictions")
    records.write_predictions(derive.predictions(spark, sf_dir).drop("ingest_order"), out)
    back = records.read_predictions(spark, out, glob="*.json")
    return back.groupBy("instance_id").agg(
        F.count("*").alias("predictions"), F.max("raw_score").alias("top_raw_score")
    )


# Streams


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = landing_stream(prepare(spark), sf_dir, EVENT_SCHEMA, "parquet", glob="events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_best_of_bucket(spark, sf_dir):
    table, checkpoint = scratch_path(spark, "best"), scratch_path(spark, "best-ckpt")
    stream_dedup.keep_best(derive.golden(_event_stream(spark, sf_dir)), table, checkpoint)
    return stream_dedup.read_best(spark, table).select(*_golden_row())


@query
def stream_process_once(spark, sf_dir):
    table, checkpoint = scratch_path(spark, "seen"), scratch_path(spark, "seen-ckpt")
    arrivals = _event_stream(spark, sf_dir).select(F.col("user_id").alias("event_id"))
    stream_dedup.process_once(arrivals, table, checkpoint)
    return stream_dedup.read_batches(spark, table, stream_dedup.PROCESSED_EVENTS).select("event_id")


@query
def stream_process_once_within(spark, sf_dir):
    table, checkpoint = scratch_path(spark, "within"), scratch_path(spark, "within-ckpt")
    arrivals = _event_stream(spark, sf_dir).select("event_id", "ts")
    (
        stream_dedup.process_once_within(arrivals, "ts")
        .writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.schema("event_id BIGINT, ts TIMESTAMP").parquet(table).select("event_id", _time("ts"))
