"""Incidents joined with predictions: markers, totals, headline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfold.functions.geo import geo_to_pixel
from emberfold.functions.nested import dot_path, fixed_text, percent_text
from emberfold.operators.scoring import risk_colour, risk_tier
from emberfold.operators.standardize import keep_one


def one_prediction_each(predictions: DataFrame, order: Column, keep: str = "first") -> DataFrame:
    """First or last prediction per instance; rows without an instance are dropped."""
    named = predictions.filter(F.col("instance_id").isNotNull() & (F.col("instance_id") != ""))
    return keep_one(named, ["instance_id"], order, keep)


def latest_job(jobs: DataFrame) -> DataFrame:
    """The job created last; ISO-8601 texts of one zone sort by time."""
    return jobs.agg(F.max_by("job_id", F.struct("created_at", "job_id")).alias("job_id"))


def join_predictions(incidents: DataFrame, predictions: DataFrame) -> DataFrame:
    scored = predictions.select(F.col("instance_id").alias("cluster_id"), "confidence_score", "raw_score")
    return incidents.join(scored, "cluster_id")


def unmatched_predictions(predictions: DataFrame, incidents: DataFrame) -> DataFrame:
    ids = incidents.select(F.col("cluster_id").alias("instance_id"))
    return predictions.join(ids, "instance_id", "left_anti")


def report_markers(incidents: DataFrame, predictions: DataFrame) -> DataFrame:
    """Map markers; context fields an incident lacks stay null."""
    joined = join_predictions(incidents, predictions)
    score = F.coalesce("confidence_score", F.lit(0.0))
    context = {
        name: dot_path(joined.schema, "realtime_context." + path)
        for name, path in (
            ("air_quality_severity", "air_quality.air_quality_severity"),
            ("relative_humidity_percent", "weather.relative_humidity_percent"),
        )
    }
    tier = risk_tier(score)
    return joined.select(
        "cluster_id",
        "centroid_latitude",
        "centroid_longitude",
        "point_count",
        score.alias("score"),
        tier.alias("risk_level"),
        risk_colour(score).alias("marker_color"),
        F.format_string("%s - %s Risk", F.col("cluster_id"), tier).alias("tooltip"),
        F.concat_ws(" ", F.upper(tier), F.lit("RISK FIRE")).alias("popup_title"),
        F.concat(fixed_text(F.col("centroid_latitude")), F.lit(", "), fixed_text(F.col("centroid_longitude"))).alias("popup_place"),
        percent_text(score).alias("popup_confidence"),
        *[column.alias(name) for name, column in context.items()],
    )


def report_kpis(incidents: DataFrame, predictions: DataFrame) -> DataFrame:
    """Totals: all incidents, hotspots of matched incidents only, and risk counts."""
    scored = predictions.select(
        F.col("instance_id").alias("cluster_id"), "confidence_score", F.lit(True).alias("_matched")
    )
    joined = incidents.select("cluster_id", "point_count").join(scored, "cluster_id", "left")
    tier = F.when(F.col("_matched"), risk_tier(F.col("confidence_score")))
    return joined.agg(
        F.count("*").alias("total_incidents"),
        F.coalesce(F.sum(F.when(F.col("_matched"), F.col("point_count"))), F.lit(0)).alias("total_hotspots"),
        F.count_if(tier == "High").alias("high"),
        F.count_if(tier == "Moderate").alias("moderate"),
        F.count_if(tier == "Low").alias("low"),
    )


def run_counts(deduplicated: DataFrame, near: DataFrame, clustered: DataFrame, run: str = "run_date") -> DataFrame:
    """Hotspots after deduplication, near polygons, and clusters, per run."""
    totals = deduplicated.groupBy(run).agg(F.count("*").alias("hotspots"))
    kept = near.groupBy(run).agg(F.count("*").alias("near_polygons"))
    grouped = (
        clustered.filter("cluster_id IS NOT NULL")
        .groupBy(run, "cluster_id").agg(F.count("*").alias("_n"))
        .groupBy(run).agg(F.count("*").alias("clusters"), F.sum("_n").alias("clustered"))
    )
    return totals.join(kept, run, "left").join(grouped, run, "left").na.fill(0)


def overlay_pixels(hotspots: DataFrame, width: int = 800, height: int = 600) -> DataFrame:
    """Pixel position of each hotspot on its scene (columns min_lon, min_lat, max_lon, max_lat).

    Every hotspot counts as in view; off-image ones sit on the edge.
    """
    box = tuple(F.col(c) for c in ("min_lon", "min_lat", "max_lon", "max_lat"))
    x, y = geo_to_pixel(F.col("latitude"), F.col("longitude"), box, F.lit(width), F.lit(height))
    return hotspots.withColumns({"pixel_x": x, "pixel_y": y})


def headline(detections: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Status texts from the first detection per key."""
    first = keep_one(detections.select(*keys, "detected", "confidence", order.alias("_order")), keys, F.col("_order"))
    seen = F.coalesce("detected", F.lit(False))
    return first.select(
        *keys,
        F.when(seen, "FIRE DETECTED").otherwise("No Fire Detected").alias("status_text"),
        F.concat(F.lit("Confidence: "), percent_text(F.coalesce("confidence", F.lit(0.0)), 1)).alias("confidence_text"),
    )
