"""From clustered hotspots to incident records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfold.functions.geo import exact_mean, nano_sum, round_half_even
from emberfold.functions.nested import append_if
from emberfold.functions.times import iso_utc


def incident_id(run_date: Column, cluster: Column) -> Column:
    return F.concat_ws("_", F.lit("fire_cluster"), F.date_format(run_date, "yyyyMMdd"), cluster.cast("string"))


def cluster_summary(clustered: DataFrame, run: str = "run_date", label: str = "cluster_id") -> DataFrame:
    """One row per cluster; noise is dropped.

    The centroid is the mean over distinct places. Rows are reduced per place first, which is
    both what the centroid needs and a map-side step for very large clusters.
    """
    places = (
        clustered.filter(F.col(label).isNotNull())
        .groupBy(run, label, "latitude", "longitude")
        .agg(
            F.count("*").alias("_n"),
            F.min("acq_datetime").alias("_from"),
            F.max("acq_datetime").alias("_until"),
            F.collect_set("source").alias("_sources"),
            nano_sum(F.col("frp_mean")).alias("_frp"),
            F.count("frp_mean").alias("_frp_n"),
        )
    )
    sources = F.sort_array(F.array_distinct(F.flatten(F.collect_set("_sources"))))
    summary = places.groupBy(run, F.col(label).alias("cluster_no")).agg(
        F.sum("_n").alias("point_count"),
        _centroid("latitude").alias("centroid_latitude"),
        _centroid("longitude").alias("centroid_longitude"),
        sources.alias("detected_by"),
        F.min("_from").alias("first_detected"),
        F.max("_until").alias("last_detected"),
        # Mean power of the hotspots that report one; none at all counts as zero.
        F.coalesce(exact_mean(F.sum("_frp"), F.sum("_frp_n")), F.lit(0.0)).alias("avg_frp"),
        F.min("latitude").alias("min_lat"),
        F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"),
        F.max("longitude").alias("max_lon"),
    )
    return summary.withColumn("cluster_id", incident_id(F.col(run), F.col("cluster_no")))


def _centroid(column: str) -> Column:
    return round_half_even(exact_mean(nano_sum(F.col(column)), F.count("*")), 6)


def assess_severity(point_count: Column, weather: Column, air_quality: Column) -> Column:
    """Severity struct from density, weather and air quality.

    ``weather`` with an error counts for nothing; absent humidity and wind count as 100 and 0;
    an absent air-quality class as unknown.
    """
    usable = weather.isNotNull() & weather["error"].isNull()
    dry = usable & (F.coalesce(weather["relative_humidity_percent"], F.lit(100.0)) < 40)
    windy = usable & (F.coalesce(weather["wind_speed_kmh"], F.lit(0.0)) > 20)
    air = F.coalesce(air_quality["air_quality_severity"], F.lit("unknown"))
    # Points and factor texts.
    density = F.when(point_count >= 15, 3).when(point_count >= 5, 2).otherwise(1)
    air_points = F.when(air == "severe", 3).when(air == "high", 2).when(air == "moderate", 1).otherwise(0)
    score = density + F.when(dry, 2).otherwise(0) + F.when(windy, 1).otherwise(0) + air_points
    overall = (
        F.when(score >= 8, "critical")
        .when(score >= 6, "severe")
        .when(score >= 4, "high")
        .when(score >= 2, "moderate")
        .otherwise("low")
    )
    factors = append_if(
        (point_count >= 15, "High hotspot density (>=15)"),
        ((point_count >= 5) & (point_count < 15), "Moderate hotspot density (>=5)"),
        (point_count < 5, "Low hotspot density"),
        (dry, "Low humidity (<40%)"),
        (windy, "High wind speed (>20km/h)"),
        (air == "severe", "Severe air quality impact"),
        (air == "high", "High air quality impact"),
        (air == "moderate", "Moderate air quality impact"),
    )
    return F.struct(
        overall.alias("overall_severity"),
        score.cast("long").alias("severity_score"),
        factors.alias("contributing_factors"),
        F.struct(
            point_count.cast("long").alias("hotspot_count"),
            F.when(dry | windy, "high").otherwise("low").alias("weather_severity"),
            air.alias("air_quality_severity"),
        ).alias("details"),
    )


def with_severity(incidents: DataFrame) -> DataFrame:
    """Fold weather, air quality and severity into the incident's context fields."""
    return incidents.withColumns(
        {
            "realtime_context": F.struct("weather", "air_quality"),
            "fire_severity_assessment": assess_severity(
                F.col("point_count"), F.col("weather"), F.col("air_quality")
            ),
        }
    )


def hotspot_records(clustered: DataFrame, run: str = "run_date", label: str = "cluster_id") -> DataFrame:
    """The hotspots of all incidents, one row each, keyed by run and incident; noise is dropped."""
    identity = F.xxhash64("source", "acq_datetime", "latitude", "longitude", "frp_mean", "confidence")
    return clustered.filter(F.col(label).isNotNull()).select(
        run,
        incident_id(F.col(run), F.col(label)).alias("cluster_id"),
        F.hex(identity).alias("id"),
        "latitude",
        "longitude",
        F.date_format("acq_datetime", "yyyy-MM-dd HH:mm:ssxxx").alias("acq_datetime"),
        "frp_mean",
        "frp_max",
        "confidence",
        F.col("n_detections").cast("long").alias("n_detections"),
        "source",
        F.col(label).cast("long").alias("cluster_no"),
    )


def incident_documents(incidents: DataFrame, run: str = "run_date") -> DataFrame:
    """Incident records ready to be written, one per line, whatever the size of a cluster.

    A record carries its mean power and its box, so that what reads it needs no hotspots; these
    are a table of their own (``hotspot_records``).
    """
    return incidents.select(
        run,
        "cluster_id",
        F.col("point_count").cast("long").alias("point_count"),
        "centroid_latitude",
        "centroid_longitude",
        "detected_by",
        iso_utc(F.col("first_detected")).alias("first_detected_utc"),
        iso_utc(F.col("last_detected")).alias("last_detected_utc"),
        "realtime_context",
        "fire_severity_assessment",
        "avg_frp",
        "min_lat",
        "max_lat",
        "min_lon",
        "max_lon",
    )


def nest_hotspots(documents: DataFrame, hotspots: DataFrame, run: str = "run_date") -> DataFrame:
    """``documents`` with their hotspots nested: a view for consumers that want one document.

    It gathers a cluster's hotspots in one row, so it is for incidents of a moderate size; nothing
    in this library reads it.
    """
    record = F.struct(
        "id", "latitude", "longitude", "acq_datetime", "frp_mean", "frp_max", "confidence", "n_detections", "source",
        F.col("cluster_no").alias("cluster_id"),
    )
    nested = hotspots.groupBy(run, "cluster_id").agg(F.sort_array(F.collect_list(record)).alias("hotspots"))
    return documents.drop("hotspots").join(nested, [run, "cluster_id"], "left")


def severity_histogram(incidents: DataFrame, run: str = "run_date") -> DataFrame:
    level = F.col("fire_severity_assessment.overall_severity").alias("overall_severity")
    return incidents.groupBy(run, level).agg(F.count("*").alias("incidents"))


def run_summary(incidents: DataFrame, run: str = "run_date") -> DataFrame:
    """One record per run: status, incident count and the severity histogram as a map."""
    return (
        severity_histogram(incidents, run)
        .groupBy(run)
        .agg(
            F.sum("incidents").alias("incident_count"),
            # At most one entry per severity level.
            F.map_from_entries(
                F.array_sort(F.collect_list(F.struct("overall_severity", "incidents")))
            ).alias("severity_summary"),
        )
        .select(F.lit("incidents_detected").alias("status"), "incident_count", run, "severity_summary")
    )


def with_power(documents: DataFrame) -> DataFrame:
    """``documents`` with ``avg_frp``: their own, else the mean over nested hotspots of either shape."""
    power = F.filter(
        F.transform("hotspots", lambda h: F.coalesce(h["properties"]["frp_mean"], h["frp_mean"])),
        lambda v: v.isNotNull(),
    )
    total = F.aggregate(power, F.lit(0.0), lambda acc, v: acc + v)
    nested = F.try_divide(total, F.size(power))
    return documents.withColumn("avg_frp", F.coalesce("avg_frp", nested, F.lit(0.0)))
