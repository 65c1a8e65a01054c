"""Declared schemas; production reads never infer."""

from __future__ import annotations

FIRMS = (
    "latitude DOUBLE, longitude DOUBLE, frp DOUBLE, acq_date STRING, acq_time INT, "
    "confidence STRING"
)

HIMAWARI = (
    "year INT, month INT, day INT, hour INT, lat DOUBLE, lon DOUBLE, "
    "ave_frp DOUBLE, max_frp DOUBLE, ave_confidence DOUBLE, n INT"
)

# Golden hotspot columns, in output order.
GOLDEN_COLUMNS = [
    "latitude",
    "longitude",
    "acq_datetime",
    "frp_mean",
    "frp_max",
    "confidence",
    "n_detections",
    "source",
]

GOLDEN = (
    "latitude DOUBLE, longitude DOUBLE, acq_datetime TIMESTAMP, frp_mean DOUBLE, frp_max DOUBLE, "
    "confidence DOUBLE, n_detections INT, source STRING"
)

WEATHER = (
    "cell_lat DOUBLE, cell_lon DOUBLE, hour TIMESTAMP, temperature_2m DOUBLE, "
    "relative_humidity_2m DOUBLE, dew_point_2m DOUBLE, precipitation DOUBLE, "
    "wind_speed_10m DOUBLE, wind_direction_10m DOUBLE, wind_gusts_10m DOUBLE"
)

PIXELS = "product STRING, ts TIMESTAMP, lat DOUBLE, lon DOUBLE, value DOUBLE"

SCENES = (
    "scene_id STRING, data_source STRING, time_start_ms BIGINT, cloud_cover DOUBLE, "
    "min_lon DOUBLE, min_lat DOUBLE, max_lon DOUBLE, max_lat DOUBLE"
)

PREDICTION = "instance_id STRING, confidence_score DOUBLE, raw_score DOUBLE"

MANIFEST = "jobs ARRAY<STRUCT<job_id: STRING, created_at: STRING>>"

PROCESSED_EVENTS = "event_id STRING, processed_at TIMESTAMP"

WEATHER_CONTEXT = (
    "STRUCT<timestamp_utc: STRING, temperature_celsius: DOUBLE, "
    "relative_humidity_percent: DOUBLE, dew_point_celsius: DOUBLE, precipitation_mm: DOUBLE, "
    "wind_speed_kmh: DOUBLE, wind_direction_deg: DOUBLE, wind_gusts_kmh: DOUBLE, error: STRING>"
)

AIR_QUALITY_CONTEXT = (
    "STRUCT<measurements: MAP<STRING, STRUCT<status: STRING, value: DOUBLE, unit: STRING, "
    "source: STRING, error: STRING>>, "
    "fire_indicators: ARRAY<STRUCT<product: STRING, severity: STRING, value: DOUBLE, "
    "message: STRING>>, air_quality_severity: STRING, error: STRING>"
)

SEVERITY_ASSESSMENT = (
    "STRUCT<overall_severity: STRING, severity_score: BIGINT, "
    "contributing_factors: ARRAY<STRING>, details: STRUCT<hotspot_count: BIGINT, "
    "weather_severity: STRING, air_quality_severity: STRING>>"
)

# Both hotspot shapes: flat fields, and GeoJSON features with properties and geometry.
HOTSPOT = (
    "STRUCT<id: STRING, latitude: DOUBLE, longitude: DOUBLE, acq_datetime: STRING, "
    "frp_mean: DOUBLE, frp_max: DOUBLE, confidence: DOUBLE, n_detections: BIGINT, "
    "source: STRING, cluster_id: BIGINT, type: STRING, "
    "properties: STRUCT<latitude: DOUBLE, longitude: DOUBLE, frp_mean: DOUBLE, "
    "frp_max: DOUBLE, confidence: DOUBLE, n_detections: BIGINT, acq_datetime: STRING, "
    "source: STRING, cluster_id: BIGINT>, "
    "geometry: STRUCT<type: STRING, coordinates: ARRAY<DOUBLE>>>"
)

# Own records carry mean power and box; records from elsewhere may nest their hotspots instead.
INCIDENT = (
    "cluster_id STRING, point_count BIGINT, centroid_latitude DOUBLE, "
    "centroid_longitude DOUBLE, detected_by ARRAY<STRING>, first_detected_utc STRING, "
    "last_detected_utc STRING, "
    f"realtime_context STRUCT<weather: {WEATHER_CONTEXT}, air_quality: {AIR_QUALITY_CONTEXT}>, "
    f"fire_severity_assessment {SEVERITY_ASSESSMENT}, hotspots ARRAY<{HOTSPOT}>, "
    "avg_frp DOUBLE, min_lat DOUBLE, max_lat DOUBLE, min_lon DOUBLE, max_lon DOUBLE"
)

INCIDENT_HOTSPOT = (
    "cluster_id STRING, id STRING, latitude DOUBLE, longitude DOUBLE, acq_datetime STRING, frp_mean DOUBLE, "
    "frp_max DOUBLE, confidence DOUBLE, n_detections BIGINT, source STRING, cluster_no BIGINT"
)
