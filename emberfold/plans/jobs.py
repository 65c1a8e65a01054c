"""The three jobs: detect incidents, score them, report on them; as functions and through folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfold.functions.times import default_run_date, in_local_day, run_date_of
from emberfold.operators.air_quality import air_quality
from emberfold.operators.asof import with_weather
from emberfold.operators.dbscan import dbscan
from emberfold.operators.imagery import best_scene, incident_regions, scene_catalogue, scenes_in_window
from emberfold.operators.incidents import (
    cluster_summary,
    hotspot_records,
    incident_documents,
    run_summary,
    with_power,
    with_severity,
)
from emberfold.operators.report import one_prediction_each, report_kpis, report_markers
from emberfold.operators.scoring import score_incidents
from emberfold.operators.spatial import points_near_polygons
from emberfold.operators.standardize import dedup_spatiotemporal, fuse
from emberfold.schemas import GOLDEN
from emberfold.session import cut_lineage
from emberfold.sources import records
from emberfold.sources.layout import stage_path

MIN_SAMPLES = 5
EPS_KM = 5.0


def row_order() -> list:
    """Order that numbers clusters: best confidence first, then time."""
    return [F.col("confidence").isNull(), -F.col("confidence"), F.col("acq_datetime"), F.col("source")]


def detect_hotspots(feeds: dict[str, DataFrame | None], run_date: str | None = None, run_days: int = 1) -> DataFrame | None:
    """Fused, deduplicated hotspots with their run date; all runs, or one local day."""
    fused = fuse(feeds)
    if fused is None:
        return None
    if run_date:
        fused = fused.filter(in_local_day(F.col("acq_datetime"), run_date, days=run_days))
        return dedup_spatiotemporal(fused).withColumn("run_date", F.lit(run_date).cast("date"))
    return dedup_spatiotemporal(fused).withColumn(
        "run_date", run_date_of(F.col("acq_datetime"), days=run_days)
    )


def cluster_hotspots(hotspots: DataFrame, polygons: DataFrame, semi: bool = False) -> DataFrame:
    """Hotspots in or near the polygons with their cluster; runs never share a cluster.

    The filtered hotspots are written down once, as clustering reads them twice.
    """
    near = points_near_polygons(hotspots, polygons, semi=semi)
    return dbscan(
        cut_lineage(near), eps_km=EPS_KM, min_samples=MIN_SAMPLES,
        partition_by=["run_date"], order_by=row_order(),
    )


def enrich(summary: DataFrame, weather: DataFrame, pixels: DataFrame) -> DataFrame:
    """Weather, air quality and severity for all incidents at once."""
    keys = ["run_date", "cluster_no"]
    air = air_quality(summary, pixels, keys).drop("severe_count", "moderate_count")
    return with_severity(with_weather(summary, weather).join(air, keys))


def detect_incidents(
    hotspots: DataFrame, polygons: DataFrame, weather: DataFrame, pixels: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(incident rows, the hotspots of all incidents), both written down once."""
    clustered = cut_lineage(cluster_hotspots(hotspots, polygons))
    summary = cut_lineage(cluster_summary(clustered))
    return cut_lineage(enrich(summary, weather, pixels)), hotspot_records(clustered)


def run_detect(
    spark: SparkSession, root: str, feeds: dict[str, DataFrame | None], polygons: DataFrame,
    weather_path: str, pixels_path: str, run_date: str | None = None, run_days: int = 1,
) -> str | None:
    """Detect the incidents of one run and write records, their hotspots and the summary.

    Without ``run_date`` the run is for yesterday in the local zone. A rerun replaces all that an
    earlier run of the day has written, also if there is no incident any more, and all of it at once:
    readers see the earlier run whole until the last output is complete.
    """
    run_date = run_date or default_run_date()
    spots = detect_hotspots(feeds, run_date, run_days)
    if spots is None:
        spots = spark.createDataFrame([], GOLDEN).withColumn("run_date", F.lit(run_date).cast("date"))
    incidents, hotspots = detect_incidents(
        spots, polygons, records.read_weather(spark, weather_path), records.read_pixels(spark, pixels_path)
    )
    outputs = {"records": incident_documents(incidents), "hotspots": hotspots, "summaries": run_summary(incidents)}
    records.write_run(outputs, stage_path(root, "incidents"), run_date)
    return run_date


def detected(spark: SparkSession, root: str, run_date: str) -> DataFrame:
    """The incident records of a run's current version, with their run date."""
    path = records.run_output(spark, stage_path(root, "incidents"), run_date, "records")
    return records.read_incidents(spark, path).withColumn("run_date", F.lit(run_date).cast("date"))


def run_score(spark: SparkSession, root: str, run_date: str, config: dict | None = None) -> None:
    """Score the written incidents of one run."""
    found = detected(spark, root, run_date)
    scored = score_incidents(with_power(found), **({"config": config} if config else {}))
    records.write_predictions(scored, stage_path(root, "predictions", f"run_date={run_date}"))


def run_imagery(
    spark: SparkSession, root: str, run_date: str, sentinel2_path: str, *landsat_paths: str
) -> None:
    """Choose the least cloudy scene of each source for the incidents of one run, and write sidecars.

    The listings hold scenes with the cloud field of their source. Those of the days that the run looks
    back on are merged into the run's catalogue, which is written first; the choice reads that catalogue. A
    rerun replaces both; a run without incidents or scenes leaves no sidecars.
    """
    listings = [scenes_in_window(spark.read.parquet(path), run_date) for path in (sentinel2_path, *landsat_paths)]
    catalogue = stage_path(root, "imagery", "catalogue", f"run_date={run_date}")
    scene_catalogue(*listings).write.mode("overwrite").parquet(catalogue)
    regions = incident_regions(detected(spark, root, run_date)).withColumn("run_date", F.lit(run_date).cast("date"))
    chosen = best_scene(regions, records.read_scenes(spark, catalogue))
    records.write_scene_sidecars(chosen, stage_path(root, "imagery", "sidecars"), [run_date])


def run_report(spark: SparkSession, root: str, run_date: str) -> None:
    """Join the written incidents and predictions of one run and write markers and totals."""
    found = detected(spark, root, run_date)
    scores = records.read_predictions(spark, stage_path(root, "predictions", f"run_date={run_date}"), glob="*.json")
    markers, totals = report(found, scores, F.col("ingest_order"))
    for name, df in (("markers", markers), ("totals", totals)):
        df.write.mode("overwrite").json(stage_path(root, "reports", name, f"run_date={run_date}"))


def report(incidents: DataFrame, predictions: DataFrame, order=None) -> tuple[DataFrame, DataFrame]:
    """(markers, totals) from the first prediction of every incident."""
    ordering = F.struct("confidence_score", "raw_score") if order is None else order
    first = one_prediction_each(predictions, ordering)
    return report_markers(incidents, first), report_kpis(incidents, first)


__all__ = [
    "cluster_hotspots", "detect_hotspots", "detect_incidents", "enrich", "report", "row_order", "run_detect",
    "run_imagery", "run_report", "run_score", "score_incidents",
]
