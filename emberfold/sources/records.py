"""Incident, prediction, manifest and context tables: reading and writing."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfold.operators.report import latest_job
from emberfold.schemas import INCIDENT, INCIDENT_HOTSPOT, MANIFEST, PIXELS, PREDICTION, SCENES, WEATHER


def read_incidents(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """Incident records, with hotspots in either shape.

    ``lines``: one record per line. ``document``: each file is one record or one array of them.
    ``concatenated``: indented records back to back, cut at a closing brace in the first
    column, so that large files still split.
    """
    if layout == "lines":
        return spark.read.schema(INCIDENT).json(path)  # run_date comes from the folders
    if layout == "document":
        return spark.read.schema(INCIDENT).option("multiLine", "true").json(path)
    if layout != "concatenated":
        raise ValueError(f"unknown layout: {layout}")
    chunk = F.col("value")
    closed = F.when(F.try_parse_json(chunk).isNotNull(), chunk).otherwise(F.concat(chunk, F.lit("\n}")))
    return (
        spark.read.option("lineSep", "\n}\n").text(path)
        .filter(F.trim(chunk) != "")
        .select(F.from_json(closed, INCIDENT).alias("r"))
        .select("r.*")
    )


def read_hotspots(spark: SparkSession, path: str) -> DataFrame:
    """The hotspots of incident records, with their run date."""
    return spark.read.schema(f"{INCIDENT_HOTSPOT}, run_date DATE").json(path)


def read_predictions(spark: SparkSession, path: str, glob: str = "*prediction.results*") -> DataFrame:
    """Predictions with ``ingest_order``, their position by file, block and line."""
    return (
        spark.read.schema(PREDICTION)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .json(path)
        .select(
            "*",
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("ingest_order"),
        )
    )


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """(job_id, created_at) of a job manifest."""
    return (
        spark.read.schema(MANIFEST).option("multiLine", "true").json(path)
        .select(F.explode("jobs").alias("j")).select("j.*")
    )


def read_latest_job(spark: SparkSession, path: str) -> DataFrame:
    return latest_job(read_jobs(spark, path))


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WEATHER).parquet(path)


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PIXELS).parquet(path)


def read_scenes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCENES).parquet(path)


def write_by_run(df: DataFrame, path: str, *partitions: str, runs: list[str] | None = None) -> None:
    """JSON lines in one folder per partition value; a rerun replaces just the runs it holds.

    ``runs`` names the run dates that were processed: the folder of each is replaced, also where
    the run has no rows now. Without it only the partitions that occur in ``df`` are replaced.
    """
    if runs is None:
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*(partitions or ("run_date",)))
            .json(path)
        )
        return
    for run in runs:
        rows = df.filter(F.col("run_date") == F.lit(run).cast("date")).drop("run_date")
        deeper = [c for c in partitions if c != "run_date"]
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(*deeper) if deeper else writer).json(f"{path.rstrip('/')}/run_date={run}")


def _hadoop(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())


def write_run(outputs: dict[str, DataFrame], root: str, run: str) -> str:
    """All outputs of a run as one version of it, made current by one write at the end.

    Every output goes to a folder of its own below ``root/run_date=.../version=...``. The pointer
    ``root/run_date=.../_current`` is replaced by a rename once all are complete: a reader sees the old
    version whole or the new one whole, also if a write fails between two outputs. The version
    before the current one is kept for readers that have already begun; older ones are deleted.
    """
    spark = next(iter(outputs.values())).sparkSession
    folder = f"{root.rstrip('/')}/run_date={run}"
    version = f"version={datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    previous = current_version(spark, root, run)
    for name, df in outputs.items():
        df.drop("run_date").write.json(f"{folder}/{version}/{name}")
    pointer, system = _hadoop(spark, f"{folder}/_current")
    fresh = _hadoop(spark, f"{folder}/_current-{uuid.uuid4().hex}")[0]
    stream = system.create(fresh, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    renames = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    renames[0] = options
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        pointer.makeQualified(system.getUri(), system.getWorkingDirectory()).toUri(),
        spark.sparkContext._jsc.hadoopConfiguration(),
    )
    context.rename(fresh, pointer, renames)
    for status in system.globStatus(_hadoop(spark, f"{folder}/version=*")[0]):
        if status.getPath().getName() not in (version, previous):
            system.delete(status.getPath(), True)
    return version


def current_version(spark: SparkSession, root: str, run: str) -> str | None:
    """Name of the run's current version, if it has one."""
    pointer, system = _hadoop(spark, f"{root.rstrip('/')}/run_date={run}/_current")
    if not system.exists(pointer):
        return None
    stream = system.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def run_output(spark: SparkSession, root: str, run: str, name: str) -> str:
    """Folder of one output of a run's current version."""
    version = current_version(spark, root, run)
    if version is None:
        raise FileNotFoundError(f"no complete version of run {run} below {root}")
    return f"{root.rstrip('/')}/run_date={run}/{version}/{name}"


def write_predictions(predictions: DataFrame, path: str) -> None:
    predictions.write.mode("overwrite").json(path)


def write_scene_sidecars(scenes: DataFrame, path: str, runs: list[str] | None = None) -> None:
    """Scene metadata by region and source; ``runs`` as in ``write_by_run``."""
    out = scenes.withColumn("source", F.col("data_source"))
    write_by_run(out, path, "run_date", "region_id", "source", runs=runs)
