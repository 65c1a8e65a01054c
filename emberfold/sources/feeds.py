"""Hotspot feeds from landing folders."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfold.functions.times import (
    LOCAL_ZONE,
    candidate_utc_days,
    hhmm_timestamp,
    hour_path,
    in_local_day,
    utc_bounds,
)
from emberfold.operators.standardize import keep_confident
from emberfold.schemas import FIRMS, HIMAWARI

FIRMS_TYPES = dict(column.split() for column in FIRMS.split(", "))


def _as_list(paths: str | list[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_firms(spark: SparkSession, paths: str | list[str], base: str | None = None) -> DataFrame:
    """Polar-orbit CSV, each file by its own header.

    Columns are taken by the header name of their file and further ones ignored. A blank body, or
    one line saying there is no fire data, yields no rows. ``sensor=``/``utc_day=`` folders become
    columns that prune whole folders; ``base`` is the folder they start at if ``paths`` lie deeper.
    Files are brought together with their header by name, so any number of them may differ; only
    the distinct headers, of which a feed has a few, reach the driver.
    """
    reader = spark.read.option("basePath", base) if base else spark.read
    lines = reader.text(_as_list(paths)).withColumn("_file", F.col("_metadata.file_path"))
    folders = [c for c in lines.columns if c not in ("value", "_file")]
    is_header = F.col("value").contains("latitude") & F.col("value").contains("acq_date")
    headers = lines.filter(is_header).groupBy("_file").agg(F.min("value").alias("_header"))
    known = [r["_header"] for r in headers.select("_header").distinct().collect()]
    if not known:
        return spark.createDataFrame([], FIRMS)
    body = lines.filter(~is_header).join(headers, "_file")
    row = F.lit(None)
    for header in known:
        names = [name.strip() for name in header.split(",")]
        parsed = F.from_csv("value", ", ".join(f"`{name}` STRING" for name in names))
        taken = [
            (parsed[c] if c in names else F.lit(None)).try_cast(t).alias(c) for c, t in FIRMS_TYPES.items()
        ]
        row = F.when(F.col("_header") == header, F.struct(*taken)).otherwise(row)
    used = {name.strip() for header in known for name in header.split(",")}
    return (
        body.select(row.alias("r"), *folders)
        .select(*[F.col(f"r.{c}").alias(c) for c in FIRMS_TYPES if c in used], *folders)
        .filter("latitude IS NOT NULL AND longitude IS NOT NULL")
    )


def _existing(spark: SparkSession, patterns: list[str]) -> list[str]:
    """The glob patterns that match something."""
    context = spark.sparkContext
    make = context._jvm.org.apache.hadoop.fs.Path
    conf = context._jsc.hadoopConfiguration()
    found = []
    for pattern in patterns:
        path = make(pattern)
        if path.getFileSystem(conf).globStatus(path):
            found.append(pattern)
    return found


def firms_local_day(spark: SparkSession, root: str, run_date: str, zone: str = LOCAL_ZONE) -> DataFrame:
    """Confident, distinct hotspots of one local day from ``sensor=/utc_day=`` folders.

    Of the archive only the sensors are listed; the folders of the UTC days that the local day
    touches are looked up by name in each and read. A root without such folders is read as a whole.
    """
    root = root.rstrip("/")
    if _existing(spark, [f"{root}/sensor=*"]):
        paths = _existing(spark, [f"{root}/sensor=*/utc_day={day}" for day in candidate_utc_days(run_date, zone)])
        if not paths:
            return spark.createDataFrame([], FIRMS)
        df = read_firms(spark, paths, root)
    else:
        df = read_firms(spark, root)
    distinct = df.drop("sensor", "utc_day").dropDuplicates()
    when = hhmm_timestamp(F.col("acq_date"), F.col("acq_time"))
    return keep_confident(distinct.filter(in_local_day(when, run_date, zone)))


def read_himawari(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Geostationary CSV without header; ``#`` starts a comment anywhere in a line."""
    body = F.trim(F.split("value", "#", 2)[0])
    return (
        spark.read.option("recursiveFileLookup", "true").text(_as_list(paths))
        .select(body.alias("body"))
        .filter("body <> ''")
        .select(F.from_csv("body", HIMAWARI, {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}).alias("r"))
        .select("r.*")
        .filter("lat IS NOT NULL AND lon IS NOT NULL")
    )


def local_day_hours(spark: SparkSession, run_date: str, zone: str = LOCAL_ZONE) -> DataFrame:
    """The UTC hours that start within a local day, with their folder and file prefix.

    These are 24, or an hour less or more where the clocks change.
    """
    start, end = utc_bounds(run_date, zone)
    first = start + timedelta(seconds=-int(start.timestamp()) % 3600)
    count = -(-int((end - first).total_seconds()) // 3600)
    hours = spark.range(count).select(F.timestamp_seconds(F.lit(int(first.timestamp())) + F.col("id") * 3600).alias("hour"))
    folder, prefix = hour_path(F.col("hour"))
    return hours.select("hour", folder.alias("folder"), prefix.alias("prefix"))


def select_hourly_files(hours: DataFrame, files: DataFrame) -> DataFrame:
    """One file per hour: the first by path in the hour's folder with its prefix; hours without
    a file drop out. ``files`` has a ``path`` column."""
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    folder = F.concat_ws("/", F.element_at(parts, -3), F.element_at(parts, -2))
    listed = files.select(
        "path", folder.alias("folder"), F.substring(name, 1, 17).alias("prefix"), name.alias("name")
    ).filter(F.col("name").endswith(".csv"))
    return hours.join(listed, ["folder", "prefix"]).groupBy("hour").agg(F.min("path").alias("path"))


def himawari_local_day(spark: SparkSession, root: str, run_date: str, zone: str = LOCAL_ZONE) -> DataFrame:
    """Hotspots of the hourly files of one local day.

    Only the two or three day folders of its hours are listed, and only the chosen files opened.
    """
    hours = local_day_hours(spark, run_date, zone)
    days = candidate_utc_days(run_date, zone)
    folders = _existing(spark, [f"{root.rstrip('/')}/{day[:4]}{day[5:7]}/{day[8:]}" for day in days])
    if not folders:
        return spark.createDataFrame([], HIMAWARI)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folders).select("path")
    paths = [row["path"] for row in select_hourly_files(hours, files).collect()]  # at most 25 paths
    if not paths:
        return spark.createDataFrame([], HIMAWARI)
    return read_himawari(spark, sorted(paths))
