"""Inputs derived from the given tables, covering every row of them.

The formulas are plain arithmetic, so that ``oracles`` can state the same ones in SQL. Events
split by type into the two feeds; sites follow from the user, jitter from the event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfold.functions.times import run_date_of
from emberfold.operators.incidents import incident_id
from emberfold.operators.standardize import fuse, keep_confident
from emberfold.plans.jobs import detect_hotspots
from emberfold.session import prepare, scratch_path

# Days per run in the registered queries: a single derived day is too thin to form clusters.
RUN_DAYS = 7

LATITUDE = (
    "-10.5D + ((user_id * 7919) % 1600) / 100.0D + ((event_id * 31) % 201 - 100) / 2000.0D"
)
LONGITUDE = (
    "95.5D + ((user_id * 104729) % 4500) / 100.0D + ((event_id * 57) % 211 - 105) / 2000.0D"
)
FIRMS_TYPES = ("click", "error", "signup")
HIMAWARI_TYPES = ("view", "purchase")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a proper UTC timestamp (the file stores one without a zone)."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def firms_feed(ev: DataFrame) -> DataFrame:
    return ev.filter(F.col("event_type").isin(*FIRMS_TYPES)).select(
        F.expr(LATITUDE).alias("latitude"),
        F.expr(LONGITUDE).alias("longitude"),
        F.col("value").alias("frp"),
        F.date_format("ts", "yyyy-MM-dd").alias("acq_date"),
        (F.hour("ts") * 100 + F.minute("ts")).alias("acq_time"),
        F.expr("CASE event_type WHEN 'signup' THEN 'l' WHEN 'error' THEN 'H' ELSE 'n' END").alias(
            "confidence"
        ),
    )


def himawari_feed(ev: DataFrame) -> DataFrame:
    return ev.filter(F.col("event_type").isin(*HIMAWARI_TYPES)).select(
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
        F.hour("ts").alias("hour"),
        F.expr(LATITUDE).alias("lat"),
        F.expr(LONGITUDE).alias("lon"),
        F.col("value").alias("ave_frp"),
        (F.col("value") * 1.5).alias("max_frp"),
        F.expr("CAST((event_id * 13) % 101 AS DOUBLE)").alias("ave_confidence"),
        F.expr("CAST(1 + event_id % 9 AS INT)").alias("n"),
    )


def write_hourly_archive(ev: DataFrame, root: str) -> None:
    """The geostationary feed in one or two files per hour, named as an archive names them.

    Hours divisible by six have their rows of more than four reads in a second file; the files of
    hour 5 bear another ending. Spark writes the rows; the driver only renames the files, one or
    two for each hour of the archive.
    """
    spark = ev.sparkSession
    rows = himawari_feed(ev)
    key = F.format_string("%04d%02d%02d_%02d", "year", "month", "day", "hour")
    second = F.when((F.col("hour") % 6 == 0) & (F.col("n") > 4), "b").otherwise("a")
    ending = F.when(F.col("hour") == 5, ".nc").otherwise(".csv")
    named = rows.select(F.concat(F.lit("H09_"), key, F.lit("00_"), second, ending).alias("name"), F.to_csv(F.struct(*rows.columns)).alias("value"))
    staged = scratch_path(spark, "hourly")
    named.repartition("name").write.partitionBy("name").text(staged)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in files.listStatus(path(staged)):
        name = folder.getPath().getName().removeprefix("name=")
        if not name.startswith("H09_"):
            continue
        day = path(f"{root}/{name[4:10]}/{name[10:12]}")
        files.mkdirs(day)
        for part in files.globStatus(path(f"{folder.getPath()}/part-*")):
            files.rename(part.getPath(), path(day, name))


def golden(ev: DataFrame) -> DataFrame:
    """Both feeds, standardised and united, before any filter."""
    return fuse({"FIRMS": firms_feed(ev), "JAXA": himawari_feed(ev)})


def confident_feeds(ev: DataFrame) -> dict[str, DataFrame]:
    return {"FIRMS": keep_confident(firms_feed(ev)), "JAXA": himawari_feed(ev)}


def hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confident, deduplicated golden hotspots of all runs."""
    return detect_hotspots(confident_feeds(events(spark, sf_dir)), run_days=RUN_DAYS)


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One octagon per nation on a 5 x 5 raster, radius 1.2 degrees."""
    def corner(i: int):
        angle = F.radians(F.lit(45.0 * i))
        return F.struct(
            (F.expr("97.0D + 9.0D * (k % 5)") + F.lit(1.2) * F.cos(angle)).alias("lon"),
            (F.expr("-9.0D + 3.2D * (k DIV 5)") + F.lit(1.2) * F.sin(angle)).alias("lat"),
        )

    ring = F.array(*[corner(i) for i in range(8)])
    return (
        table(spark, sf_dir, "nation")
        .withColumn("k", F.col("n_nationkey"))
        .select(
            F.col("n_nationkey").alias("poly_id"),
            F.col("n_name").alias("layer_revi"),
            F.array(ring).alias("rings"),
        )
    )


SITE_LATITUDE = "-10.5D + ((user_id * 7919) % 1600) / 100.0D"
SITE_LONGITUDE = "95.5D + ((user_id * 104729) % 4500) / 100.0D"


def site_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incident-like rows without clustering: the events of one user's site in one run."""
    ev = events(spark, sf_dir).withColumn("run_date", run_date_of(F.col("ts"), days=RUN_DAYS))
    return (
        ev.groupBy("run_date", "user_id")
        .agg(
            F.count("*").alias("point_count"),
            F.date_trunc("minute", F.min("ts")).alias("first_detected"),
            F.date_trunc("minute", F.max("ts")).alias("last_detected"),
            F.avg("value").alias("avg_frp"),
        )
        .select(
            "run_date",
            F.col("user_id").alias("cluster_no"),
            incident_id(F.col("run_date"), F.col("user_id")).alias("cluster_id"),
            "point_count",
            F.expr(SITE_LATITUDE).alias("centroid_latitude"),
            F.expr(SITE_LONGITUDE).alias("centroid_longitude"),
            "first_detected",
            "last_detected",
            "avg_frp",
        )
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse hourly weather per 1-degree cell; some rows lack the dew point."""
    return (
        events(spark, sf_dir)
        .groupBy(
            F.rint(F.expr(SITE_LATITUDE)).alias("cell_lat"),
            F.rint(F.expr(SITE_LONGITUDE)).alias("cell_lon"),
            F.date_trunc("hour", "ts").alias("hour"),
        )
        .agg(
            (F.lit(20.0) + F.min("value") / 10.0).alias("temperature_2m"),
            F.expr("max(value) % 100.0D").alias("relative_humidity_2m"),
            F.expr("CASE WHEN max(event_id) % 29 = 0 THEN NULL ELSE min(value) % 25.0D END").alias("dew_point_2m"),
            F.expr("(min(event_id) % 4) / 20.0D").alias("precipitation"),
            F.expr("CAST((max(event_id) * 7) % 50 AS DOUBLE)").alias("wind_speed_10m"),
            F.expr("CAST((max(event_id) * 31) % 360 AS DOUBLE)").alias("wind_direction_10m"),
            F.expr("CAST((max(event_id) * 11) % 75 AS DOUBLE)").alias("wind_gusts_10m"),
        )
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three pollutant samples per event; NO2 is missing for purchases."""
    samples = F.array(
        F.struct(F.lit("CO").alias("product"), (F.col("value") / 1000.0).alias("value")),
        F.struct(F.lit("AEROSOL").alias("product"), (F.col("value") / 20.0).alias("value")),
        F.struct(
            F.lit("NO2").alias("product"),
            F.when(F.col("event_type") != "purchase", F.col("value") / 1000000.0).alias("value"),
        ),
    )
    return events(spark, sf_dir).select(
        "ts", F.expr(LATITUDE).alias("lat"), F.expr(LONGITUDE).alias("lon"), F.explode(samples).alias("s")
    ).select("s.product", "ts", "lat", "lon", "s.value")


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scene of 1.8 x 1.8 degrees per order, spread over 50 days."""
    day_ms = "(datediff(o_orderdate, DATE'1995-01-01') % 50) * 86400000L"
    lat = "-10.0D + ((o_orderkey * 37) % 1700) / 100.0D"
    lon = "95.0D + ((o_orderkey * 101) % 4600) / 100.0D"
    return table(spark, sf_dir, "orders").select(
        F.expr("concat('S', o_orderkey)").alias("scene_id"),
        F.expr(
            "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'sentinel2' ELSE 'landsat' END"
        ).alias("data_source"),
        # 1703030400000 is 2023-12-20 00:00 UTC.
        F.expr(f"1703030400000L + {day_ms} + ((o_orderkey * 7919) % 86400) * 1000L").alias("time_start_ms"),
        F.expr("o_totalprice % 100.0D").alias("cloud_cover"),
        (F.expr(lon) - 0.9).alias("min_lon"),
        (F.expr(lat) - 0.9).alias("min_lat"),
        (F.expr(lon) + 0.9).alias("max_lon"),
        (F.expr(lat) + 0.9).alias("max_lat"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many predictions per instance, in event order; signups name no instance."""
    return events(spark, sf_dir).select(
        F.expr("CASE WHEN event_type <> 'signup' THEN concat('site_', user_id) END").alias("instance_id"),
        F.expr("value / (1.0D + value)").alias("confidence_score"),
        F.col("value").alias("raw_score"),
        F.col("event_id").alias("ingest_order"),
    )


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of JSON (event properties) and of prose (whole documents), by file."""
    props = events(spark, sf_dir).select(
        F.col("event_type").alias("file"), F.col("event_id").alias("line_id"), F.col("props").alias("line")
    )
    texts = table(spark, sf_dir, "documents").select(
        F.col("source").alias("file"), F.col("doc_id").alias("line_id"), F.col("text").alias("line")
    )
    return props.unionByName(texts)
