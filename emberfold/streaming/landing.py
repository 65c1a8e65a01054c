"""Landing folders as streams, and stage-to-stage triggering."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfold.operators.incidents import with_power
from emberfold.operators.report import one_prediction_each, report_kpis, report_markers
from emberfold.operators.scoring import score_incidents
from emberfold.operators.standardize import keep_one
from emberfold.schemas import INCIDENT, PREDICTION
from emberfold.sources.records import run_output, write_run


def landing_stream(
    spark: SparkSession, folder: str, schema: str, fmt: str = "parquet", glob: str | None = None, **options: str
) -> DataFrame:
    """New files of a folder as a stream; ``glob`` picks files by name."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder)


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process what has arrived since the last call, then stop."""
    (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def write_batch(df: DataFrame, table: str, batch_id: int, *partitions: str) -> None:
    """Write a batch under its own folder; a repeated batch replaces itself."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(f"{table}/batch_id={batch_id}")


def read_batches(spark: SparkSession, table: str, schema: str, before: int | None = None) -> DataFrame:
    """Rows of all batches, or of those before a given one."""
    df = spark.read.schema(f"{schema}, batch_id BIGINT").parquet(table)
    if before is not None:
        df = df.filter(f"batch_id < {int(before)}")
    return df.drop("batch_id")


def list_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, by name."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def delete_folders(spark: SparkSession, paths: list[str]) -> None:
    context = spark.sparkContext
    for name in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def create_table(spark: SparkSession, table: str, schema: str) -> None:
    """An empty first batch, so that the table can be read before any data arrives."""
    write_batch(spark.createDataFrame([], schema), table, -1)


def score_arrivals(spark: SparkSession, incidents: str, predictions: str, checkpoint: str) -> None:
    """Score incident records as their files arrive; the arrival of a file is the trigger.

    A record is complete in itself, so it does not matter what arrives together with it.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(score_incidents(with_power(batch)), predictions, batch_id)

    run_available(landing_stream(spark, incidents, INCIDENT, "json", recursiveFileLookup="true"), handle, checkpoint)


def read_scored(spark: SparkSession, predictions: str) -> DataFrame:
    return read_batches(spark, predictions, PREDICTION)


def report_arrivals(
    spark: SparkSession, incidents: str, predictions: str, state: str, reports: str, checkpoint: str
) -> None:
    """Report on every run as soon as it is whole, and again when more predictions of it come.

    Two streams feed it: incident records and predictions, both in ``run_date=`` folders. What has arrived
    is kept by run below ``state``. After a batch of either, the runs that it brought rows for
    are looked at: a run is whole when each of its incidents has a prediction. Its markers and totals are then
    written as one version of the run. The order in which the two sides arrive does not matter, and
    a repeated batch replaces itself.
    """
    create_table(spark, f"{state}/incidents", INCIDENT)
    create_table(spark, f"{state}/predictions", PREDICTION)

    def arrived(side: str):
        def handle(batch: DataFrame, batch_id: int) -> None:
            kept = batch.filter("run_date IS NOT NULL")
            write_batch(kept, f"{state}/{side}", batch_id, "run_date")
            session = batch.sparkSession
            # Runs that this batch brought rows for: their folders, by name.
            runs = sorted({p.rsplit("=", 1)[1] for p in list_folders(session, f"{state}/{side}/batch_id={batch_id}/run_date=*")})
            for run in runs:
                report_run(session, state, reports, run)

        return handle

    for side, folder, schema in (("incidents", incidents, INCIDENT), ("predictions", predictions, PREDICTION)):
        source = landing_stream(spark, folder, f"{schema}, run_date STRING", "json")
        run_available(source, arrived(side), f"{checkpoint}/{side}")


def rows_of_run(spark: SparkSession, table: str, schema: str, run: str) -> DataFrame:
    """All rows of a run that have arrived, with ``ingest_order``; only its folders are read."""
    paths = list_folders(spark, f"{table}/batch_id=*/run_date={run}")
    if not paths:
        return spark.createDataFrame([], f"{schema}, ingest_order BIGINT")
    df = spark.read.schema(f"{schema}, batch_id BIGINT").option("basePath", table).parquet(*paths)
    order = F.struct(F.col("batch_id"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"))
    return df.withColumn("ingest_order", order).drop("batch_id")


def report_run(spark: SparkSession, state: str, reports: str, run: str) -> bool:
    """Write the report of a run if it is whole; whether it is."""
    found = one_incident_each(rows_of_run(spark, f"{state}/incidents", INCIDENT, run))
    seen = rows_of_run(spark, f"{state}/predictions", PREDICTION, run)
    first = one_prediction_each(seen, F.col("ingest_order"))
    waiting = found.join(first.select(F.col("instance_id").alias("cluster_id")), "cluster_id", "left_anti")
    if found.isEmpty() or not waiting.isEmpty():
        return False
    write_run({"markers": report_markers(found, first), "totals": report_kpis(found, first)}, reports, run)
    return True


def one_incident_each(incidents: DataFrame) -> DataFrame:
    """The first record of each incident; records of a later delivery do not count twice."""
    return keep_one(incidents.filter("cluster_id IS NOT NULL"), ["cluster_id"], F.col("ingest_order")).drop("ingest_order")


def read_reports(spark: SparkSession, reports: str, name: str, schema: str) -> DataFrame:
    """One output of the current reports of all runs, with the run date."""
    runs = sorted(p.rsplit("/", 2)[1].split("=", 1)[1] for p in list_folders(spark, f"{reports}/run_date=*/_current"))
    paths = [run_output(spark, reports, run, name) for run in runs]
    if not paths:
        return spark.createDataFrame([], f"{schema}, run_date STRING")
    df = spark.read.schema(f"{schema}, run_date STRING").option("basePath", reports).json(paths)
    return df.drop("version")
