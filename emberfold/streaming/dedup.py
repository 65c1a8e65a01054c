"""Event idempotency and best-of-bucket deduplication on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfold.operators.standardize import best_key, dedup_spatiotemporal, drop_processed
from emberfold.schemas import PROCESSED_EVENTS
from emberfold.streaming.landing import (
    create_table,
    delete_folders,
    list_folders,
    read_batches,
    run_available,
    write_batch,
)

# Folders that the recorded ids are spread over.
BUCKETS = 64

GOLDEN = (
    "latitude DOUBLE, longitude DOUBLE, acq_datetime TIMESTAMP, frp_mean DOUBLE, frp_max DOUBLE, "
    "confidence DOUBLE, n_detections INT, source STRING"
)


def _bucketed(ids: DataFrame) -> DataFrame:
    return ids.withColumn("bucket", F.pmod(F.xxhash64("event_id"), F.lit(BUCKETS)).cast("int"))


def process_once(stream: DataFrame, processed: str, checkpoint: str, key: str = "event_id") -> None:
    """Record each event id once, for ever: exact, with the memory on storage.

    A batch is compared with earlier batches only, so a repeated batch gives the same result. The
    table is laid out by a hash of the id, and a batch reads only the buckets that its ids fall in.
    """
    spark = stream.sparkSession
    write_batch(_bucketed(spark.createDataFrame([], PROCESSED_EVENTS)), processed, -1, "bucket")

    def handle(batch: DataFrame, batch_id: int) -> None:
        ids = _bucketed(batch.select(F.col(key).cast("string").alias("event_id")))
        touched = [r["bucket"] for r in ids.select("bucket").distinct().collect()]  # at most BUCKETS
        known = read_batches(
            batch.sparkSession, processed, f"{PROCESSED_EVENTS}, bucket INT", before=batch_id
        ).filter(F.col("bucket").isin(touched))
        fresh = drop_processed(ids.drop("bucket"), known).withColumn("processed_at", F.current_timestamp())
        write_batch(_bucketed(fresh), processed, batch_id, "bucket")

    run_available(stream, handle, checkpoint)


def compact_processed(spark: SparkSession, processed: str, target: str) -> None:
    """Rewrite the recorded ids as one batch, a file per bucket, in a new place for cheaper reads.

    The new table serves a stream from its next batch on.
    """
    ids = _bucketed(read_batches(spark, processed, PROCESSED_EVENTS).select("event_id", "processed_at"))
    write_batch(ids.repartition("bucket"), target, -2, "bucket")


def process_once_within(stream: DataFrame, ts: str, delay: str = "4 hours", key: str = "event_id") -> DataFrame:
    """Same with bounded state: repeats are caught within ``delay`` of event time."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def _place_bucket(df: DataFrame) -> DataFrame:
    keys = best_key(F.col("latitude"), F.col("longitude"), F.col("acq_datetime"))
    return df.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))


def _versions(spark: SparkSession, table: str) -> dict[int, list[int]]:
    """Batches that have written each bucket, oldest first; only folder names are listed."""
    found: dict[int, list[int]] = {}
    for path in list_folders(spark, f"{table}/batch_id=*/bucket=*"):
        batch, bucket = (int(part.split("=")[1]) for part in path.rsplit("/", 2)[1:])
        found.setdefault(bucket, []).append(batch)
    return {bucket: sorted(batches) for bucket, batches in found.items()}


def _read_buckets(spark: SparkSession, table: str, chosen: dict[int, int]) -> DataFrame:
    paths = [f"{table}/batch_id={batch}/bucket={bucket}" for bucket, batch in chosen.items()]
    return spark.read.schema(GOLDEN).parquet(*paths) if paths else spark.createDataFrame([], GOLDEN)


def keep_best(stream: DataFrame, table: str, checkpoint: str) -> None:
    """Best hotspot per space-time bucket as data arrives, as a table with one row per key.

    The table is laid out by a hash of the key. A batch is reduced to its own best rows, merged with
    the buckets that these fall in, and rewrites those buckets only; what it has replaced is
    deleted once it is complete, and other buckets' files stay as they are. A repeated batch that was
    complete only deletes what is left to delete, so it never loses a row.
    """
    create_table(stream.sparkSession, table, GOLDEN)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = bool(list_folders(spark, f"{table}/batch_id={batch_id}/_SUCCESS"))
        if not done:
            fresh = _place_bucket(dedup_spatiotemporal(batch)).persist()
            touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # at most BUCKETS
            earlier = {b: [n for n in all_ if n < batch_id] for b, all_ in _versions(spark, table).items()}
            known = _read_buckets(spark, table, {b: earlier[b][-1] for b in touched if earlier.get(b)})
            best = _place_bucket(dedup_spatiotemporal(fresh.drop("bucket").unionByName(known)))
            write_batch(best, table, batch_id, "bucket")
            fresh.unpersist()
        stale = [
            f"{table}/batch_id={n}/bucket={bucket}"
            for bucket, batches in _versions(spark, table).items() if batch_id in batches for n in batches if n < batch_id
        ]
        delete_folders(spark, stale)

    run_available(stream, handle, checkpoint)


def read_best(spark: SparkSession, table: str) -> DataFrame:
    """The table: the latest version of every bucket, read as it is."""
    return _read_buckets(spark, table, {bucket: batches[-1] for bucket, batches in _versions(spark, table).items()})
