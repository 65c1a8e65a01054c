"""Feeds to golden hotspots: standardise, filter, fuse, deduplicate."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfold.functions.geo import round_half_even
from emberfold.functions.nested import nan_to_null
from emberfold.functions.times import floor_minutes, hhmm_timestamp
from emberfold.schemas import GOLDEN_COLUMNS

# Score of each confidence class of the polar-orbit feed.
CONFIDENCE_SCORE = {"l": 30, "n": 75, "h": 100}


def golden_columns(df: DataFrame, source: str) -> DataFrame:
    """Stamp the source and keep the golden columns that exist, in golden order."""
    stamped = df.withColumn("source", F.lit(source))
    return stamped.select([c for c in GOLDEN_COLUMNS if c in stamped.columns])


def confidence_score(label: Column) -> Column:
    lowered = F.lower(label)
    score = F.lit(None).cast("double")
    for name, value in CONFIDENCE_SCORE.items():
        score = F.when(lowered == name, F.lit(float(value))).otherwise(score)
    return score


def standardize_firms(df: DataFrame) -> DataFrame:
    out = df.withColumnRenamed("frp", "frp_mean") if "frp" in df.columns else df
    out = out.withColumns(
        {
            "confidence": confidence_score(F.col("confidence")),
            "n_detections": F.lit(1),
            "acq_datetime": hhmm_timestamp(F.col("acq_date"), F.col("acq_time")),
        }
    )
    return golden_columns(out, "FIRMS")


def standardize_himawari(df: DataFrame) -> DataFrame:
    out = df.select(
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        F.try_make_timestamp(
            F.col("year"), F.col("month"), F.col("day"), F.col("hour"), F.lit(0), F.lit(0.0),
            F.lit("UTC"),
        ).alias("acq_datetime"),
        F.col("ave_frp").alias("frp_mean"),
        F.col("max_frp").alias("frp_max"),
        nan_to_null(F.col("ave_confidence")).alias("confidence"),
        F.col("n").alias("n_detections"),
    )
    return golden_columns(out, "JAXA")


# Source name to standardiser; add an entry to plug in another feed.
STANDARDIZERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "FIRMS": standardize_firms,
    "JAXA": standardize_himawari,
}


def keep_confident(df: DataFrame, classes: tuple[str, ...] = ("h", "n")) -> DataFrame:
    """Rows of the wanted confidence classes, any case; a feed without the column passes."""
    if "confidence" not in df.columns:
        return df
    return df.filter(F.lower("confidence").isin(*classes))


def union_feeds(*feeds: DataFrame | None) -> DataFrame | None:
    """Union by name with nulls for missing columns; absent feeds are skipped."""
    present = [f for f in feeds if f is not None]
    if not present:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def fuse(feeds: dict[str, DataFrame | None]) -> DataFrame | None:
    """Standardise every feed by its registered name and union them."""
    return union_feeds(*[STANDARDIZERS[name](df) for name, df in feeds.items() if df is not None])


def best_key(lat: Column, lon: Column, at: Column, places: int = 2, minutes: int = 10) -> list[Column]:
    """Rounded place and time bucket that hotspots are compared within."""
    return [
        round_half_even(lat, places).alias("_lat_key"), round_half_even(lon, places).alias("_lon_key"),
        floor_minutes(at, minutes).alias("_time_key"),
    ]


def dedup_spatiotemporal(
    df: DataFrame, places: int = 2, minutes: int = 10, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Best row per (rounded place, time bucket): highest confidence, nulls last.

    Ties fall to the earliest time, then place, source and power, then to all remaining columns,
    so that the result does not depend on row order. One aggregation with a map-side step: however many copies a key has,
    each map task ships one row of it.
    """
    columns = [c for c in df.columns if c not in carry]
    named = {"confidence", "acq_datetime", "latitude", "longitude", "source", "frp_mean"}
    rank = F.struct(
        F.col("confidence").isNull(),
        -F.col("confidence"),
        F.col("acq_datetime"),
        F.col("latitude"),
        F.col("longitude"),
        F.col("source"),
        -F.col("frp_mean"),
        *[F.col(c) for c in columns if c not in named],
    )
    keyed = df.select(
        *[F.col(c) for c in carry],
        *best_key(F.col("latitude"), F.col("longitude"), F.col("acq_datetime"), places, minutes),
        F.struct(*columns).alias("_row"),
        rank.alias("_rank"),
    )
    return (
        keyed.groupBy(*carry, "_lat_key", "_lon_key", "_time_key")
        .agg(F.min_by("_row", "_rank").alias("_row"))
        .select(*carry, "_row.*")
    )


def keep_one(df: DataFrame, keys: list[str], order: Column, keep: str = "first") -> DataFrame:
    """First or last row per key in ``order``, as one aggregation with a map-side step."""
    pick = F.min_by if keep == "first" else F.max_by
    payload = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(pick(F.struct(*payload), order).alias("_row"))
        .select(*keys, "_row.*")
    )


def drop_processed(
    events: DataFrame, processed: DataFrame, key: str = "event_id", order: Column | None = None
) -> DataFrame:
    """New events only: the first row per key in ``order``, minus the keys already recorded."""
    others = [c for c in events.columns if c != key]
    first = F.struct(*others) if order is None else order
    fresh = keep_one(events, [key], first) if others else events.distinct()
    return fresh.join(processed.select(key), key, "left_anti")
