"""Nearest-in-time join against an hourly table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberfold.functions.geo import round_half_even
from emberfold.functions.times import iso_utc

WEATHER_GRID_DEGREES = 1.0

# Weather variables and their names in the incident record, in order.
WEATHER_FIELDS = [
    ("temperature_2m", "temperature_celsius"),
    ("relative_humidity_2m", "relative_humidity_percent"),
    ("dew_point_2m", "dew_point_celsius"),
    ("precipitation", "precipitation_mm"),
    ("wind_speed_10m", "wind_speed_kmh"),
    ("wind_direction_10m", "wind_direction_deg"),
    ("wind_gusts_10m", "wind_gusts_kmh"),
]
WEATHER_FAILED = "Weather data acquisition failed or returned incomplete data."


def snap(value: Column, grid: float = WEATHER_GRID_DEGREES) -> Column:
    """Nearest node of a regular grid."""
    return F.rint(value / F.lit(grid)) * F.lit(grid)


def asof_nearest(
    left: DataFrame,
    hourly: DataFrame,
    by: list[str],
    left_ts: str,
    hour: str = "hour",
    out: str = "nearest",
) -> DataFrame:
    """``left`` plus a struct with the row of ``hourly`` closest in time per ``by`` key.

    Ties go to the earlier hour; no row at all gives null. The hourly table is made unique per
    (key, hour) first. Per key, a calendar of its hours and of the hours asked for carries the
    last row up to each hour and the first one after it; a left row meets the one calendar row
    of its own hour and takes the nearer of the two. No left row is multiplied, a key with very
    many left rows is spread over its hours, and what a window sees per key is bounded by time.
    """
    values = [c for c in hourly.columns if c not in (*by, hour)]
    unique = (
        hourly.withColumn("_slot", F.date_trunc("hour", hour))
        .filter("_slot IS NOT NULL")
        .groupBy(*by, "_slot")
        .agg(F.min(F.struct(*values)).alias("_values"))
    )
    wanted = left.select(*by, F.date_trunc("hour", left_ts).alias("_slot")).distinct()
    known = F.when(
        F.col("_values").isNotNull(),
        F.struct(F.col("_slot").alias(hour), *[F.col("_values")[v].alias(v) for v in values]),
    )
    so_far = Window.partitionBy(*by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    to_come = (
        Window.partitionBy(*by).orderBy(F.desc("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    )
    calendar = (
        unique.join(wanted, [*by, "_slot"], "full_outer")
        .withColumn("_row", known)
        .select(
            *by,
            "_slot",
            F.last("_row", ignorenulls=True).over(so_far).alias("_before"),
            F.last("_row", ignorenulls=True).over(to_come).alias("_after"),
        )
    )
    asked = F.unix_micros(left_ts)
    wait = F.unix_micros(F.col("_after")[hour]) - asked
    ago = asked - F.unix_micros(F.col("_before")[hour])
    nearer = F.when(F.col("_after").isNull() | (ago <= wait), F.col("_before")).otherwise(F.col("_after"))
    return (
        left.withColumn("_slot", F.date_trunc("hour", left_ts))
        .join(calendar, [*by, "_slot"], "left")
        .select(*[F.col(c) for c in left.columns], nearer.alias(out))
    )


def weather_context(nearest: Column) -> Column:
    """Weather part of an incident: rounded fields, or only an error if anything is missing."""
    missing = nearest.isNull()
    for source, _ in WEATHER_FIELDS:
        missing = missing | nearest[source].isNull() | F.isnan(nearest[source])

    def unless_missing(value: Column) -> Column:
        return F.when(~missing, value)

    return F.struct(
        unless_missing(iso_utc(nearest["hour"])).alias("timestamp_utc"),
        *[
            unless_missing(round_half_even(nearest[source], 2)).alias(name)
            for source, name in WEATHER_FIELDS
        ],
        F.when(missing, F.lit(WEATHER_FAILED)).alias("error"),
    )


def with_weather(incidents: DataFrame, weather: DataFrame, grid: float = WEATHER_GRID_DEGREES) -> DataFrame:
    """Attach ``weather`` (a struct) from the hour nearest to the last detection."""
    located = incidents.withColumns(
        {
            "cell_lat": snap(F.col("centroid_latitude"), grid),
            "cell_lon": snap(F.col("centroid_longitude"), grid),
        }
    )
    joined = asof_nearest(located, weather, ["cell_lat", "cell_lon"], "last_detected")
    return joined.withColumn("weather", weather_context(F.col("nearest"))).drop(
        "cell_lat", "cell_lon", "nearest"
    )
