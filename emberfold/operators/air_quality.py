"""Pollutant composites around incidents, their indicators and the air-quality class."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pandas.api.indexers import BaseIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emberfold.functions.geo import EARTH_RADIUS_KM, hav_distance, round_half_even
from emberfold.session import cut_lineage

RADIUS_KM = 50.0
WINDOW_DAYS = 3
# About 5 km at the equator, the resolution composites are taken at.
PIXEL_DEGREES = 0.045
TILE_DEGREES = 0.5
DAY_MICROS = 86_400_000_000
# Windows to a span of time that is worked on together; the images of one window more are read with it.
SPAN_WINDOWS = 4
# Pairs of an incident and a pixel compared at once in a task.
PAIRS_AT_ONCE = 1 << 20

# Products with unit, scale, moderate and severe thresholds, text, collection.
PRODUCTS = [
    ("CO", "µmol/m²", 1e6, 50000.0, 100000.0, "Carbon Monoxide", "COPERNICUS/S5P/NRTI/L3_CO"),
    ("AEROSOL", "index", 1.0, 1.0, 3.0, "Aerosol Index", "COPERNICUS/S5P/NRTI/L3_AER_AI"),
    ("NO2", "µmol/m²", 1e6, 20.0, 50.0, "Nitrogen Dioxide", "COPERNICUS/S5P/NRTI/L3_NO2"),
]
NO_DATA = "No NRTI images available for this time range."
NO_PIXELS = "No valid pixels in NRTI data for region"


def _mean(column: str) -> Column:
    """Mean whose sum is exact, so that it does not follow the order of rows.

    Values too large for the fixed point, which no product reaches, count as missing.
    """
    exact = F.col(column).try_cast("decimal(38,18)")
    return F.sum(exact).cast("double") / F.nullif(F.count(exact), F.lit(0))


def coarsen_pixels(pixels: DataFrame, degrees: float = PIXEL_DEGREES) -> DataFrame:
    """One value per product, image and coarse pixel; an image is told by its exact time.

    Runs before anything is joined: however many raw samples of an image fall on a pixel, map
    tasks ship one partial average.
    """
    return pixels.groupBy(
        "product",
        F.col("ts").alias("image_ts"),
        F.floor(F.col("lat") / degrees).alias("pixel_y"),
        F.floor(F.col("lon") / degrees).alias("pixel_x"),
    ).agg(_mean("value").alias("value"))


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def _span_start(at: Column, span: int) -> Column:
    return ((at - F.pmod(at, F.lit(span))) / span).cast("long")


def _placed(pixels: DataFrame, degrees: float) -> DataFrame:
    """Coarse pixels with their tile and the time of their image."""
    rounds = int(360 / TILE_DEGREES)
    return coarsen_pixels(pixels, degrees).withColumns(
        {
            "tile_y": F.floor((F.col("pixel_y") + 0.5) * degrees / TILE_DEGREES),
            "tile_x": F.pmod(F.floor((F.col("pixel_x") + 0.5) * degrees / TILE_DEGREES), F.lit(rounds)),
            "at": _micros("image_ts"),
        }
    )


def pixel_series(pixels: DataFrame, days: int = WINDOW_DAYS, degrees: float = PIXEL_DEGREES) -> DataFrame:
    """(product, pixel_y, pixel_x, tile_y, tile_x, span, images): each pixel's images in order of time.

    Time is cut into spans as long as a window, and a series holds two spans in a row, so that every
    window lies within one series and a series has the images of two windows at most.
    """
    own = _span_start(F.col("at"), 2 * days * DAY_MICROS)
    return (
        _placed(pixels, degrees).withColumn("span", F.explode(F.array(own - 1, own)))
        .groupBy("product", "pixel_y", "pixel_x", "tile_y", "tile_x", "span")
        .agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("images"))
    )


def _reach(incidents: DataFrame, radius_km: float, days: int, windows: int = 1) -> DataFrame:
    """One row per tile an incident's disc can touch, with the span of so many windows that its own starts in."""
    angle = radius_km / EARTH_RADIUS_KM
    dlat = math.degrees(angle) * (1 + 1e-9)
    narrow = F.cos(F.radians(F.least(F.abs(F.col("_lat")) + dlat, F.lit(90.0))))
    share = F.lit(math.sin(angle)) / F.greatest(narrow, F.lit(1e-12))
    dlon = F.when(share < 1.0, F.degrees(F.asin(F.least(share, F.lit(1.0)))) * (1 + 1e-9)).otherwise(180.0)
    rounds = int(360 / TILE_DEGREES)
    first_x = F.floor((F.col("_lon") - dlon) / TILE_DEGREES)
    last_x = F.least(F.floor((F.col("_lon") + dlon) / TILE_DEGREES), first_x + (rounds - 1))
    rows = F.sequence(F.floor((F.col("_lat") - dlat) / TILE_DEGREES), F.floor((F.col("_lat") + dlat) / TILE_DEGREES))
    length = days * DAY_MICROS
    return (
        incidents.withColumn("tile_y", F.explode(rows))
        .withColumn("tile_x", F.explode(F.sequence(first_x, last_x)))
        .withColumn("tile_x", F.pmod("tile_x", F.lit(rounds)))
        .withColumns({"_from": F.col("_at") - length, "_until": F.col("_at") + length})
        .withColumn("span", _span_start(F.col("_from"), 2 * length * windows))
    )


def windows_seen(reach: DataFrame, series: DataFrame) -> DataFrame:
    """``reach`` with the first and last image that each window sees in its tile.

    Two windows that see the same images of a tile are one from here on: however many incidents a
    site has, its windows are at most twice as many as its images.
    """
    tile = ["tile_y", "tile_x", "span"]
    times = (
        series.select(*tile, F.explode("images.at").alias("at")).groupBy(*tile)
        .agg(F.array_sort(F.collect_set("at")).alias("_times"))
    )
    seen = F.filter("_times", lambda t: (t >= F.col("_from")) & (t < F.col("_until")))
    return (
        reach.join(times, tile).withColumn("_seen", seen).filter(F.size("_seen") > 0)
        .withColumns({"first": F.get("_seen", F.lit(0)), "last": F.element_at("_seen", -1)})
        .drop("_times", "_seen", "_from", "_until")
    )


def window_medians(series: DataFrame, windows: DataFrame) -> DataFrame:
    """Each pixel's median over its images of each distinct window (tile_y, tile_x, span, first, last)."""
    inside = F.filter("images", lambda i: (i["at"] >= F.col("first")) & (i["at"] <= F.col("last")))
    values = F.array_sort(F.transform(F.filter("_in", lambda i: i["value"].isNotNull()), lambda i: i["value"]))
    size = F.size("_values")

    def middle(above: int) -> Column:
        return F.get("_values", F.floor((size - 1 + above) / 2).cast("int")) * 0.5

    return (
        series.join(windows.select("tile_y", "tile_x", "span", "first", "last").distinct(), ["tile_y", "tile_x", "span"])
        .withColumn("_in", inside).filter(F.size("_in") > 0)
        .withColumn("_values", values)
        .select(
            "tile_y", "tile_x", "span", "first", "last", "product", "pixel_y", "pixel_x",
            F.size("_in").cast("long").alias("images"), F.when(size > 0, middle(0) + middle(1)).alias("median"),
        )
    )


def _distinct(values: np.ndarray) -> np.ndarray:
    """Distinct numbers in order; ``np.unique`` hashes them, which takes many times as long as sorting."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


class _Bounds(BaseIndexer):
    """Windows given by their first and last position; without any they are empty."""

    def get_window_bounds(self, num_values=0, min_periods=None, center=None, closed=None, step=None):
        rest = np.full(num_values - len(self.first), num_values, dtype=np.int64)
        return np.concatenate([self.first, rest]), np.concatenate([self.last, rest])


def window_steps(series: np.ndarray, at: np.ndarray, value: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(series, start, images, median): what windows that start at ``start`` or later see, up to the next row.

    Images are sorted by series and time. A window of ``length`` sees an image from ``at - length + 1``
    on, up to ``at``, so a series has two steps an image at most, whatever windows are asked for.
    """
    steps = pd.DataFrame(
        {"series": np.tile(series, 2), "start": np.concatenate([at - length + 1, at + 1])}
    ).drop_duplicates().sort_values(["series", "start"])
    owner, start = steps["series"].to_numpy(), steps["start"].to_numpy()
    times = _distinct(at)
    placed = series * (len(times) + 1) + np.searchsorted(times, at)
    first, last = (
        np.searchsorted(placed, owner * (len(times) + 1) + np.searchsorted(times, start + more)) for more in (0, length)
    )
    padded = np.concatenate([value, np.full(max(len(start) - len(value), 0), np.nan)])
    median = pd.Series(padded).rolling(_Bounds(first=first, last=last), min_periods=1).median()
    return owner, start, last - first, median.to_numpy()[: len(start)]


def _limbs(values: np.ndarray) -> list[np.ndarray]:
    """Values as decimal(38,18) in four parts of 32 bits, the last one with the sign; NaN counts as zero.

    The parts are small enough for sums of them to be exact as doubles.
    """
    texts = pa.array(np.where(np.isnan(values), 0.0, values)).cast(pa.string())
    exact = pc.round(texts.cast(pa.decimal256(76, 48)), 18, "half_towards_infinity").cast(pa.decimal128(38, 18))
    words = np.frombuffer(exact.buffers()[1], dtype=np.int64, count=2 * len(values)).reshape(-1, 2)
    low, high = words[:, 0].view(np.uint64) if len(values) else words[:, 0], words[:, 1]
    mask = 0xFFFFFFFF
    return [part.astype(np.float64) for part in (low & mask, low >> 32, high & mask, high >> 32)]


def _from_limbs(parts: list[np.ndarray]) -> pa.Array:
    """Sums of ``_limbs`` as decimal(38,18)."""
    carry, digits = 0, []
    for part in parts:
        total = part.astype(np.int64) + carry
        digits.append(total & 0xFFFFFFFF)
        carry = total >> 32
    words = np.stack([digits[0] | (digits[1] << 32), digits[2] | (digits[3] << 32)], axis=1)
    return pa.Array.from_buffers(pa.decimal128(38, 18), len(words), [None, pa.py_buffer(words.tobytes())])


def _tile_sums(images: pa.Table, asked: pa.Table, keys: list[str], degrees: float, limit: float, length: int) -> pa.Table:
    """For each incident and product of a tile the images, medians and their sum over its pixels in the disc."""
    schema = pa.schema(
        [*[asked.schema.field(k) for k in keys], images.schema.field("product")]
        + [("images", pa.int64()), ("medians", pa.int64()), ("total", pa.decimal128(38, 18))]
    )
    if not images.num_rows or not asked.num_rows:
        return schema.empty_table()
    named = images["product"].combine_chunks().dictionary_encode(null_encoding="encode")
    places = pd.MultiIndex.from_arrays([images["pixel_y"].to_numpy(), images["pixel_x"].to_numpy()])
    pixel, spots = pd.factorize(places)
    series = named.indices.to_numpy().astype(np.int64) * len(spots) + pixel
    at = images["at"].to_numpy()
    order = np.lexsort([at, series])
    owner, start, seen, median = window_steps(
        series[order], at[order], images["value"].to_numpy()[order].astype(np.float64), length
    )
    known = ~np.isnan(median)
    starts = _distinct(start)
    steps = owner * (len(starts) + 1) + np.searchsorted(starts, start) + 1
    weights = [seen, known, *_limbs(median)]
    weights = [w if w.any() else None for w in weights]

    asked = asked.take(pc.sort_indices(asked["_from"]))
    begin = np.searchsorted(starts, asked["_from"].to_numpy(), "right")
    lat, lon = (np.radians(asked[c].to_numpy()) for c in ("_lat", "_lon"))
    y, x = (np.radians((spots.get_level_values(i).to_numpy() + 0.5) * degrees) for i in (0, 1))
    rows = []
    some = max(PAIRS_AT_ONCE // len(spots), 1)
    for top in range(0, asked.num_rows, some):
        part = slice(top, top + some)
        apart = np.sin((y[:, None] - lat[part]) / 2.0) ** 2 + np.cos(lat[part]) * np.cos(y)[:, None] * (
            np.sin((x[:, None] - lon[part]) / 2.0) ** 2
        )
        spot, incident = np.nonzero(apart <= limit)
        for number in range(len(named.dictionary)):
            own = number * len(spots) + spot
            step = np.searchsorted(steps, own * (len(starts) + 1) + begin[part][incident], "right") - 1
            there = (step >= 0) & (owner[step] == own)
            there &= seen[step] > 0
            of, step = incident[there], step[there]
            many = len(lat[part])
            sums = [np.zeros(many) if w is None else np.bincount(of, w[step], many) for w in weights]
            hit = np.nonzero(sums[0])[0]
            if len(hit):
                columns = [asked[k].take(pa.array(hit + top)) for k in keys]
                columns.append(named.dictionary.take(pa.array(np.full(len(hit), number))))
                columns += [pa.array(s[hit].astype(np.int64)) for s in sums[:2]]
                columns.append(_from_limbs([s[hit] for s in sums[2:]]))
                rows.append(pa.table(columns, schema=schema))
    return pa.concat_tables(rows) if rows else schema.empty_table()


def composite_mean(
    incidents: DataFrame,
    pixels: DataFrame,
    keys: list[str],
    lat: str = "centroid_latitude",
    lon: str = "centroid_longitude",
    ts: str = "last_detected",
    radius_km: float = RADIUS_KM,
    days: int = WINDOW_DAYS,
    degrees: float = PIXEL_DEGREES,
) -> DataFrame:
    """(keys, product, images, composite): mean over the disc of each pixel's median in time.

    Pixels count by their centre; the window is [ts - days, ts + days). Images meet the incidents by
    tile and span of time. There the median of a pixel is a step function of the window's start, with
    two steps an image at most (``window_steps``); an incident looks up one step per pixel of its disc.
    So the work follows the images and the incidents, not the windows that all of them make together.
    """
    limit = math.sin(radius_km / EARTH_RADIUS_KM / 2.0) ** 2
    length = 2 * days * DAY_MICROS
    tile = ["tile_y", "tile_x", "span"]
    at, span = F.col("at"), length * SPAN_WINDOWS
    spans = F.array_distinct(F.array(_span_start(at - (length - 1), span), _span_start(at, span)))
    images = _placed(pixels, degrees).filter("at IS NOT NULL AND tile_y IS NOT NULL AND tile_x IS NOT NULL").select(
        "tile_y", "tile_x", F.explode(spans).alias("span"), "product", "pixel_y", "pixel_x", "at", "value"
    )
    asked = incidents.select(*keys, F.col(lat).alias("_lat"), F.col(lon).alias("_lon"), _micros(ts).alias("_at"))
    reach = _reach(asked.filter("_at IS NOT NULL"), radius_km, days, SPAN_WINDOWS).select(*tile, *keys, "_lat", "_lon", "_from")
    schema = StructType(reach.select(*keys).schema.fields + images.select("product").schema.fields)
    schema = schema.add("images", "long").add("medians", "long").add("total", "decimal(38,18)")

    def sums(images: pa.Table, asked: pa.Table) -> pa.Table:
        return _tile_sums(images, asked, keys, degrees, limit, length)

    near = images.groupBy(*tile).cogroup(reach.groupBy(*tile)).applyInArrow(sums, schema)
    return cut_lineage(
        near.groupBy(*keys, "product").agg(
            F.sum("images").alias("images"),
            (F.sum("total").cast("double") / F.nullif(F.sum("medians"), F.lit(0))).alias("composite"),
        )
    )


def product_rows(incidents: DataFrame, keys: list[str]) -> DataFrame:
    """Every incident with every product, so that absent products show up too."""
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("product_no"), F.lit(name).alias("product"), F.lit(unit).alias("unit"),
                F.lit(scale).alias("scale"), F.lit(moderate).alias("moderate_above"),
                F.lit(severe).alias("severe_above"), F.lit(text).alias("description"),
                F.lit(collection).alias("collection"),
            )
            for i, (name, unit, scale, moderate, severe, text, collection) in enumerate(PRODUCTS)
        ]
    )
    return incidents.select(*keys, F.explode(rows).alias("p")).select(*keys, "p.*")


def indicator(value: Column, moderate: Column, severe: Column) -> Column:
    return F.when(value > severe, "severe").when(value > moderate, "moderate")


def measurements(incidents: DataFrame, composites: DataFrame, keys: list[str]) -> DataFrame:
    """Status, scaled value and indicator of every (incident, product)."""
    joined = product_rows(incidents, keys).join(composites, [*keys, "product"], "left")
    value = F.col("composite") * F.col("scale")
    status = (
        F.when(F.col("images").isNull(), "no_data")
        .when(F.col("composite").isNull(), "no_valid_pixels")
        .otherwise("success")
    )
    return joined.withColumns({"status": status, "scaled": value}).withColumn(
        "severity", indicator(F.col("scaled"), F.col("moderate_above"), F.col("severe_above"))
    )


def air_quality_class(severe: Column, moderate: Column) -> Column:
    return (
        F.when((severe >= 2) | ((severe == 1) & (moderate >= 1)), "severe")
        .when((severe >= 1) | (moderate >= 2), "high")
        .when(moderate == 1, "moderate")
        .otherwise("low")
    )


def air_quality(incidents: DataFrame, pixels: DataFrame, keys: list[str], **options) -> DataFrame:
    """(keys, severe_count, moderate_count, air_quality): the nested record per incident."""
    rows = measurements(incidents, composite_mean(incidents, pixels, keys, **options), keys)
    ok = F.col("status") == "success"
    measurement = F.struct(
        F.col("status"),
        F.when(ok, round_half_even(F.col("scaled"), 2)).alias("value"),
        F.when(ok, F.col("unit")).alias("unit"),
        F.when(ok, F.col("collection")).alias("source"),
        F.when(F.col("status") == "no_data", NO_DATA)
        .when(F.col("status") == "no_valid_pixels", NO_PIXELS)
        .alias("error"),
    )
    wording = F.when(F.col("severity") == "severe", "severely").otherwise("moderately")
    finding = F.struct(
        F.col("product"),
        F.col("severity"),
        F.col("scaled").alias("value"),
        F.concat_ws(" ", F.col("description"), wording, F.lit("elevated")).alias("message"),
    )
    # At most one row per product and incident, so these arrays have three entries.
    grouped = rows.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("product_no", "product", measurement.alias("m")))).alias("_m"),
        F.array_sort(
            F.collect_list(F.when(F.col("severity").isNotNull(), F.struct("product_no", finding.alias("f"))))
        ).alias("_f"),
        F.count_if(F.col("severity") == "severe").alias("severe_count"),
        F.count_if(F.col("severity") == "moderate").alias("moderate_count"),
    )
    record = F.struct(
        F.map_from_entries(F.transform("_m", lambda e: F.struct(e["product"], e["m"]))).alias("measurements"),
        F.transform("_f", lambda e: e["f"]).alias("fire_indicators"),
        air_quality_class(F.col("severe_count"), F.col("moderate_count")).alias("air_quality_severity"),
        F.lit(None).cast("string").alias("error"),
    )
    return grouped.select(*keys, "severe_count", "moderate_count", record.alias("air_quality"))
