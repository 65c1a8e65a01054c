"""Search regions and least-cloudy scene selection."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfold.functions.geo import visual_stretch
from emberfold.functions.times import iso_utc
from emberfold.operators.components import rank_within
from emberfold.operators.standardize import union_feeds
from emberfold.session import cut_lineage

PADDING_DEGREES = 0.05
LOOKBACK_DAYS = 13
# Half the footprint of the smallest scenes, so that each covers a finest cell; cells double in size by level.
TILE_DEGREES = 0.5
LEVELS = 4

# Display range of each source, with a gamma of 1.4.
STRETCH_RANGE = {"sentinel2": (0.0, 3500.0), "landsat": (8000.0, 30000.0)}
# Surface-reflectance band names and the common names.
BAND_NAMES = {"SR_B4": "B4", "SR_B3": "B3", "SR_B2": "B2"}
# Cloud field of each source.
CLOUD_FIELD = {"sentinel2": "CLOUDY_PIXEL_PERCENTAGE", "landsat": "CLOUD_COVER"}


def pad_box(df: DataFrame, padding: float = PADDING_DEGREES) -> DataFrame:
    return df.select(
        *[c for c in df.columns if c not in ("min_lon", "min_lat", "max_lon", "max_lat")],
        (F.col("min_lon") - padding).alias("min_lon"),
        (F.col("min_lat") - padding).alias("min_lat"),
        (F.col("max_lon") + padding).alias("max_lon"),
        (F.col("max_lat") + padding).alias("max_lat"),
    )


def incident_regions(documents: DataFrame, padding: float = PADDING_DEGREES) -> DataFrame:
    """Padded box per incident document: its own, else that of its nested hotspots.

    Incidents without an id, or with neither, are left out.
    """

    def coordinate(index: int, name: str) -> Column:
        return F.transform(
            "hotspots", lambda h: F.coalesce(F.get(h["geometry"]["coordinates"], F.lit(index)), h[name])
        )

    lon, lat = coordinate(0, "longitude"), coordinate(1, "latitude")
    boxes = documents.filter(F.col("cluster_id").isNotNull()).select(
        F.col("cluster_id").alias("region_id"),
        F.coalesce("min_lon", F.array_min(lon)).alias("min_lon"),
        F.coalesce("min_lat", F.array_min(lat)).alias("min_lat"),
        F.coalesce("max_lon", F.array_max(lon)).alias("max_lon"),
        F.coalesce("max_lat", F.array_max(lat)).alias("max_lat"),
    )
    return pad_box(boxes.filter("min_lon IS NOT NULL AND min_lat IS NOT NULL"), padding)


def harmonise_bands(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(BAND_NAMES.get(c, c)) for c in df.columns])


def scene_catalogue(sentinel2: DataFrame, *landsat: DataFrame) -> DataFrame:
    """One catalogue from per-source listings, each with its own cloud field."""
    def listing(df: DataFrame, source: str) -> DataFrame:
        return df.select(
            "scene_id", F.lit(source).alias("data_source"), "time_start_ms",
            F.col(CLOUD_FIELD[source]).alias("cloud_cover"),
            "min_lon", "min_lat", "max_lon", "max_lat",
        )

    return union_feeds(listing(sentinel2, "sentinel2"), *[listing(df, "landsat") for df in landsat])


def scenes_in_window(scenes: DataFrame, run_date: str, lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """Scenes of [run_date - lookback, run_date + 1 day): a plain range, pushed to the scan."""
    day = date.fromisoformat(run_date)
    low, high = [
        int((d - date(1970, 1, 1)).total_seconds() * 1000)
        for d in (day - timedelta(days=lookback), day + timedelta(days=1))
    ]
    return scenes.filter((F.col("time_start_ms") >= low) & (F.col("time_start_ms") < high))


def _cells(low: Column, high: Column, degrees: float) -> tuple[Column, Column]:
    """First and last cell that the closed range touches."""
    return F.floor(low / degrees), F.floor(high / degrees)


def _touched(df: DataFrame, degrees: float) -> DataFrame:
    """``df`` once for every finest cell that its box touches."""
    for name, low, high in (("_cy", "min_lat", "max_lat"), ("_cx", "min_lon", "max_lon")):
        df = df.withColumn(name, F.explode(F.sequence(*_cells(F.col(low), F.col(high), degrees))))
    return df


def _covers(size: Column, cx: Column, cy: Column) -> Column:
    """Whether the row's box covers a cell of the given size."""
    return (
        (F.col("min_lon") <= cx * size) & (F.col("max_lon") >= (cx + 1) * size)
        & (F.col("min_lat") <= cy * size) & (F.col("max_lat") >= (cy + 1) * size)
    )


def _covered(df: DataFrame, degrees: float) -> DataFrame:
    """``df`` once for every cell of every level that its box covers without covering the next level's."""
    df = df.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))))
    df = df.withColumn("_size", F.lit(degrees) * F.expr("shiftleft(1, _level)"))
    for name, low, high in (("_cy", "min_lat", "max_lat"), ("_cx", "min_lon", "max_lon")):
        first, last = F.ceil(F.col(low) / F.col("_size")), F.floor(F.col(high) / F.col("_size")) - 1
        df = df.withColumn(name, F.explode(F.when(first <= last, F.sequence(first, last))))
    size, cx, cy = F.col("_size"), F.col("_cx"), F.col("_cy")
    below = (F.col("_level") < LEVELS - 1) & _covers(2 * size, F.floor(cx / 2), F.floor(cy / 2))
    return df.filter(_covers(size, cx, cy) & ~below).drop("_size")


def _best_of_each_day(entries: DataFrame) -> DataFrame:
    """(cell, source, _block, _day, _place): the best scene of each day among those that cover the cell."""
    return entries.groupBy("_level", "_cy", "_cx", "data_source", "_block", "_day").agg(F.min("_place").alias("_place"))


def _best_of_days(daily: DataFrame) -> DataFrame:
    """(cell, source, _block, _days): the best scene of each day of a block of days, one entry per day."""
    cell = ["_level", "_cy", "_cx", "data_source", "_block"]
    return daily.groupBy(*cell).agg(F.collect_list(F.struct("_day", "_place")).alias("_days"))


def _unbeaten_edges(dated: DataFrame, daily: DataFrame, degrees: float) -> DataFrame:
    """Entries of scenes in the finest cells that hold their edge, if no better scene covers the cell that day.

    Whatever window takes in the scene takes in its day, so with a better one there it cannot win for
    any region of the cell. About as many are left as there are cells, days and sources, however many scenes
    there are. The best scenes are written first: their table, often small, then goes to the entries.
    """
    within = F.sequence(F.lit(0).cast("long"), F.expr("shiftleft(1L, _level) - 1"))
    covering = daily.select("*", F.explode(within).alias("_dy")).select("*", F.explode(within).alias("_dx")).groupBy(
        *[(F.expr(f"shiftleft({c}, _level)") + F.col(d)).alias(c) for c, d in (("_cy", "_dy"), ("_cx", "_dx"))],
        "data_source", "_day",
    ).agg(F.min("_place").alias("_covering"))
    edges = _touched(dated, degrees).filter(~_covers(F.lit(degrees), F.col("_cx"), F.col("_cy")))
    return edges.join(cut_lineage(covering), ["_cy", "_cx", "data_source", "_day"], "left").filter(
        F.col("_covering").isNull() | (F.col("_place") < F.col("_covering"))
    ).drop("_covering")


def best_scene(
    regions: DataFrame,
    scenes: DataFrame,
    date_column: str = "run_date",
    lookback: int = LOOKBACK_DAYS,
    degrees: float = TILE_DEGREES,
) -> DataFrame:
    """Least cloudy scene per (region, run date, source) among those that overlap the region.

    A scene is entered in the largest grid cells that it covers, of ``LEVELS`` sizes, and in the
    finest cells that hold its edge. A scene that covers a cell overlaps whatever lies in it, so per
    cell and source only the best of each day is kept (scenes are numbered in their order first), in blocks as long as the window: a window slides
    over the end of one block and the start of the next, so a region looks up its cells and those
    above them twice, whatever the number of days. Scenes with an edge in a cell are compared with each
    region of the cell, but only those before the best covering scene can still win; most fall out before,
    as a better one covers the cell on their own day.
    """
    days = lookback + 1
    box = ["min_lon", "min_lat", "max_lon", "max_lat"]
    order = [F.col("cloud_cover").isNull(), F.col("cloud_cover"), -F.col("time_start_ms"), F.col("scene_id")]
    placed = cut_lineage(rank_within(
        scenes.select("data_source", "scene_id", "time_start_ms", "cloud_cover", *box), ["data_source"], order, "_place"
    ))
    day = F.floor(F.col("time_start_ms") / 86_400_000)
    dated = placed.select("data_source", *box, "_place", F.floor(day / days).alias("_block"), day.alias("_day"))
    daily = cut_lineage(_best_of_each_day(_covered(dated, degrees)))
    full = _best_of_days(daily)
    edges = _unbeaten_edges(dated, daily, degrees).select(
        "_cy", "_cx", "_block", "_day", "data_source", "_place", *[F.col(c).alias("s_" + c) for c in box]
    )

    key = ["region_id", date_column]
    end = F.datediff(F.col(date_column), F.lit("1970-01-01").cast("date")).cast("long")
    blocks = F.array_distinct(F.array(F.floor((F.col("_end") - lookback) / days), F.floor(F.col("_end") / days)))
    cells = cut_lineage(
        _touched(regions.select(*key, *box), degrees).withColumn("_end", end)
        .withColumn("_block", F.explode(blocks))
    )
    above = cells.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1)))).select(
        *key, "_end", "_block", "_level", *[F.expr(f"shiftright({c}, _level)").alias(c) for c in ("_cy", "_cx")]
    )
    inside = F.filter("_days", lambda x: (x["_day"] <= F.col("_end")) & (x["_day"] >= F.col("_end") - lookback))
    best_full = cut_lineage(
        above.distinct().join(full, ["_level", "_cy", "_cx", "_block"])
        .select(*key, "data_source", F.array_min(F.transform(inside, lambda x: x["_place"])).alias("_place"))
        .filter("_place IS NOT NULL")
        .groupBy(*key, "data_source").agg(F.min("_place").alias("_place"))
    )
    # One entry per source.
    limits = best_full.groupBy(*key).agg(
        F.map_from_entries(F.collect_list(F.struct("data_source", "_place"))).alias("_limits")
    )
    overlaps = (
        (F.col("s_min_lon") <= F.col("max_lon")) & (F.col("s_max_lon") >= F.col("min_lon"))
        & (F.col("s_min_lat") <= F.col("max_lat")) & (F.col("s_max_lat") >= F.col("min_lat"))
    )
    beaten = F.col("_place") > F.try_element_at("_limits", F.col("data_source"))
    contenders = (
        cells.join(limits, key, "left").join(edges, ["_cy", "_cx", "_block"])
        .filter((F.col("_day") <= F.col("_end")) & (F.col("_day") >= F.col("_end") - lookback))
        .filter(overlaps & ~F.coalesce(beaten, F.lit(False)))
        .select(*key, "data_source", "_place")
    )
    best = best_full.unionByName(contenders).groupBy(*key, "data_source").agg(F.min("_place").alias("_place"))
    return best.join(placed.drop(*box), ["data_source", "_place"]).select(
        *key, "data_source", F.col("scene_id").alias("original_id"),
        iso_utc(F.timestamp_millis("time_start_ms")).alias("acquisition_date_utc"), "cloud_cover",
    )


def stretch_bands(pixels: DataFrame, source: str, bands: tuple[str, ...] = ("B4", "B3", "B2")) -> DataFrame:
    low, high = STRETCH_RANGE[source]
    return pixels.withColumns({b: visual_stretch(F.col(b), low, high) for b in bands})
