"""Points within buffered polygons, without a geometry library.

The polygon layer is turned once into a table keyed by grid cell. A cell no edge comes near is
settled by one flag; a cell near an edge carries just its own edges and whether its anchor (a point near its centre) is
inside. A point then needs a single equi-join on its cell and looks at the edges of that cell
only, so the work per point does not grow with the polygon or the layer. The table depends on
the polygons alone, never on the points. Its size is measured: up to a limit it is broadcast and
the points are not shuffled at all; beyond it both sides shuffle on the cell, where adaptive
execution splits hot cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberfold.functions.geo import mercator_x, mercator_y
from emberfold.session import cut_lineage

FEATURE = "_feature"
BUFFER_UNITS = 1000.0
CELL_UNITS = 5000.0
EDGES_PER_ROW = 512
# The cell table is broadcast up to about this size, estimated from its rows and edges.
BROADCAST_BYTES = 128 * 1024 * 1024
_ROW_BYTES, _EDGE_BYTES = 64, 40
# Anchor of a cell, as a share of its side. Uneven shares keep anchors off the vertices and
# edges of layers digitised on a regular raster.
ANCHOR_X, ANCHOR_Y = 0.5123456789, 0.4871592653
# Slack, in map units, that keeps rounding from losing a cell at its border.
_SLACK = 1e-3


def polygon_edges(polygons: DataFrame, key: str = "poly_id") -> DataFrame:
    """(key, x1, y1, x2, y2) in Web Mercator; holes and further parts are just more rings."""
    rings = polygons.select(key, F.explode("rings").alias("ring")).filter(F.size("ring") >= 3)
    n = F.size("ring")

    def edge(i: Column) -> Column:
        return F.struct(F.get("ring", i).alias("a"), F.get("ring", F.pmod(i + 1, n)).alias("b"))

    edges = rings.select(key, F.explode(F.transform(F.sequence(F.lit(0), n - 1), edge)).alias("e"))
    return edges.select(
        key,
        mercator_x(F.col("e.a.lon")).alias("x1"),
        mercator_y(F.col("e.a.lat")).alias("y1"),
        mercator_x(F.col("e.b.lon")).alias("x2"),
        mercator_y(F.col("e.b.lat")).alias("y2"),
    ).filter("x1 <> x2 OR y1 <> y2")


def _edges_by_cell(edges: DataFrame, key: str, buffer: float, cell: float) -> DataFrame:
    """Every cell an edge comes within ``buffer`` of, found row by row of the grid.

    The edge is clipped to each grid row first, so a long diagonal edge yields cells along its
    length, not over its bounding box.
    """
    grow = buffer + _SLACK
    rows = edges.withColumn(
        "cy",
        F.explode(
            F.sequence(
                F.floor((F.least("y1", "y2") - grow) / cell),
                F.floor((F.greatest("y1", "y2") + grow) / cell),
            )
        ),
    )
    low = F.greatest(F.least("y1", "y2"), F.col("cy") * cell - grow)
    high = F.least(F.greatest("y1", "y2"), (F.col("cy") + 1) * cell + grow)

    def x_at(y: Column) -> Column:
        return F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / F.nullif(
            F.col("y2") - F.col("y1"), F.lit(0.0)
        )

    flat = F.col("y1") == F.col("y2")
    left = F.when(flat, F.least("x1", "x2")).otherwise(F.least(x_at(low), x_at(high)))
    right = F.when(flat, F.greatest("x1", "x2")).otherwise(F.greatest(x_at(low), x_at(high)))
    columns = F.sequence(F.floor((left - grow) / cell), F.floor((right + grow) / cell))
    return rows.select(key, "cy", F.explode(columns).alias("cx"), "x1", "y1", "x2", "y2")


def _inside_anchors(edges: DataFrame, key: str, cell: float) -> DataFrame:
    """Cells whose anchor lies inside the polygon: even-odd runs along the anchor lines."""
    span = F.sequence(
        F.floor(F.least("y1", "y2") / cell - ANCHOR_Y), F.floor(F.greatest("y1", "y2") / cell - ANCHOR_Y) + 1
    )
    y = (F.col("cy") + ANCHOR_Y) * cell
    crossing = (
        edges.withColumn("cy", F.explode(span))
        .filter((F.col("y1") > y) != (F.col("y2") > y))
        .select(
            key,
            "cy",
            (
                (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1"))
                + F.col("x1")
            ).alias("x"),
        )
    )
    # Crossings of a line pair up in order: in at the odd ones, out at the next.
    along = Window.partitionBy(key, "cy").orderBy("x")
    runs = (
        crossing.withColumn("turn", F.row_number().over(along)).withColumn("until", F.lead("x").over(along))
        .filter("turn % 2 = 1 AND until IS NOT NULL")
        .select(
            key, "cy",
            F.ceil(F.col("x") / cell - ANCHOR_X).alias("lo"), (F.ceil(F.col("until") / cell - ANCHOR_X) - 1).alias("hi"),
        )
    )
    return (
        runs.filter("lo <= hi")
        .select(key, "cy", F.explode(F.sequence("lo", "hi")).alias("cx"))
        .withColumn("anchor_inside", F.lit(True))
    )


def polygon_index(
    polygons: DataFrame,
    key: str = "poly_id",
    buffer: float = BUFFER_UNITS,
    cell: float = CELL_UNITS,
    edges_per_row: int = EDGES_PER_ROW,
) -> DataFrame:
    """Cell table of a polygon layer: (key, cx, cy, anchor_inside, edges, pieces).

    Cells with very many edges are split over ``pieces`` rows, so that no array outgrows
    roughly ``edges_per_row`` entries.
    """
    edges = polygon_edges(polygons, key)
    near = _edges_by_cell(edges, key, buffer, cell)
    cell_key = [key, "cx", "cy"]
    pieces = near.groupBy(*cell_key).agg(
        F.ceil(F.count("*") / edges_per_row).cast("int").alias("pieces")
    )
    edge = F.struct("x1", "y1", "x2", "y2")
    packed = (
        near.join(pieces, cell_key)
        .withColumn("piece", F.pmod(F.xxhash64("x1", "y1", "x2", "y2"), F.col("pieces")))
        .groupBy(*cell_key, "pieces", "piece")
        .agg(F.collect_list(edge).alias("edges"))
    )
    empty = F.lit([]).cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")
    return packed.join(_inside_anchors(edges, key, cell), cell_key, "full_outer").select(
        *cell_key,
        F.coalesce("anchor_inside", F.lit(False)).alias("anchor_inside"),
        F.coalesce("edges", empty).alias("edges"),
        F.coalesce("pieces", F.lit(1)).alias("pieces"),
    )


def stored_index(
    polygons: DataFrame, buffer: float = BUFFER_UNITS, cell: float = CELL_UNITS, edges_per_row: int = EDGES_PER_ROW
) -> tuple[DataFrame, DataFrame]:
    """(layer with numbered features, its cell table), both written down: for any number of joins.

    The layer alone decides both, so one pair serves every call with the same buffer and cell.
    """
    layer = cut_lineage(polygons.withColumn(FEATURE, F.monotonically_increasing_id()))
    return layer, cut_lineage(polygon_index(layer, FEATURE, buffer, cell, edges_per_row))


def _flips(edges: Column, x: Column, y: Column, xc: Column, yc: Column) -> Column:
    """Parity of edges crossed on the way anchor -> (xc, y) -> (x, y), all within one cell.

    Both legs judge the turning point by the same cross product. A point exactly on an edge's
    line counts as lying a touch higher (and, for upright edges, further right), which is what
    the strict comparisons of end points mean as well.
    """

    def side(e: Column, px: Column, py: Column) -> Column:
        dx, dy = e.x2 - e.x1, e.y2 - e.y1
        cross = dx * (py - e.y1) - dy * (px - e.x1)
        return (cross > 0) | ((cross == 0) & ((dx > 0) | ((dx == 0) & (dy < 0))))

    def crossed(e: Column) -> Column:
        up = ((e.x1 > xc) != (e.x2 > xc)) & (side(e, xc, yc) != side(e, xc, y))
        across = ((e.y1 > y) != (e.y2 > y)) & (side(e, xc, y) != side(e, x, y))
        return up != across

    return F.aggregate(edges, F.lit(False), lambda odd, e: odd != crossed(e))


def _close(edges: Column, x: Column, y: Column, buffer: float) -> Column:
    """Some edge of the cell lies less than ``buffer`` away."""

    def near(e: Column) -> Column:
        dx, dy = e.x2 - e.x1, e.y2 - e.y1
        along = ((x - e.x1) * dx + (y - e.y1) * dy) / (dx * dx + dy * dy)
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
        ex, ey = x - (e.x1 + t * dx), y - (e.y1 + t * dy)
        return ex * ex + ey * ey < F.lit(buffer * buffer)

    return F.exists(edges, near)


def points_near_polygons(
    points: DataFrame,
    polygons: DataFrame,
    lat: str = "latitude",
    lon: str = "longitude",
    buffer: float = BUFFER_UNITS,
    cell: float = CELL_UNITS,
    edges_per_row: int = EDGES_PER_ROW,
    semi: bool = False,
    index: DataFrame | None = None,
) -> DataFrame:
    """Points inside a polygon or less than ``buffer`` Mercator units from its edge.

    Every row of the layer is a feature of its own, also where several share a ``key``. A point
    inside the buffers of two features yields two rows, each with that feature's attributes;
    ``semi=True`` keeps each point once and adds no attributes. ``index`` takes a table that
    ``stored_index`` made of the layer, whose numbers of features it holds.
    """
    if index is None:
        polygons, index = stored_index(polygons, buffer, cell, edges_per_row)
    key = FEATURE
    size = index.agg(
        F.count("*").alias("rows"), F.sum(F.size("edges")).alias("edges"), F.max("pieces").alias("pieces")
    ).first()
    split_cells = (size["pieces"] or 1) > 1
    fits = size["rows"] * _ROW_BYTES + (size["edges"] or 0) * _EDGE_BYTES <= BROADCAST_BYTES

    columns = points.columns
    x, y = F.col("_x"), F.col("_y")
    xc, yc = (F.col("_cx") + ANCHOR_X) * cell, (F.col("_cy") + ANCHOR_Y) * cell
    located = (
        points.withColumns({"_x": mercator_x(F.col(lon)), "_y": mercator_y(F.col(lat))})
        .withColumns({"_cx": F.floor(x / cell), "_cy": F.floor(y / cell)})
    )
    on_cell = (F.col("_cx") == F.col("cx")) & (F.col("_cy") == F.col("cy"))
    flips, close = _flips(F.col("edges"), x, y, xc, yc), _close(F.col("edges"), x, y, buffer)
    settled = index.filter("pieces = 1").select(
        F.col(key).alias("_poly"), "cx", "cy", "anchor_inside", "edges"
    )
    settled = F.broadcast(settled) if fits else settled
    hit = on_cell & ((F.col("anchor_inside") != flips) | close)
    if semi and not split_cells:
        return located.join(settled, hit, "left_semi").select(*columns)
    matches = located.join(settled, hit, "inner").select(*columns, "_poly")
    if split_cells:
        split = index.filter("pieces > 1")
        matches = matches.unionByName(
            _match_split_cells(located, split, key, columns, flips, close, on_cell)
        )
    if semi:
        return points.join(matches.select(lat, lon).distinct(), [lat, lon], "left_semi")
    attributes = polygons.select(
        F.col(key).alias("_poly"), *[c for c in polygons.columns if c not in ("rings", FEATURE)]
    )
    return matches.join(attributes, "_poly").drop("_poly")


def _match_split_cells(
    located: DataFrame, index: DataFrame, key: str, columns: list[str],
    flips: Column, close: Column, on_cell: Column,
) -> DataFrame:
    """Cells whose edges span several rows: combine the rows' answers per distinct place."""
    pieces = index.select(F.col(key).alias("_poly"), "cx", "cy", "anchor_inside", "edges")
    place = ["_x", "_y", "_cx", "_cy"]
    verdict = (
        located.select(*place)
        .distinct()
        .join(pieces, on_cell)
        .select(*place, "_poly", "anchor_inside", flips.alias("flip"), close.alias("near"))
        .groupBy(*place, "_poly")
        .agg(
            (F.max("anchor_inside") != (F.sum(F.col("flip").cast("int")) % 2 == 1)).alias("inside"),
            F.max("near").alias("near"),
        )
        .filter("inside OR near")
        .select(*place, "_poly")
    )
    return located.join(verdict, place).select(*columns, "_poly")
