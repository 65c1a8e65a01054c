"""Exact density clustering (DBSCAN, haversine) whose work stays linear in the points.

Points are laid on a grid whose cells are small enough that any two points of one cell are
neighbours. That gives three facts the job is built on:

* a cell of at least ``min_samples`` points consists of core points of one cluster, so its
  inside is never paired up, however many points it holds;
* any other ("sparse") cell holds fewer than ``min_samples`` places, so comparing its points
  with the cells around them costs a bounded number of pairs per point;
* clusters are the connected components of a graph of cells, with a bounded number of edges
  per cell. Whether two cells touch is decided from bounding boxes, split further only where
  the boxes leave it open.

Neighbours are looked up within tiles of TILE x TILE cells, to which places are shuffled together with
a margin of what lies within epsilon of the tile: once to count the neighbours of sparse places, once to link
core cells. A tile links its own cells; only links that leave it, one per cell of the margin, are joined.
Of a cell with many places ("big") a tile gets the box alone, so what it holds is bounded; what the
boxes leave open is then settled by joins on the places.

Repeated places collapse to one weighted place before anything is shuffled by cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StructType

from emberfold.functions.geo import EARTH_RADIUS_KM, hav, hav_distance
from emberfold.operators.components import connected_components, rank_within
from emberfold.session import cut_lineage

# Two boxes with at most this many point pairs between them are compared point by point.
PAIRS_PER_BOX_PAIR = 1024
# Each refinement step cuts a box into SPLIT x SPLIT smaller ones.
SPLIT = 4
# Boxes of the last level are finer than double-precision degrees, so no pair stays open.
MAX_LEVEL = 20
# Cells along each side of a tile, and pairs compared at once in a task.
TILE = 64
PAIRS_AT_ONCE = 1 << 19


class Grid:
    """Square cells in degrees with a diagonal of at most epsilon anywhere on the sphere."""

    def __init__(self, eps_km: float):
        eps = eps_km / EARTH_RADIUS_KM
        self.limit = math.sin(eps / 2.0) ** 2
        widest = math.degrees(2.0 * math.sin(eps / 2.0) / math.sqrt(2.0)) * (1.0 - 1e-9)
        # An odd number of columns lets a row be covered evenly to both sides.
        self.columns = math.ceil(360.0 / widest) | 1
        self.step = 360.0 / self.columns

    def row(self, lat: Column) -> Column:
        return F.floor((lat + 90.0) / self.step)

    def column(self, lon: Column) -> Column:
        return F.pmod(F.floor(F.pmod(lon + 180.0, F.lit(360.0)) / self.step), F.lit(self.columns))

    def cell(self, row: Column, column: Column) -> Column:
        return row * F.lit(self.columns) + column

    def reach(self, row: Column) -> Column:
        """Columns to either side that can hold neighbours; more of them towards the poles."""
        top = F.greatest(F.abs((row + 3) * self.step - 90.0), F.abs((row - 2) * self.step - 90.0))
        narrow = F.cos(F.radians(F.least(top, F.lit(90.0))))
        root = math.sqrt(self.limit)
        span = F.degrees(2.0 * F.asin(F.least(F.lit(root) / F.greatest(narrow, F.lit(root)), F.lit(1.0))))
        most = (self.columns - 1) // 2
        return F.least(F.floor(span / self.step) + 1, F.lit(most)).cast("int")

    def in_tiles(self, df: DataFrame) -> DataFrame:
        """One row per tile (``_ty``, ``_tx``) that holds or may hold neighbours of the row's cell."""
        low, high, last = F.col("_col") - F.col("_reach"), F.col("_col") + F.col("_reach"), F.lit(self.columns - 1)

        def tiles(first: Column, to: Column) -> Column:
            return F.sequence(F.floor(first / TILE), F.floor(to / TILE))

        none = F.array().cast("array<bigint>")
        across = F.array_distinct(
            F.concat(
                tiles(F.greatest(low, F.lit(0)), F.least(high, last)),
                F.when(low < 0, tiles(low + self.columns, last)).otherwise(none),
                F.when(high > last, tiles(F.lit(0), high - self.columns)).otherwise(none),
            )
        )
        return (
            df.withColumn("_ty", F.explode(tiles(F.greatest(F.col("_row") - 2, F.lit(0)), F.col("_row") + 2)))
            .withColumn("_tx", F.explode(across))
            .withColumn("_own", (F.col("_ty") == F.floor(F.col("_row") / TILE)) & (F.col("_tx") == F.floor(F.col("_col") / TILE)))
        )


def _box_bounds(a: dict[str, Column], b: dict[str, Column]) -> tuple[Column, Column]:
    """Least and greatest haversine between points of two latitude/longitude boxes."""
    lat_gap = F.greatest(b["lat0"] - a["lat1"], a["lat0"] - b["lat1"], F.lit(0.0))
    lat_span = F.greatest(b["lat1"] - a["lat0"], a["lat1"] - b["lat0"])
    gap = F.greatest(b["lon0"] - a["lon1"], a["lon0"] - b["lon1"], F.lit(0.0))
    span = F.greatest(b["lon1"] - a["lon0"], a["lon1"] - b["lon0"])
    # Differences beyond 180 degrees count the other way round the globe.
    lon_gap = F.least(gap, F.greatest(360.0 - span, F.lit(0.0)))
    lon_span = F.when(span <= 180.0, span).when(gap >= 180.0, 360.0 - gap).otherwise(F.lit(180.0))

    def cosines(box: dict[str, Column]) -> tuple[Column, Column]:
        c0, c1 = F.cos(F.radians(box["lat0"])), F.cos(F.radians(box["lat1"]))
        crosses = (box["lat0"] < 0.0) & (box["lat1"] > 0.0)
        return F.least(c0, c1), F.when(crosses, F.lit(1.0)).otherwise(F.greatest(c0, c1))

    (a_low, a_high), (b_low, b_high) = cosines(a), cosines(b)
    least = hav(F.radians(lat_gap)) + a_low * b_low * hav(F.radians(lon_gap))
    most = hav(F.radians(lat_span)) + a_high * b_high * hav(F.radians(lon_span))
    return least, most


_BOX = ["lat0", "lat1", "lon0", "lon1"]


def _box(prefix: str) -> dict[str, Column]:
    return {side: F.col(prefix + side) for side in _BOX}


def _box_aggregates(prefix: str = "_") -> list[Column]:
    return [
        F.min("_lat").alias(f"{prefix}lat0"),
        F.max("_lat").alias(f"{prefix}lat1"),
        F.min("_lon").alias(f"{prefix}lon0"),
        F.max("_lon").alias(f"{prefix}lon1"),
    ]


def _touching_cells(grid: Grid, pairs: DataFrame, places: DataFrame, g: list[str]) -> DataFrame:
    """(g, a, b): those of the pairs of core cells that have two core points within epsilon of each other.

    ``pairs`` are open by their boxes, with the places na and nb of both cells.
    """
    zero = F.lit(0).cast("long")
    pairs = cut_lineage(pairs.select(*g, "a", "b", "na", "nb", *[zero.alias(c) for c in ("ay", "ax", "by", "bx")]))
    cells = pairs.select(*g, F.explode(F.array("a", "b")).alias("_cell")).distinct()
    places = cut_lineage(places.join(cells, [*g, "_cell"], "left_semi"))
    sure = F.col("_most") <= grid.limit
    few = F.col("na") * F.col("nb") <= PAIRS_PER_BOX_PAIR
    open_large = pairs.filter(~few)
    found = _compare_points(grid, pairs.filter(few), places, g, 0)

    level = 0
    while not open_large.isEmpty():
        level += 1
        pairs = cut_lineage(_split_pairs(grid, open_large, places, g, level))
        small = pairs.filter(~sure & few) if level < MAX_LEVEL else pairs.filter(~sure)
        settled = cut_lineage(
            pairs.filter(sure).select(*g, "a", "b")
            .unionByName(_compare_points(grid, small, places, g, level))
            .distinct()
        )
        found = found.unionByName(settled)
        if level == MAX_LEVEL:
            break
        open_large = cut_lineage(
            pairs.filter(~sure & ~few).join(settled, [*g, "a", "b"], "left_anti")
        )
    return found


def _bounds_columns() -> list[Column]:
    least, most = _box_bounds(_box("a"), _box("b"))
    return [least.alias("_least"), most.alias("_most")]


def _sub_index(grid: Grid, places: DataFrame, level: int) -> DataFrame:
    """Position of each place in its cell, cut SPLIT**level times along each axis."""
    n = SPLIT**level

    def index(offset: Column, cell_start: Column) -> Column:
        at = F.floor((offset - cell_start * grid.step) / grid.step * n)
        return F.least(F.greatest(at, F.lit(0)), F.lit(n - 1)).cast("long")

    return places.withColumns(
        {
            "_sy": index(F.col("_lat") + 90.0, F.col("_row")),
            "_sx": index(F.pmod(F.col("_lon") + 180.0, F.lit(360.0)), F.col("_col")),
        }
    )


def _side(df: DataFrame, g: list[str], side: str, columns: dict[str, str]) -> DataFrame:
    return df.select(*g, F.col("_cell").alias(side), *[F.col(k).alias(v) for k, v in columns.items()])


def _compare_points(
    grid: Grid, pairs: DataFrame, places: DataFrame, g: list[str], level: int
) -> DataFrame:
    """Point-by-point comparison of box pairs known to hold few points."""
    spots = _sub_index(grid, places, level)
    a = _side(spots, g, "a", {"_sy": "ay", "_sx": "ax", "_lat": "alat", "_lon": "alon"})
    b = _side(spots, g, "b", {"_sy": "by", "_sx": "bx", "_lat": "blat", "_lon": "blon"})
    near = hav_distance(F.col("alat"), F.col("alon"), F.col("blat"), F.col("blon")) <= grid.limit
    return (
        pairs.select(*g, "a", "ay", "ax", "b", "by", "bx")
        .join(a, [*g, "a", "ay", "ax"])
        .join(b, [*g, "b", "by", "bx"])
        .filter(near)
        .select(*g, "a", "b")
        .distinct()
    )


def _split_pairs(
    grid: Grid, pairs: DataFrame, places: DataFrame, g: list[str], level: int
) -> DataFrame:
    """Replace each open box pair by the pairs of its non-empty sub-boxes that may touch."""
    boxes = _sub_index(grid, places, level).groupBy(*g, "_cell", "_sy", "_sx").agg(
        F.count("*").alias("_n"), *_box_aggregates()
    )

    def children(side: str) -> DataFrame:
        return boxes.select(
            *g, F.col("_cell").alias(side),
            F.floor(F.col("_sy") / SPLIT).alias(side + "y"), F.floor(F.col("_sx") / SPLIT).alias(side + "x"),
            F.col("_sy").alias(side + "y2"), F.col("_sx").alias(side + "x2"),
            F.col("_n").alias("n" + side), *[F.col("_" + s).alias(side + s) for s in _BOX],
        )

    return (
        pairs.select(*g, "a", "ay", "ax", "b", "by", "bx")
        .join(children("a"), [*g, "a", "ay", "ax"])
        .join(children("b"), [*g, "b", "by", "bx"])
        .select(
            *g, "a", "b", "na", "nb", *_bounds_columns(),
            F.col("ay2").alias("ay"), F.col("ax2").alias("ax"),
            F.col("by2").alias("by"), F.col("bx2").alias("bx"),
        )
        .filter(F.col("_least") <= grid.limit)
    )


def _bounds(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``_box_bounds`` over arrays."""
    lat_gap = np.maximum(np.maximum(b["lat0"] - a["lat1"], a["lat0"] - b["lat1"]), 0.0)
    lat_span = np.maximum(b["lat1"] - a["lat0"], a["lat1"] - b["lat0"])
    gap = np.maximum(np.maximum(b["lon0"] - a["lon1"], a["lon0"] - b["lon1"]), 0.0)
    span = np.maximum(b["lon1"] - a["lon0"], a["lon1"] - b["lon0"])
    lon_gap = np.minimum(gap, np.maximum(360.0 - span, 0.0))
    lon_span = np.where(span <= 180.0, span, np.where(gap >= 180.0, 360.0 - gap, 180.0))

    def cosines(box: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        c0, c1 = np.cos(np.radians(box["lat0"])), np.cos(np.radians(box["lat1"]))
        crosses = (box["lat0"] < 0.0) & (box["lat1"] > 0.0)
        return np.minimum(c0, c1), np.where(crosses, 1.0, np.maximum(c0, c1))

    def apart(lat: np.ndarray, lon: np.ndarray, cosine: np.ndarray) -> np.ndarray:
        return np.sin(np.radians(lat) / 2.0) ** 2 + cosine * np.sin(np.radians(lon) / 2.0) ** 2

    (a_low, a_high), (b_low, b_high) = cosines(a), cosines(b)
    return apart(lat_gap, lon_gap, a_low * b_low), apart(lat_span, lon_span, a_high * b_high)


def _expanded(owner: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each owner with every position of its range."""
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(owner, count), np.repeat(start, count) + within


def _some(count: np.ndarray) -> Iterator[slice]:
    """Slices with about PAIRS_AT_ONCE pairs each."""
    group = (np.cumsum(count) - count) // PAIRS_AT_ONCE
    edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(count)]])
    return (slice(a, b) for a, b in zip(edges[:-1], edges[1:]) if b > a)


class _Tile:
    """The places and big cells of a tile and its margin, in the order of their cells."""

    def __init__(self, table: pa.Table, columns: int, limit: float):
        self.columns, self.limit = columns, limit
        raw = {c: table[c].to_numpy() for c in ("_row", "_col", "_reach", "_w", "_n", "_own", "_big", "_core", *_BOX)}
        self.cell = raw["_row"] * columns + raw["_col"]
        self.order = np.argsort(self.cell, kind="stable")
        self.cell = self.cell[self.order]
        for name, values in raw.items():
            setattr(self, name.lstrip("_"), values[self.order])
        self.box = {s: getattr(self, s) for s in _BOX}
        self.lat, self.lon = np.radians(self.lat0), np.radians(self.lon0)
        self.cos = np.cos(self.lat)

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether places i and j are within epsilon."""
        half = np.sin((self.lat[j] - self.lat[i]) / 2.0) ** 2
        return half + self.cos[i] * self.cos[j] * np.sin((self.lon[j] - self.lon[i]) / 2.0) ** 2 <= self.limit

    def around(self, asked: np.ndarray, cells: np.ndarray, first: int = -2) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of an asked position and a position in ``cells`` (sorted) not too far for neighbours."""
        row, col, reach = self.row[asked], self.col[asked], self.reach[asked]
        found = []
        for down in range(first, 3):
            for turn in (-self.columns, 0, self.columns):
                low = np.maximum(col - reach + turn, 0)
                high = np.minimum(col + reach + turn, self.columns - 1)
                base = (row + down) * self.columns
                start = np.searchsorted(cells, base + low)
                count = np.where(high >= low, np.searchsorted(cells, base + high, "right") - start, 0)
                some = np.flatnonzero(count > 0)
                found.append((asked[some], start[some], count[some]))
        owner, start, count = (np.concatenate(x) for x in zip(*found))
        for part in _some(count):
            yield _expanded(owner[part], start[part], count[part])

    def met(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For places i and items j: surely within epsilon; open, as j is a big cell partly within."""
        sure = (self.cell[i] == self.cell[j]) | (~self.big[j] & self.near(i, j))
        undecided = np.zeros(len(i), bool)
        far = np.flatnonzero(self.big[j])
        if len(far):
            least, most = _bounds(*({s: x[k[far]] for s, x in self.box.items()} for k in (i, j)))
            sure[far] = most <= self.limit
            undecided[far] = (least <= self.limit) & (most > self.limit)
        return sure, undecided


def _counted(grid: Grid, min_samples: int, schema: pa.Schema):
    """A tile's own places, those of sparse cells with the points within epsilon and the cells still open."""

    def run(table: pa.Table) -> pa.Table:
        if not pc.any(table["_own"]).as_py():
            return schema.empty_table()
        tile = _Tile(table, grid.columns, grid.limit)
        _, cell_of = np.unique(tile.cell, return_inverse=True)
        dense = np.bincount(cell_of, tile.w)[cell_of] >= min_samples
        mine = np.flatnonzero(tile.own & ~tile.big)
        near = np.zeros(len(tile.cell), np.int64)
        left = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for i, j in tile.around(mine[~dense[mine]], tile.cell):
            sure, undecided = tile.met(i, j)
            near += np.bincount(i[sure], tile.w[j[sure]], len(near)).astype(np.int64)
            left.append((i[undecided], tile.cell[j[undecided]]))
        place, cell = (np.concatenate(x) for x in zip(*left))
        # Of use only to places that are not core already.
        useful = near[place] < min_samples
        place, cell = place[useful], cell[useful]
        by_place = np.argsort(place, kind="stable")
        ends = np.cumsum(np.bincount(place, minlength=len(near))[mine])
        rows = table.take(pa.array(tile.order[mine]))
        values = {
            "_dense": pa.array(dense[mine]), "_near": pa.array(near[mine]),
            "_open": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(cell[by_place])),
        }
        return pa.table([values[f.name] if f.name in values else rows[f.name] for f in schema], schema=schema)

    return run


def _merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (the smallest node of a component) after nodes a and b have been linked."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        label = label.copy()
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def _linked(grid: Grid, groups: list[str], schema: pa.Schema):
    """The core cells of a tile linked with each other and its margin; rows by kind.

    MEMBER: an own core cell and the first cell of its component in the tile. CROSSING: such a first cell
    and a cell of the margin. OPEN: two cells whose boxes do not tell whether they touch. TOUCHED: a place that
    is not core and a cell of the component it touches. UNSURE: such a place and a big cell partly within.
    """

    def run(table: pa.Table) -> pa.Table:
        if not pc.any(table["_own"]).as_py():
            return schema.empty_table()
        tile = _Tile(table, grid.columns, grid.limit)
        core = np.flatnonzero(tile.core)
        cells, first, size = np.unique(tile.cell[core], return_index=True, return_counts=True)
        own, big = tile.own[core[first]] if len(core) else np.empty(0, bool), tile.big[core[first]] if len(core) else np.empty(0, bool)
        size = np.where(big, tile.n[core[first]], size) if len(core) else size
        label = np.arange(len(cells))
        box = {}
        if len(core):
            box = {s: (np.minimum if s[-1] == "0" else np.maximum).reduceat(tile.box[s][core], first) for s in _BOX}
        cell_of = np.searchsorted(cells, tile.cell)
        pending = []
        for i, y in tile.around(core[first] if len(core) else core, cells, first=0):
            x = cell_of[i]
            ahead = (y > x) & (own[x] | own[y])
            x, y = x[ahead], y[ahead]
            least, most = _bounds(*({s: v[k] for s, v in box.items()} for k in (x, y)))
            sure = most <= tile.limit
            label = _merged(label, x[sure], y[sure])
            undecided = ~sure & (least <= tile.limit)
            pending.append((x[undecided], y[undecided]))
        x, y = (np.concatenate(p) for p in zip(*pending)) if pending else (label[:0], label[:0])

        # One place of a cell against the other cell often tells; the rest of the places follow.
        small = ~big[x] & ~big[y]
        for whole in (False, True):
            u, v = x[small], y[small]
            many = (size[u] if whole else np.ones(len(u), np.int64)) * size[v]
            for part in _some(many):
                apart = np.flatnonzero(label[u[part]] != label[v[part]])
                p, q = u[part][apart], v[part][apart]
                pair, at = _expanded(np.arange(len(p)), np.zeros(len(p), np.int64), many[part][apart])
                i, j = core[first[p[pair]] + at // size[q[pair]]], core[first[q[pair]] + at % size[q[pair]]]
                hit = tile.near(i, j)
                label = _merged(label, p[pair[hit]], q[pair[hit]])
        undecided = ~small & own[x] & (label[x] != label[y])
        x, y = x[undecided], y[undecided]

        none = np.iinfo(np.int64).max
        lowest = np.full(len(cells), none)
        np.minimum.at(lowest, label[own], cells[own])
        named = lowest[label]
        crossing = ~own & (named < none)
        target = np.where(named < none, named, cells)

        touched, unsure = [], []
        for i, k in tile.around(np.flatnonzero(tile.own & ~tile.core), tile.cell[core]):
            j = core[k]
            sure, undecided = tile.met(i, j)
            if sure.any():
                touched.append(np.unique(np.stack([i[sure], target[cell_of[j[sure]]]]), axis=1))
            unsure.append(np.stack([i[undecided], tile.cell[j[undecided]]]))
        empty = np.empty((2, 0), np.int64)
        touched, unsure = (np.concatenate([empty, *x], axis=1) for x in (touched, unsure))
        kinds = [
            (MEMBER, cells[own], named[own], None, None),
            (CROSSING, named[crossing], cells[crossing], None, None),
            (OPEN, cells[x], cells[y], size[x], size[y]),
            (TOUCHED, tile.cell[touched[0]], touched[1], touched[0], None),
            (UNSURE, tile.cell[unsure[0]], unsure[1], unsure[0], None),
        ]
        out = []
        for kind, a, b, left, right in kinds:
            if not len(a):
                continue
            columns = {c: pa.array([table[c][0].as_py()] * len(a), schema.field(c).type) for c in groups}
            columns |= {"kind": pa.array(np.full(len(a), kind, np.int32)), "a": pa.array(a), "b": pa.array(b)}
            if kind == OPEN:
                columns |= {"na": pa.array(left.astype(np.int64)), "nb": pa.array(right.astype(np.int64))}
            elif left is not None:
                columns |= {"_lat": pa.array(tile.lat0[left]), "_lon": pa.array(tile.lon0[left])}
            out.append(pa.table([columns.get(f.name, pa.nulls(len(a), f.type)) for f in schema], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


MEMBER, CROSSING, OPEN, TOUCHED, UNSURE = range(5)


def _within(grid: Grid, unsure: DataFrame, places: DataFrame, g: list[str]) -> DataFrame:
    """(g, _lat, _lon, _near, _qw): places with the weight of each place of a cell ``_near`` within epsilon."""
    others = places.select(
        *g, F.col("_cell").alias("_near"), F.col("_lat").alias("_qlat"), F.col("_lon").alias("_qlon"), F.col("_w").alias("_qw")
    )
    near = hav_distance(F.col("_lat"), F.col("_lon"), F.col("_qlat"), F.col("_qlon")) <= grid.limit
    return unsure.join(others, [*g, "_near"]).filter(near)


def dbscan(
    df: DataFrame,
    eps_km: float = 5.0,
    min_samples: int = 5,
    partition_by: list[str] | None = None,
    order_by: list[Column] | None = None,
    lat: str = "latitude",
    lon: str = "longitude",
    label: str = "cluster_id",
    core: str = "is_core",
) -> DataFrame:
    """``df`` plus a cluster number (null for noise) and a core flag.

    A row is core when at least ``min_samples`` rows, itself included, lie within ``eps_km``.
    Clusters are numbered from 0 within each group of ``partition_by``, by the first of their
    core rows in ``order_by`` (then latitude, longitude). A border row goes to the lowest
    numbered cluster it touches.
    """
    g = list(partition_by or [])
    grid = Grid(eps_km)
    order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate([*(order_by or []), F.col(lat), F.col(lon)])])

    present = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    for name in g:
        present = present & F.col(name).isNotNull()
    places = (
        df.filter(present)
        .groupBy(*g, F.col(lat).alias("_lat"), F.col(lon).alias("_lon"))
        .agg(F.count("*").alias("_w"), F.min(order).alias("_first"))
        .withColumns({"_row": grid.row(F.col("_lat")), "_col": grid.column(F.col("_lon"))})
        .withColumn("_cell", grid.cell(F.col("_row"), F.col("_col")))
    )
    places = cut_lineage(places)
    cell_key, me = [*g, "_cell"], [*g, "_lat", "_lon"]
    dense = cut_lineage(
        places.groupBy(*cell_key, "_row", "_col").agg(
            F.sum("_w").alias("_w"), F.count("*").alias("_n"),
            F.min("_first").alias("_first"), *_box_aggregates(),
        ).filter(F.col("_w") >= min_samples)
    )
    big = dense.filter(F.col("_n") * F.col("_n") > PAIRS_PER_BOX_PAIR)
    any_big = not big.isEmpty()
    small = places.join(big.select(*cell_key), cell_key, "left_anti") if any_big else places
    reach = grid.reach(F.col("_row")).cast("long").alias("_reach")
    item = [*g, "_row", "_col", reach]
    spots = small.select(
        *item, *[F.col("_" + s[:3]).alias(s) for s in _BOX], "_w", F.lit(1).cast("long").alias("_n"),
        F.lit(False).alias("_big"), F.lit(False).alias("_core"), "_first",
    )
    boxes = big.select(
        *item, *[F.col("_" + s).alias(s) for s in _BOX], "_w", "_n", F.lit(True).alias("_big"), F.lit(True).alias("_core"),
        F.lit(None).cast(places.schema["_first"].dataType).alias("_first"),
    )
    tile = [*g, "_ty", "_tx"]

    # The points within epsilon of the places of sparse cells, and with them the core places.
    around = grid.in_tiles(spots.unionByName(boxes)).withColumn("_first", F.when(F.col("_own"), F.col("_first")))
    schema = StructType([f for f in spots.schema.fields if f.name not in ("_big", "_core")])
    schema = schema.add("_dense", "boolean").add("_near", "long").add("_open", ArrayType(LongType()))
    counted = cut_lineage(
        around.groupBy(*tile).applyInArrow(_counted(grid, min_samples, to_arrow_schema(schema)), schema)
    ).withColumn("_cell", grid.cell(F.col("_row"), F.col("_col"))).withColumnsRenamed({"lat0": "_lat", "lon0": "_lon"})
    known = counted.withColumn("_core", F.col("_dense") | (F.col("_near") >= min_samples))
    if any_big:
        unsure = counted.filter(F.size("_open") > 0).select(*me, F.explode("_open").alias("_near"))
        more = _within(grid, unsure, places, g).groupBy(*me).agg(F.sum("_qw").alias("_more"))
        known = cut_lineage(
            counted.join(more, me, "left")
            .withColumn("_core", F.col("_dense") | (F.col("_near") + F.coalesce("_more", F.lit(0)) >= min_samples))
        )
    sparse_core = known.filter("_core AND NOT _dense")
    core_cells = dense.select(*cell_key, "_first").unionByName(
        sparse_core.groupBy(*cell_key).agg(F.min("_first").alias("_first"))
    )

    # Links of core cells, within the tiles and then between them.
    again = known.withColumnsRenamed({"_lat": "lat0", "_lon": "lon0"}).withColumn("_big", F.lit(False))
    columns = [*item[:-1], "_reach", *_BOX, "_w", "_n", "_big", "_core"]
    around = grid.in_tiles(again.select(*columns).unionByName(boxes.select(*columns)))
    schema = StructType([places.schema[name] for name in g])
    for name in ("kind integer", "a long", "b long", "na long", "nb long", "_lat double", "_lon double"):
        schema = schema.add(*name.split())
    links = cut_lineage(around.groupBy(*tile).applyInArrow(_linked(grid, g, to_arrow_schema(schema)), schema))
    members = links.filter(F.col("kind") == MEMBER).select(*g, F.col("a").alias("_cell"), F.col("b").alias("_part"))
    edges = links.filter(F.col("kind") == CROSSING).select(*g, "a", "b")
    touched = links.filter(F.col("kind") == TOUCHED).select(*me, F.col("b").alias("_near"))
    if any_big:
        core_places = places.join(dense.select(*cell_key), cell_key, "left_semi").select(*cell_key, "_row", "_col", "_lat", "_lon")
        core_places = core_places.unionByName(sparse_core.select(*core_places.columns))
        edges = edges.unionByName(_touching_cells(grid, links.filter(F.col("kind") == OPEN), core_places, g))
        unsure = links.filter(F.col("kind") == UNSURE).select(*me, F.col("b").alias("_near"))
        touched = touched.unionByName(_within(grid, unsure, places, g).select(*me, "_near").distinct())
    for side in ("a", "b"):
        edges = edges.withColumnRenamed(side, "_cell").join(members, cell_key).drop("_cell").withColumnRenamed("_part", side)
    parts = members.select(*g, F.col("_part").alias("node")).distinct()
    roots = connected_components(parts, edges, g).withColumnRenamed("node", "_part")
    roots = cut_lineage(members.join(roots, [*g, "_part"]).select(*cell_key, "root"))
    clusters = (
        core_cells.join(roots, cell_key).groupBy(*g, "root").agg(F.min("_first").alias("_first"))
    )
    numbered = rank_within(clusters, g, [F.col("_first")], "_cluster").select(*g, "root", "_cluster")
    cell_cluster = cut_lineage(roots.join(numbered, [*g, "root"]).select(*cell_key, "_cluster"))

    # Border places: the lowest numbered cluster among the core points in reach.
    border = (
        touched.join(cell_cluster.withColumnRenamed("_cell", "_near"), [*g, "_near"])
        .groupBy(*me)
        .agg(F.min("_cluster").alias("_cluster"))
        .withColumns(
            {
                "_row": grid.row(F.col("_lat")),
                "_cell": grid.cell(F.col("_row"), grid.column(F.col("_lon"))),
                "_is_core": F.lit(False),
            }
        )
        .select(*cell_key, "_lat", "_lon", "_cluster", "_is_core")
    )
    inner = sparse_core.join(cell_cluster, cell_key).select(
        *cell_key, "_lat", "_lon", "_cluster", F.lit(True).alias("_is_core")
    )
    # A sparse cell lists fewer than min_samples places, so this array is bounded.
    listed = inner.unionByName(border).groupBy(*cell_key).agg(
        F.collect_list(F.struct("_lat", "_lon", "_cluster", "_is_core")).alias("_listed")
    )
    dense_labels = cell_cluster.join(dense.select(*cell_key), cell_key, "left_semi")
    by_cell = dense_labels.withColumn("_listed", F.lit(None)).unionByName(
        listed.select(*cell_key, F.lit(None).cast("int").alias("_cluster"), "_listed")
    )
    mine = F.get(
        F.filter("_listed", lambda p: (p["_lat"] == F.col(lat)) & (p["_lon"] == F.col(lon))), F.lit(0)
    )
    located = df.withColumn("_cell", grid.cell(grid.row(F.col(lat)), grid.column(F.col(lon))))
    return located.join(by_cell, cell_key, "left").select(
        *[F.col(c) for c in df.columns],
        F.coalesce(F.col("_cluster"), mine["_cluster"]).alias(label),
        (F.col("_cluster").isNotNull() | F.coalesce(mine["_is_core"], F.lit(False))).alias(core),
    )
