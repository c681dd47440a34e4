"""Points near places and points in regions, by a Voronoi partition and vantage-point trees.

The globe is cut into the Voronoi cells of pivots, in two levels: each cell of the first
is cut again by the pivots that lie in it. Their number grows with the number of places,
so a cell holds about as many however many there are. A point goes to the cell of its
nearest pivot. A place that reaches ``r`` km is copied to every cell where a point within
its reach may lie: by the triangle inequality these are, on each level, the cells whose
pivot is at most ``2 r`` farther from the place than its nearest pivot. So every pair
meets in exactly one cell, the point's, and the join is complete without a cross join. In
each cell a vantage-point tree over the places finds the candidates with the exact
great-circle metric.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.session import reliable_checkpoint

EARTH_KM = 6371.0
#: Cells there are at least (if there are as many places) and at most; their pivots, 16 bytes each, are all that's collected.
PIVOTS = 96
MOST_PIVOTS = 32_768
#: Places a cell has about, up to ``MOST_PIVOTS`` cells.
PLACES_PER_CELL = 2_000
#: Pivots of the first level.
TOP_PIVOTS = 128
#: Points and places one task holds at a time; fuller cells are cut into blocks.
POINTS_PER_BLOCK = 200_000
PLACES_PER_BLOCK = 20_000
#: Allowance in km for rounding in the copy rule; it only adds copies.
SLACK_KM = 0.01


def valid_point(lat: str, lon: str, zero_is_missing: bool = True) -> Column:
    """Coordinates that can be placed: present, in range and, if asked, not (0, 0)."""
    a, b = F.col(lat), F.col(lon)
    ok = a.isNotNull() & b.isNotNull() & ~F.isnan(a) & ~F.isnan(b) & (F.abs(a) <= 90) & (F.abs(b) <= 180)
    return ok & ~((a == 0) & (b == 0)) if zero_is_missing else ok


def great_circle_km(lat1, lon1, lat2, lon2):
    """Haversine distance of degrees; NumPy arrays broadcast."""
    p1, p2 = np.radians(lat1), np.radians(lat2)
    h = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_KM * np.arcsin(np.sqrt(np.minimum(1.0, h)))


def _unit(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    p, q = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(p) * np.cos(q), np.cos(p) * np.sin(q), np.sin(p)], axis=1)


def _pivots(places: DataFrame, least: int, per_cell: int) -> np.ndarray:
    """One distinct place (to a hundredth of a degree) in ``per_cell``, at least ``least`` and at most ``MOST_PIVOTS``, picked by hash."""
    spots = places.select(F.round("lat", 2).alias("lat"), F.round("lon", 2).alias("lon")).distinct()
    n = min(MOST_PIVOTS, max(least, math.ceil(spots.count() / per_cell)))
    rows = spots.orderBy(F.xxhash64("lat", "lon"), "lat", "lon").limit(n).collect()
    return np.array([(r.lat, r.lon) for r in rows], dtype=float).reshape(-1, 2)


class Cells:
    """The Voronoi cells of pivots in two levels; a cell is named by the number of its pivot."""

    def __init__(self, pivots: np.ndarray, top: int = TOP_PIVOTS) -> None:
        self.pivots, self.units = pivots, _unit(pivots[:, 0], pivots[:, 1])
        self.top = np.arange(min(top, len(pivots)))
        above = np.argmax(self.units @ self.units[self.top].T, axis=1)
        self.under = [np.flatnonzero(above == t) for t in self.top]

    def nearest(self, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        points = _unit(lat, lon)
        above = np.argmax(points @ self.units[self.top].T, axis=1)
        out = np.empty(len(points), np.int32)
        for t in np.unique(above):
            mine, under = np.flatnonzero(above == t), self.under[t]
            for at in range(0, len(mine), 4096):
                part = mine[at : at + 4096]
                out[part] = under[np.argmax(points[part] @ self.units[under].T, axis=1)]
        return out

    def reached(self, lat: np.ndarray, lon: np.ndarray, reach: np.ndarray) -> list[np.ndarray]:
        """For each place the cells in which a point within its reach may lie."""
        rows, cells = [], []
        above = self._within(lat, lon, reach, self.top)
        for t in np.flatnonzero(above.any(axis=0)):
            mine = np.flatnonzero(above[:, t])
            for at in range(0, len(mine), 4096):
                part = mine[at : at + 4096]
                r, c = np.nonzero(self._within(lat[part], lon[part], reach[part], self.under[t]))
                rows.append(part[r])
                cells.append(self.under[t][c])
        if not rows:
            return []
        row, cell = np.concatenate(rows), np.concatenate(cells).astype(np.int32)
        order = np.argsort(row, kind="stable")
        return np.split(cell[order], np.searchsorted(row[order], np.arange(1, len(lat))))

    def _within(self, lat: np.ndarray, lon: np.ndarray, reach: np.ndarray, pivots: np.ndarray) -> np.ndarray:
        d = great_circle_km(lat[:, None], lon[:, None], self.pivots[None, pivots, 0], self.pivots[None, pivots, 1])
        return d <= d.min(axis=1, keepdims=True) + 2 * reach[:, None] + SLACK_KM


def _nearest(cells: Cells):
    @F.pandas_udf(T.IntegerType())
    def cell(lat: pd.Series, lon: pd.Series) -> pd.Series:
        return pd.Series(cells.nearest(lat.to_numpy(float), lon.to_numpy(float)))

    return cell


def _reached(cells: Cells):
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def reached(lat: pd.Series, lon: pd.Series, reach: pd.Series) -> pd.Series:
        return pd.Series(cells.reached(lat.to_numpy(float), lon.to_numpy(float), reach.to_numpy(float)), dtype=object)

    return reached


class VantageTree:
    """Objects on the globe, each with its own reach; finds all objects that reach a point."""

    LEAF = 12

    def __init__(self, lat: np.ndarray, lon: np.ndarray, reach: np.ndarray) -> None:
        self.lat, self.lon, self.reach = lat, lon, reach
        self.root = self._build(np.arange(len(lat)))

    def _build(self, own: np.ndarray):
        if len(own) <= self.LEAF:
            return own
        top, rest = own[0], own[1:]
        d = great_circle_km(self.lat[top], self.lon[top], self.lat[rest], self.lon[rest])
        cut = np.median(d)
        inner = d <= cut
        if inner.all():
            inner = d < cut
            if not inner.any():
                return own  # all at one distance: nothing to cut
        near, far = rest[inner], rest[~inner]
        return (top, d[inner].max(), self.reach[near].max(), self._build(near), d[~inner].min(), self.reach[far].max(), self._build(far))

    def query(self, lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (point, object) with the point within the object's reach."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        stack = [(self.root, np.arange(len(lat)))]
        while stack:
            node, q = stack.pop()
            if not len(q):
                continue
            if isinstance(node, np.ndarray):
                for o in node:
                    hit = q[great_circle_km(lat[q], lon[q], self.lat[o], self.lon[o]) <= self.reach[o]]
                    if len(hit):
                        found.append((hit, np.full(len(hit), o)))
                continue
            top, within, near_reach, near, beyond, far_reach, far = node
            d = great_circle_km(lat[q], lon[q], self.lat[top], self.lon[top])
            if (hit := q[d <= self.reach[top]]).size:
                found.append((hit, np.full(len(hit), top)))
            stack.append((near, q[d <= within + near_reach + SLACK_KM]))
            stack.append((far, q[d >= beyond - far_reach - SLACK_KM]))
        if not found:
            return np.empty(0, int), np.empty(0, int)
        return np.concatenate([p for p, _ in found]), np.concatenate([o for _, o in found])


def inside_rings(lon: np.ndarray, lat: np.ndarray, xs: np.ndarray, ys: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each point is enclosed by an odd number of the rings (straight edges in degrees)."""
    odd = np.zeros(len(lon), dtype=bool)
    begin = 0
    for end in ends:
        x, y = xs[begin:end], ys[begin:end]
        begin = end
        if len(x) < 3:
            continue
        x2, y2 = np.roll(x, -1), np.roll(y, -1)
        keep = y != y2
        x, y, x2, y2 = x[keep], y[keep], x2[keep], y2[keep]
        for at in range(0, len(lon), 4096):
            px, py = lon[at : at + 4096, None], lat[at : at + 4096, None]
            crosses = ((y > py) != (y2 > py)) & (px < (x2 - x) * (py - y) / (y2 - y) + x)
            odd[at : at + 4096] ^= (crosses.sum(axis=1) % 2).astype(bool)
    return odd


def _places(places: DataFrame | None, key: str, lat: str, lon: str, radius_km: float) -> DataFrame | None:
    if places is None:
        return None
    return places.filter(valid_point(lat, lon, False) & F.col(key).isNotNull()).select(
        F.lit("near").alias("kind"), F.col(key).cast("bigint").alias("ref_id"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"), F.lit(float(radius_km)).alias("reach"),
        F.lit(None).cast("array<double>").alias("xs"), F.lit(None).cast("array<double>").alias("ys"), F.lit(None).cast("array<int>").alias("ends"),
    ).distinct()


def _regions(regions: DataFrame | None, key: str, geometry: str) -> DataFrame | None:
    """Regions as a centre and a radius around the bounding box, with flat rings."""
    if regions is None:
        return None
    rings = F.filter(F.col(geometry), lambda r: F.size(r) > 2)
    flat = regions.filter(F.col(key).isNotNull() & F.col(geometry).isNotNull()).select(
        F.col(key).cast("bigint").alias("ref_id"),
        F.transform(F.flatten(rings), lambda p: p["lon"]).alias("xs"),
        F.transform(F.flatten(rings), lambda p: p["lat"]).alias("ys"),
        F.transform(rings, lambda r: F.size(r)).alias("sizes"),
    ).filter(F.size("xs") > 0)
    boxed = flat.select(
        "ref_id", "xs", "ys",
        F.transform(F.sequence(F.lit(1), F.size("sizes")), lambda i: F.aggregate(F.slice("sizes", 1, i), F.lit(0), lambda a, b: a + b)).alias("ends"),
        ((F.array_min("ys") + F.array_max("ys")) / 2).alias("lat"),
        ((F.array_min("xs") + F.array_max("xs")) / 2).alias("lon"),
        F.radians((F.array_max("ys") - F.array_min("ys")) / 2).alias("h"),
        F.radians((F.array_max("xs") - F.array_min("xs")) / 2).alias("w"),
        F.radians(F.when(F.array_min("ys") * F.array_max("ys") <= 0, F.lit(0.0)).otherwise(F.least(F.abs(F.array_min("ys")), F.abs(F.array_max("ys"))))).alias("low"),
    )
    hav = F.pow(F.sin(F.col("h") / 2), 2) + F.cos(F.radians("lat")) * F.cos("low") * F.pow(F.sin(F.least(F.col("w"), F.lit(math.pi)) / 2), 2)
    reach = F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(hav, F.lit(1.0)))) + F.lit(SLACK_KM)
    return boxed.select(F.lit("in").alias("kind"), "ref_id", "lat", "lon", reach.alias("reach"), "xs", "ys", "ends").distinct()


def _meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    out = {"kind": [], "key": [], "ref_id": []}
    if len(left) and len(right):
        spots, of = np.unique(left[["lat", "lon"]].to_numpy(float), axis=0, return_inverse=True)
        of = of.reshape(-1)
        order, keys = np.argsort(of, kind="stable"), left["key"].to_numpy()
        starts = np.searchsorted(of[order], np.arange(len(spots) + 1))
        tree = VantageTree(right["lat"].to_numpy(float), right["lon"].to_numpy(float), right["reach"].to_numpy(float))
        p, o = tree.query(spots[:, 0], spots[:, 1])
        kinds, refs = right["kind"].to_numpy(), right["ref_id"].to_numpy()
        by = np.argsort(o, kind="stable")
        p, o = p[by], o[by]
        for obj, begin, count in zip(*np.unique(o, return_index=True, return_counts=True)):
            mine = p[begin : begin + count]
            if kinds[obj] == "in":
                r = right.iloc[obj]
                mine = mine[inside_rings(spots[mine, 1], spots[mine, 0], np.asarray(r["xs"], float), np.asarray(r["ys"], float), np.asarray(r["ends"], int))]
            if len(mine):
                got = np.concatenate([keys[order[starts[m] : starts[m + 1]]] for m in mine])
                out["key"].append(got)
                out["kind"].append(np.full(len(got), kinds[obj], dtype=object))
                out["ref_id"].append(np.full(len(got), refs[obj]))
    if not out["key"]:
        return pd.DataFrame({"kind": pd.Series([], dtype=object), "key": np.empty(0, np.int64), "ref_id": np.empty(0, np.int64)})
    return pd.DataFrame({k: np.concatenate(v) for k, v in out.items()})


def locate(
    points: DataFrame,
    key: str,
    lat: str,
    lon: str,
    places: DataFrame | None = None,
    place_key: str = "site_id",
    place_lat: str = "lat",
    place_lon: str = "lon",
    radius_km: float = 10.0,
    regions: DataFrame | None = None,
    region_key: str = "poly_id",
    geometry: str = "geometry",
    pivots: int = PIVOTS,
    places_per_cell: int = PLACES_PER_CELL,
    points_per_block: int = POINTS_PER_BLOCK,
    places_per_block: int = PLACES_PER_BLOCK,
) -> DataFrame:
    """For each point every place within ``radius_km`` and every region that contains it.

    Columns ``kind`` (``near`` or ``in``), ``key`` (the point's, bigint), ``ref_id``;
    distinct rows. Points with a null key or without valid coordinates (null, NaN, out
    of range, exactly (0, 0)) have no row; nor have places without valid coordinates and
    regions without a ring of three corners. Repeated points and places count once.
    A region is taken as its bounding circle for the partition and tested exactly in its
    cell; edges are straight in degrees and don't wrap at the date line. Empty inputs
    give an empty result.

    Nothing but the pivots and the row counts per cell (at most ``MOST_PIVOTS`` of each)
    reaches the driver. Cells have about ``places_per_cell`` places, so a place is copied to
    few of them. A cell that holds more rows than a block, as one around a hot place does,
    is cut into blocks by the hash of the rows; places are copied to the point blocks of
    their cell and the other way round, so a task's rows are bounded. Points and copied
    places are laid down once (checkpoint) and then counted and joined.
    """
    schema = "kind string, key bigint, ref_id bigint"
    spark = points.sparkSession
    parts = [x for x in (_places(places, place_key, place_lat, place_lon, radius_km), _regions(regions, region_key, geometry)) if x is not None]
    targets = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    marks = _pivots(targets, pivots, places_per_cell)
    if not len(marks):
        return spark.createDataFrame([], schema)
    cells = Cells(marks)
    spread = reliable_checkpoint(
        points.filter(valid_point(lat, lon) & F.col(key).isNotNull())
        .select(F.col(key).cast("bigint").alias("key"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
        .withColumn("cell", _nearest(cells)("lat", "lon"))
    )
    copied = reliable_checkpoint(targets.withColumn("cell", F.explode(_reached(cells)("lat", "lon", "reach"))))
    n_points = {r.cell: r.n for r in spread.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # one row per pivot
    n_places = {r.cell: r.n for r in copied.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    rows = [(c, math.ceil(n / points_per_block), math.ceil(n_places[c] / places_per_block)) for c, n in n_points.items() if c in n_places]
    blocks = spark.createDataFrame(rows, "cell int, pb int, qb int")
    h = lambda *c: F.xxhash64(*c)
    left = (
        spread.join(F.broadcast(blocks), "cell")  # one row per pivot
        .withColumn("a", F.pmod(h("key", "lat", "lon"), F.col("pb")).cast("int"))
        .withColumn("b", F.explode(F.sequence(F.lit(0), F.col("qb") - 1)))
        .select("cell", "a", "b", "key", "lat", "lon")
    )
    right = (
        copied.join(F.broadcast(blocks), "cell")
        .withColumn("b", F.pmod(h("kind", "ref_id"), F.col("qb")).cast("int"))
        .withColumn("a", F.explode(F.sequence(F.lit(0), F.col("pb") - 1)))
        .select("cell", "a", "b", "kind", "ref_id", "lat", "lon", "reach", "xs", "ys", "ends")
    )
    return left.groupBy("cell", "a", "b").cogroup(right.groupBy("cell", "a", "b")).applyInPandas(_meet, schema).distinct()


def within_distance(points: DataFrame, key: str, lat: str, lon: str, places: DataFrame, radius_km: float, **options) -> DataFrame:
    """``locate`` for places only."""
    return locate(points, key, lat, lon, places=places, radius_km=radius_km, **options)


def containing_region(points: DataFrame, key: str, lat: str, lon: str, regions: DataFrame, **options) -> DataFrame:
    """``locate`` for regions only."""
    return locate(points, key, lat, lon, regions=regions, **options)
