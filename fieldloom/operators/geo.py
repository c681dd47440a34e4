"""The nearest area of a point, and the rules that bring area names into line."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.operators.spatial import inside_rings, valid_point

#: Radius of the sphere of the map projection.
MERCATOR_M = 6378137.0
#: Corners of areas that are sent to all tasks at once (16 bytes each); more are taken in blocks.
MOST_CORNERS = 2_000_000
#: Points of one task where areas are taken in blocks.
POINTS_PER_TASK = 200_000


def web_mercator(lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Metres on the web map; latitudes are clipped to the map's edge."""
    p = np.radians(np.clip(lat, -85.06, 85.06))
    return np.radians(lon) * MERCATOR_M, np.log(np.tan(math.pi / 4 + p / 2)) * MERCATOR_M


def largest_part(geometry: Column | str) -> Column:
    """The ring with the greatest area of a list of closed rings."""
    g = F.col(geometry) if isinstance(geometry, str) else geometry

    def area(ring: Column) -> Column:
        steps = F.sequence(F.lit(1), F.greatest(F.size(ring) - 1, F.lit(1)))
        cross = F.transform(steps, lambda i: F.coalesce(F.get(ring, i - 1)["lon"] * F.get(ring, i)["lat"] - F.get(ring, i)["lon"] * F.get(ring, i - 1)["lat"], F.lit(0.0)))
        return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, x: s + x)) / 2

    scored = F.transform(F.filter(g, lambda r: F.size(r) > 3), lambda r: F.struct(area(r).alias("area"), r.alias("ring")))
    return F.array_max(scored)["ring"]


class _Areas:
    """Areas as rings on the web map, in a tree of bounding boxes."""

    LEAF = 6

    def __init__(self, areas: list[tuple[int, list[np.ndarray], list[np.ndarray]]]) -> None:
        self.ids, self.rings = [], []
        for key, lons, lats in sorted(areas, key=lambda a: a[0]):
            mapped = [web_mercator(np.asarray(x, float), np.asarray(y, float)) for x, y in zip(lons, lats) if len(x) > 2]
            if mapped:
                self.ids.append(key)
                self.rings.append(mapped)
        boxes = [[min(x.min() for x, _ in r), min(y.min() for _, y in r), max(x.max() for x, _ in r), max(y.max() for _, y in r)] for r in self.rings]
        self.boxes = np.array(boxes, float).reshape(-1, 4)
        self.root = self._build(np.arange(len(self.ids))) if self.ids else None

    def _build(self, own: np.ndarray):
        b = self.boxes[own]
        box = np.r_[b[:, :2].min(axis=0), b[:, 2:].max(axis=0)]
        if len(own) <= self.LEAF:
            return box, own, None, None
        middle = (b[:, :2] + b[:, 2:]) / 2
        axis = int(np.argmax(np.ptp(middle, axis=0)))
        order, half = np.argsort(middle[:, axis], kind="stable"), len(own) // 2
        return box, None, self._build(own[order[:half]]), self._build(own[order[half:]])

    @staticmethod
    def _to_box(box: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.hypot(np.maximum(0, np.maximum(box[0] - x, x - box[2])), np.maximum(0, np.maximum(box[1] - y, y - box[3])))

    def nearest(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest area (the first on a tie) and the distance in map metres, 0 inside.

        All points go down the tree together, each into the nearer box first; a box farther
        than the best area so far is left out.
        """
        best, at = np.full(len(x), np.inf), np.full(len(x), -1)

        def visit(node, q: np.ndarray) -> None:
            box, own, one, two = node
            q = q[self._to_box(box, x[q], y[q]) <= best[q] + 1e-6]
            if not len(q):
                return
            if own is None:
                first = self._to_box(one[0], x[q], y[q]) <= self._to_box(two[0], x[q], y[q])
                for child, mine in ((one, q[first]), (two, q[~first]), (two, q[first]), (one, q[~first])):
                    visit(child, mine)
                return
            for i in own:
                mine = q[self._to_box(self.boxes[i], x[q], y[q]) <= best[q] + 1e-6]
                if len(mine):
                    d = self._distance(i, x[mine], y[mine])
                    better = (d < best[mine]) | ((d == best[mine]) & (i < at[mine]))
                    best[mine[better]], at[mine[better]] = d[better], i

        if self.root is not None:
            visit(self.root, np.arange(len(x)))
        return at, best

    def _distance(self, i: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        xs, ys = np.concatenate([r[0] for r in self.rings[i]]), np.concatenate([r[1] for r in self.rings[i]])
        ends = np.cumsum([len(r[0]) for r in self.rings[i]])
        out = np.full(len(x), np.inf)
        for rx, ry in self.rings[i]:
            ax, ay = rx, ry
            vx, vy = np.roll(rx, -1) - ax, np.roll(ry, -1) - ay
            size = np.maximum(vx * vx + vy * vy, 1e-12)
            for k in range(0, len(x), 2048):
                px, py = x[k : k + 2048, None], y[k : k + 2048, None]
                t = np.clip(((px - ax) * vx + (py - ay) * vy) / size, 0, 1)
                out[k : k + 2048] = np.minimum(out[k : k + 2048], np.hypot(px - ax - t * vx, py - ay - t * vy).min(axis=1))
        out[inside_rings(x, y, xs, ys, ends)] = 0.0
        return np.round(out, 6)  # so that a point on a common border is equally near to both


def nearest_area(points: DataFrame, key: str, lat: str, lon: str, areas: DataFrame, area_key: str = "poly_id", geometry: str = "geometry", most_corners: int = MOST_CORNERS, points_per_task: int = POINTS_PER_TASK) -> DataFrame:
    """``key``, ``area_id``, ``distance_m`` (on the web map) of the nearest area of every distinct point; on a tie the smallest id.

    Points without valid coordinates have null columns. Areas of up to ``most_corners``
    corners in all, a map's districts, are broadcast. Where there are more, blocks of areas
    and of points meet by their numbers, so neither the driver nor a task holds all of
    them, and the nearest of the blocks wins. Repeated places are looked up once per batch.
    """
    schema = "key bigint, area_id bigint, distance_m double"
    base = points.select(F.col(key).cast("bigint").alias("key"), F.when(valid_point(lat, lon), F.col(lat)).cast("double").alias("lat"), F.when(valid_point(lat, lon), F.col(lon)).cast("double").alias("lon")).distinct()
    flat = areas.filter(F.col(area_key).isNotNull() & F.col(geometry).isNotNull()).select(
        F.col(area_key).cast("bigint").alias("id"), F.transform(geometry, lambda r: r["lon"]).alias("lon"), F.transform(geometry, lambda r: r["lat"]).alias("lat")
    )
    corners = flat.agg(F.sum(F.size(F.flatten("lon")))).first()[0] or 0
    if corners <= most_corners:
        held = [(r.id, r.lon, r.lat) for r in flat.toLocalIterator()]
        sent = points.sparkSession.sparkContext.broadcast(held)  # at most ``most_corners`` corners

        def run(batches):
            found = _Areas(sent.value)
            for b in batches:
                yield _located(found, b)

        return base.mapInPandas(run, schema).withColumnRenamed("key", key)
    blocks, tasks = math.ceil(corners / most_corners), math.ceil(base.count() / points_per_task) or 1
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    left = base.withColumn("task", F.pmod(F.xxhash64("key", "lat", "lon"), F.lit(tasks))).withColumn("block", every(blocks))
    right = flat.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).withColumn("task", every(tasks))

    def meet(p: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        return _located(_Areas([(i, x, y) for i, x, y in zip(a["id"], a["lon"], a["lat"])]), p).assign(spot=p["spot"])

    met = left.withColumn("spot", F.xxhash64("lat", "lon")).groupBy("task", "block").cogroup(right.groupBy("task", "block")).applyInPandas(meet, schema + ", spot bigint")
    nearest = F.min(F.when(F.col("area_id").isNotNull(), F.struct("distance_m", "area_id"))).alias("x")
    return met.groupBy("key", "spot").agg(nearest).select(F.col("key").alias(key), "x.area_id", "x.distance_m")


def _located(areas: _Areas, b: pd.DataFrame) -> pd.DataFrame:
    lat, lon = b["lat"].to_numpy(float), b["lon"].to_numpy(float)
    ids, far = np.full(len(b), None, dtype=object), np.full(len(b), np.nan)
    ok = np.flatnonzero(~np.isnan(lat))
    if len(ok) and areas.ids:
        spots, of = np.unique(np.stack([lat[ok], lon[ok]], 1), axis=0, return_inverse=True)
        at, d = areas.nearest(*web_mercator(spots[:, 1], spots[:, 0]))
        ids[ok] = np.array(areas.ids)[at[of.reshape(-1)]]
        far[ok] = d[of.reshape(-1)]
    return pd.DataFrame({"key": b["key"], "area_id": pd.array(ids, dtype="Int64"), "distance_m": far})


#: A rule: in rows where all of ``where`` hold, ``column`` becomes ``to`` (a value, or old-to-new values).
Rule = tuple[dict[str, str], str, str | dict[str, str]]

# Renamings of areas of the map, in the order in which they apply.
AREA_RULES: list[Rule] = [
    ({"name_0": "burundi"}, "name_2", {"butaganzwa1": "butaganzwa", "butaganzwa2": "butaganzwa", "butaganzwal": "butaganzwa", "muramvya": "muramviya", "buhinyuza": "buhinvuza", "nyamurenza": "nvamurenza"}),
    ({"name_0": "cameroon"}, "name_1", {"sud": "south", "nord": "north", "est": "east", "ouest": "west", "extreme nord": "far north", "nord ouest": "northwest", "sud ouest": "southwest"}),
    ({"name_0": "chad"}, "name_2", {"barh el gazel": "barh el gazel nord"}),
    ({"name_1": "bungoma", "name_2": "likuyani"}, "name_1", "kakamega"),
    ({"name_1": "hodh ech chargui", "name_2": "ouadane"}, "name_1", "adrar"),
    ({"name_0": "sierra leone", "name_1": "western"}, "name_1", "western area"),
    ({"name_1": "al jawf", "name_2": "az zahir"}, "name_2", "az zahir al humayqan"),
    ({"name_1": "masvingo urban"}, "name_1", "masvingo"),
    ({"name_1": "harare", "name_2": "harare"}, "name_2", "harare urban"),
]
# The districts of each region of Malawi.
MALAWI_REGIONS = {
    "central": ["dedza", "dowa", "kasungu", "lilongwe", "mchinji", "nkhotakota", "ntcheu", "ntchisi", "salima"],
    "northern": ["chitipa", "karonga", "mzimba", "nkhata bay", "rumphi"],
    "southern": [
        "balaka", "blantyre", "chikwawa", "chiradzulu", "machinga", "mangochi", "mulanje", "mwanza", "neno", "nsanje", "phalombe", "thyolo", "zomba",
    ],
}
AREA_RULES.append(({"name_0": "malawi"}, "name_1", {d: r for r, ds in MALAWI_REGIONS.items() for d in ds}))


def apply_rules(df: DataFrame, rules: Sequence[Rule] = tuple(AREA_RULES)) -> DataFrame:
    """``df`` with the rules applied in order, each seeing what those before it left; a null never matches."""
    for where, column, to in rules:
        cond = F.lit(True)
        for c, v in where.items():
            cond = cond & (F.col(c) == v)
        if isinstance(to, dict):
            pairs = F.create_map(*[F.lit(x) for kv in to.items() for x in kv])
            new = F.coalesce(F.try_element_at(pairs, F.lower(F.trim(F.col(column)))), F.col(column))
        else:
            new = F.lit(to)
        df = df.withColumn(column, F.when(cond, new).otherwise(F.col(column)))
    return df


# Renamings on the side of the score table, in order.
SCORE_RULES: list[Rule] = [
    ({"admin0": "burundi"}, "admin2", {"butaganzwa1": "butaganzwa", "butaganzwa2": "butaganzwa", "butaganzwal": "butaganzwa", "muramvya": "muramviya", "buhinyuza": "buhinvuza", "nyamurenza": "nvamurenza"}),
    ({"admin0": "yemen", "admin1": "socotra"}, "admin1", "hadramaut"),
]
# The region of each district of Uganda.
UGANDA_REGIONS = {
    "adjumani": "northern", "amuria": "eastern", "apac": "northern", "arua": "northern", "budaka": "eastern", "bududa": "eastern", "bugiri": "eastern",
    "buikwe": "central", "bukedea": "eastern", "bukomansimbi": "central", "bukwo": "eastern", "bulambuli": "eastern", "bundibugyo": "western",
    "bushenyi": "western", "busia": "eastern", "butaleja": "eastern", "butambala": "central", "buvuma": "central", "buyende": "eastern", "gomba": "central",
    "gulu": "northern", "hoima": "western", "iganga": "eastern", "jinja": "eastern", "kabale": "western", "kabarole": "western", "kaberamaido": "eastern",
    "kalangala": "central", "kaliro": "eastern", "kalungu": "central", "kampala": "central", "kamuli": "eastern", "kamwenge": "western", "kanungu": "western",
    "kapchorwa": "eastern", "kasese": "western", "katakwi": "eastern", "kayunga": "central", "kiboga": "central", "kibuku": "eastern", "kisoro": "western",
    "kitgum": "northern", "kotido": "northern", "kumi": "eastern", "kween": "eastern", "kyankwanzi": "central", "kyenjojo": "western", "lira": "northern",
    "luuka": "eastern", "luwero": "central", "lwengo": "central", "lyantonde": "central", "manafwa": "eastern", "masaka": "central", "masindi": "western",
    "mayuge": "eastern", "mbale": "eastern", "mbarara": "western", "mityana": "central", "moroto": "northern", "moyo": "northern", "mpigi": "central",
    "mubende": "central", "mukono": "central", "nakapiripirit": "northern", "nakaseke": "central", "nakasongola": "central", "namayingo": "eastern",
    "namutumba": "eastern", "nebbi": "northern", "ngora": "eastern", "ntungamo": "western", "pader": "northern", "pallisa": "eastern", "rakai": "central",
    "rukungiri": "western", "sembabule": "central", "serere": "eastern", "sironko": "eastern", "soroti": "eastern", "tororo": "eastern", "wakiso": "central",
    "yumbe": "northern",
}
# Areas of Uganda that keep their own name; others take that of the district around them.
UGANDA_KEPT = [
    "buikwe", "bukomansimbi", "butambala", "buvuma", "gomba", "kalangala", "kalungu", "kyankwanzi", "luwero", "lwengo", "lyantonde", "mityana", "mpigi",
    "nakaseke", "amuria", "budaka", "bududa", "bukedea", "bukwo", "bulambuli", "butaleja", "buyende", "kaliro", "kibuku", "kumi", "kween", "luuka", "manafwa",
    "namayingo", "namutumba", "ngora", "serere", "abim", "agago", "alebtong", "amolatar", "amudat", "amuru", "dokolo", "kaabong", "koboko", "kole", "lamwo",
    "maracha", "napak", "nwoya", "otuke", "oyam", "zombo", "buhweju", "buliisa", "ibanda", "isingiro", "kibaale", "kiruhura", "kiryandongo", "kyegegwa",
    "mitooma", "ntoroko", "rubirizi", "sheema",
]


def align_areas(df: DataFrame) -> DataFrame:
    """Areas of the map (``name_0..2``, normalised) brought into line with the score table.

    The rules in order; then districts of Malawi without "boma", "city" and "town"; then in
    Uganda areas that don't keep their name take their district's, and districts become
    regions. Nulls and other countries stay as they are.
    """
    df = apply_rules(df)
    malawi, uganda = F.coalesce(F.col("name_0") == "malawi", F.lit(False)), F.coalesce(F.col("name_0") == "uganda", F.lit(False))
    df = df.withColumn("name_2", F.when(malawi, F.regexp_replace("name_2", " (?:boma|city|town)", "")).otherwise(F.col("name_2")))
    df = df.withColumn("name_2", F.when(uganda & ~F.coalesce(F.col("name_2").isin(UGANDA_KEPT), F.lit(False)), F.col("name_1")).otherwise(F.col("name_2")))
    regions = F.create_map(*[F.lit(x) for pair in UGANDA_REGIONS.items() for x in pair])
    return df.withColumn("name_1", F.when(uganda, F.coalesce(F.try_element_at(regions, F.col("name_1")), F.col("name_1"))).otherwise(F.col("name_1")))


def rename_once(df: DataFrame, columns: Sequence[str], names: DataFrame, old: str = "old", new: str = "new") -> DataFrame:
    """Names replaced by a table of renamings in exactly one pass (a new name isn't looked up again); null stays."""
    for c in columns:
        table = names.select(F.col(old).alias("__old"), F.col(new).alias("__new"))
        df = df.join(table, df[c] == table["__old"], "left").withColumn(c, F.coalesce("__new", c)).drop("__old", "__new")
    return df
