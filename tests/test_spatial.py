import math
import random

import numpy as np
import pytest

from fieldloom.operators.spatial import Cells, VantageTree, great_circle_km, locate

POINTS = "id bigint, la double, lo double, lat string"
SITES = "site_id bigint, lat double, lon double"
REGIONS = "poly_id bigint, geometry array<array<struct<lon:double,lat:double>>>, kind string"


def far(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(h))


def enclosed(lat, lon, rings):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > lat) != (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def square(x, y, w):
    x, y, w = float(x), float(y), float(w)
    return [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]


@pytest.mark.parametrize("blocks", [(200_000, 20_000), (37, 5)])
def test_equal_to_brute_force(spark, blocks):
    rng = random.Random(3)
    points = [(i, rng.uniform(-80, 80), rng.uniform(-180, 180), "x") for i in range(300)]
    points += [(1000 + i, 10.0 + rng.uniform(-1, 1), 20 + rng.uniform(-1, 1), "x") for i in range(400)]
    points += [(2000 + i, 10.25, 20.25, "hot") for i in range(300)] + [(5000, -40.0, 179.95, "x")]
    sites = [(i, 10 + rng.uniform(-1, 1), 20 + rng.uniform(-1, 1)) for i in range(60)] + [(100 + i, rng.uniform(-80, 80), rng.uniform(-180, 180)) for i in range(60)] + [(999, -40.0, -179.95)]
    regions = [(i, [square(19 + i / 4, 9 + i / 5, 0.6)]) for i in range(8)] + [(50, [square(0.0, 0.0, 40), square(10, 10, 5), square(60, -20, 9)]), (51, [square(-170, -75, 330)])]
    df = spark.createDataFrame(points, POINTS)
    got = locate(
        df, "id", "la", "lo", places=spark.createDataFrame(sites, SITES), radius_km=25.0, regions=spark.createDataFrame([(i, [[{"lon": x, "lat": y} for x, y in r] for r in g], "k") for i, g in regions], REGIONS),
        pivots=16, points_per_block=blocks[0], places_per_block=blocks[1], places_per_cell=2_000 if blocks[0] > 100 else 1,
    )
    want = {("near", p, s) for p, a, b, _ in points for s, c, d in sites if far(a, b, c, d) <= 25} | {("in", p, r) for p, a, b, _ in points for r, g in regions if enclosed(a, b, g)}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and {(k, i, r) for k, i, r in rows} == want and ("near", 5000, 999) in want


def test_missing_coordinates_and_empty_inputs(spark):
    bad = [(1, None, 1.0, ""), (2, 1.0, None, ""), (3, 91.0, 1.0, ""), (4, 1.0, -181.0, ""), (5, 0.0, 0.0, ""), (6, float("nan"), 1.0, ""), (None, 1.0, 1.0, ""), (7, 1.0, 1.0, ""), (7, 1.0, 1.0, "")]
    df = spark.createDataFrame(bad, POINTS)
    sites = spark.createDataFrame([(1, 1.0, 1.0), (1, 1.0, 1.0), (2, None, 1.0), (3, 0.01, 0.0)], SITES)
    assert [tuple(r) for r in locate(df, "id", "la", "lo", places=sites).collect()] == [("near", 7, 1)]
    assert locate(df, "id", "la", "lo", places=sites.limit(0)).count() == 0
    assert locate(df.limit(0), "id", "la", "lo", places=sites).count() == 0


def test_tree_with_reaches():
    rng = np.random.default_rng(0)
    lat, lon, reach = rng.uniform(-60, 60, 500), rng.uniform(-180, 180, 500), rng.uniform(0, 900, 500)
    lat[:40], lon[:40] = 5.0, 5.0
    qa, qo = rng.uniform(-60, 60, 200), rng.uniform(-180, 180, 200)
    p, o = VantageTree(lat, lon, reach).query(qa, qo)
    want = np.argwhere(great_circle_km(qa[:, None], qo[:, None], lat, lon) <= reach)
    assert sorted(zip(p, o)) == [tuple(x) for x in want]


@pytest.mark.parametrize("top", [1, 6, 500])
def test_every_near_pair_meets_in_one_cell(top):
    rng = np.random.default_rng(top)
    crowd = lambda n: (np.r_[rng.uniform(-89, 89, n), rng.normal(10, 0.5, n)], np.r_[rng.uniform(-180, 180, n), rng.normal(20, 0.5, n)])
    (lat, lon), (qa, qo) = crowd(300), crowd(400)
    reach = rng.uniform(0, 120, len(lat))
    cells = Cells(np.stack([lat, lon], 1)[rng.permutation(len(lat))[:150]], top)
    assert sorted(np.concatenate(cells.under)) == list(range(150))
    own, copies = cells.nearest(qa, qo), cells.reached(lat, lon, reach)
    assert len(copies) == len(lat) and all(len(c) == len(set(c)) >= 1 for c in copies) and np.mean([len(c) for c in copies]) < 30
    for q, p in np.argwhere(great_circle_km(qa[:, None], qo[:, None], lat, lon) <= reach):
        assert own[q] in copies[p]
