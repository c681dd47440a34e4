import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from fieldloom.operators.rolling import latest_revisions, trailing_totals

SCHEMA = "k string, d date, a int, b int, extra string"


def brute(rows, windows):
    sums, out = {}, {}
    for k, d, a, b, _ in rows:
        if k is not None and d is not None:
            x = sums.setdefault(k, {}).setdefault(d, [0, 0])
            x[0] += a or 0
            x[1] += b or 0
    for k, days in sums.items():
        d = min(days)
        while d <= max(days):
            for w in windows:
                past = [days[p] for i in range(w) if (p := d - dt.timedelta(i)) in days]
                out[k, d, w] = (sum(x[0] for x in past), sum(x[1] for x in past))
            d += dt.timedelta(1)
    return out


def test_totals_equal_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(400):
        k = rng.choice(["hot", "hot", "x", "y", None])
        d = None if rng.random() < 0.03 else dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(3) * 40 + rng.randrange(12))
        rows.append((k, d, rng.choice([None, 0, 1, 7]), rng.choice([None, 2]), "e"))
    got = trailing_totals(spark.createDataFrame(rows, SCHEMA), "k", "d", ["a", "b"], (3, 7)).collect()
    want = brute(rows, (3, 7))
    assert len(got) * 2 == len(want)
    for r in got:
        for w in (3, 7):
            assert (r[f"a_{w}"], r[f"b_{w}"]) == want[r.k, r.d, w]
            assert abs(r[f"a_{w}_avg"] - want[r.k, r.d, w][0] / w) < 1e-12


def test_empty(spark):
    assert trailing_totals(spark.createDataFrame([], SCHEMA), "k", "d", ["a"]).count() == 0


def test_latest_revision_ties_nulls_and_repeats(spark):
    rows = [(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (1, 2, "c"), (2, None, "d"), (2, 0, "e"), (None, 1, "f"), (None, 1, "f")]
    got = latest_revisions(spark.createDataFrame(rows, "id int, v int, x string"), "id", "v").collect()
    assert sorted((r.id or 0, r.x) for r in got) == [(0, "f"), (0, "f"), (1, "c"), (2, "e")]


def test_fractions_and_decimals(spark):
    rows = [("a", "2020-01-01", 0.9, Decimal("0.90"), 2), ("a", "2020-01-02", 2.7, Decimal("2.70"), None), ("a", "2020-01-12", float("nan"), None, 5), ("a", "2020-01-13", 0.1, Decimal("0.10"), 1)]
    df = spark.createDataFrame(rows, "e string, d string, x double, y decimal(9,2), z int").withColumn("d", F.to_date("d"))
    got = trailing_totals(df, "e", "d", ["x", "y", "z"], (7,)).orderBy("d").collect()
    assert [r.x_7 for r in got[:2]] == [0.9, 3.6] and [r.y_7 for r in got[:2]] == [Decimal("0.90"), Decimal("3.60")] and [r.z_7 for r in got[:2]] == [2, 2]
    assert got[8].x_7 == 0.0 and got[8].y_7 == 0 and got[-1].x_7 == 0.1 and got[-1].z_7 == 6 and abs(got[1].y_7_avg - 3.6 / 7) < 1e-12
    assert dict(trailing_totals(df, "e", "d", ["x", "y", "z"], (7,), averages=False).dtypes)["z_7"] == "bigint"
