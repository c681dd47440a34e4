import glob
import math
import os

import duckdb
import pytest

from fieldloom.plans import catalog

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="needs the test tables")


def plain(x):
    if x is None:
        return None
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6) + 0.0
    if isinstance(x, (list, tuple)):
        return tuple(plain(v) for v in x)
    return x


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for path in glob.glob(f"{ROOT}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalog.queries()[name](spark, ROOT)
    out = duck.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in out.description]
    assert sorted(df.columns) == sorted(columns)
    order = [columns.index(c) for c in df.columns]
    want = sorted((tuple(plain(r[i]) for i in order) for r in out.fetchall()), key=repr)
    assert sorted((tuple(plain(v) for v in r) for r in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_runs(spark, name):
    df = catalog.queries()[name](spark, ROOT)
    assert df.columns and df.count() >= 0


def test_flagship(spark):
    assert catalog.flagship(spark, ROOT).count() > 0


def test_nearest_area_of_every_event(spark):
    events = spark.read.parquet(f"{ROOT}/gdelt_events.parquet")
    got = catalog.queries()["nearest_area"](spark, ROOT)
    ids = lambda df: {r[0] for r in df.select("globaleventid").collect()}
    assert ids(got) == ids(events)
    placed = events.filter("abs(actiongeo_lat) <= 90 and abs(actiongeo_long) <= 180 and not (actiongeo_lat = 0 and actiongeo_long = 0)")
    assert ids(got.filter("area_id is not null")) == ids(placed) and ids(got.filter("area_id is null"))


def test_minhash_dedupe_of_every_document(spark):
    got = [r.doc_id for r in catalog.queries()["minhash_dedupe"](spark, ROOT).select("doc_id").collect()]
    assert sorted(got) == sorted(r[0] for r in spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id").collect())
