import glob
import math
import os

import duckdb
import pytest

from fieldloom.llm import catalog

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="needs the test tables")


def plain(x):
    return None if x is None or isinstance(x, float) and math.isnan(x) else round(x, 6) + 0.0 if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{ROOT}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    df = catalog.QUERIES[name](spark, ROOT)
    out = con.execute(catalog.SQL[name])
    columns = [c[0] for c in out.description]
    assert sorted(df.columns) == sorted(columns)
    order = [columns.index(c) for c in df.columns]
    want = sorted((tuple(plain(r[i]) for i in order) for r in out.fetchall()), key=repr)
    assert sorted((tuple(plain(v) for v in r) for r in df.collect()), key=repr) == want and want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_runs(spark, name):
    rows = catalog.QUERIES[name](spark, ROOT).collect()
    assert rows and len(set(rows)) == len(rows)


def test_mixture_and_report_agree(spark):
    drawn, shares, margins = catalog.p9_mixture(spark, ROOT).collect(), catalog.p9_shares(spark, ROOT).collect(), catalog.p9_margins(spark, ROOT).collect()
    for r in shares:
        mine = [d for d in drawn if d.source == r.source]
        assert r.tokens_drawn == sum(d.tokens * d.copies for d in mine) and r.records_drawn == len(mine) and all(d.copies <= r.max_repeats for d in mine)
    for axis in ("lang", "topic"):
        assert abs(sum(m.share_reached for m in margins if m.axis == axis) - 1) < 1e-6
