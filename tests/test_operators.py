import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.functions import similarity as sim
from fieldloom.operators import baselines as B
from fieldloom.operators import dedupe as D
from fieldloom.operators import geo as G
from fieldloom.operators import joins as J
from fieldloom.operators import panel as P
from fieldloom.operators import statistics as S

PANEL = "admin0 string, admin1 string, admin2 string, period string, cs_score double"


def panel(spark, rows):
    return spark.createDataFrame([("x", "y", d, p, s) for d, p, s in rows], PANEL)


def test_targets(spark):
    rows = [("a", "201602", 2.0), ("a", "201603", None), ("a", "201604", None), ("a", "201606", 3.0), ("a", "201607", 66.0), ("a", "201610", 4.0), ("b", "201602", 1.0), ("b", "201603", None)]
    w = P.by_district()
    got = panel(spark, rows).select("admin2", "period", P.last_observed("cs_score", w).alias("l"), P.next_valid("cs_score", w).alias("n")).orderBy("admin2", "period").collect()
    assert [(r.l, r.n) for r in got] == [(2, 3), (2, 3), (2, 3), (3, 4), (66, 4), (4, None), (1, None), (1, None)]


def test_windows_stay_in_their_district(spark):
    df = spark.createDataFrame([(k, p, float(v)) for k in "ab" for p, v in zip(range(6), (1, 1, 2, 2, 5, 0))], "k string, p int, v double")
    w = P.by_district(["k"], "p")
    got = df.select("k", "p", P.rolling_before("v", 3, w).alias("s"), P.rolling_with("v", 3, w, least=2).alias("m"), P.mean_before("v", w).alias("b"), P.percent_change("v", w).alias("c")).orderBy("k", "p").collect()
    for k in (0, 6):
        assert [r.s for r in got[k : k + 6]] == [None, 1, 2, 4, 5, 9] and got[k].m is None and got[k].b is None and got[k].c is None
        assert got[k + 5].c == -1.0
    t = P.transitions_before(df, "v", "n", ["k"], "p").orderBy("k", "p").collect()
    assert [r.n for r in t[:6]] == [None, 1, 1, 2, 2, 3]
    assert [r.n for r in t[6:]] == [None, 1, 1, 2, 2, 3]


def test_total_between(spark):
    df = spark.createDataFrame([("x", str(i), o, v) for i, o, v in [(1, None, 9), (2, 1.0, 1), (3, None, 2), (4, None, 3), (5, 2.0, 4), (6, 1.0, 5), (7, None, 6)]], "k string, period string, o double, v int")
    got = P.total_between(df, "o", "v", "s", ["k"]).orderBy("period").collect()
    assert [r.s for r in got] == [None, None, None, None, 9, 5, None]


def test_scaffold_and_periods(spark):
    assert P.months(spark, "201602", "202402").count() == 97
    assert P.scaffold(spark.createDataFrame([("a",), ("a",), ("b",)], "k string"), P.months(spark, "202311", "202401")).count() == 6
    df = spark.createDataFrame([("202001",), ("202002",), ("202002",), ("202003",), (None,)], "period string")
    assert sorted(r.period for r in P.latest_periods(df, 1, skip=1).collect()) == ["202002", "202002"]


def test_outer_merge(spark):
    a = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (None, "y"), (4, "z")], "k int, v string")
    got = {(r.k, r.v_l, r.v_r, r.side) for r in J.outer_merge(a, b, ["k"], ("_l", "_r"), "side").collect()}
    assert got == {(1, "a", "x", "both"), (None, "b", "y", "both"), (3, "c", None, "left_only"), (4, None, "z", "right_only")}


def test_lookups(spark):
    df = spark.createDataFrame([(1, ["a", "z", "b", "a"]), (2, None), (3, [])], "id int, u array<string>")
    look = J.last_per_key(spark.createDataFrame([("a", 1, 5.0), ("a", 2, 6.0), ("b", 1, None)], "u string, o int, f double"), ["u"], ["o"])
    got = {r.id: r.f_list for r in J.map_array(df, "id", "u", look, "u", ["f"]).collect()}
    assert got == {1: [6.0, None, 6.0], 2: [], 3: []}
    assert {r.id: r.k for r in J.keep_known(df, "id", "u", look, "u", "k").collect()} == {1: ["a", "b", "a"], 2: [], 3: []}
    base = spark.createDataFrame([(None, "p", 1), ("C", "p", 2), (None, None, 3)], "c string, r string, i int")
    filled = J.fill_from_lookup(base, spark.createDataFrame([("p", "D"), (None, "E")], "r string, c string"), ["r"], "c").collect()
    assert {(r.i, r.c) for r in filled} == {(1, "D"), (2, "C"), (3, "E")}


def test_best_text_match_in_its_block(spark):
    left = spark.createDataFrame([(1, "x", "abc def"), (2, "x", "zzz"), (3, "y", "abc def")], "id int, b string, t string")
    right = spark.createDataFrame([(10, "x", "def abc"), (11, "x", "abc dex"), (12, "x", "def abc")], "k int, b string, e string")
    assert [tuple(r) for r in J.best_text_match(left, right, "b", "id", "t", "k", "e").collect()] == [(1, 10, 95.0)]


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_similar_sets_and_first_wins(spark):
    rng = random.Random(5)
    base = [frozenset(rng.sample(range(60), 12)) for _ in range(12)]
    sets = {}
    for i in range(120):
        s = set(rng.choice(base))
        for _ in range(rng.randrange(3)):
            s.discard(rng.choice(sorted(s)))
            s.add(rng.randrange(60))
        sets[i] = frozenset(s)
    df = spark.createDataFrame([(i, [str(x) for x in sorted(s)]) for i, s in sets.items()] + [(999, [])], "id int, items array<string>")
    want = {(a, b) for a, b in itertools.combinations(sets, 2) if jaccard(sets[a], sets[b]) >= 0.7}
    pairs = D.similar_sets(df, 0.7)
    assert {(r.a, r.b) for r in pairs.collect()} == want and want
    kept, dropped = [], set()
    for i in sorted(sets):
        (dropped.add if any((k, i) in want for k in kept) else kept.append)(i)
    got = {r.id: r.kept for r in D.first_wins(pairs).collect()}
    assert all(got.get(i, True) for i in kept) and not any(got[i] for i in dropped)


def test_similar_sets_keep_items_out_of_the_driver(spark, monkeypatch, tmp_path):
    texts = [" ".join(f"w{i}_{k}" for k in range(300)) for i in range(40)]
    spark.createDataFrame([(i, t + end) for i, t in enumerate(texts) for end in ("", " and more")], "id int, t string").select(F.monotonically_increasing_id().alias("id"), "t").write.parquet(f"{tmp_path}/t")
    plans, checkpoint = [], D.reliable_checkpoint
    planned = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    monkeypatch.setattr(D, "reliable_checkpoint", lambda df: plans.append(planned(df)) or checkpoint(df))
    sets = checkpoint(spark.read.parquet(f"{tmp_path}/t").select("id", D.shingles("t").alias("items")))
    pairs = D.similar_sets(sets, 0.8)
    plans.append(planned(pairs))
    assert pairs.count() == 40
    joins = [x for p in plans for x in re.findall(r"\w+Join [^\n]*", p)]
    assert [x.split()[0] for x in joins if "LeftSemi" not in x] == ["SortMergeJoin"] * 3  # only ids of pairs, up to a number, are broadcast
    member = D.deduplicate_by_shingles(spark.read.parquet(f"{tmp_path}/t"), "id", "t")
    assert [x.split()[0] for x in re.findall(r"\w+Join [^\n]*", planned(member)) if "[h#" in x] == ["SortMergeJoin"]
    assert sorted((r.n_links, r.is_kept) for r in member.collect()) == [(1, False)] * 40 + [(1, True)] * 40


def test_first_wins_chain(spark):
    def kept(pairs, **limits):
        got = {r.id: r.kept for r in D.first_wins(spark.createDataFrame(pairs, "a bigint, b bigint"), **limits).collect()}
        assert None not in got.values()
        return sorted(i for i in got if got[i])

    chain = [(i, i + 1) for i in range(450)]
    assert kept(chain) == list(range(0, 451, 2))
    assert kept(chain[:9] + [(9, 9), (3, 0), (20, 0), (20, 21)], one_task=3) == [0, 2, 4, 6, 8, 21]


def test_deduplicate(spark):
    words = [f"w{i}" for i in range(20)]
    text, near, other = " ".join(words), " ".join(words[:19] + ["zz"]), "quite another text of its own"
    rows = [(1, other, "k"), (2, text, "k"), (3, text, "k"), (4, near, "k"), (5, None, "k"), (6, "", "k"), (7, " ", "k"), (8, text.upper(), "k")]
    df = spark.createDataFrame(rows, "id int, t string, kept string")
    got = {r.id: r for r in D.deduplicate_by_similarity(df, "id", "t", 0.9).collect()}
    assert [i for i in got if got[i].is_kept] and {i for i in got if got[i].is_kept} == {1, 2, 5, 6, 7}
    assert got[3].class_id == 2 and got[8].class_id == 2 and got[2].n_links == 1 and got[4].n_links == 1
    assert D.deduplicate_by_similarity(df.limit(0), "id", "t").count() == 0
    assert {(r.a, r.b) for r in D.minhash_pairs(df, "id", "t").collect()} == {(2, 4)}
    assert {r.id for r in D.deduplicate_by_shingles(df, "id", "t", 0.5).filter("is_kept").collect()} == {1, 2, 5, 6, 7}


def test_minhash_recall(spark):
    rng = random.Random(9)
    rows = []
    for i in range(60):
        words = [f"v{rng.randrange(4000)}" for _ in range(60)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:57] + ["q1", "q2", "q3"]))]
    df = spark.createDataFrame(rows, "id int, t string")
    exact = {(r.a, r.b) for r in D.similar_sets(df.select("id", D.token_set("t").alias("items")), 0.85).collect()}
    got = {(r.a, r.b) for r in D.minhash_pairs(df, "id", "t").collect()}
    assert len(exact) >= 50 and got <= exact and len(got) >= 0.9 * len(exact)


def test_deduplicate_by_minhash(spark):
    rows = []
    for i in range(60):
        words = [f"v{i}_{k}" for k in range(60)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:56] + ["q1", "q2", "q3", "q4"]))]  # 0.875 alike: bands miss some
    df = spark.createDataFrame([*rows, (500, rows[0][1]), (501, "alone here"), (502, None)], "id int, t string")
    got = {r.id: r for r in D.deduplicate_by_minhash(df, "id", "t").collect()}
    assert sorted(got) == [*range(120), 500, 501, 502] and got[500].class_id == 0
    assert {i for i in got if got[i].is_kept} == {*range(0, 120, 2), 501, 502} and all(got[i].n_links == 1 for i in range(120))


def square(x, y, w):
    x, y, w = float(x), float(y), float(w)
    return [{"lon": a, "lat": b} for a, b in [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]]


def test_nearest_area(spark):
    areas = [(1, [square(0, 0, 1)]), (2, [square(1, 0, 1)]), (3, [square(10, 10, 2)])]
    df = spark.createDataFrame(areas, "poly_id bigint, geometry array<array<struct<lon:double,lat:double>>>")
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 0.5, 1.0), (3, 0.5, -0.2), (4, 9.0, 9.0), (5, None, 1.0), (6, 95.0, 1.0)], "id bigint, la double, lo double")
    for most, task in ((20_000, 200_000), (6, 2)):
        got = {r.id: r for r in G.nearest_area(pts, "id", "la", "lo", df, most_corners=most, points_per_task=task).collect()}
        assert [got[i].area_id for i in (1, 2, 3, 4)] == [1, 1, 1, 3] and got[1].distance_m == 0 and got[3].distance_m == pytest.approx(22263.9, rel=1e-3)
        assert got[5].area_id is None and got[6].area_id is None
    assert G.nearest_area(pts, "id", "la", "lo", df.limit(0)).filter("area_id is null").count() == 6
    rng = np.random.default_rng(4)
    rings = [(k, [np.r_[x + np.array([0, 2, 2, 0, 0.0])]], [y + np.array([0, 0, 2, 2, 0.0])]) for k, (x, y) in enumerate(rng.uniform(-60, 60, (90, 2)))]
    held = G._Areas(rings)
    x, y = G.web_mercator(rng.uniform(-70, 70, 500), rng.uniform(-70, 70, 500))
    at, d = held.nearest(x, y)
    every = np.array([held._distance(i, x, y) for i in range(90)])
    assert (d == every.min(axis=0)).all() and (at == every.argmin(axis=0)).all()
    parts = spark.createDataFrame([(1, [square(0, 0, 1), square(5, 5, 3)])], "i int, g array<array<struct<lon:double,lat:double>>>")
    assert parts.select(G.largest_part("g").alias("r")).first().r[0].lon == 5.0


def test_rules(spark):
    rows = [("cameroon", "Nord", "x"), ("kenya", "bungoma", "likuyani"), ("malawi", "zomba", "q"), (None, None, None), ("harare", "harare", "harare")]
    got = [tuple(r) for r in G.apply_rules(spark.createDataFrame(rows, "name_0 string, name_1 string, name_2 string")).collect()]
    assert got == [("cameroon", "north", "x"), ("kenya", "kakamega", "likuyani"), ("malawi", "southern", "q"), (None, None, None), ("harare", "harare", "harare urban")]
    rows = [("uganda", "apac", "oyam"), ("uganda", "apac", "maruzi"), ("uganda", "new", None), ("malawi", "lilongwe", "lilongwe city"), ("kenya", "kumi", "x city")]
    got = [tuple(r) for r in G.align_areas(spark.createDataFrame(rows, "name_0 string, name_1 string, name_2 string")).collect()]
    assert got == [("uganda", "northern", "oyam"), ("uganda", "northern", "apac"), ("uganda", "new", "new"), ("malawi", "central", "lilongwe"), ("kenya", "kumi", "x city")]
    scores = spark.createDataFrame([("yemen", "socotra", "a"), ("burundi", "b", "Muramvya")], "admin0 string, admin1 string, admin2 string")
    assert [tuple(r) for r in G.apply_rules(scores, G.SCORE_RULES).collect()] == [("yemen", "hadramaut", "a"), ("burundi", "b", "muramviya")]
    names = spark.createDataFrame([("a", "b"), ("b", "a")], "old string, new string")
    assert [r.n for r in G.rename_once(spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "n string"), ["n"], names).collect()] .count("a") == 1


def test_scores(spark):
    rng = random.Random(2)
    rows = [(float(rng.randrange(1, 4)), float(rng.randrange(0, 4))) for _ in range(200)]
    got = B.scores(spark.createDataFrame(rows, "actual double, predicted double")).first()
    labels = {x for r in rows for x in r}
    p = r = f = 0.0
    for k in labels:
        tp = sum(a == k == b for a, b in rows)
        n, c = sum(a == k for a, _ in rows), sum(b == k for _, b in rows)
        pk, rk = (tp / c if c else 0), (tp / n if n else 0)
        p, r, f = p + pk * n / 200, r + rk * n / 200, f + (2 * pk * rk / (pk + rk) if pk + rk else 0) * n / 200
    assert (got.precision, got.recall, got.f1) == (pytest.approx(p), pytest.approx(r), pytest.approx(f)) and got.accuracy == got.recall


def test_splits_use_no_later_rows(spark):
    df = panel(spark, [("a", f"20{y:02d}{m}", 2.0) for y in range(10, 22) for m in ("02", "06", "10")])
    got = B.rolling_splits(df, 3, 20).collect()
    assert len(got) == 60 and all(r.train_period < r.test_period for r in got)


def test_fixed_effects(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        a, b = int(rng.integers(6)), int(rng.integers(9))
        x = float(rng.normal() + a)
        rows.append((f"c{a}", f"p{b}", x, float(2.5 * x + a * 3 - b + rng.normal())))
    got = S.fixed_effects_slope(spark.createDataFrame(rows, "c string, p string, x double, y double"), "y", "x", "c", "p").first()
    design = np.array([[r[2], *[r[0] == f"c{i}" for i in range(6)], *[r[1] == f"p{i}" for i in range(1, 9)]] for r in rows], float)
    assert got.slope == pytest.approx(np.linalg.lstsq(design, np.array([r[3] for r in rows]), rcond=None)[0][0], abs=1e-6) and got.n == 300


def test_statistics(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y"), ("b", None)], "k string, v string")
    assert {tuple(r) for r in S.mode_of(df, ["k"], "v").collect()} == {("a", "x"), ("b", "y")}
    assert S.sample_rows(df, 2).count() == 2 and S.sample_rows(df, 2).collect() == S.sample_rows(df, 2).collect()
    many = spark.range(5000).select(F.col("id"), (F.col("id") % 3).alias("s"))
    shares = [r.m for r in S.stratified_split(many, "id", "s").groupBy("s").agg(F.avg("is_train").alias("m")).collect()]
    assert all(abs(m - 0.8) < 0.04 for m in shares)
    t = B.trimmed_summary(spark.createDataFrame([("m", x) for x in (1.0, 2.0, 3.0, 10.0)], "model string, v double"), "v", ["model"]).first()
    assert (t.mean, t.trimmed_mean, t.range) == (4.0, 2.5, 9.0)


def test_weighted_ratio():
    assert sim.ratio("this is a test", "this is a test!") == pytest.approx(96.55, abs=0.01) and sim.partial("this is a test", "this is a test!") == 100
    assert sim.weighted("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 95 and sim.by_words("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert sim.weighted("", "a") == 0 and sim.weighted("same", "same") == 100 and sim.weighted("north kelimot", "kelimot") == pytest.approx(90) and 0 < sim.weighted("abc", "xbz") < 50
    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(8))) for _ in range(2))
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = d[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(d[i - 1][j], d[i][j - 1])
        assert sim.common(a, b) == d[-1][-1]


def test_best_text_match(spark):
    rng = random.Random(2)
    words = ["north", "kelimot", "bar", "baruvan", "old", "dola"]
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(1, 4)))
    left = [(i, rng.choice("xyz"), text()) for i in range(60)] + [(100, None, "old"), (101, "x", None), (102, "x", ""), (103, "nowhere", "old"), (0, "x", "old bar")]
    right = [(i, rng.choice("xy"), text()) for i in range(40)] + [(40, "x", None), (3, None, "old")]
    best = lambda **o: sorted(tuple(r) for r in J.best_text_match(spark.createDataFrame(left, "id int, c string, t string"), spark.createDataFrame(right, "u int, c string, e string"), "c", "id", "t", "u", "e", **o).collect())
    want = []
    for i, c, t in left:
        s = [(round(sim.weighted(t, e), 6), -u) for u, d, e in right if c and t and c == d and e]
        if s and max(s)[0] >= 50:
            want.append((i, -max(s)[1], max(s)[0]))
    assert best() == sorted(want) and best(entries_per_task=7, names_per_task=5) == sorted(want) and len(want) > 30


def test_window_dedupe(spark):
    rng = random.Random(7)
    base = [" ".join(f"w{rng.randrange(400)}" for _ in range(30)) for _ in range(12)]
    rows = []
    for i in range(300):
        t = rng.choice(base).split()
        if rng.random() < 0.5:
            t[rng.randrange(30)] = "new"
        rows.append((i * 3, rng.choice([" ".join(t)] * 9 + [None, "", " "])))
    got = {r.id: r.is_kept for r in D.deduplicate_in_window(spark.createDataFrame(rows, "id int, t string").repartition(5), "id", "t", 0.9, 20).collect()}
    kept = {}
    for n, (i, t) in enumerate(rows):
        s = set((t or "").split())
        kept[i] = not any(kept[j] and s and (o := set((u or "").split())) and len(s & o) / len(s | o) >= 0.9 for j, u in rows[max(0, n - 19) : n])
    assert got == kept and 0 < sum(kept.values()) < 300
    assert D.deduplicate_in_window(spark.createDataFrame([], "id int, t string"), "id", "t").count() == 0
    assert [r.place for r in D.numbered(spark.range(100).repartition(7), "id").orderBy("id").collect()] == list(range(100))


def test_summary_and_patterns(spark):
    df = spark.createDataFrame([(1.0, 2, "a"), (3.0, None, "b"), (None, 4, "c"), (8.0, 6, "d")], "x double, y int, s_mean string")
    got = {r.column: r for r in S.describe(df, ["x", "y"]).collect()}
    assert (got["x"]["count"], got["x"].mean, got["x"].p50, got["x"].max) == (3, 4.0, 3.0, 8.0) and got["y"].p25 == 3.0
    assert S.drop_matching(df, "_(mean|std)$", "^y").columns == ["x"]
    assert S.fixed_effects_slope(df.limit(0).withColumn("a", F.lit("p")), "x", "y", "s_mean", "a").first().n == 0
    with pytest.raises(ValueError):
        S.fixed_effects_slope(spark.createDataFrame([("a", "b", 1.0, 2.0), ("c", "d", 2.0, 1.0)], "p string, q string, x double, y double"), "y", "x", "p", "q", most_levels=1)
