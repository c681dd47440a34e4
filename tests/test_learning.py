import random

import pytest
from pyspark.sql import functions as F

from fieldloom.operators import learning as L
from fieldloom.operators.aggregates import collect_features, guarded


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = []
    for i in range(240):
        k, x = rng.choice(["a", "b", None]), rng.random()
        data.append((i, k, None if i % 40 == 0 else x, 1.0 if (x > 0.5) ^ (k == "a") else 2.0))
    return spark.createDataFrame(data + [(999, "a", 0.1, None)], "id int, k string, x double, y double").cache()


def test_forest_and_importances(spark, rows):
    model = L.fit_classifier(rows.filter("id % 4 <> 0"), "y", ["k"], ["x"], "forest")
    unseen = rows.filter("id % 4 = 0").withColumn("k", F.when(F.col("id") == 8, "new").otherwise(F.col("k")))
    got = L.predict(model, unseen, ["k"], ["x"])
    assert got.count() == unseen.count() and got.filter("y is not null").agg(F.avg((F.col("predicted") == F.col("y")).cast("int"))).first()[0] > 0.75
    only = L.fit_classifier(rows, "y", [], ["x"], "forest")
    assert [r.feature for r in L.importances(only, ["x"], spark).collect()] == ["x"]
    with pytest.raises(ValueError):
        L.fit_classifier(rows.filter("y is null"), "y", ["k"], ["x"])


def test_grid(rows):
    best = L.grid_search(rows, "y", ["k"], ["x"], depths=(1, 4), trees=(3,), folds=2)
    with pytest.raises(ValueError):
        L.grid_search(rows.limit(5), "y", ["k"], ["x"], folds=2)
    assert {(r.depth, r.trees) for r in L.grid_scores(best, rows.sparkSession).collect()} == {(1, 3), (4, 3)}
    assert len(best.avgMetrics) == 2 and best.bestModel.stages[-1].getMaxDepth() == 4


def test_text_head_and_topics(spark):
    df = spark.createDataFrame([(i, ("crops failed " if i % 2 else "roads closed ") * 3, "high" if i % 2 else "low") for i in range(40)] + [(99, None, "low")], "id int, t string, l string")
    got = L.predict_label(L.fit_text_head(df, "t", "l", 1 << 8), df, "t", "p").collect()
    assert all(r.p == r.l for r in got if r.t) and [r.p for r in got if not r.t] == [None]
    few = spark.createDataFrame([([0.0, 1.0],)], "e array<float>")
    assert L.topics(few, "e").first().topic == -1
    many = spark.createDataFrame([([float(i % 2) * 9, 0.1 * i / 60],) for i in range(60)], "e array<float>")
    assert L.topics(many, "e", k=2).select("topic").distinct().count() == 2


def test_collect_features(spark):
    df = spark.createDataFrame([("a", 2, "x", [1], 1.0), ("a", 1, None, None, None), ("b", 1, "z", [3, 4], None), (None, 1, "q", [], 2.0)], "k string, o int, s string, l array<int>, v double")
    got = {r.k: r for r in collect_features(df, ["k"], ["o"], ["s", "l", "missing"], ["v"], ["v"]).collect()}
    assert got["a"].s_list == [None, "x"] and got["a"].l_list == [1] and got["a"].v_sum == 1.0 and got["b"].v_sum == 0.0 and got["b"].v_mean is None and got[None].l_list == []


def test_guarded_scores_hold_nothing_of_the_tested_period(spark):
    df = spark.createDataFrame([("a", "1", 2.0), ("a", "2", 66.0), ("a", "3", 4.0), ("b", "3", 1.0)], "k string, period string, s double")
    got = {(r.k, r.period): r.known_score for r in guarded(df, ["k"], "s", "period", "3").collect()}
    assert got == {("a", "1"): 2.0, ("a", "2"): 66.0, ("a", "3"): 2.0, ("b", "3"): None}


def test_save_and_load(spark, rows, tmp_path):
    model = L.fit_classifier(rows, "y", ["k"], ["x"], "forest")
    L.save_model(model, str(tmp_path / "m"))
    L.save_model(model, str(tmp_path / "m"))
    again = L.load_model(str(tmp_path / "m"))
    got = [sorted((r.id, r.predicted) for r in L.predict(m, rows, ["k"], ["x"]).collect()) for m in (model, again)]
    assert got[0] == got[1]


def test_chunk_votes(spark):
    train = spark.createDataFrame([(w, k, f) for w, k, f in [("war attack", "a", "1"), ("rain storm", "b", "0"), ("food crop", "c", "0")] for _ in range(10)], "t string, k string, f string")
    heads, flags = {"kind": L.fit_text_head(train, "t", "k", 1 << 8)}, {"flag": L.fit_text_head(train, "t", "f", 1 << 8)}
    texts = [(1, "war attack " * 4 + "rain storm " * 2), (2, "rain storm " * 4 + "war attack"), (3, None), (4, " "), (5, "food crop")]
    got = {r.id: tuple(r)[1:] for r in L.chunk_votes(spark.createDataFrame(texts, "id int, t string"), "id", "t", heads, flags, size=2, stride=2).collect()}
    assert got == {1: ("a", 1), 2: ("b", 1), 3: (None, 0), 4: (None, 0), 5: ("c", 0)}
