"""Queries over models: forecasts of scores, text heads, topics. Seeded; checked by rows and by tests."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions import constants as K
from fieldloom.functions.arrays import parse_text_list
from fieldloom.operators import baselines as B
from fieldloom.operators import learning as L
from fieldloom.operators import panel as P
from fieldloom.operators import statistics as S
from fieldloom.plans.panels import KEYS, district_panel
from fieldloom.session import reliable_checkpoint, table

CATEGORIES = ["admin0", "admin1"]
NUMBERS = ["score_last", "articles", "mentions", "articles_3"]


def features(spark: SparkSession, root: str) -> DataFrame:
    """Panel rows with the target (next score) and features known at the row's period only."""
    w = P.by_district()
    p = district_panel(spark, root).select(
        *KEYS, "period", "articles", "mentions", P.last_observed("cs_score", w).alias("score_last"), P.next_valid("cs_score", w).alias("target"), P.rolling_with("articles", 3, w).alias("articles_3")
    )
    return p.filter(F.col("score_last").isin(K.VALID_SCORES) & F.col("target").isNotNull())


def _forecast(spark: SparkSession, root: str, model: str) -> DataFrame:
    """Scores of a model and of the last observed score on the latest periods, trained on earlier ones.

    Up to three periods are tested, fewer where the panel has fewer than six; a panel of
    less than two periods has nothing to test and gives no row.
    """
    data = features(spark, root)
    periods = [r.period for r in data.select("period").distinct().orderBy(F.desc("period")).limit(6).collect()]
    if len(periods) < 2:
        return B.scores(data.limit(0).select(F.col("target").alias("actual"), F.col("score_last").alias("predicted"), F.lit(model).alias("model")), ["model"])
    cut = periods[min(3, len(periods) // 2) - 1]
    train, test = data.filter(F.col("period") < cut), data.filter(F.col("period") >= cut)
    fitted = L.fit_classifier(train, "target", CATEGORIES, NUMBERS, model)
    predicted = L.predict(fitted, test, CATEGORIES, NUMBERS).select(F.col("target").alias("actual"), F.col("predicted").cast("double").alias("predicted"))
    naive = test.select(F.col("target").alias("actual"), F.col("score_last").alias("predicted"))
    return B.scores(predicted.withColumn("model", F.lit(model)), ["model"]).unionByName(B.scores(naive.withColumn("model", F.lit("last_score")), ["model"]))


def model_logistic(spark: SparkSession, root: str) -> DataFrame:
    return _forecast(spark, root, "logistic")


def model_forest(spark: SparkSession, root: str) -> DataFrame:
    return _forecast(spark, root, "forest")


def model_boosted(spark: SparkSession, root: str) -> DataFrame:
    return _forecast(spark, root, "boosted")


def model_grid(spark: SparkSession, root: str) -> DataFrame:
    """Mean weighted F1 over two folds of each setting of a forest; no row with fewer than ten labelled rows a fold."""
    data = features(spark, root)
    if data.count() < 20:
        return spark.createDataFrame([], "depth int, trees int, f1 double")
    return L.grid_scores(L.grid_search(data, "target", CATEGORIES, NUMBERS, depths=(4, 8), trees=(10, 20), folds=2), spark).select("depth", "trees", F.round("f1", 6).alias("f1"))


def text_votes(spark: SparkSession, root: str) -> DataFrame:
    """Impact, urgency and resources of every labelled text, voted by its chunks; three heads fitted on the training side."""
    t = S.stratified_split(table(spark, root, "labelled_text").select("text_id", "clean_text", "impact_type", "urgency", "resource"), "text_id", "urgency")
    train = t.filter("is_train = 1")
    held = parse_text_list(F.coalesce("resource", F.lit("")))
    flags = [F.array_contains(held, r).cast("int").cast("string").alias(f"resource_{r}") for r in K.RESOURCE_LABELS]
    laid = reliable_checkpoint(train.select("clean_text", "impact_type", "urgency", *flags))
    both = laid.agg(*[F.count_distinct(c).alias(c) for c in laid.columns[1:]]).first().asDict()
    with ThreadPoolExecutor(4) as pool:  # the fits are many small jobs
        fitted = dict(pool.map(lambda c: (c, L.fit_text_head(laid, "clean_text", c, 1 << 12)), [c for c, n in both.items() if n > 1]))
    heads = {c: m for c, m in fitted.items() if not c.startswith("resource_")}
    return L.chunk_votes(t, "text_id", "clean_text", heads, {c: m for c, m in fitted.items() if c not in heads})


def improvement(spark: SparkSession, root: str) -> DataFrame:
    """What the model gains on the last score, per measure."""
    s = _forecast(spark, root, "logistic")
    a, b = s.filter("model = 'logistic'"), s.filter("model = 'last_score'")
    wide = a.select(F.lit(1).alias("k"), *[F.col(c).alias(f"m_{c}") for c in ("accuracy", "f1")]).join(b.select(F.lit(1).alias("k"), "accuracy", "f1"), "k")
    return wide.select(*[F.round(F.col(f"m_{c}") - F.col(c), 9).alias(f"{c}_gain") for c in ("accuracy", "f1")])


def forest_importances(spark: SparkSession, root: str) -> DataFrame:
    data = features(spark, root)
    return L.importances(L.fit_classifier(data, "target", [], NUMBERS, "forest"), NUMBERS, spark)


def text_head(spark: SparkSession, root: str) -> DataFrame:
    """Predicted urgency of labelled texts, with the side of the stratified split."""
    t = S.stratified_split(table(spark, root, "labelled_text").filter(F.col("urgency").isNotNull()).select("text_id", "clean_text", "urgency"), "text_id", "urgency")
    model = L.fit_text_head(t.filter("is_train = 1"), "clean_text", "urgency")
    return L.predict_label(model, t, "clean_text", "predicted").select("text_id", "is_train", "urgency", "predicted")


def embedding_topics(spark: SparkSession, root: str) -> DataFrame:
    return L.topics(table(spark, root, "embeddings"), "embedding").select("vec_id", "label", "topic")


QUERIES = {"model_logistic": model_logistic, "model_forest": model_forest, "model_boosted": model_boosted, "model_grid": model_grid, "text_votes": text_votes, "model_improvement": improvement, "forest_importances": forest_importances, "text_head": text_head, "embedding_topics": embedding_topics}
SQL: dict[str, str] = {}
