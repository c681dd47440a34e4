"""Feature encoding and models on pyspark.ml: scaled, one-hot features, classifiers, importances, text heads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, IDF, MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer, Tokenizer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.text import token_windows
from fieldloom.operators.baselines import balanced_weights
from fieldloom.operators.statistics import any_of, mode_of
from fieldloom.session import reliable_checkpoint


def encoder(categories: Sequence[str], numbers: Sequence[str], scale: str | None = "minmax") -> list:
    """Stages to ``features``: categories one-hot (unseen ones get none), numbers scaled; fitted on training rows only.

    One-hot vectors are sparse, so thousands of districts cost nothing per row.
    """
    indexed, hot = [f"__{c}_i" for c in categories], [f"__{c}_v" for c in categories]
    stages: list = []
    if categories:
        stages += [StringIndexer(inputCols=list(categories), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"), OneHotEncoder(inputCols=indexed, outputCols=hot, handleInvalid="keep")]
    if numbers:
        stages.append(VectorAssembler(inputCols=list(numbers), outputCol="__raw", handleInvalid="keep"))
        if scale == "minmax":
            stages.append(MinMaxScaler(inputCol="__raw", outputCol="__num"))
        elif scale == "standard":
            stages.append(StandardScaler(inputCol="__raw", outputCol="__num", withMean=True))
    last = [*(["__num" if scale else "__raw"] if numbers else []), *hot]
    return [*stages, VectorAssembler(inputCols=last, outputCol="features", handleInvalid="keep")]


#: Training rows of one partition, about.
ROWS_PER_PART = 50_000
MODELS = {
    "logistic": lambda label, weight, seed: LogisticRegression(labelCol=label, weightCol=weight, family="multinomial", maxIter=50),
    "forest": lambda label, weight, seed: RandomForestClassifier(labelCol=label, weightCol=weight, numTrees=50, maxDepth=8, seed=seed),
    "boosted": lambda label, weight, seed: OneVsRest(classifier=GBTClassifier(maxIter=10, maxDepth=4, seed=seed), labelCol=label, weightCol=weight),
}


def with_weights(df: DataFrame, label: str) -> DataFrame:
    """``df`` with ``weight`` balanced over the labels (one row per label is joined)."""
    return df.join(F.broadcast(balanced_weights(df, label).select(label, "weight")), label)


def fit_classifier(train: DataFrame, label: str, categories: Sequence[str], numbers: Sequence[str], model: str = "logistic", scale: str | None = "minmax", seed: int = 42) -> PipelineModel:
    """A fitted pipeline whose ``predicted`` is a label. Null numbers count as 0, null categories as a category of their own; null labels are left out. Raises ``ValueError`` without a labelled row."""
    stages = encoder(categories, numbers, scale)
    ready = _ready(train.filter(F.col(label).isNotNull()), categories, numbers)
    if ready.isEmpty():
        raise ValueError("there is no labelled row to learn from")
    ready = _laid(with_weights(ready, label).withColumn("__label", F.col(label).cast("double")))
    return Pipeline(stages=[*stages, MODELS[model]("__label", "weight", seed)]).fit(ready)


def grid_search(train: DataFrame, label: str, categories: Sequence[str], numbers: Sequence[str], depths: Sequence[int] = (4, 8), trees: Sequence[int] = (20, 50), folds: int = 3, seed: int = 42):
    """The best forest of a grid by weighted F1 over ``folds`` folds; the fitted cross-validator. Raises ``ValueError`` for fewer than ten labelled rows a fold, of which some fold may hold none."""
    forest = RandomForestClassifier(labelCol="__label", weightCol="weight", seed=seed)
    grid = ParamGridBuilder().addGrid(forest.maxDepth, list(depths)).addGrid(forest.numTrees, list(trees)).build()
    pipeline = Pipeline(stages=[*encoder(categories, numbers), forest])
    ready = _laid(with_weights(_ready(train.filter(F.col(label).isNotNull()), categories, numbers), label).withColumn("__label", F.col(label).cast("double")))
    if ready.count() < 10 * folds:
        raise ValueError("too few labelled rows for the folds")
    rated = MulticlassClassificationEvaluator(labelCol="__label", metricName="f1")
    return CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=rated, numFolds=folds, seed=seed).fit(ready)


def grid_scores(searched, spark) -> DataFrame:
    """``depth``, ``trees``, ``f1`` (mean over the folds) of each setting of a ``grid_search``."""
    rows = [(*(int(v) for _, v in sorted((p.name, v) for p, v in setting.items())), float(m)) for setting, m in zip(searched.getEstimatorParamMaps(), searched.avgMetrics)]
    return spark.createDataFrame(rows, "depth int, trees int, f1 double")


def save_model(model: PipelineModel, path: str) -> None:
    """The fitted pipeline, encoders and labels with it, in a folder; what was there is replaced."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _laid(df: DataFrame) -> DataFrame:
    """``df`` written once, as an estimator goes over its rows many times, in parts of some size."""
    held = reliable_checkpoint(df)
    return held.coalesce(max(1, -(-held.count() // ROWS_PER_PART)))


def _ready(df: DataFrame, categories: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    return df.na.fill("(none)", list(categories)).na.fill(0, list(numbers))


def predict(model: PipelineModel, df: DataFrame, categories: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    return model.transform(_ready(df, categories, numbers)).withColumnRenamed("prediction", "predicted").drop("features", "rawPrediction", "probability", *[c for c in ("__raw", "__num") if numbers], *[f"__{c}_i" for c in categories], *[f"__{c}_v" for c in categories])


def importances(model: PipelineModel, names: Sequence[str], spark, least: float = 0.0) -> DataFrame:
    """``feature``, ``importance`` of a forest, the greatest first."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(names[i] if i < len(names) else f"feature_{i}", float(v)) for i, v in enumerate(values) if v > least]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def fit_text_head(df: DataFrame, text: str, label: str, features: int = 1 << 14) -> PipelineModel:
    """TF-IDF and logistic regression for one label of a text: stands in for a fine-tuned language model, with the same output."""
    ready = _laid(df.filter(F.col(text).isNotNull() & F.col(label).isNotNull()).select(label, F.col(text).alias("__text")))
    stages = [
        StringIndexer(inputCol=label, outputCol="__label", stringOrderType="alphabetAsc"), Tokenizer(inputCol="__text", outputCol="__t"),
        HashingTF(inputCol="__t", outputCol="__tf", numFeatures=features), IDF(inputCol="__tf", outputCol="features"), LogisticRegression(labelCol="__label", maxIter=10),
    ]
    return Pipeline(stages=stages).fit(ready)


def _predicted(model: PipelineModel, df: DataFrame, text: str, out: str) -> DataFrame:
    names = F.array(*[F.lit(x) for x in model.stages[0].labels])
    scored = df.withColumn("__text", F.col(text))
    for stage in model.stages[1:]:
        scored = stage.transform(scored)
    return scored.withColumn(out, F.get(names, F.col("prediction").cast("int"))).select(*df.columns, out)


def predict_label(model: PipelineModel, df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the label of highest probability; null for null texts."""
    known = _predicted(model, df.filter(F.col(text).isNotNull()), text, out)
    return known.unionByName(df.filter(F.col(text).isNull()), allowMissingColumns=True)


def chunk_votes(df: DataFrame, key: str, text: str, heads: dict[str, PipelineModel], flags: dict[str, PipelineModel] | None = None, size: int = 512, stride: int = 256) -> DataFrame:
    """One row per text: for each of ``heads`` the label most of its chunks have (the smallest on a tie), for each of ``flags`` 1 if a chunk has the label ``1``.

    Chunks are windows of ``size`` words, one starting at every ``stride``-th. Null and blank
    texts have null labels and flags of 0. Chunks of a text are brought together by its key
    with what was predicted only; a very long text has many chunks, but they're counted, not
    collected.
    """
    words = F.filter(F.split(F.regexp_replace(text, r"\s+", " "), " "), lambda w: w != "")
    chunks = df.select(key, F.posexplode(token_windows(words, size, stride)).alias("chunk", "w")).select(key, F.array_join("w", " ").alias("__text"))
    flags = flags or {}
    for name, model in {**heads, **flags}.items():
        chunks = _predicted(model, chunks, "__text", name)
    chunks = reliable_checkpoint(chunks.drop("__text"))
    out = df.select(key).distinct()
    for name in heads:
        out = out.join(mode_of(chunks, [key], name), key, "left")
    if flags:
        out = out.join(any_of(chunks.select(key, *[(F.col(n) == "1").cast("int").alias(n) for n in flags]), [key], list(flags)), key, "left")
    return out.select(key, *heads, *[F.coalesce(n, F.lit(0)).alias(n) for n in flags])


def topics(df: DataFrame, embedding: str, k: int = 10, least: int = 50, seed: int = 42) -> DataFrame:
    """``df`` with ``topic`` by k-means on embeddings; -1 for all where there are fewer than ``least`` rows."""
    if df.limit(least).count() < least:
        return df.withColumn("topic", F.lit(-1))
    ready = df.withColumn("__v", array_to_vector(F.col(embedding).cast("array<double>")))
    return KMeans(featuresCol="__v", predictionCol="topic", k=k, seed=seed).fit(ready).transform(ready).drop("__v")


def topic_label(words: str, lists: dict[str, Sequence[str]], otherwise: str = "Other"):
    """The last list of ``lists`` of which a word stands in the array; later lists override earlier ones."""
    out = F.lit(otherwise)
    for name, terms in lists.items():
        out = F.when(F.arrays_overlap(F.col(words), F.array(*[F.lit(t) for t in terms])), F.lit(name)).otherwise(out)
    return out
