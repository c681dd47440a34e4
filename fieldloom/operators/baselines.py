"""Naive forecasts and their scores, as plain joins and aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.operators.panel import DISTRICT


def period_back(period: str, months: int):
    """The period ``months`` before, as text ``yyyyMM``; null for texts that aren't periods."""
    n = F.col(period).try_cast("int")
    index = F.floor(n / 100) * 12 + (n % 100) - 1 - months
    return F.when(n.isNotNull(), F.lpad((F.floor(index / 12) * 100 + (index % 12) + 1).cast("bigint").cast("string"), 6, "0"))


def assessments(panel: DataFrame, score: str = "cs_score") -> DataFrame:
    """Distinct periods with a valid score, numbered from the first (``step``)."""
    from pyspark.sql import Window as W

    periods = panel.filter(F.col(score).between(1, 5) & F.col("period").isNotNull()).select("period").distinct()
    return periods.withColumn("step", F.row_number().over(W.orderBy("period")).cast("int"))  # a few hundred periods


def _by_steps(panel: DataFrame, score: str, backs: Sequence[int], keys: Sequence[str]) -> DataFrame:
    """Panel rows with a valid score and per entry of ``backs`` the district's score so many assessments before, 0 without one; one window, no join but that of the steps."""
    from pyspark.sql import Window as W

    steps = F.broadcast(assessments(panel, score))  # one row per period
    valid = panel.filter(F.col(score).between(1, 5)).join(steps, "period")
    w = W.partitionBy(*keys).orderBy("step")
    before = lambda back: F.coalesce(*[F.when(F.lag("step", j).over(w) == F.col("step") - back, F.lag(score, j).over(w)) for j in range(1, back + 1)], F.lit(0.0))
    return valid.select(*keys, "period", F.col(score).alias("actual"), *[before(k).alias(f"__{k}") for k in backs])


def previous_score(panel: DataFrame, score: str = "cs_score", back: int = 1, keys: Sequence[str] = DISTRICT) -> DataFrame:
    """Panel rows with a valid score and ``predicted``: the district's score ``back`` assessments before, 0 without one."""
    return _by_steps(panel, score, [back], keys).withColumnRenamed(f"__{back}", "predicted")


def same_period_last_year(panel: DataFrame, score: str = "cs_score", keys: Sequence[str] = DISTRICT) -> DataFrame:
    """``predicted`` is the district's score twelve months before, 0 without one."""
    valid = panel.filter(F.col(score).between(1, 5)).withColumn("__back", period_back("period", 12))
    past = valid.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("period").alias("__p"), F.col(score).alias("__s"))
    cond = [valid[k].eqNullSafe(past[f"__{k}"]) for k in keys] + [valid["__back"] == past["__p"]]
    return valid.join(past, cond, "left").select(*keys, "period", F.col(score).alias("actual"), F.coalesce("__s", F.lit(0.0)).alias("predicted"))


def max_of_two_before(panel: DataFrame, score: str = "cs_score", keys: Sequence[str] = DISTRICT) -> DataFrame:
    """``predicted`` is the greater of the scores one and two assessments before, 0 without either."""
    both = _by_steps(panel, score, [1, 2], keys)
    return both.select(*keys, "period", "actual", F.greatest("__1", "__2").alias("predicted"))


def scores(forecast: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and weighted precision, recall and F1 from the counts of (actual, predicted); 0 where undefined."""
    cells = forecast.groupBy(*by, "actual", "predicted").agg(F.count("*").alias("n"))
    labels = cells.select(*by, F.explode(F.array("actual", "predicted")).alias("label"), "actual", "predicted", "n").distinct()
    per = labels.groupBy(*by, "label").agg(
        F.sum(F.when((F.col("actual") == F.col("label")) & (F.col("predicted") == F.col("label")), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("actual") == F.col("label"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(F.col("predicted") == F.col("label"), F.col("n")).otherwise(0)).alias("claimed"),
    )
    p, r = F.coalesce(F.try_divide("tp", "claimed"), F.lit(0.0)), F.coalesce(F.try_divide("tp", "support"), F.lit(0.0))
    rated = per.select(*by, "tp", "support", p.alias("p"), r.alias("r")).withColumn("f", F.coalesce(F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0)))
    weighted = lambda c: F.round(F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")), 9)
    return rated.groupBy(*by).agg(
        F.sum("support").alias("rows"), F.round(F.try_divide(F.sum("tp"), F.sum("support")), 9).alias("accuracy"), weighted("p").alias("precision"), weighted("r").alias("recall"), weighted("f").alias("f1")
    )


def confusion(forecast: DataFrame, labels: Sequence[int] = (1, 2, 3, 4, 5)) -> DataFrame:
    """Count and share of the actual label for every pair of ``labels``."""
    grid = forecast.sparkSession.createDataFrame([(float(a), float(b)) for a in labels for b in labels], "actual double, predicted double")
    cells = forecast.groupBy(F.col("actual").cast("double").alias("actual"), F.col("predicted").cast("double").alias("predicted")).agg(F.count("*").alias("n"))
    full = grid.join(cells, ["actual", "predicted"], "left").select("actual", "predicted", F.coalesce("n", F.lit(0)).alias("n"))
    totals = full.groupBy("actual").agg(F.sum("n").alias("all"))
    return full.join(totals, "actual").select("actual", "predicted", "n", F.round(F.coalesce(F.try_divide("n", "all"), F.lit(0.0)), 9).alias("share"))


def trimmed_summary(results: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Mean, mean without the least and greatest value, population deviation, its ratio to the mean, and range."""
    values = results.groupBy(*by).agg(F.array_sort(F.collect_list(value)).alias("v"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    n = F.size("v")
    mean = total(F.col("v")) / n
    inner = F.slice("v", 2, F.greatest(n - 2, F.lit(0)))
    std = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean)) / n)
    return values.filter(n > 0).select(
        *by, n.alias("n"), F.round(mean, 9).alias("mean"), F.round(F.when(n > 2, total(inner) / (n - 2)).otherwise(mean), 9).alias("trimmed_mean"), F.round(std, 9).alias("std"),
        F.round(F.try_divide(std, mean), 9).alias("cv"), F.round(F.array_max("v") - F.array_min("v"), 9).alias("range"),
    )


def rolling_splits(panel: DataFrame, last: int = 3, window: int = 20, score: str = "cs_score") -> DataFrame:
    """``test_period``, ``train_period``: for each of the ``last`` assessments up to ``window`` earlier ones."""
    steps = assessments(panel, score)
    top = steps.agg(F.max("step").alias("m"))
    tests = steps.join(F.broadcast(top), steps["step"] > F.col("m") - last).select(F.col("period").alias("test_period"), F.col("step").alias("t"))  # one row
    offsets = tests.select("test_period", F.explode(F.sequence(F.lit(1), F.lit(window))).alias("k"), "t").select("test_period", (F.col("t") - F.col("k")).alias("step"))
    return offsets.join(steps, "step").select("test_period", F.col("period").alias("train_period"))


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """``label``, ``n`` and ``weight`` = rows / (labels x rows of the label); null labels don't count."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    whole = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("k"))
    return counts.join(F.broadcast(whole), F.lit(True)).select(label, "n", F.round(F.col("rows") / (F.col("k") * F.col("n")), 9).alias("weight"))  # one row
