"""Correlation, fixed-effects regression, summaries, modes and votes."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.session import reliable_checkpoint


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``x``, ``y``, ``r`` for every pair of columns, over rows where both are present; one aggregation for all."""
    pairs = [(a, b) for a in columns for b in columns]
    both = lambda a, b, c: F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.col(c).cast("double"))
    wide = df.agg(*[F.corr(both(a, b, a), both(a, b, b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.round(f"r{i}", 9).alias("r")) for i, (a, b) in enumerate(pairs)])).alias("p")).select("p.*")


def fixed_effects_slope(df: DataFrame, y: str, x: str, first: str, second: str, most_levels: int = 2000) -> DataFrame:
    """Slope of ``y`` on ``x`` with effects of two factors (one row: ``slope``, ``n``), on unbalanced panels too.

    The factor with more levels is taken out by its means; what is left of the other are the
    normal equations of its effects, as many as it has levels. Rows are added up per pair of
    levels, then per level of the greater factor, and the equations per partition; so only
    they reach the driver. The lesser factor may have ``most_levels`` levels (32 MB of
    equations), more is an error. A null variable or factor drops the row; the slope is null
    if ``x`` doesn't vary within.
    """
    used = df.filter(F.col(y).isNotNull() & F.col(x).isNotNull() & F.col(first).isNotNull() & F.col(second).isNotNull())
    cells = reliable_checkpoint(used.groupBy(F.col(first).cast("string").alias("a"), F.col(second).cast("string").alias("b")).agg(
        F.count("*").alias("n"), F.sum(F.col(x).cast("double")).alias("sx"), F.sum(F.col(y).cast("double")).alias("sy"),
        F.sum(F.col(x).cast("double") * F.col(x)).alias("sxx"), F.sum(F.col(x).cast("double") * F.col(y)).alias("sxy"),
    ))
    size = cells.agg(F.count_distinct("a").alias("a"), F.count_distinct("b").alias("b"), F.sum("n").alias("n"), F.sum("sxx").alias("sxx"), F.sum("sxy").alias("sxy")).first()
    spark = df.sparkSession
    if not size.n:
        return spark.createDataFrame([(None, 0)], "slope double, n bigint")
    great, small = ("b", "a") if size.a < size.b else ("a", "b")
    if size[small] > most_levels:
        raise ValueError(f"the lesser factor has {size[small]} levels, more than {most_levels}")
    levels = sorted(r[0] for r in cells.select(small).distinct().collect())  # at most ``most_levels``
    at, k = {v: i for i, v in enumerate(levels)}, len(levels)
    by_level = cells.groupBy(great).agg(F.collect_list(F.struct(F.col(small).alias("s"), "n", "sx", "sy")).alias("c"))

    def equations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left, rx, ry, xx, xy = np.zeros((k, k)), np.zeros(k), np.zeros(k), 0.0, 0.0
        for b in batches:
            for c in b["c"]:
                i = np.array([at[r["s"]] for r in c])
                n, sx, sy = (np.array([r[v] for r in c], float) for v in ("n", "sx", "sy"))
                whole, tx, ty = n.sum(), sx.sum(), sy.sum()
                left[i, i] += n
                left[np.ix_(i, i)] -= np.outer(n, n) / whole
                rx[i] += sx - n * tx / whole
                ry[i] += sy - n * ty / whole
                xx, xy = xx + tx * tx / whole, xy + tx * ty / whole
        i, j = np.nonzero(left)
        yield pd.DataFrame({"i": np.r_[i, np.arange(k), np.arange(k), -1, -2], "j": np.r_[j, np.full(k, -1), np.full(k, -2), -1, -2], "v": np.r_[left[i, j], rx, ry, xx, xy]})

    left, rx, ry, taken = np.zeros((k, k)), np.zeros(k), np.zeros(k), {-1: 0.0, -2: 0.0}
    for r in by_level.mapInPandas(equations, "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toLocalIterator():
        if r.i < 0:
            taken[r.i] = r.v
        elif r.j < 0:
            (rx if r.j == -1 else ry)[r.i] = r.v
        else:
            left[r.i, r.j] = r.v
    inverse = np.linalg.pinv(left, hermitian=True)
    sxx, sxy = size.sxx - taken[-1] - rx @ inverse @ rx, size.sxy - taken[-2] - rx @ inverse @ ry
    return spark.createDataFrame([(round(float(sxy / sxx), 9) if sxx > 1e-9 * max(1.0, size.sxx) else None, int(size.n))], "slope double, n bigint")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per numeric column ``count, mean, std`` (sample), ``min``, exact quartiles and ``max`` over its values; one row per column."""
    quarters = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    stats = [F.struct(F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(F.col(c).cast("double")).alias("min"), F.percentile(c, quarters).alias("q"), F.max(F.col(c).cast("double")).alias("max")) for c in columns]
    rows = df.agg(F.array(*stats).alias("a")).select(F.explode("a").alias("s")).select("s.*")
    return rows.select("column", "count", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"), "min", *[F.get("q", F.lit(i)).alias(f"p{p}") for i, p in enumerate((25, 50, 75))], "max")


def drop_matching(df: DataFrame, *patterns: str) -> DataFrame:
    """``df`` without the columns in whose name a pattern is found."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not any(re.search(p, c) for p in patterns)])


def mode_of(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent value per key; the smallest on a tie; nulls don't vote."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    return counts.groupBy(*keys).agg(F.min(F.struct((-F.col("__n")).alias("a"), F.col(value).alias("v"))).alias("x")).select(*keys, F.col("x.v").alias(value))


def any_of(df: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Per key 1 for each flag that is set in some row."""
    return df.groupBy(*keys).agg(*[F.coalesce(F.max(f), F.lit(0)).alias(f) for f in flags])


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """The first ``k`` rows in ``order`` (one pass, no full sort)."""
    return df.orderBy(*order).limit(k)


def sample_rows(df: DataFrame, k: int, seed: int = 42, keys: Sequence[str] = ()) -> DataFrame:
    """``k`` rows in the order of a seeded hash of ``keys`` (all columns by default): the same in every run."""
    cols = list(keys) or df.columns
    return df.orderBy(F.xxhash64(F.lit(seed), *cols), *cols).limit(k)


def stratified_split(df: DataFrame, key: str, stratum: str, share: float = 0.8) -> DataFrame:
    """``df`` with ``is_train``: 1 for about ``share`` of the rows of each stratum.

    A row's side depends on the hash of its stratum and key only, so it's the same in every
    run, needs no shuffle, and rows with one key are never parted.
    """
    h = F.pmod(F.xxhash64(F.lit("split"), stratum, key), F.lit(1_000_000))
    return df.withColumn("is_train", (h < int(share * 1_000_000)).cast("int"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row and their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
