"""Aggregates whose columns are found at run time: lists, flattened arrays, sums and means in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def collect_features(df: DataFrame, keys: Sequence[str], order: Sequence[str], lists: Sequence[str] = (), totals: Sequence[str] = (), means: Sequence[str] = ()) -> DataFrame:
    """One row per key: ``<c>_list`` in the order of ``order``, array columns flattened, sums (0 without a value), means.

    Columns that ``df`` lacks are passed over. All lists are cut from one sorted array of
    structs, so they stay parallel: nulls keep their place, except in flattened arrays. Null
    keys form a group. Lists of a key are one row by nature; sums and means are partial
    aggregates.
    """
    kept = [c for c in lists if c in df.columns]
    plain = [c for c in kept if not isinstance(df.schema[c].dataType, T.ArrayType)]
    nested = [c for c in kept if c not in plain]
    aggs = [F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_sum") for c in totals if c in df.columns]
    aggs += [F.avg(c).alias(f"{c}_mean") for c in means if c in df.columns]
    if kept:
        aggs.append(F.array_sort(F.collect_list(F.struct(*[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)], *kept))).alias("__x"))
    grouped = df.groupBy(*keys).agg(*(aggs or [F.count("*").alias("n")]))

    def values(name: str):
        each = F.transform("__x", lambda x: x[name])
        return (F.flatten(F.filter(each, lambda v: v.isNotNull())) if name in nested else each).alias(f"{name}_list")

    others = [c for c in grouped.columns if c not in (*keys, "__x")]
    return grouped.select(*keys, *others, *[values(c) for c in kept])


def guarded(panel: DataFrame, keys: Sequence[str], score: str, period: str, test_period: str) -> DataFrame:
    """``panel`` with ``known_score``: at ``test_period`` the district's last score before it, elsewhere the score itself.

    So no feature of a tested row holds what is to be forecast.
    """
    from pyspark.sql import Window as W

    before = F.last(F.when(F.col(score).between(1, 5), F.col(score)), ignorenulls=True).over(W.partitionBy(*keys).orderBy(period).rowsBetween(W.unboundedPreceding, -1))
    return panel.withColumn("known_score", F.when(F.col(period) == test_period, before).otherwise(F.col(score)))
