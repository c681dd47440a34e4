"""Joins with the null and duplicate behaviour the pipeline relies on."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.functions.similarity import weighted


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality of all keys with null equal to null; still a hashable equi-join."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def outer_merge(left: DataFrame, right: DataFrame, keys: Sequence[str], suffixes: tuple[str, str] = ("_x", "_y"), indicator: str | None = None) -> DataFrame:
    """Full outer join on ``keys`` where null keys meet null keys.

    Other columns both sides have get the suffixes. ``indicator`` names a column with
    ``both``, ``left_only`` or ``right_only``. Repeated keys multiply as in any join.
    """
    a, b = left.withColumn("__l", F.lit(True)).alias("a"), right.withColumn("__r", F.lit(True)).alias("b")
    shared = (set(left.columns) & set(right.columns)) - set(keys)
    joined = a.join(b, reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]), "full_outer")
    out = [F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys]
    out += [F.col(f"a.{c}").alias(c + suffixes[0] if c in shared else c) for c in left.columns if c not in keys]
    out += [F.col(f"b.{c}").alias(c + suffixes[1] if c in shared else c) for c in right.columns if c not in keys]
    if indicator:
        out.append(F.when(F.col("__l") & F.col("__r"), "both").when(F.col("__l"), "left_only").otherwise("right_only").alias(indicator))
    return joined.select(*out)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the last in ``order`` (nulls first), by a partial aggregate."""
    packed = F.struct(*[o if isinstance(o, Column) else F.col(o) for o in order], *[F.col(c).alias(f"__{c}") for c in df.columns])
    return df.groupBy(*keys).agg(F.max(packed).alias("__x")).select(*[F.col(f"__x.__{c}").alias(c) for c in df.columns])


def distinct_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in ``order``."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def fill_from_lookup(df: DataFrame, lookup: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """``column`` filled where null from ``lookup`` (one row per key)."""
    other = lookup.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(column).alias("__v"))
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(other[f"__{k}"]) for k in keys])
    return df.join(other, cond, "left").select(*[F.coalesce(F.col(c), F.col("__v")).alias(c) if c == column else df[c] for c in df.columns])


def map_array(df: DataFrame, key: str, array: str, lookup: DataFrame, lookup_key: str, features: Sequence[str]) -> DataFrame:
    """``key`` and per feature an array of the values that ``lookup`` has for the elements of ``array``.

    Order is kept and elements without an entry are left out, so the arrays stay parallel.
    ``key`` must be unique. The features are carried as one struct through one join; a
    repeated lookup key multiplies, so make it unique first (``last_per_key``). Rows with
    null or empty arrays give empty arrays.
    """
    items = df.select(key, F.posexplode(array).alias("__pos", "__item"))
    table = lookup.select(F.col(lookup_key).alias("__item"), F.struct(*features).alias("__f"))
    met = items.join(table, "__item").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("__pos", "__f"))).alias("__x"))
    out = df.select(key).join(met, key, "left")
    empty = F.coalesce("__x", F.array())

    def values(feature: str) -> Column:
        return F.transform(empty, lambda x: x["__f"][feature]).alias(f"{feature}_list")

    return out.select(key, *[values(f) for f in features])


def keep_known(df: DataFrame, key: str, array: str, known: DataFrame, known_key: str, out: str) -> DataFrame:
    """``key`` and ``out``: the elements of ``array`` that ``known`` has, in order."""
    items = df.select(key, F.posexplode(array).alias("__pos", "__item"))
    met = items.join(known.select(F.col(known_key).alias("__item")).distinct(), "__item", "left_semi")
    kept = met.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("__pos", "__item"))).alias("__x"))
    return df.select(key).join(kept, key, "left").select(key, F.transform(F.coalesce("__x", F.array()), lambda x: x["__item"]).alias(out))


def unprocessed(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among the finished ones; null keys are kept."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def best_text_match(left: DataFrame, right: DataFrame, block: str, left_key: str, left_text: str, right_key: str, right_text: str, least: float = 50.0, entries_per_task: int = 5_000, names_per_task: int = 5_000) -> DataFrame:
    """``left_key``, ``right_key``, ``score``: the reference entry of the same block that is most alike by ``similarity.weighted`` (0 to 100).

    ``right`` is the reference list; distinct texts of ``left`` are compared with the
    entries of their block, as the score has no cheaper bound. Blocks are cut into parts of
    about ``names_per_task`` names and ``entries_per_task`` entries that meet in one task, in
    which only the best entry of a name is kept, so no pairs are written. Below ``least``
    there is no row; on a tie the smallest ``right_key`` wins. Null texts and blocks match
    nothing, empty texts neither.
    """
    q = left.select(F.col(block).alias("b"), F.col(left_text).alias("t")).filter(F.col("b").isNotNull() & (F.length("t") > 0)).distinct()
    r = right.select(F.col(block).alias("b"), F.col(right_key).cast("bigint").alias("k"), F.col(right_text).alias("e")).filter(F.col("b").isNotNull() & (F.length("e") > 0)).distinct()
    parts = lambda df, n: max(1, -(-(df.groupBy("b").count().agg(F.max("count")).first()[0] or 0) // n))
    x, y = parts(q, names_per_task), parts(r, entries_per_task)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    names = q.withColumn("x", F.pmod(F.xxhash64("t"), F.lit(x))).withColumn("y", every(y))
    entries = r.withColumn("y", F.pmod(F.xxhash64("e"), F.lit(y))).withColumn("x", every(x))

    def best(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        listed, out = sorted(zip(b["k"], b["e"])), []
        for t in a["t"]:
            score, k = max(((round(weighted(t, e), 6), -k) for k, e in listed), default=(0.0, 0))
            if score >= least:
                out.append((key[0], t, -k, score))
        return pd.DataFrame(out, columns=["b", "t", "k", "s"])

    met = names.groupBy("b", "x", "y").cogroup(entries.groupBy("b", "x", "y")).applyInPandas(best, "b string, t string, k bigint, s double")
    top = met.groupBy("b", "t").agg(F.min(F.struct((-F.col("s")).alias("n"), "k")).alias("best"))
    return left.join(top, (left[block] == top["b"]) & (left[left_text] == top["t"])).select(left[left_key], F.col("best.k").alias(right_key), (-F.col("best.n")).alias("score"))
