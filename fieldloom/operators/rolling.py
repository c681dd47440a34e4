"""Totals over trailing calendar periods, quiet days included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_revisions(df: DataFrame, key: str, version: str) -> DataFrame:
    """One row per ``key``: the one with the greatest ``version``.

    Ties on ``version`` are resolved by the greatest row, so the result doesn't
    depend on the input's order; repeated rows collapse. A null ``version`` is the
    oldest. Rows with a null ``key`` can't be revisions of one another and are all
    kept. The keyed rows are reduced before the shuffle and null keys never
    enter it, so neither repeated nor missing keys make a hot group.
    """
    rest = [c for c in df.columns if c not in (key, version)]
    packed = F.struct(F.col(version), *[F.col(c) for c in rest])
    keyed = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(packed).alias("__last"))
        .select(*[F.col(key) if c == key else F.col("__last")[c].alias(c) for c in df.columns])
    )
    return keyed.unionByName(df.filter(F.col(key).isNull()))


#: Decimal places kept of fractions.
PLACES = 12


def _kind(kind: T.DataType) -> T.DataType:
    """The type in which amounts of a type are added."""
    if isinstance(kind, T.DecimalType):
        return kind
    return T.DecimalType(25 + PLACES, PLACES) if isinstance(kind, (T.FloatType, T.DoubleType)) else T.LongType()


def trailing_totals(
    df: DataFrame,
    entity: str,
    day: str,
    measures: Sequence[str],
    windows: Sequence[int] = (7, 30),
    averages: bool = True,
) -> DataFrame:
    """Totals (``m_w``) and daily averages (``m_w_avg``) of ``measures`` over the last ``w`` days.

    One row per entity and day from the entity's first to its last ``day``. Every
    daily amount is entered as a contribution at its date and taken back ``w`` days
    later; the running sum of these deltas is the total, which is constant between
    two change points, so the days in between are filled from the segment and no
    per-day self join or range frame is needed.

    Averages are totals over ``w``, also where the entity has fewer days behind it. Whole
    numbers give bigint totals, decimals decimal ones; fractions (float, double) are added
    as decimals of ``PLACES`` places, so that taking an amount back leaves nothing, and
    come out as double. Rows with a null entity or day are left out; a null measure counts
    as 0, as do NaN, infinities and fractions of more than 25 digits before the point. An
    empty table gives an empty result. Amounts are summed per entity and day before
    the first shuffle, so what reaches the per-entity running sum is at most
    ``1 + len(windows)`` rows per calendar day, however many rows an entity has.
    """
    windows = sorted(set(windows))
    kinds = [_kind(df.schema[m].dataType) for m in measures]
    base = df.filter(F.col(entity).isNotNull() & F.col(day).isNotNull()).select(
        F.col(entity).alias("__e"), F.col(day).cast("date").alias("__d"), *[F.coalesce(F.col(m).try_cast(k), F.lit(0).cast(k)).alias(f"__m{i}") for i, (m, k) in enumerate(zip(measures, kinds))]
    )
    names = [(i, w, f"__m{i}_{w}") for i in range(len(measures)) for w in windows]

    def entry(shift: int) -> Column:
        def amount(i: int, w: int) -> Column:
            m = F.col(f"__m{i}")
            return m if shift == 0 else -m if shift == w else F.lit(0).cast(daily.schema[f"__m{i}"].dataType)

        return F.struct(F.date_add("__d", shift).alias("d"), F.lit(shift == 0).alias("event"), *[amount(i, w).alias(n) for i, w, n in names])

    daily = base.groupBy("__e", "__d").agg(*[F.sum(f"__m{i}").alias(f"__m{i}") for i in range(len(measures))])
    deltas = (
        daily.select("__e", F.explode(F.array(*[entry(s) for s in (0, *windows)])).alias("x"))
        .select("__e", "x.*")
        .withColumnRenamed("d", "__d")
    )
    changes = deltas.groupBy("__e", "__d").agg(F.max("event").alias("__event"), *[F.sum(n).alias(n) for _, _, n in names])
    order = W.partitionBy("__e").orderBy("__d")
    running = order.rowsBetween(W.unboundedPreceding, 0)
    segments = changes.select(
        "__e",
        "__d",
        F.lead("__d").over(order).alias("__next"),
        F.max(F.when(F.col("__event"), F.col("__d"))).over(W.partitionBy("__e")).alias("__last"),
        *[F.sum(n).over(running).alias(n) for _, _, n in names],
    ).filter(F.col("__d") <= F.col("__last"))
    end = F.least(F.coalesce(F.date_sub("__next", 1), F.col("__last")), F.col("__last"))
    days = segments.select("__e", F.explode(F.sequence(F.col("__d"), end)).alias("__d"), *[n for _, _, n in names])
    out = [F.col("__e").alias(entity), F.col("__d").alias(day)]
    total = lambda i, n: F.col(n).cast("double") if isinstance(df.schema[measures[i]].dataType, (T.FloatType, T.DoubleType)) else F.col(n)
    out += [total(i, n).alias(f"{measures[i]}_{w}") for i, w, n in names]
    if averages:
        out += [(F.col(n).cast("double") / F.lit(float(w))).alias(f"{measures[i]}_{w}_avg") for i, w, n in names]
    return days.select(*out)
