"""District-by-month panels: scaffold, lags, rolling and expanding windows, targets.

Every window is ordered by the period within one district, so frames never cross a
district; a panel has one row per district and period, so a window group is bounded by
the number of months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DISTRICT = ("admin0", "admin1", "admin2")


def months(spark, first: str, last: str, name: str = "period") -> DataFrame:
    """All months from ``first`` to ``last`` (``yyyyMM``), as text."""
    seq = F.sequence(F.to_date(F.lit(first + "01"), "yyyyMMdd"), F.to_date(F.lit(last + "01"), "yyyyMMdd"), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(seq).alias("d")).select(F.date_format("d", "yyyyMM").alias(name))


def scaffold(units: DataFrame, periods: DataFrame) -> DataFrame:
    """Every distinct unit with every period. The periods, a few hundred at most, are the broadcast side."""
    return units.distinct().crossJoin(F.broadcast(periods.distinct()))


def by_district(keys: Sequence[str] = DISTRICT, order: str = "period") -> WindowSpec:
    return W.partitionBy(*keys).orderBy(order)


def lag_of(x: str, k: int, w: WindowSpec) -> Column:
    return F.lag(x, k).over(w)


def lead_of(x: str, k: int, w: WindowSpec) -> Column:
    return F.lead(x, k).over(w)


def change_flag(x: str, w: WindowSpec) -> Column:
    """1 where ``x`` differs from the row before; the first row and any null side count as a change."""
    return F.coalesce((F.col(x) != F.lag(x).over(w)).cast("int"), F.lit(1))


def running_total(x: str, w: WindowSpec) -> Column:
    return F.sum(x).over(w.rowsBetween(W.unboundedPreceding, 0))


def transitions_before(df: DataFrame, x: str, out: str, keys: Sequence[str] = DISTRICT, order: str = "period", k: int = 1) -> DataFrame:
    """Number of changes of ``x`` up to ``k`` rows before; null for the first ``k`` rows."""
    w = by_district(keys, order)
    flagged = df.withColumn("__flag", change_flag(x, w)).withColumn("__run", running_total("__flag", w))
    return flagged.withColumn(out, F.lag("__run", k).over(w)).drop("__flag", "__run")


def rolling_before(x: str, size: int, w: WindowSpec, how: str = "sum") -> Column:
    """Sum or mean over the ``size`` rows before the current one; null without any value."""
    return getattr(F, how)(x).over(w.rowsBetween(-size, -1))


def rolling_with(x: str, size: int, w: WindowSpec, how: str = "avg", least: int = 1) -> Column:
    """Sum or mean over the last ``size`` rows, the current one included, if at least ``least`` hold a value."""
    frame = w.rowsBetween(-(size - 1), 0)
    return F.when(F.count(x).over(frame) >= least, getattr(F, how)(x).over(frame))


def mean_before(x: str, w: WindowSpec) -> Column:
    """Mean over all rows before the current one."""
    return F.avg(x).over(w.rowsBetween(W.unboundedPreceding, -1))


def last_observed(x: str, w: WindowSpec) -> Column:
    """The last value up to the current row."""
    return F.last(x, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))


def next_valid(x: str, w: WindowSpec, low: float = 1, high: float = 5) -> Column:
    """The first later value from ``low`` to ``high``; other codes are passed over."""
    return F.first(F.when(F.col(x).between(low, high), F.col(x)), ignorenulls=True).over(w.rowsBetween(1, W.unboundedFollowing))


def group_mean(x: str, keys: Sequence[str]) -> Column:
    return F.avg(x).over(W.partitionBy(*keys))


def group_max(x: str, keys: Sequence[str]) -> Column:
    return F.max(x).over(W.partitionBy(*keys))


def escalates(short: Column, long: Column) -> Column:
    """1 where the short mean is over the long one; a null side counts as no."""
    return F.coalesce(short > long, F.lit(False)).cast("int")


def percent_change(x: str, w: WindowSpec) -> Column:
    """Change to the row before as a part of it; null at the first row and after 0."""
    before = F.lag(x).over(w)
    return F.try_divide((F.col(x) - before).cast("double"), before.cast("double"))


def total_between(df: DataFrame, observed: str, x: str, out: str, keys: Sequence[str], order: str = "period") -> DataFrame:
    """At each observed row the sum of ``x`` since the observed row before (excluded); null at the first one and elsewhere."""
    w = by_district(keys, order)
    marked = df.withColumn("__o", F.col(observed).isNotNull().cast("int"))
    island = F.coalesce(F.sum("__o").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cut = marked.withColumn("__i", island)
    summed = cut.withColumn("__s", F.coalesce(F.sum(x).over(W.partitionBy(*keys, "__i")), F.lit(0)))
    return summed.withColumn(out, F.when((F.col("__o") == 1) & (F.col("__i") > 0), F.col("__s"))).drop("__o", "__i", "__s")


def latest_periods(df: DataFrame, n: int, order: str = "period", skip: int = 0) -> DataFrame:
    """Rows of the ``n`` latest distinct periods after the ``skip`` latest; null periods don't count."""
    ranked = df.select(order).filter(F.col(order).isNotNull()).distinct().orderBy(F.desc(order)).limit(n + skip)
    kept = ranked.orderBy(order).limit(n)
    return df.join(F.broadcast(kept), order, "left_semi")  # at most n periods
