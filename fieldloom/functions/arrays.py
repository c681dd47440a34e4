"""Array expressions: reducers, parallel arrays, caps, counters. All run in the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce as fold

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside other lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def numbers(a: Column | str) -> Column:
    """The finite numbers of an array, as doubles: nulls, text, NaN and infinities are left out; a null array is empty."""
    as_double = F.transform(F.coalesce(_c(a), F.array()), lambda x: x.try_cast("double"))
    return F.filter(as_double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def total(a: Column | str) -> Column:
    """Sum of the numbers, null if there are none."""
    return let(numbers(a), lambda n: F.when(F.size(n) > 0, F.aggregate(n, F.lit(0.0), lambda s, x: s + x)))


def safe_total(a: Column | str) -> Column:
    """Sum with anything that isn't a number taken as 0; 0 for null and empty arrays."""
    return F.aggregate(numbers(a), F.lit(0.0), lambda s, x: s + x)


def mean(a: Column | str) -> Column:
    """Mean of the numbers, null if there are none."""
    return let(numbers(a), lambda n: F.when(F.size(n) > 0, F.aggregate(n, F.lit(0.0), lambda s, x: s + x) / F.size(n)))


def population_std(a: Column | str) -> Column:
    """Population standard deviation of the numbers (two passes), null if there are none."""

    def spread(n: Column) -> Column:
        average = F.aggregate(n, F.lit(0.0), lambda s, x: s + x) / F.size(n)
        return let(average, lambda m: F.sqrt(F.aggregate(n, F.lit(0.0), lambda s, x: s + (x - m) * (x - m)) / F.size(n)))

    return let(numbers(a), lambda n: F.when(F.size(n) > 0, spread(n)))


def largest(a: Column | str) -> Column:
    return F.array_max(numbers(a))


def smallest(a: Column | str) -> Column:
    return F.array_min(numbers(a))


def raw_size(a: Column | str) -> Column:
    """Number of elements whatever they are; 0 for null."""
    return F.size(F.coalesce(_c(a), F.array()))


REDUCERS = {"mean": mean, "max": largest, "sum": total, "count": raw_size, "std": population_std, "min": smallest}
#: Features of which the largest element is kept in the reduced set.
KEEP_MAX = ("fatalities", "displaced", "injured", "violence", "torture", "crisis")


def reduce_arrays(df: DataFrame, columns: Sequence[str], kinds: Sequence[str] = tuple(REDUCERS), prefix: str = "") -> DataFrame:
    """``df`` with one column per array and reducer, in a single projection."""
    return df.select("*", *[REDUCERS[k](c).alias(f"{prefix}{c.removesuffix('_list')}_{k}") for c in columns for k in kinds])


def reduced_kinds(column: str, text: bool = False) -> list[str]:
    """Reducers of the reduced set: text has only a count, some features a maximum too."""
    return ["count"] if text else ["mean", "count", "sum"] + (["max"] if any(k in column for k in KEEP_MAX) else [])


def cap(a: Column | str, most: float) -> Column:
    """Elements over ``most`` become ``most``; nulls stay."""
    return F.transform(_c(a), lambda x: F.when(x > most, F.lit(most)).otherwise(x))


def non_empty(a: Column | str) -> Column:
    """1 if the array has an element, else 0."""
    return (raw_size(a) > 0).cast("int")


def count_of(a: Column | str, value: str) -> Column:
    """How often a value stands in an array; 0 for null arrays."""
    return F.size(F.filter(F.coalesce(_c(a), F.array()), lambda x: x == value))


def parallel_dedupe(df: DataFrame, key: str, others: Sequence[str]) -> DataFrame:
    """Parallel arrays reduced to the first place of each value of ``key``.

    Arrays shorter than ``key`` give null at places they lack; a null key array leaves all
    arrays as they were; null elements count as a value.
    """
    k = F.col(key)

    def firsts(ordered: Column) -> Column:  # in the order of values and places the first place of each value
        new = lambda x, i: F.when((i == 0) | ~x["v"].eqNullSafe(F.get(ordered, i - 1)["v"]), x["i"])
        return F.array_sort(F.filter(F.transform(ordered, new), lambda x: x.isNotNull()))

    places = let(F.array_sort(F.transform(k, lambda x, i: F.struct(x.alias("v"), i.alias("i")))), firsts)

    def take(name: str) -> Column:
        return F.when(k.isNull() | F.col(name).isNull(), F.col(name)).otherwise(F.transform("__places", lambda i: F.get(F.col(name), i))).alias(name)

    return df.withColumn("__places", places).select(*[take(c) if c in (key, *others) else F.col(c) for c in df.columns])


def flatten_single(a: Column | str) -> Column:
    """The element of an array of one, else null."""
    return F.when(F.size(_c(a)) == 1, F.get(_c(a), F.lit(0)))


def strip_controls(a: Column | str) -> Column:
    """Text elements without control characters; null and blank elements are removed."""
    cleaned = F.transform(F.filter(_c(a), lambda x: x.isNotNull()), lambda x: F.regexp_replace(x, r"[\x00-\x1F\x7F-\x9F]", ""))
    return F.filter(cleaned, lambda x: F.trim(x) != "")


def parse_text_list(a: Column | str) -> Column:
    """A list written as text (``['a', 'b']``) as an array of strings; never evaluated."""
    inner = F.regexp_replace(_c(a), r"^\s*\[|\]\s*$", "")
    return F.filter(F.transform(F.split(inner, r"\s*,\s*"), lambda x: F.regexp_replace(F.trim(x), r"^['\"]|['\"]$", "")), lambda x: x != "")


def row_total(columns: Sequence[Column | str]) -> Column:
    """Sum over columns with nulls as 0."""
    return fold(lambda a, b: a + b, [F.coalesce(_c(c), F.lit(0)) for c in columns])


def row_mean(columns: Sequence[Column | str]) -> Column:
    """Mean over the columns that aren't null; null if all are."""
    present = fold(lambda a, b: a + b, [_c(c).isNotNull().cast("int") for c in columns])
    return F.try_divide(row_total(columns).cast("double"), F.nullif(present, F.lit(0)))


def flatten_parallel(df: DataFrame, items: str, parallel: Sequence[str]) -> DataFrame:
    """One row per element of ``items``.

    A parallel array of the same length gives its element, one of length 1 its only
    element, any other is kept whole (as text). ``pos`` counts from 0. Null and empty
    ``items`` have no row.
    """
    n = F.size(items)

    def pick(name: str) -> Column:
        a = F.col(name)
        return F.when(F.size(a) == n, F.get(a, F.col("pos")).cast("string")).when(F.size(a) == 1, F.get(a, F.lit(0)).cast("string")).otherwise(a.cast("string")).alias(name)

    rest = [c for c in df.columns if c not in (items, *parallel)]
    return df.select("*", F.posexplode(items).alias("pos", "__item")).select(*rest, "pos", F.col("__item").alias(items), *[pick(c) for c in parallel])
