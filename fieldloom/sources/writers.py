"""Writers: partitioned by period, in chunks of rows, or as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.schemas import WIDE_RECORD_COLUMNS


def by_period(df: DataFrame, path: str, period: str = "period", files: int = 8) -> None:
    """Parquet with one folder per period; only the periods in ``df`` are replaced.

    Rows of a period are brought together first, spread over ``files`` tasks by a hash, so a
    busy month isn't one task's work: as many as make files of the size wanted.
    """
    spread = df.withColumn("__s", F.pmod(F.xxhash64(*[c for c in df.columns if c != period]), F.lit(files)))
    laid = spread.repartition(period, "__s").drop("__s")
    laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period).parquet(path)


def missing_periods(df: DataFrame, existing: DataFrame, period: str = "period") -> DataFrame:
    """Rows of periods that aren't written yet."""
    return df.join(F.broadcast(existing.select(period).distinct()), period, "left_anti")  # one row per month


def single(df: DataFrame, path: str) -> None:
    """One Parquet folder."""
    df.write.mode("overwrite").parquet(path)


def chunks(df: DataFrame, path: str, rows: int = 20_000) -> None:
    """Parquet files of at most ``rows`` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(path)


def plain_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated text without header."""
    df.write.mode("overwrite").option("sep", "\t").option("header", "false").option("quote", "").csv(path)


def csv_with_header(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def consolidated_day(df: DataFrame) -> DataFrame:
    """A day's records without the wide columns that nothing uses."""
    return df.drop(*WIDE_RECORD_COLUMNS)
