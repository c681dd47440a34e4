"""Readers of the feeds, lexicons and page tables. Fetching stays outside; a folder of files is the interface."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom import schemas
from fieldloom.functions import text as X


def day_names(first: date, last: date) -> list[str]:
    """Names (``yyyyMMdd``) of the daily files from ``first`` to ``last``."""
    return [(first + timedelta(n)).strftime("%Y%m%d") for n in range((last - first).days + 1)]


def quarter_hours(first: str | datetime, last: str | datetime) -> list[str]:
    """Stamps (``yyyyMMddHHmmss``) of the 15-minute files; a last stamp at midnight means the whole day."""
    begin, end = (datetime.fromisoformat(x) if isinstance(x, str) else x for x in (first, last))
    if (end.hour, end.minute) == (0, 0):
        end = end.replace(hour=23, minute=45)
    out = []
    while begin <= end:
        out.append(begin.strftime("%Y%m%d%H%M%S"))
        begin += timedelta(minutes=15)
    return out


def events_tsv(spark: SparkSession, path: str | list[str], compat: bool = False) -> DataFrame:
    """The events feed: tab-separated, without header. Malformed lines and numbers become nulls, all-null rows are dropped.

    ``compat``: the files are comma-separated with a header (the rewritten form).
    """
    reader = spark.read.schema(schemas.EVENTS).option("mode", "PERMISSIVE").option("ignoreCorruptFiles", "true")
    df = reader.option("header", "true").csv(path) if compat else reader.option("sep", "\t").option("quote", "").csv(path)
    return df.dropna(how="all")


def records_tsv(spark: SparkSession, path: str | list[str], drop_wide: bool = True) -> DataFrame:
    """The record feed: tab-separated, Latin-1, no quoting, no header; lines with too few or too many fields are left out.

    All rows are kept, the first of each file too. ``drop_wide`` leaves out the wide columns that nothing uses.
    """
    df = spark.read.schema(schemas.RECORDS).option("sep", "\t").option("quote", "").option("encoding", "ISO-8859-1").option("mode", "DROPMALFORMED").option("columnPruning", "false").csv(path)
    return df.drop(*schemas.WIDE_RECORD_COLUMNS) if drop_wide else df


def theme_list(spark: SparkSession, path: str, column: str = "unique_v2theme") -> list[str]:
    """Themes of a list: the named column, else the first one; an empty list if the file is missing."""
    try:
        df = spark.read.option("header", "true").csv(path)
        name = column if column in df.columns else df.columns[0]
        return [r[0].strip() for r in df.select(name).distinct().orderBy(name).toLocalIterator() if r[0] and r[0].strip()]
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return []
        raise


def lexicon(spark: SparkSession, path: str, with_concepts: bool = True) -> list[str]:
    """Terms of a lexicon file: ``Keyword`` and, if asked and present, ``Concept``; malformed lines are left out."""
    df = spark.read.option("header", "true").option("quote", '"').option("mode", "DROPMALFORMED").csv(path)
    if "Keyword" not in df.columns:
        raise ValueError("a lexicon needs the column Keyword")
    names = ["Keyword"] + (["Concept"] if with_concepts and "Concept" in df.columns else [])
    terms = df.select(F.explode(F.array(*names)).alias("t")).filter("t is not null").distinct().orderBy("t")
    return X.lexicon_terms([r.t for r in terms.toLocalIterator()])


def names_map(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of old to new names as a table ``old, new``."""
    pairs = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("old", "new"))
    return pairs.filter(F.col("old").isNotNull())


def polarity_lexicon(spark: SparkSession, path: str, most: int = 100_000) -> dict[str, float]:
    """Words and their polarity from a tab-separated file without header (further columns are passed over); more than ``most`` entries are refused."""
    df = spark.read.option("sep", "\t").option("quote", "").csv(path)
    rows = df.select(F.lower(df.columns[0]).alias("w"), F.col(df.columns[1]).try_cast("double").alias("v")).filter("w is not null and v is not null").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a lexicon of more than {most} entries")
    return {r.w: r.v for r in rows}


def concept_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of concepts and their phrases as a table ``concept, phrase`` (trimmed, lower case, distinct)."""
    pairs = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("concept", "p"))
    return pairs.select("concept", F.explode("p").alias("p")).select("concept", F.lower(F.trim("p")).alias("phrase")).filter("phrase <> ''").distinct()


def labelled_csv(spark: SparkSession, path: str) -> DataFrame:
    """Labelled texts; ``resource``, a list stored as text, becomes an array."""
    from fieldloom.functions.arrays import parse_text_list

    df = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)
    return df.withColumn("resource", parse_text_list(F.coalesce("resource", F.lit(""))))


def parquet(spark: SparkSession, *paths: str, merge: bool = False) -> DataFrame:
    """Parquet files or folders as one table; ``merge`` unites differing schemas."""
    return spark.read.option("mergeSchema", str(merge).lower()).parquet(*paths)


def unfetched(urls: DataFrame, chunks: DataFrame, url: str = "url") -> DataFrame:
    """Addresses that no chunk holds yet."""
    return urls.join(chunks.select(url).distinct(), url, "left_anti")


def next_chunk(spark: SparkSession, folder: str) -> int:
    """One more than the greatest number in the names of the chunk files; 0 for an empty or missing folder."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(folder).select("path")
        top = files.agg(F.max(F.regexp_extract("path", r"(\d+)[^/\d]*\.parquet$", 1).try_cast("int"))).first()[0]
        return 0 if top is None else top + 1
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return 0
        raise


def routed_pages(fetched: DataFrame, blacklist: DataFrame | None = None, url: str = "url", status: str = "status", html: str = "html") -> DataFrame:
    """Pages of ``(url, status, html)`` with ``header``, ``body``, ``outcome``.

    200 is parsed; 403 goes to the fallback; a host on the blacklist or none is 499; the
    rest has failed, with ``Error`` as texts.
    """
    df = fetched.withColumn("domain", X.domain(url))
    if blacklist is not None:
        df = df.join(blacklist.select(F.col("domain"), F.lit(True).alias("__b")).distinct(), "domain", "left")
    else:
        df = df.withColumn("__b", F.lit(None).cast("boolean"))
    code = F.when(F.col("__b") | F.col("domain").isNull(), 499).otherwise(F.col(status))
    parsed = X.extract_pages(df.withColumn(status, code).drop("__b"), html)
    ok = F.col(status) == 200
    return parsed.select(
        url, "domain", status, F.when(ok, X.safe_text("header")).otherwise("Error").alias("header"), F.when(ok, X.safe_text("body")).otherwise("Error").alias("body"),
        F.when(ok, "page").when(F.col(status) == 403, "fallback").otherwise("failed").alias("outcome"),
    )


def failing_domains(fetched: DataFrame, most: int = 100, url: str = "url", status: str = "status") -> DataFrame:
    """Hosts with at least ``most`` failures."""
    failed = fetched.filter(F.coalesce(F.col(status) != 200, F.lit(True)))
    return failed.groupBy(X.domain(url).alias("domain")).agg(F.count("*").alias("failures")).filter((F.col("failures") >= most) & F.col("domain").isNotNull())
