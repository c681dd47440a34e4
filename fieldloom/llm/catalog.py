"""Queries of the text problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.boilerplate import find_boilerplate, story_text
from fieldloom.llm.leaks import find_leaks
from fieldloom.llm.lines import remove_repeated_lines, repeated_line_numbers
from fieldloom.llm.mixing import TopicModel, mix
from fieldloom.llm.naming import match_names
from fieldloom.llm.splitting import split_oversized
from fieldloom.llm.stuffing import find_stuffed
from fieldloom.session import table


def p1_pieces(spark: SparkSession, root: str) -> DataFrame:
    """The pieces of every text of more than 2,000 characters."""
    return split_oversized(table(spark, root, "labelled_text").select("text_id", "clean_text"), "text_id", "clean_text")


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    """Texts that had to be cut: those with a second piece."""
    return p1_pieces(spark, root).filter(F.col("piece_no") == 2).select("text_id").distinct()


def p1_rejoined(spark: SparkSession, root: str) -> DataFrame:
    """Digest of each cut text put together from its pieces without their overlaps, and whether all pieces keep to the limits."""
    p = p1_pieces(spark, root).groupBy("text_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_no", F.expr("substring(piece, overlap + 1)").alias("t")))), lambda x: x["t"]), "").alias("text"),
        F.max(F.length("piece")).alias("longest"), F.max("overlap").alias("overlap"), F.min("overlap").alias("least"), F.count("*").alias("n"), F.max("piece_no").alias("last"),
    )
    kept = (F.col("longest") <= 2000) & (F.col("overlap") <= 200) & (F.col("least") >= 0) & (F.col("n") == F.col("last"))
    return p.select("text_id", F.md5("text").alias("digest"), kept.alias("is_within_limits"))


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    """Lines of web pages that aren't part of the story."""
    pages = table(spark, root, "articles_events").select("article_id", "sourceurl", "header", "clean_text")
    return find_boilerplate(pages).filter("around").select("article_id", "line_no").distinct()


def p3_stories(spark: SparkSession, root: str) -> DataFrame:
    """The story of every page."""
    return story_text(table(spark, root, "articles_events").select("article_id", "sourceurl", "header", "clean_text"))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    """The district meant by each name typed by hand."""

    def typed(name: str, key: str, country: str, region: str, district: str) -> DataFrame:
        return table(spark, root, name).select(F.lit(name).alias("src"), F.col(key).cast("bigint").alias("row_key"), F.col(country).alias("country"), F.col(region).alias("region"), F.col(district).alias("district"))

    rows = typed("gdelt_events", "globaleventid", "name_0", "name_1", "name_2")
    rows = rows.unionByName(typed("events_panel", "panel_id", "admin0", "admin1", "admin2")).unionByName(typed("admin_polygons", "poly_id", "name_0", "name_1", "name_2"))
    return match_names(rows, table(spark, root, "admin_units"))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    """Lines that occur in at least ten documents of their source."""
    return repeated_line_numbers(table(spark, root, "articles_gkg").select("article_id", "sourcecommonname", "clean_text"))


def p6_cleaned(spark: SparkSession, root: str) -> DataFrame:
    """Every article's text without the lines that recur in its source."""
    return remove_repeated_lines(table(spark, root, "articles_gkg").select("article_id", "sourcecommonname", "clean_text")).select("article_id", "kept_text")


def p8_found(spark: SparkSession, root: str) -> DataFrame:
    """Documents that hold a passage of a held-out item."""
    docs, items = table(spark, root, "documents").select("doc_id", "text"), table(spark, root, "eval_items").select("item_id", "text")
    return find_leaks(docs, items, offsets=False).select("doc_id", "item_id").distinct()


def p8_passages(spark: SparkSession, root: str) -> DataFrame:
    """The passages with their offsets in the document's text."""
    docs, items = table(spark, root, "documents").select("doc_id", "text"), table(spark, root, "eval_items").select("item_id", "text")
    return find_leaks(docs, items)


def _mixed(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    topic = TopicModel.fit(table(spark, root, "labelled_text"), "clean_text", "impact_type")
    return mix(table(spark, root, "documents").select("doc_id", "text", "source", "lang"), table(spark, root, "mix_targets"), topic=topic)


def p9_mixture(spark: SparkSession, root: str) -> DataFrame:
    """The records drawn for the mixture and how often each is used; topics are the impact types of the labelled texts."""
    return _mixed(spark, root)[0]


def p9_shares(spark: SparkSession, root: str) -> DataFrame:
    """The share of all tokens each source reached."""
    return _mixed(spark, root)[1]


def p9_margins(spark: SparkSession, root: str) -> DataFrame:
    """The shares of all tokens languages and topics reached."""
    return _mixed(spark, root)[2]


def p9_checks(spark: SparkSession, root: str) -> DataFrame:
    """Whether each listed source is within one record of what is aimed at, which is its share or all it has, and within its repeats."""
    r = _mixed(spark, root)[1]
    aimed = F.abs(F.col("tokens_drawn") - F.col("tokens_aimed")) <= F.col("largest_record")
    full = F.col("tokens_aimed") <= F.col("tokens_available") * F.col("max_repeats") + 0.001
    return r.select("source", "max_repeats", (aimed & full).alias("is_met"), (F.col("max_copies") <= F.col("max_repeats")).alias("is_within_repeats"), (F.col("tokens_available") > 0).alias("has_tokens"))


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    """Documents that are heaps of keywords, links or tags."""
    return find_stuffed(table(spark, root, "documents").select("doc_id", "text")).filter("stuffed").select("doc_id").distinct()


QUERIES = {
    "p1_found": p1_found,
    "p1_pieces": p1_pieces,
    "p1_rejoined": p1_rejoined,
    "p3_found": p3_found,
    "p3_stories": p3_stories,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p6_cleaned": p6_cleaned,
    "p8_found": p8_found,
    "p8_passages": p8_passages,
    "p9_mixture": p9_mixture,
    "p9_shares": p9_shares,
    "p9_margins": p9_margins,
    "p9_checks": p9_checks,
    "p10_found": p10_found,
}

_RECURRING = r"""
with lined as (
  select article_id, lower(sourcecommonname) as s, unnest(string_split(clean_text, chr(10))) as line, generate_subscripts(string_split(clean_text, chr(10)), 1) as line_no
  from articles_gkg where sourcecommonname is not null and clean_text is not null and article_id is not null
), keyed as (
  select article_id, s, line, line_no, regexp_replace(lower(line), '[\s\p{Zs}\p{Zl}\p{Zp}\x{85}\x{b}\p{Nd}]+', '', 'g') as k from lined
), often as (select s, k from keyed where k <> '' group by 1, 2 having count(distinct article_id) >= 10)
"""
SQL = {
    "p1_found": "select distinct text_id from labelled_text where length(clean_text) > 2000",
    "p1_rejoined": "select text_id, md5(clean_text) as digest, true as is_within_limits from labelled_text where length(clean_text) > 2000",
    "p9_checks": """with t as (select lower(trim(source)) as source, max(max_repeats) as max_repeats from mix_targets where source is not null group by 1)
    select source, max_repeats, true as is_met, true as is_within_repeats, source in (select lower(trim(source)) from documents where source is not null and doc_id is not null and length(text) > 0) as has_tokens from t""",
    "p6_found": _RECURRING + "select distinct article_id, cast(line_no as integer) as line_no from keyed join often using (s, k)",
    "p6_cleaned": _RECURRING
    + """, kept as (select article_id, string_agg(case when o.k is null then line end, chr(10) order by line_no) as t from keyed left join often o using (s, k) group by 1)
    select a.article_id, case when a.sourcecommonname is null or a.clean_text is null then a.clean_text else coalesce(kept.t, '') end as kept_text from articles_gkg a left join kept using (article_id)""",
}
