"""Queries over the raw feeds: consolidation, record parsing, and the link to the score panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions import constants as K
from fieldloom.functions import text as X
from fieldloom.functions.arrays import row_total
from fieldloom.operators.aggregates import collect_features
from fieldloom.operators.joins import distinct_first, outer_merge
from fieldloom.session import table


def consolidated_events(events: DataFrame) -> DataFrame:
    """Usable events: known country, listed code, year and coordinates in range, one row per event (the latest added).

    The code is kept as text and as a number, as ``010`` and ``10`` are different codes.
    Rows of nulls only, impossible coordinates and other countries are dropped before the
    only shuffle, which is on the event's id.
    """
    code = F.col("eventcode").try_cast("int")
    kept = events.filter(
        F.col("globaleventid").isNotNull()
        & F.col("actiongeo_countrycode").isin(K.FIPS)
        & code.isin(K.EVENT_CODES)
        & F.col("actiongeo_lat").between(-90, 90)
        & F.col("actiongeo_long").between(-180, 180)
        & F.col("event_year").between(K.FIRST_YEAR, K.LAST_YEAR)
    ).withColumn("event_number", code)
    iso = F.create_map(*[F.lit(x) for pair in K.FIPS_TO_ISO.items() for x in pair])
    return distinct_first(kept, ["globaleventid"], [F.desc("dateadded"), "sourceurl", "name_1", "name_2"]).withColumn("country", iso[F.col("actiongeo_countrycode")])


def events_clean(spark: SparkSession, root: str) -> DataFrame:
    return consolidated_events(table(spark, root, "gdelt_events")).select(
        "globaleventid", "sqldate", "eventcode", "event_number", "country", "actiongeo_lat", "actiongeo_long", "nummentions", "dateadded"
    )


_EVENTS = f"""
with kept as (select *, try_cast(eventcode as integer) as event_number from gdelt_events where globaleventid is not null
    and actiongeo_countrycode in ({", ".join(f"'{c}'" for c in K.FIPS)}) and try_cast(eventcode as integer) in ({", ".join(map(str, K.EVENT_CODES))})
    and actiongeo_lat between -90 and 90 and actiongeo_long between -180 and 180 and event_year between {K.FIRST_YEAR} and {K.LAST_YEAR}),
one as (select * from (select *, row_number() over (partition by globaleventid order by dateadded desc nulls last, sourceurl nulls first, name_1 nulls first, name_2 nulls first) as rn from kept) where rn = 1),
iso as (select unnest([{", ".join(f"'{c}'" for c in K.FIPS)}]) as f, unnest([{", ".join(f"'{c}'" for c in K.ISO)}]) as country),
clean as (select one.*, iso.country from one left join iso on iso.f = one.actiongeo_countrycode)
"""


def events_funnel(spark: SparkSession, root: str) -> DataFrame:
    """Rows left after each filter, in one pass."""
    e = table(spark, root, "gdelt_events")
    steps = [
        ("all", F.lit(True)),
        ("with_id", F.col("globaleventid").isNotNull()),
        ("country", F.col("actiongeo_countrycode").isin(K.FIPS)),
        ("code", F.col("eventcode").try_cast("int").isin(K.EVENT_CODES)),
        ("place", F.col("actiongeo_lat").between(-90, 90) & F.col("actiongeo_long").between(-180, 180)),
    ]
    passed, counts = F.lit(True), []
    for name, cond in steps:
        passed = passed & F.coalesce(cond, F.lit(False))
        counts.append(F.struct(F.lit(name).alias("step"), F.sum(passed.cast("bigint")).alias("n")))
    return e.agg(F.array(*counts).alias("a")).select(F.explode("a").alias("s")).select("s.*")


_FUNNEL = f"""
with f as (select globaleventid is not null as a, coalesce(actiongeo_countrycode in ({", ".join(f"'{c}'" for c in K.FIPS)}), false) as b,
  coalesce(try_cast(eventcode as integer) in ({", ".join(map(str, K.EVENT_CODES))}), false) as c,
  coalesce(actiongeo_lat between -90 and 90 and actiongeo_long between -180 and 180, false) as d from gdelt_events)
select 'all' as step, count(*) as n from f union all select 'with_id', count(*) from f where a union all select 'country', count(*) from f where a and b
union all select 'code', count(*) from f where a and b and c union all select 'place', count(*) from f where a and b and c and d
"""


def noise_removed(spark: SparkSession, root: str) -> DataFrame:
    """Articles joined to the greatest event code of their address, without those that are noise."""
    top = table(spark, root, "gdelt_events").filter(F.col("sourceurl").isNotNull()).groupBy("sourceurl").agg(F.max(F.col("eventcode").try_cast("int")).alias("top_code"))
    joined = table(spark, root, "articles_events").select("article_id", "sourceurl").join(top, "sourceurl")
    return joined.filter(F.col("top_code").isNotNull() & ~F.col("top_code").isin(K.NOISE_CODES)).select("article_id", "sourceurl", F.col("top_code").alias("code"))


_NOISE = f"""
with top as (select sourceurl, max(try_cast(eventcode as integer)) as top_code from gdelt_events where sourceurl is not null group by 1)
select article_id, a.sourceurl, top_code as code from articles_events a join top using (sourceurl) where top_code not in ({", ".join(map(str, K.NOISE_CODES))})
"""


def events_by_area_month(spark: SparkSession, root: str) -> DataFrame:
    """Per area and month the mentions, and the addresses in order of date as one array of structs."""
    e = consolidated_events(table(spark, root, "gdelt_events")).withColumn("period", F.floor(F.col("sqldate") / 100).cast("string"))
    item = F.struct("sqldate", "globaleventid", "sourceurl", "nummentions")
    grouped = e.groupBy("name_0", "name_1", "name_2", "period").agg(F.array_sort(F.collect_list(item)).alias("items"), F.count("*").alias("n"), F.coalesce(F.sum("nummentions"), F.lit(0)).alias("mentions"))
    return grouped.select(
        "name_0", "name_1", "name_2", "period", "n", "mentions", F.transform("items", lambda x: x["globaleventid"]).alias("ids"), F.transform("items", lambda x: x["sqldate"]).alias("dates")
    )


_BY_AREA = (
    _EVENTS
    + """select name_0, name_1, name_2, cast(sqldate // 100 as varchar) as period, count(*) as n, cast(coalesce(sum(nummentions), 0) as bigint) as mentions,
  list(globaleventid order by sqldate nulls first, globaleventid) as ids, list(sqldate order by sqldate nulls first, globaleventid) as dates
from clean group by 1, 2, 3, 4"""
)


def outer_merge_indicator(spark: SparkSession, root: str) -> DataFrame:
    """Score panel and events of the same area and month, both kept, with what side each row comes from."""
    scores = table(spark, root, "events_panel").groupBy("admin1", "admin2", F.col("period_ym").alias("period")).agg(F.max("cs_score").alias("cs_score"))
    events = consolidated_events(table(spark, root, "gdelt_events")).groupBy(
        F.col("name_1").alias("admin1"), F.col("name_2").alias("admin2"), F.floor(F.col("sqldate") / 100).cast("string").alias("period")
    ).agg(F.count("*").alias("n_events"))
    return outer_merge(scores, events, ["admin1", "admin2", "period"], indicator="side")


_OUTER = (
    _EVENTS
    + """, s as (select admin1, admin2, period_ym as period, max(cs_score) as cs_score from events_panel group by 1, 2, 3),
e as (select name_1 as admin1, name_2 as admin2, cast(sqldate // 100 as varchar) as period, count(*) as n_events from clean group by 1, 2, 3)
select coalesce(s.admin1, e.admin1) as admin1, coalesce(s.admin2, e.admin2) as admin2, coalesce(s.period, e.period) as period, cs_score, n_events,
  case when s.k and e.k then 'both' when s.k then 'left_only' else 'right_only' end as side
from (select *, true as k from s) s full join (select *, true as k from e) e
  on s.admin1 is not distinct from e.admin1 and s.admin2 is not distinct from e.admin2 and s.period is not distinct from e.period"""
)


def record_themes(spark: SparkSession, root: str) -> DataFrame:
    """Themes of each record, those on a list, and whether one of its first three country codes is wanted."""
    wanted = ["FOOD_SECURITY", "FAMINE_RISK", "ENV_DROUGHT", "REFUGEES", "ARMEDCONFLICT"]
    r = table(spark, root, "gkg_raw").select("gkgrecordid", "v2themes", "v2locations")
    themes, codes = X.theme_list(F.coalesce("v2themes", F.lit(""))), X.fips_list("v2locations")
    listed = F.array(*[F.lit(w) for w in wanted])
    return r.select(
        "gkgrecordid",
        F.size(themes).alias("n_themes"),
        F.array_join(F.filter(themes, lambda t: F.array_contains(listed, t)), ",").alias("matched"),
        F.arrays_overlap(themes, listed).cast("int").alias("is_relevant"),
        F.size(codes).alias("n_codes"),
        F.array_join(F.array_sort(F.array_distinct(codes)), ",").alias("codes"),
        F.get(codes, F.lit(0)).alias("first_code"),
        F.exists(F.slice(codes, 1, 3), lambda c: c.isin(K.FIPS)).cast("int").alias("wanted_country"),
    )


_THEMES = f"""
with r as (select gkgrecordid, list_filter(list_transform(string_split(coalesce(v2themes, ''), ';'), lambda e: upper(trim(string_split(e, ',')[1], ' '))), lambda e: e <> '') as t,
  regexp_extract_all(coalesce(v2locations, ''), '#([A-Z]{{2}})#', 1) as c from gkg_raw), w as (select ['FOOD_SECURITY', 'FAMINE_RISK', 'ENV_DROUGHT', 'REFUGEES', 'ARMEDCONFLICT'] as l)
select gkgrecordid, cast(len(t) as integer) as n_themes, coalesce(array_to_string(list_filter(t, lambda e: list_contains(l, e)), ','), '') as matched,
  cast(list_has_any(t, l) as integer) as is_relevant, cast(len(c) as integer) as n_codes, coalesce(array_to_string(list_sort(list_distinct(c)), ','), '') as codes, c[1] as first_code,
  cast(list_has_any(c[1:3], [{", ".join(f"'{c}'" for c in K.FIPS)}]) as integer) as wanted_country
from r, w
"""


def record_tone(spark: SparkSession, root: str) -> DataFrame:
    """Tone of a record, its size, that as a part of one more, and its sign."""
    tone = X.tone("v2tone")
    return table(spark, root, "gkg_raw").select("gkgrecordid", tone.alias("tone"), F.abs(tone).alias("tone_abs"), F.round(F.abs(tone) / (F.abs(tone) + 1), 9).alias("tone_part"), F.coalesce(tone < 0, F.lit(False)).cast("int").alias("is_negative"))


_TONE = """select gkgrecordid, try_cast(string_split(v2tone, ',')[1] as double) as tone, abs(try_cast(string_split(v2tone, ',')[1] as double)) as tone_abs,
  round(abs(try_cast(string_split(v2tone, ',')[1] as double)) / (abs(try_cast(string_split(v2tone, ',')[1] as double)) + 1), 9) as tone_part,
  cast(coalesce(try_cast(string_split(v2tone, ',')[1] as double) < 0, false) as integer) as is_negative from gkg_raw"""


def record_counts(spark: SparkSession, root: str) -> DataFrame:
    """Counted things of each record by bucket, entries separated by semicolons."""
    r = table(spark, root, "gkg_raw")
    return r.select("gkgrecordid", *X.bucket_counts("counts", entries=";").values())


def crisis_ratios(spark: SparkSession, root: str) -> DataFrame:
    """Ratios of the counted things of a record: casualties, aid per casualty, intensity of conflict and severity of crisis."""
    c = record_counts(spark, root)
    related = [b for b in K.COUNT_BUCKETS if b.endswith("_related")]
    killed, injured = F.col("n_killed"), F.col("n_injured")
    casualties, themes = killed + injured + F.col("n_missing"), row_total(related)
    severe = F.col("n_food_related") + F.col("n_water_related") + F.col("n_disease_related")
    return c.select(
        "gkgrecordid", F.round(killed / (killed + injured + 1), 9).alias("casualty_rate"), casualties.alias("total_casualties"), F.round(F.col("usd_aid") / (casualties + 1), 9).alias("aid_per_casualty"), themes.alias("total_themes"),
        F.round(F.col("n_conflict_related") / (themes + 1), 9).alias("conflict_intensity"), F.round(severe / (themes + 1), 9).alias("crisis_severity"),
    )


_BUCKET = " ".join(f"when regexp_matches(code, '{'|'.join(words)}') then '{b}'" for b, words in K.COUNT_BUCKETS.items())
_COUNTS = (
    "with r as (select row_number() over () as id, gkgrecordid, counts from gkg_raw), e as (select id, unnest(string_split(coalesce(counts, ''), ';')) as e from r), "
    "p as (select id, lower(string_split(e, '#')[1]) as code, case when regexp_full_match(string_split(e, '#')[2], '\\s*[0-9]+\\s*') then try_cast(trim(string_split(e, '#')[2]) as bigint) end as n from e), "
    f"b as (select id, case {_BUCKET} end as bucket, n from p) select r.gkgrecordid, "
    + ", ".join(f"cast(coalesce(sum(n) filter (bucket = '{b}'), 0) as bigint) as {b}" for b in K.COUNT_BUCKETS)
    + " from r left join b using (id) group by r.id, r.gkgrecordid"
)


_RELATED = " + ".join(b for b in K.COUNT_BUCKETS if b.endswith("_related"))
_CRISIS = f"""select gkgrecordid, round(n_killed / (n_killed + n_injured + 1), 9) as casualty_rate, n_killed + n_injured + n_missing as total_casualties,
  round(usd_aid / (n_killed + n_injured + n_missing + 1), 9) as aid_per_casualty, {_RELATED} as total_themes, round(n_conflict_related / ({_RELATED} + 1), 9) as conflict_intensity,
  round((n_food_related + n_water_related + n_disease_related) / ({_RELATED} + 1), 9) as crisis_severity from ({_COUNTS})"""


def record_places(spark: SparkSession, root: str) -> DataFrame:
    """Coordinates of the first location in a wanted country, else of the first one."""
    place = X.first_coordinates("v2locations", K.FIPS, entries=";")
    return table(spark, root, "gkg_raw").select("gkgrecordid", place["lat"].alias("lat"), place["lon"].alias("lon"))


_PLACES = f"""
with s as (select gkgrecordid, list_filter(list_transform(string_split(v2locations, ';'), lambda e: string_split(e, '#')), lambda p: len(p) >= 7) as a from gkg_raw),
g as (select gkgrecordid, list_filter(list_transform(a, lambda p: struct_pack(c := p[3], lat := try_cast(p[6] as double), lon := try_cast(p[7] as double))),
  lambda p: p.lat is not null and p.lon is not null and not (p.lat = 0 and p.lon = 0)) as g from s),
f as (select gkgrecordid, coalesce(list_filter(g, lambda p: list_contains([{", ".join(f"'{c}'" for c in K.FIPS)}], p.c))[1], g[1]) as p from g)
select gkgrecordid, p.lat as lat, p.lon as lon from f
"""


def record_months(spark: SparkSession, root: str) -> DataFrame:
    """Records, distinct sources and mean tone per month; stamps that aren't times form the null month."""
    r = table(spark, root, "gkg_raw")
    stamp = F.when(F.col("gkg_date").rlike(r"^\d{14}$"), F.try_to_timestamp("gkg_date", F.lit("yyyyMMddHHmmss")))
    return r.groupBy(F.date_format(stamp, "yyyyMM").alias("period")).agg(
        F.count("*").alias("n"), F.count_distinct("gkgrecordid").alias("records"), F.count_distinct(F.lower("sourcecommonname")).alias("sources"), F.round(F.avg(X.tone("v2tone")), 9).alias("tone")
    )


_MONTHS = """select strftime(try_strptime(case when regexp_full_match(gkg_date, '[0-9]{14}') then gkg_date end, '%Y%m%d%H%M%S'), '%Y%m') as period, count(*) as n,
  count(distinct gkgrecordid) as records, count(distinct lower(sourcecommonname)) as sources, round(avg(try_cast(string_split(v2tone, ',')[1] as double)), 9) as tone from gkg_raw group by 1"""

def records_by_source(spark: SparkSession, root: str) -> DataFrame:
    """Per source sums of counted things, mean tone, and the records in order."""
    r = table(spark, root, "gkg_raw").filter(F.col("gkgrecordid").isNotNull()).select("gkgrecordid", "gkg_date", F.lower("sourcecommonname").alias("source"), X.tone("v2tone").alias("tone"), *X.bucket_counts("counts", entries=";").values())
    out = collect_features(r.distinct(), ["source"], ["gkgrecordid", "gkg_date"], lists=["gkgrecordid", "gkg_date", "absent"], totals=["n_killed", "n_displaced", "usd_aid"], means=["tone"])
    return out.select("source", "n_killed_sum", "n_displaced_sum", "usd_aid_sum", F.round("tone_mean", 9).alias("tone_mean"), F.size("gkgrecordid_list").alias("n"), F.array_join("gkgrecordid_list", ",").alias("records"))


def _bucket_sum(bucket: str) -> str:
    return f"cast(coalesce(sum({bucket}), 0) as bigint) as {bucket}_sum"


_BY_SOURCE = (
    "with parsed as (" + _COUNTS.replace("select r.gkgrecordid", "select r.id as rid, r.gkgrecordid") + "), "
    "raw as (select row_number() over () as rid, gkgrecordid, gkg_date, lower(sourcecommonname) as source, try_cast(string_split(v2tone, ',')[1] as double) as tone from gkg_raw), "
    "d as (select distinct raw.gkgrecordid, gkg_date, source, tone, n_killed, n_displaced, usd_aid, " + ", ".join(f"parsed.{b} as x_{b}" for b in K.COUNT_BUCKETS) + " from raw join parsed using (rid) where raw.gkgrecordid is not null) "
    f"select source, {_bucket_sum('n_killed')}, {_bucket_sum('n_displaced')}, {_bucket_sum('usd_aid')}, round(avg(tone), 9) as tone_mean, cast(count(*) as integer) as n, string_agg(gkgrecordid, ',' order by gkgrecordid, gkg_date nulls first) as records from d group by 1"
)


def panels_merged(spark: SparkSession, root: str) -> DataFrame:
    """Both article feeds per country and urgency, kept on both sides, same columns told apart by suffixes."""

    def side(name: str) -> DataFrame:
        return table(spark, root, name).groupBy(F.lower("ner_admin0").alias("admin0"), "pred_urgency").agg(F.count("*").alias("n"), F.round(F.avg("compound_score"), 9).alias("compound"))

    return outer_merge(side("articles_events"), side("articles_gkg"), ["admin0", "pred_urgency"], ("_events", "_gkg"))


_SIDE = "select lower(ner_admin0) as admin0, pred_urgency, count(*) as n, round(avg(compound_score), 9) as compound from {} group by 1, 2"
_MERGED = f"""with a as ({_SIDE.format('articles_events')}), b as ({_SIDE.format('articles_gkg')}) select coalesce(a.admin0, b.admin0) as admin0, coalesce(a.pred_urgency, b.pred_urgency) as pred_urgency,
  a.n as n_events, a.compound as compound_events, b.n as n_gkg, b.compound as compound_gkg from a full join b on a.admin0 is not distinct from b.admin0 and a.pred_urgency is not distinct from b.pred_urgency"""

QUERIES = {
    "crisis_ratios": crisis_ratios, "records_by_source": records_by_source, "panels_merged": panels_merged,
    "events_clean": events_clean, "events_funnel": events_funnel, "noise_removed": noise_removed, "events_by_area_month": events_by_area_month, "outer_merge_indicator": outer_merge_indicator,
    "record_themes": record_themes, "record_tone": record_tone, "record_counts": record_counts, "record_places": record_places, "record_months": record_months,
}
SQL = {
    "crisis_ratios": _CRISIS, "records_by_source": _BY_SOURCE, "panels_merged": _MERGED,
    "events_clean": _EVENTS + "select globaleventid, sqldate, eventcode, event_number, country, actiongeo_lat, actiongeo_long, nummentions, dateadded from clean",
    "events_funnel": _FUNNEL, "noise_removed": _NOISE, "events_by_area_month": _BY_AREA, "outer_merge_indicator": _OUTER,
    "record_themes": _THEMES, "record_tone": _TONE, "record_counts": _COUNTS, "record_places": _PLACES, "record_months": _MONTHS,
}
