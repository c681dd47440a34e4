"""Queries of the general data problems: trailing totals, packed fields, points and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.operators.packed import FEED_LAYOUTS, unpack_fields
from fieldloom.operators.rolling import latest_revisions, trailing_totals
from fieldloom.operators.spatial import locate
from fieldloom.plans.mapping import _EDGES, _SPOTS
from fieldloom.session import table

WINDOWS = (7, 30)
RADIUS_KM = 10.0


def _daily(spark: SparkSession, root: str) -> DataFrame:
    reports = table(spark, root, "conflict_daily").select("report_id", "region", "event_date", "conflicts", "fatalities", "reported_at")
    return latest_revisions(reports, "report_id", "reported_at")


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    """Totals of the last 7 and 30 days for every region and day."""
    totals = trailing_totals(_daily(spark, root), "region", "event_date", ["conflicts", "fatalities"], WINDOWS, averages=False)
    return totals.select("region", F.date_format("event_date", "yyyy-MM-dd").alias("day"), "conflicts_7", "fatalities_7", "conflicts_30", "fatalities_30")


def p2_averages(spark: SparkSession, root: str) -> DataFrame:
    """Totals and daily averages of the last 7 and 30 days for every region and day."""
    totals = trailing_totals(_daily(spark, root), "region", "event_date", ["conflicts", "fatalities"], WINDOWS)
    return totals.select("region", F.date_format("event_date", "yyyy-MM-dd").alias("day"), *[F.round(c, 9).alias(c) if c.endswith("_avg") else F.col(c) for c in totals.columns[2:]])


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    """One row per value of the packed fields of the feed."""
    raw = table(spark, root, "gkg_raw").select("gkgrecordid", *FEED_LAYOUTS)
    return unpack_fields(raw, "gkgrecordid", FEED_LAYOUTS).distinct()


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    """The polygon around each event and the market sites within 10 km of it."""
    events = table(spark, root, "gdelt_events").select("globaleventid", "actiongeo_lat", "actiongeo_long")
    found = locate(
        events, "globaleventid", "actiongeo_lat", "actiongeo_long",
        places=table(spark, root, "market_sites"), radius_km=RADIUS_KM, regions=table(spark, root, "admin_polygons"),
    )
    return found.select("kind", F.col("key").alias("globaleventid"), "ref_id")


QUERIES = {"p2_found": p2_found, "p2_averages": p2_averages, "p4_found": p4_found, "p7_found": p7_found}

_DAYS = """
with kept as (
  select * from (select *, row_number() over (partition by report_id order by reported_at desc nulls last, region desc nulls last, event_date desc nulls last,
    conflicts desc nulls last, fatalities desc nulls last) as rn from conflict_daily where report_id is not null) where rn = 1
), used as (
  select region, event_date, conflicts, fatalities from kept
  union all select region, event_date, conflicts, fatalities from conflict_daily where report_id is null
), daily as (
  select region, event_date as d, sum(coalesce(conflicts, 0)) as c, sum(coalesce(fatalities, 0)) as f from used
  where region is not null and event_date is not null group by 1, 2
), days as (
  select region, cast(unnest(generate_series(a::timestamp, b::timestamp, interval 1 day)) as date) as d from (select region, min(d) as a, max(d) as b from daily group by 1)
), filled as (
  select region, d, coalesce(c, 0) as c, coalesce(f, 0) as f from days left join daily using (region, d)
), totals as (
  select region, strftime(d, '%Y-%m-%d') as day,
    cast(sum(c) over w7 as bigint) as conflicts_7, cast(sum(f) over w7 as bigint) as fatalities_7,
    cast(sum(c) over w30 as bigint) as conflicts_30, cast(sum(f) over w30 as bigint) as fatalities_30
  from filled window w7 as (partition by region order by d rows between 6 preceding and current row), w30 as (partition by region order by d rows between 29 preceding and current row)
)
"""
SQL = {
    "p2_found": _DAYS + "select * from totals",
    "p2_averages": _DAYS
    + """select region, day, conflicts_7, conflicts_30, fatalities_7, fatalities_30, round(conflicts_7 / 7.0, 9) as conflicts_7_avg, round(conflicts_30 / 30.0, 9) as conflicts_30_avg,
    round(fatalities_7 / 7.0, 9) as fatalities_7_avg, round(fatalities_30 / 30.0, 9) as fatalities_30_avg from totals""",
    "p7_found": f"""with {_EDGES}, {_SPOTS},
  near as (select lat, lon, site_id from spots s join (select site_id, lat as slat, lon as slon from market_sites) on abs(lat - slat) < 0.1
    where 2 * 6371.0 * asin(sqrt(least(1.0, sin(radians(slat - lat) / 2) ** 2 + cos(radians(lat)) * cos(radians(slat)) * sin(radians(slon - lon) / 2) ** 2))) <= 10),
  met as (select 'near' as kind, lat, lon, site_id as ref_id from near union all select 'in', lat, lon, poly_id from inside)
  select distinct kind, globaleventid, ref_id from gdelt_events join met on actiongeo_lat = lat and actiongeo_long = lon where globaleventid is not null""",
}
