"""From the feeds to area-months: nearest areas, names brought into line, and the join with the score panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions import constants as K
from fieldloom.functions import text as X
from fieldloom.operators import geo as G
from fieldloom.operators.joins import best_text_match, outer_merge
from fieldloom.plans.feeds import _EVENTS, consolidated_events
from fieldloom.session import table
from fieldloom.sources import readers, writers

AREA = ["name_0", "name_1", "name_2"]


def aligned_areas(areas: DataFrame) -> DataFrame:
    """The areas with normalised names, brought into line with the score table."""
    return G.align_areas(areas.select("poly_id", *[X.normalize_name(c).alias(c) for c in AREA], "geometry"))


def with_areas(df: DataFrame, key: str, lat: str, lon: str, areas: DataFrame) -> DataFrame:
    """``df`` with ``name_0..2`` of the nearest of ``areas`` (null without valid coordinates) instead of names it has."""
    found = G.nearest_area(df, key, lat, lon, areas).join(areas.select(F.col("poly_id").alias("area_id"), *AREA), "area_id", "left").select(F.col(key).alias("__k"), *AREA)
    return df.drop(*AREA).join(found, F.col(key) == F.col("__k"), "left").drop("__k")


def area_months(events: DataFrame, areas: DataFrame) -> DataFrame:
    """Events and mentions per area and month (``yyyyMM``) of usable events, by the areas nearest to them."""
    known = [c for c in AREA if c not in events.columns]
    e = consolidated_events(events.select("*", *[F.lit(None).cast("string").alias(c) for c in known]))
    mapped = with_areas(e.select("globaleventid", "sqldate", "actiongeo_lat", "actiongeo_long", "nummentions"), "globaleventid", "actiongeo_lat", "actiongeo_long", aligned_areas(areas))
    period = F.floor(F.col("sqldate") / 100).cast("string").alias("period")
    return mapped.groupBy(*AREA, period).agg(F.count("*").alias("n"), F.coalesce(F.sum("nummentions"), F.lit(0)).alias("mentions"))


def write_area_months(spark: SparkSession, feed: str | list[str], areas: DataFrame, path: str, files: int = 1) -> list[str]:
    """Reads feed files, maps them in one pass and writes the months that ``path`` doesn't hold yet, one folder each; returns these months.

    Months present are left as they are, so an interrupted or daily run only adds.
    """
    from pyspark.errors import AnalysisException

    table_ = area_months(readers.events_tsv(spark, feed), areas).filter(F.col("period").isNotNull())
    try:
        table_ = writers.missing_periods(table_, spark.read.parquet(path))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    writers.by_period(table_, path, files=files)
    return sorted(r.period for r in table_.select("period").distinct().collect())  # a few hundred months


def events_mapped(spark: SparkSession, root: str) -> DataFrame:
    """Events and mentions of every area and month."""
    return area_months(table(spark, root, "gdelt_events"), table(spark, root, "admin_polygons"))


def records_merged(spark: SparkSession, root: str) -> DataFrame:
    """Score panel and records of the same district and month, both kept, with what side each row comes from; records are mapped by their first wanted place."""
    place = X.first_coordinates("v2locations", K.FIPS, entries=";")
    stamp = F.when(F.col("gkg_date").rlike(r"^\d{14}$"), F.substring("gkg_date", 1, 6))
    r = table(spark, root, "gkg_raw").select(F.xxhash64("gkgrecordid", "gkg_date", "v2locations").alias("k"), "gkgrecordid", stamp.alias("period"), place["lat"].alias("lat"), place["lon"].alias("lon")).filter("gkgrecordid is not null").distinct()
    mapped = with_areas(r, "k", "lat", "lon", aligned_areas(table(spark, root, "admin_polygons")))
    records = mapped.groupBy(F.col("name_1").alias("admin1"), F.col("name_2").alias("admin2"), "period").agg(F.count_distinct("gkgrecordid").alias("n_records"))
    scores = table(spark, root, "events_panel").groupBy(X.normalize_name("admin1").alias("admin1"), X.normalize_name("admin2").alias("admin2"), F.col("period_ym").alias("period")).agg(F.max("cs_score").alias("cs_score"))
    return outer_merge(scores, records, ["admin1", "admin2", "period"], indicator="side")


def nearest_area(spark: SparkSession, root: str) -> DataFrame:
    """The nearest polygon of every event; null columns where it has no valid coordinates."""
    events = table(spark, root, "gdelt_events")
    found = G.nearest_area(events, "globaleventid", "actiongeo_lat", "actiongeo_long", table(spark, root, "admin_polygons"))
    return found.select("globaleventid", "area_id", F.round("distance_m", 3).alias("distance_m"))


def largest_parts(spark: SparkSession, root: str) -> DataFrame:
    """Corners and rings of every polygon: those of its largest ring and how many it has."""
    return table(spark, root, "admin_polygons").select("poly_id", F.size(G.largest_part("geometry")).alias("corners"), F.size("geometry").alias("rings"))


#: Areas of the countries the rules name, put beside those of the map.
NAMED = [
    ("burundi", "ngozi", "Nyamurenza"), ("burundi", "kirundo", "butaganzwa2"), ("burundi", "muramvya", "muramvya"), ("burundi", None, "buhinyuza"), ("cameroon", "Extreme Nord", "diamare"), ("cameroon", " nord", "benoue"),
    ("cameroon", "sud", "ocean"), ("chad", "c", "barh el gazel"), ("niger", "sud", "barh el gazel"), ("kenya", "bungoma", "likuyani"), ("kenya", "bungoma", "kimilili"), ("mauritania", "hodh ech chargui", "ouadane"),
    ("mauritania", "hodh ech chargui", "nema"), ("sierra leone", "western", "freetown"), ("guinea", "western", "boke"), ("yemen", "al jawf", "az zahir"), ("yemen", "ibb", "az zahir"), ("zimbabwe", "masvingo urban", "masvingo"),
    ("zimbabwe", "harare", "harare"), ("zimbabwe", "harare", "epworth"), ("malawi", "lilongwe", "lilongwe city"), ("malawi", "nkhata bay", "nkhata bay boma"), ("malawi", "zomba", "zomba town"), ("malawi", "likoma", "likoma"),
    ("uganda", "apac", "oyam"), ("uganda", "apac", "maruzi"), ("uganda", "kampala", "kampala central"), ("uganda", "hoima", None), ("uganda", "unlisted", "sheema"), (None, "harare", "harare"), ("kenya", None, None),
]


def area_rules(spark: SparkSession, root: str) -> DataFrame:
    """Area names after the renaming rules, of the map and of the countries the rules name."""
    named = spark.createDataFrame([(-1 - i, *x) for i, x in enumerate(NAMED)], "poly_id bigint, name_0 string, name_1 string, name_2 string")
    p = table(spark, root, "admin_polygons").select("poly_id", *[F.lower(c).alias(c) for c in AREA])
    return G.align_areas(p.unionByName(named))


def _crosswalk(spark: SparkSession, root: str) -> DataFrame:
    """The unit with the same names but for spelling, per area of the map; the smallest of several."""
    key = lambda *c: [X.normalize_for_match(x).alias(f"k{i}") for i, x in enumerate(c)]
    p = table(spark, root, "admin_polygons").select("poly_id", *key(*AREA))
    u = table(spark, root, "admin_units").select("unit_id", *key("admin0", "admin1", "admin2"))
    return p.join(u, ["k0", "k1", "k2"]).groupBy("poly_id").agg(F.min("unit_id").alias("unit_id"))


def crosswalk_units(spark: SparkSession, root: str) -> DataFrame:
    """Names of the map replaced by those of the unit the crosswalk gives; areas it doesn't hold keep theirs."""
    units = table(spark, root, "admin_units").select("unit_id", *[F.col(f"admin{i}").alias(f"u{i}") for i in range(3)])
    p = table(spark, root, "admin_polygons").select("poly_id", *AREA).join(_crosswalk(spark, root), "poly_id", "left").join(units, "unit_id", "left")
    return p.select("poly_id", "unit_id", *[F.coalesce(f"u{i}", f"name_{i}").alias(f"admin{i}") for i in range(3)])


def renamed_areas(spark: SparkSession, root: str) -> DataFrame:
    """District names of the map after one pass of a table of renamings made from the crosswalk, in which names are chained and swapped."""
    units = table(spark, root, "admin_units").select("unit_id", F.lower("admin2").alias("new"), F.lower("admin1").alias("region"))
    p = table(spark, root, "admin_polygons").select("poly_id", F.lower("name_1").alias("name_1"), F.lower("name_2").alias("name_2"))
    met = p.join(_crosswalk(spark, root), "poly_id").join(units, "unit_id")
    pairs = met.select(F.col("name_2").alias("old"), "region").union(met.select(F.col("region").alias("old"), F.col("name_2").alias("region")))
    names = pairs.filter("old is not null").groupBy("old").agg(F.min("region").alias("new"))
    return G.rename_once(p, ["name_1", "name_2"], names)


def fuzzy_crosswalk(spark: SparkSession, root: str) -> DataFrame:
    """The unit of the list most like each polygon's region and district by the weighted ratio, at least 50."""
    whole = lambda a, b: F.concat_ws(" ", X.normalize_for_match(a), X.normalize_for_match(b))
    p = table(spark, root, "admin_polygons").filter(F.col("name_1").isNotNull() & F.col("name_2").isNotNull()).select("poly_id", F.col("name_0").alias("country"), whole("name_1", "name_2").alias("t"))
    u = table(spark, root, "admin_units").select("unit_id", F.col("admin0").alias("country"), whole("admin1", "admin2").alias("e"))
    return best_text_match(p, u, "country", "poly_id", "t", "unit_id", "e")


QUERIES = {
    "events_mapped": events_mapped, "records_merged": records_merged, "nearest_area": nearest_area, "largest_parts": largest_parts, "area_rules": area_rules,
    "crosswalk_units": crosswalk_units, "renamed_areas": renamed_areas, "fuzzy_crosswalk": fuzzy_crosswalk,
}


def _plain(c: str) -> str:
    return f"translate({c}, '{X.ACCENTED}', '{X.PLAIN}')"


def _blank(c: str) -> str:
    return f"regexp_replace({c}, '[\\p{{Z}}\\t\\n\\r]', ' ', 'g')"


def _name(c: str) -> str:
    return f"translate(replace(trim(lower({_plain(_blank(c))})), '-', ' '), '''`', '')"


def _match(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace(lower({_plain(c)}), '\\bal\\b', '', 'g'), '[^a-z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g'))"


def _text(x: str | None) -> str:
    return "null" if x is None else "'" + x.replace("'", "''") + "'"


def _rules_sql() -> str:
    steps = ["r0 as (select poly_id, lower(name_0) as name_0, lower(name_1) as name_1, lower(name_2) as name_2 from admin_polygons union all select * from (values " + ", ".join(f"({-1 - i}, {', '.join(map(_text, x))})" for i, x in enumerate(NAMED)) + ") v(poly_id, name_0, name_1, name_2))"]

    def step(column: str, value: str) -> None:
        names = ", ".join(f"{value} as {c}" if c == column else c for c in AREA)
        steps.append(f"r{len(steps)} as (select poly_id, {names} from r{len(steps) - 1})")

    for where, column, to in G.AREA_RULES:
        cond = " and ".join(f"{c} = {_text(v)}" for c, v in where.items())
        new = f"case lower(trim({column})) " + " ".join(f"when {_text(a)} then {_text(b)}" for a, b in to.items()) + f" else {column} end" if isinstance(to, dict) else _text(to)
        step(column, f"case when {cond} then {new} else {column} end")
    step("name_2", "case when name_0 = 'malawi' then regexp_replace(name_2, ' (boma|city|town)', '', 'g') else name_2 end")
    step("name_2", f"case when name_0 = 'uganda' and coalesce(name_2 not in ({', '.join(map(_text, G.UGANDA_KEPT))}), true) then name_1 else name_2 end")
    step("name_1", "case when name_0 = 'uganda' then case name_1 " + " ".join(f"when {_text(d)} then {_text(r)}" for d, r in G.UGANDA_REGIONS.items()) + " else name_1 end else name_1 end")
    return "with " + ", ".join(steps) + f" select * from r{len(steps) - 1}"


_EDGES = """rings as (select poly_id, ring, ring_no from (select poly_id, unnest(geometry) as ring, generate_subscripts(geometry, 1) as ring_no from admin_polygons)),
edges as (select poly_id, ring[i].lon as x1, ring[i].lat as y1, ring[i % len(ring) + 1].lon as x2, ring[i % len(ring) + 1].lat as y2 from (select poly_id, ring, unnest(range(1, len(ring) + 1)) as i from rings where len(ring) > 2))"""
_INSIDE = """boxes as (select poly_id, min(x1) as bx1, max(x1) as bx2, min(y1) as by1, max(y1) as by2 from edges group by 1),
inside as (select lat, lon, poly_id from (select lat, lon, b.poly_id, e.* exclude (poly_id) from spots join boxes b on lat between by1 and by2 and lon between bx1 and bx2 join edges e on e.poly_id = b.poly_id)
  where (y1 > lat) <> (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 group by 1, 2, 3 having count(*) % 2 = 1)"""


def _spots(rows: str, lat: str, lon: str) -> str:
    return f"spots as (select distinct {lat} as lat, {lon} as lon from {rows} where {lat} between -90 and 90 and {lon} between -180 and 180 and not ({lat} = 0 and {lon} = 0)), {_INSIDE}"


_SPOTS = _spots("gdelt_events", "actiongeo_lat", "actiongeo_long")
_MAP_Y = "6378137.0 * ln(tan(pi() / 4 + radians(greatest(-85.06, least(85.06, {}))) / 2))"
_CROSSWALK = f"""cross_ as (select poly_id, min(unit_id) as unit_id from admin_polygons p join admin_units u on {_match('p.name_0')} = {_match('u.admin0')} and {_match('p.name_1')} = {_match('u.admin1')} and {_match('p.name_2')} = {_match('u.admin2')} group by 1)"""
_NEAREST_OF = f"""m as (select poly_id, radians(x1) * 6378137.0 as ax, {_MAP_Y.format('y1')} as ay, radians(x2) * 6378137.0 as bx, {_MAP_Y.format('y2')} as by_ from edges),
  outside as (select lat, lon, radians(lon) * 6378137.0 as px, {_MAP_Y.format('lat')} as py from spots where (lat, lon) not in (select (lat, lon) from inside)),
  d as (select lat, lon, poly_id, px, py, ax, ay, bx - ax as vx, by_ - ay as vy, greatest(0, least(1, ((px - ax) * (bx - ax) + (py - ay) * (by_ - ay)) / greatest((bx - ax) ** 2 + (by_ - ay) ** 2, 1e-12))) as t from outside cross join m),
  f as (select lat, lon, poly_id, round(min(sqrt((px - ax - t * vx) ** 2 + (py - ay - t * vy) ** 2)), 6) as d from d group by 1, 2, 3 union all select lat, lon, poly_id, 0.0 from inside),
  n as (select lat, lon, poly_id, d from (select *, row_number() over (partition by lat, lon order by d, poly_id) as rn from f) where rn = 1)"""
_NEAREST = f"{_EDGES}, {_SPOTS}, {_NEAREST_OF}"
_NAMES = "names as (select poly_id, " + ", ".join(f"{_name(c)} as {c}" for c in AREA) + " from admin_polygons)"
_FIPS = ", ".join(map(_text, K.FIPS))
SQL = {
    "nearest_area": f"""with {_NEAREST},
  e as (select distinct globaleventid, case when ok then actiongeo_lat end as lat, case when ok then actiongeo_long end as lon from (select *, coalesce(actiongeo_lat between -90 and 90 and actiongeo_long between -180 and 180 and not (actiongeo_lat = 0 and actiongeo_long = 0), false) as ok from gdelt_events))
  select globaleventid, poly_id as area_id, round(d, 3) as distance_m from e left join n using (lat, lon)""",
    "events_mapped": f"""{_EVENTS}, {_NEAREST},
  {_NAMES},
  mapped as (select a.name_0, a.name_1, a.name_2, cast(sqldate // 100 as varchar) as period, nummentions from clean left join n on actiongeo_lat = n.lat and actiongeo_long = n.lon left join names a using (poly_id))
  select name_0, name_1, name_2, period, count(*) as n, cast(coalesce(sum(nummentions), 0) as bigint) as mentions from mapped group by 1, 2, 3, 4""",
    "records_merged": f"""with s as (select gkgrecordid, case when regexp_full_match(gkg_date, '[0-9]{{14}}') then substr(gkg_date, 1, 6) end as period,
    list_filter(list_transform(string_split(v2locations, ';'), lambda e: string_split(e, '#')), lambda p: len(p) >= 7) as a from gkg_raw where gkgrecordid is not null),
  g as (select gkgrecordid, period, list_filter(list_transform(a, lambda p: struct_pack(c := p[3], lat := try_cast(p[6] as double), lon := try_cast(p[7] as double))),
    lambda p: p.lat is not null and p.lon is not null and not (p.lat = 0 and p.lon = 0)) as g from s),
  rec as (select gkgrecordid, period, p.lat as rlat, p.lon as rlon from (select *, coalesce(list_filter(g, lambda p: list_contains([{_FIPS}], p.c))[1], g[1]) as p from g)),
  {_EDGES}, {_spots("rec", "rlat", "rlon")}, {_NEAREST_OF}, {_NAMES},
  records as (select name_1 as admin1, name_2 as admin2, period, count(distinct gkgrecordid) as n_records from rec left join n on rlat = n.lat and rlon = n.lon left join names using (poly_id) group by 1, 2, 3),
  scores as (select {_name("admin1")} as admin1, {_name("admin2")} as admin2, period_ym as period, max(cs_score) as cs_score from events_panel group by 1, 2, 3)
  select coalesce(s.admin1, r.admin1) as admin1, coalesce(s.admin2, r.admin2) as admin2, coalesce(s.period, r.period) as period, cs_score, n_records,
    case when s.k and r.k then 'both' when s.k then 'left_only' else 'right_only' end as side
  from (select *, true as k from scores) s full join (select *, true as k from records) r on s.admin1 is not distinct from r.admin1 and s.admin2 is not distinct from r.admin2 and s.period is not distinct from r.period""",
    "largest_parts": """with r as (select poly_id, unnest(geometry) as ring from admin_polygons),
  a as (select poly_id, len(ring) as n, abs(list_sum(list_transform(range(2, len(ring) + 1), lambda i: ring[i - 1].lon * ring[i].lat - ring[i].lon * ring[i - 1].lat))) / 2 as area from r where len(ring) > 3),
  b as (select poly_id, first(n order by area desc) as n from a group by 1) select p.poly_id, cast(n as integer) as corners, cast(len(geometry) as integer) as rings from admin_polygons p left join b using (poly_id)""",
    "area_rules": _rules_sql(),
    "crosswalk_units": f"with {_CROSSWALK} select poly_id, c.unit_id, coalesce(admin0, name_0) as admin0, coalesce(admin1, name_1) as admin1, coalesce(admin2, name_2) as admin2 from admin_polygons left join cross_ c using (poly_id) left join admin_units u on u.unit_id = c.unit_id",
    "renamed_areas": f"""with {_CROSSWALK}, p as (select poly_id, lower(name_1) as name_1, lower(name_2) as name_2 from admin_polygons), met as (select name_2, lower(u.admin1) as region from p join cross_ using (poly_id) join admin_units u using (unit_id)),
  names as (select old, min(new) as new from (select name_2 as old, region as new from met union all select region, name_2 from met) where old is not null group by 1)
  select poly_id, coalesce(a.new, name_1) as name_1, coalesce(b.new, name_2) as name_2 from p left join names a on a.old = name_1 left join names b on b.old = name_2""",
}
