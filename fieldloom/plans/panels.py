"""Queries over the district-by-month panel: windows, targets, baselines, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.functions import constants as K
from fieldloom.operators import baselines as B
from fieldloom.operators import panel as P
from fieldloom.operators import statistics as S
from fieldloom.functions.arrays import row_mean
from fieldloom.operators.aggregates import collect_features, guarded
from fieldloom.operators.joins import outer_merge
from fieldloom.session import table

KEYS = ["admin0", "admin1", "admin2"]


def district_panel(spark: SparkSession, root: str) -> DataFrame:
    """One row per district and period: greatest score, addresses and mentions; districts without a name are left out."""
    e = table(spark, root, "events_panel").filter(F.col("admin2").isNotNull() & F.col("period_ym").isNotNull())
    return e.groupBy(*KEYS, F.col("period_ym").alias("period")).agg(
        F.max("cs_score").alias("cs_score"),
        F.sum(F.size(F.coalesce("sourceurl", F.array()))).cast("bigint").alias("articles"),
        F.sum(F.aggregate(F.coalesce("nummentions", F.array()), F.lit(0).cast("bigint"), lambda s, x: s + F.coalesce(x, F.lit(0)))).cast("bigint").alias("mentions"),
    )


_PANEL = """
panel as (select admin0, admin1, admin2, period_ym as period, max(cs_score) as cs_score, cast(sum(coalesce(len(sourceurl), 0)) as bigint) as articles,
  cast(sum(coalesce(list_sum(nummentions), 0)) as bigint) as mentions from events_panel where admin2 is not null and period_ym is not null group by 1, 2, 3, 4)
"""
_W = "(partition by admin0, admin1, admin2 order by period)"
_ALL = "select admin0, admin1, admin2, period"


def monthly_conflicts(spark: SparkSession, root: str) -> DataFrame:
    """Every region and month of the whole span, with 0 where nothing was reported."""
    c = table(spark, root, "conflict_daily").filter(F.col("region").isNotNull() & F.col("event_date").isNotNull())
    seen = c.groupBy("region", F.date_format("event_date", "yyyyMM").alias("period")).agg(F.coalesce(F.sum("conflicts"), F.lit(0)).alias("conflicts"), F.coalesce(F.sum("fatalities"), F.lit(0)).alias("fatalities"))
    span = c.agg(F.trunc(F.min("event_date"), "MM").alias("a"), F.trunc(F.max("event_date"), "MM").alias("b")).filter(F.col("a").isNotNull())
    periods = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("d")).select(F.date_format("d", "yyyyMM").alias("period"))
    grid = P.scaffold(seen.select("region"), periods)
    return grid.join(seen, ["region", "period"], "left").na.fill(0, ["conflicts", "fatalities"])


_MONTHLY = """
seen as (select region, strftime(event_date, '%Y%m') as period, cast(coalesce(sum(conflicts), 0) as bigint) as conflicts, cast(coalesce(sum(fatalities), 0) as bigint) as fatalities
  from conflict_daily where region is not null and event_date is not null group by 1, 2),
span as (select date_trunc('month', min(event_date)) as a, date_trunc('month', max(event_date)) as b from conflict_daily where region is not null and event_date is not null),
periods as (select strftime(unnest(generate_series(a::timestamp, b::timestamp, interval 1 month)), '%Y%m') as period from span),
monthly as (select region, period, coalesce(conflicts, 0) as conflicts, coalesce(fatalities, 0) as fatalities
  from (select distinct region from seen) cross join periods left join seen using (region, period))
"""
_R = "(partition by region order by period)"


def lag_lead(spark: SparkSession, root: str) -> DataFrame:
    w = P.by_district()
    return district_panel(spark, root).select(*KEYS, "period", "cs_score", P.lag_of("cs_score", 1, w).alias("score_before"), P.lag_of("cs_score", 3, w).alias("score_3_before"), P.lead_of("cs_score", 3, w).alias("score_3_later"))


def transitions(spark: SparkSession, root: str) -> DataFrame:
    p, w = district_panel(spark, root), P.by_district()
    p = P.transitions_before(p, "cs_score", "transitions_prev").withColumn("changed", P.change_flag("cs_score", w))
    return p.select(*KEYS, "period", "changed", "transitions_prev", F.sum("changed").over(W.partitionBy(*KEYS)).alias("transitions_all"))


def rolling_before(spark: SparkSession, root: str) -> DataFrame:
    w = P.by_district(["region"])
    return monthly_conflicts(spark, root).select("region", "period", *[P.rolling_before(x, n, w, h).alias(f"{x}_{h}_{n}") for x in ("conflicts", "fatalities") for n in (3, 6) for h in ("sum", "avg")])


def rolling_with_least(spark: SparkSession, root: str) -> DataFrame:
    w = P.by_district()
    return district_panel(spark, root).select(*KEYS, "period", F.round(P.rolling_with("cs_score", 3, w), 9).alias("mean_3"), F.round(P.rolling_with("cs_score", 6, w, least=2), 9).alias("mean_6"))


def expanding_anomaly(spark: SparkSession, root: str) -> DataFrame:
    w = P.by_district(["region"])
    usual = P.mean_before("fatalities", w)
    return monthly_conflicts(spark, root).select("region", "period", F.round(usual, 9).alias("usual"), F.round(F.col("fatalities") - usual, 9).alias("anomaly"), P.running_total("fatalities", w).alias("so_far"))


def forecast_targets(spark: SparkSession, root: str) -> DataFrame:
    """Last observed score and next valid one, for rows with a valid last score."""
    w = P.by_district()
    p = district_panel(spark, root).select(*KEYS, "period", "cs_score", P.last_observed("cs_score", w).alias("score_last"), P.next_valid("cs_score", w).alias("score_next"))
    return p.filter(F.col("score_last").isin(K.VALID_SCORES))


def region_anomaly(spark: SparkSession, root: str) -> DataFrame:
    mean = P.group_mean("conflicts", ["region"])
    return monthly_conflicts(spark, root).select("region", "period", F.round(mean, 9).alias("usual"), F.round(F.col("conflicts") - mean, 9).alias("anomaly"))


def region_propagation(spark: SparkSession, root: str) -> DataFrame:
    """Whether a district, and any district of its region in the month, has articles."""
    p = district_panel(spark, root).withColumn("has_articles", (F.col("articles") > 0).cast("int"))
    return p.select(*KEYS, "period", "has_articles", P.group_max("has_articles", ["admin0", "admin1", "period"]).alias("region_has_articles"))


def escalation(spark: SparkSession, root: str) -> DataFrame:
    w = P.by_district(["region"])
    short, long = P.rolling_with("conflicts", 3, w), P.rolling_with("conflicts", 6, w)
    p = monthly_conflicts(spark, root).withColumn("r3", short).withColumn("r6", long)
    return p.select(
        "region", "period", F.round(F.col("r3") - F.col("r6"), 9).alias("escalation"), P.escalates(F.col("r3"), F.col("r6")).alias("is_escalating"), F.round(F.col("r3") / (F.col("r6") + 1e-6), 6).alias("intensity")
    )


def percent_change(spark: SparkSession, root: str) -> DataFrame:
    w = P.by_district(["region"])
    return monthly_conflicts(spark, root).select("region", "period", (F.col("conflicts") - F.lag("conflicts").over(w)).alias("change"), F.round(P.percent_change("conflicts", w), 9).alias("change_part"))


def between_observations(spark: SparkSession, root: str) -> DataFrame:
    """Articles between two scored periods of a country."""
    c = district_panel(spark, root).filter(F.col("admin0").isNotNull()).groupBy("admin0", "period").agg(F.max(F.when(F.col("cs_score").isin(K.VALID_SCORES), F.col("cs_score"))).alias("cs_score"), F.sum("articles").alias("articles"))
    odd = c.withColumn("seen", F.when(F.substring("period", 5, 2).isin("02", "06", "10"), F.col("cs_score")))
    return P.total_between(odd, "seen", "articles", "between", ["admin0"]).select("admin0", "period", "seen", "articles", "between")


def latest_periods(spark: SparkSession, root: str) -> DataFrame:
    return P.latest_periods(district_panel(spark, root), 7).select(*KEYS, "period", "cs_score")


def country_month_panel(spark: SparkSession, root: str) -> DataFrame:
    """Every country with every period; scores, articles and the score before joined to it."""
    p = district_panel(spark, root).filter(F.col("admin0").isNotNull())
    grid = P.scaffold(p.select("admin0"), p.select("period"))
    score = p.groupBy("admin0", "period").agg(F.max("cs_score").alias("cs_score"))
    articles = p.groupBy("admin0", "period").agg(F.sum("articles").alias("articles"))
    valid = score.filter(F.col("cs_score").isin(K.VALID_SCORES))
    before = valid.select("admin0", "period", F.lag("cs_score").over(P.by_district(["admin0"])).alias("score_before"))
    return grid.join(score, ["admin0", "period"], "left").join(articles, ["admin0", "period"], "left").join(before, ["admin0", "period"], "left").select("admin0", "period", "cs_score", F.coalesce("articles", F.lit(0)).alias("articles"), "score_before")


def baseline_previous(spark: SparkSession, root: str) -> DataFrame:
    return B.scores(B.previous_score(district_panel(spark, root)), ["period"])


def baseline_last_year(spark: SparkSession, root: str) -> DataFrame:
    return B.scores(B.same_period_last_year(district_panel(spark, root)), ["period"])


def baseline_max_two(spark: SparkSession, root: str) -> DataFrame:
    return B.scores(B.max_of_two_before(district_panel(spark, root)))


def confusion_matrix(spark: SparkSession, root: str) -> DataFrame:
    return B.confusion(B.previous_score(district_panel(spark, root)))


def baseline_summary(spark: SparkSession, root: str) -> DataFrame:
    """Accuracy of two baselines over all periods: mean, trimmed mean, deviation, range."""
    p = district_panel(spark, root)
    one = B.scores(B.previous_score(p), ["period"]).select(F.lit("previous").alias("model"), "accuracy")
    two = B.scores(B.same_period_last_year(p), ["period"]).select(F.lit("last_year").alias("model"), "accuracy")
    return B.trimmed_summary(one.unionByName(two), "accuracy", ["model"])


def period_splits(spark: SparkSession, root: str) -> DataFrame:
    return B.rolling_splits(district_panel(spark, root), 3, 20)


def class_weights(spark: SparkSession, root: str) -> DataFrame:
    return B.balanced_weights(table(spark, root, "labelled_text"), "impact_type")


def coverage(spark: SparkSession, root: str) -> DataFrame:
    """Per country: rows, rows with articles and with a valid score, as numbers and per cent."""
    has, valid = (F.col("articles") > 0).cast("int"), F.coalesce(F.col("cs_score").isin(K.VALID_SCORES), F.lit(False)).cast("int")
    return district_panel(spark, root).groupBy("admin0").agg(
        F.count("*").alias("n"), F.sum(has).alias("with_articles"), F.sum(valid).alias("with_score"), F.round(F.avg(has) * 100, 6).alias("articles_pct"), F.round(F.avg(valid) * 100, 6).alias("score_pct")
    )


def article_buckets(spark: SparkSession, root: str) -> DataFrame:
    """Districts by number of distinct articles, in fixed bins; empty bins are listed."""
    e = table(spark, root, "events_panel").filter(F.col("admin2").isNotNull())
    n = e.select(*KEYS, F.explode_outer("sourceurl").alias("u")).groupBy(*KEYS).agg(F.count_distinct("u").alias("n"))
    label = F.lit(K.ARTICLE_BINS[-1][1])
    for top, name in reversed(K.ARTICLE_BINS[:-1]):
        label = F.when(F.col("n") <= top, name).otherwise(label)
    bins = spark.createDataFrame([(name,) for _, name in K.ARTICLE_BINS], "bin string")
    return bins.join(n.groupBy(label.alias("bin")).agg(F.count("*").alias("districts")), "bin", "left").select("bin", F.coalesce("districts", F.lit(0)).alias("districts"))


def correlation(spark: SparkSession, root: str) -> DataFrame:
    return S.correlations(district_panel(spark, root).filter(F.col("cs_score").isin(K.VALID_SCORES)), ["cs_score", "articles", "mentions"])


def fixed_effects(spark: SparkSession, root: str) -> DataFrame:
    p = district_panel(spark, root).filter(F.col("cs_score").isin(K.VALID_SCORES))
    return S.fixed_effects_slope(p, "articles", "cs_score", "admin0", "period")


def duplicate_keys(spark: SparkSession, root: str) -> DataFrame:
    return S.duplicate_keys(table(spark, root, "events_panel"), [*KEYS, "period_ym"])


def period_pivot(spark: SparkSession, root: str) -> DataFrame:
    """Distinct districts with a valid score per country and year of the feed, as columns."""
    p = district_panel(spark, root).filter(F.col("cs_score").isin(K.VALID_SCORES))
    years = [str(y) for y in range(K.FIRST_YEAR, K.LAST_YEAR + 1)]
    wide = p.withColumn("y", F.substring("period", 1, 4)).groupBy("admin0").pivot("y", years).agg(F.count_distinct("admin2"))
    return wide.select("admin0", *[F.coalesce(F.col(y), F.lit(0)).alias(f"y{y}") for y in years])


def top_districts(spark: SparkSession, root: str) -> DataFrame:
    """The twenty district-months with most mentions (a report)."""
    return S.top_k(district_panel(spark, root).select(*KEYS, "period", "mentions"), 20, F.desc("mentions"), F.asc_nulls_last("admin0"), F.asc_nulls_last("admin1"), "admin2", "period")


def guarded_scores(spark: SparkSession, root: str) -> DataFrame:
    """Scores with those of the last period replaced by what was known before it."""
    p = district_panel(spark, root)
    last = p.agg(F.max("period")).first()[0]
    return guarded(p, KEYS, "cs_score", "period", last or "").select(*KEYS, "period", "cs_score", "known_score")


def aggregated_articles(spark: SparkSession, root: str) -> DataFrame:
    """Addresses of all districts of a region and month in one array, sums and parallel lists."""
    e = table(spark, root, "events_panel").filter(F.col("admin1").isNotNull()).withColumn("size", F.size(F.coalesce("sourceurl", F.array())))
    out = collect_features(e, ["admin0", "admin1", "period_ym"], ["panel_id"], lists=["panel_id", "sourceurl"], totals=["size"], means=["cs_score"])
    return out.select("admin0", "admin1", "period_ym", "size_sum", F.round("cs_score_mean", 9).alias("cs_score_mean"), F.array_join(F.transform("panel_id_list", lambda x: x.cast("string")), ",").alias("ids"), F.size("sourceurl_list").alias("n_urls"))


def label_any(spark: SparkSession, root: str) -> DataFrame:
    """Per impact type whether any text is urgent, needs food, or is long."""
    t = table(spark, root, "labelled_text").select("impact_type", (F.col("urgency") == "high").cast("int").alias("urgent"), F.contains("resource", F.lit("'food'")).cast("int").alias("food"), (F.length("clean_text") > 2000).cast("int").alias("long"))
    return S.any_of(t, ["impact_type"], ["urgent", "food", "long"])


def previous_by_region(spark: SparkSession, root: str) -> DataFrame:
    """The score class (rounded up) of the row before in the region, whose districts follow one another within a period."""
    p = district_panel(spark, root).withColumn("score_class", F.ceil("cs_score").cast("int"))
    w = P.by_district(["admin0", "admin1"]).orderBy("period", "admin2")
    return p.select(*KEYS, "period", "score_class", F.lag("score_class").over(w).alias("previous_class"))


def transitions_total(spark: SparkSession, root: str) -> DataFrame:
    """Changes of a district's score class over all its periods, on each of its rows."""
    p = district_panel(spark, root).withColumn("score_class", F.ceil("cs_score").cast("int"))
    flagged = p.withColumn("flag", P.change_flag("score_class", P.by_district()))
    return flagged.select(*KEYS, "period", F.sum("flag").over(P.W.partitionBy(*KEYS)).alias("transitions"))


def panel_summary(spark: SparkSession, root: str) -> DataFrame:
    return S.describe(district_panel(spark, root), ["cs_score", "articles", "mentions"])


def combined_scores(spark: SparkSession, root: str) -> DataFrame:
    """Scores of country and month from panel rows with and without articles: their mean, difference, and whether both are there."""
    e = table(spark, root, "events_panel").filter(F.col("admin0").isNotNull() & F.col("period_ym").isNotNull()).withColumn("has", F.size(F.coalesce("sourceurl", F.array())) > 0)
    side = lambda has: e.filter(F.col("has") == has).groupBy("admin0", F.col("period_ym").alias("period")).agg(F.max("cs_score").alias("score"))
    m = outer_merge(side(True), side(False), ["admin0", "period"], ("_events", "_records"))
    a, b = F.col("score_events"), F.col("score_records")
    return m.select(
        "admin0", "period", "score_events", "score_records", row_mean(["score_events", "score_records"]).alias("score_combined"), (a - b).alias("score_diff"), (a.isNotNull() & b.isNotNull()).cast("int").alias("has_both")
    )


QUERIES = {
    "previous_by_region": previous_by_region, "transitions_total": transitions_total, "panel_summary": panel_summary, "combined_scores": combined_scores,
    "guarded_scores": guarded_scores, "aggregated_articles": aggregated_articles, "label_any": label_any,
    "district_panel": district_panel, "monthly_conflicts": monthly_conflicts, "lag_lead": lag_lead, "transitions_prev": transitions, "rolling_lagged": rolling_before,
    "rolling_mean_least": rolling_with_least, "expanding_anomaly": expanding_anomaly, "forecast_targets": forecast_targets, "region_mean_anomaly": region_anomaly,
    "region_propagation": region_propagation, "escalation_ratio": escalation, "pct_change": percent_change, "sum_between_observations": between_observations,
    "latest_periods": latest_periods, "country_month_panel": country_month_panel, "baseline_previous": baseline_previous, "baseline_last_year": baseline_last_year,
    "baseline_max_two": baseline_max_two, "confusion_matrix": confusion_matrix, "baseline_summary": baseline_summary, "period_splits": period_splits,
    "balanced_class_weights": class_weights, "coverage_breakdown": coverage, "bucket_distribution": article_buckets, "pearson_corr": correlation,
    "fixed_effects_slope": fixed_effects, "dup_key_check": duplicate_keys, "nunique_pivot": period_pivot, "topk_sorted": top_districts,
}

_VALID = "cs_score in (1, 2, 3, 4, 5)"
_SCORED = f"""steps as (select period, row_number() over (order by period) as step from (select distinct period from panel where cs_score between 1 and 5)),
valid as (select panel.*, step from panel join steps using (period) where cs_score between 1 and 5)"""
_JOIN = "v.admin0 is not distinct from o.admin0 and v.admin1 is not distinct from o.admin1 and v.admin2 is not distinct from o.admin2"
_PREV = f"forecast as (select v.admin0, v.admin1, v.admin2, v.period, v.cs_score as actual, coalesce(o.cs_score, 0.0) as predicted from valid v left join valid o on {_JOIN} and o.step = v.step - 1)"
_YEAR = f"forecast as (select v.admin0, v.admin1, v.admin2, v.period, v.cs_score as actual, coalesce(o.cs_score, 0.0) as predicted from valid v left join valid o on {_JOIN} and cast(o.period as integer) = cast(v.period as integer) - 100)"
_MAX2 = f"""forecast as (select v.period, v.cs_score as actual, greatest(coalesce(o.cs_score, 0.0), coalesce(p.cs_score, 0.0)) as predicted from valid v
  left join valid o on {_JOIN} and o.step = v.step - 1 left join valid p on {_JOIN.replace("o.", "p.")} and p.step = v.step - 2)"""


def _score_sql(by: str) -> str:
    key, group = (f"{by}, ", f"group by {by}") if by else ("", "")
    on = f"f.{by} = l.{by} and " if by else ""
    return f"""labels as (select distinct {key}unnest([actual, predicted]) as label from forecast),
per as (select {"l." + by + "," if by else ""} label, count(*) filter (actual = label and predicted = label) as tp, count(*) filter (actual = label) as support, count(*) filter (predicted = label) as claimed
  from labels l join forecast f on {on}(f.actual = l.label or f.predicted = l.label) group by all),
rated as (select *, coalesce(tp / nullif(claimed, 0), 0) as p, coalesce(tp / nullif(support, 0), 0) as r from per),
full_ as (select *, coalesce(2 * p * r / nullif(p + r, 0), 0) as f from rated),
result as (select {key}cast(sum(support) as bigint) as rows, round(sum(tp) / sum(support), 9) as accuracy, round(sum(p * support) / sum(support), 9) as precision,
  round(sum(r * support) / sum(support), 9) as recall, round(sum(f * support) / sum(support), 9) as f1 from full_ {group})"""


def _rolls() -> str:
    out = []
    for x in ("conflicts", "fatalities"):
        for n in (3, 6):
            frame = f"over (partition by region order by period rows between {n} preceding and 1 preceding)"
            out += [f"cast(sum({x}) {frame} as bigint) as {x}_sum_{n}", f"avg({x}) {frame} as {x}_avg_{n}"]
    return ", ".join(out)


SQL = {
    "guarded_scores": f"""with {_PANEL} {_ALL}, cs_score, case when period = (select max(period) from panel) then
  last_value(case when cs_score between 1 and 5 then cs_score end ignore nulls) over (partition by admin0, admin1, admin2 order by period rows between unbounded preceding and 1 preceding) else cs_score end as known_score from panel""",
    "aggregated_articles": """select admin0, admin1, period_ym, cast(sum(coalesce(len(sourceurl), 0)) as bigint) as size_sum, round(avg(cs_score), 9) as cs_score_mean, string_agg(cast(panel_id as varchar), ',' order by panel_id) as ids,
  cast(sum(coalesce(len(sourceurl), 0)) as integer) as n_urls from events_panel where admin1 is not null group by 1, 2, 3""",
    "label_any": "select impact_type, coalesce(max(cast(urgency = 'high' as integer)), 0) as urgent, coalesce(max(cast(contains(resource, '''food''') as integer)), 0) as food, coalesce(max(cast(length(clean_text) > 2000 as integer)), 0) as long from labelled_text group by 1",
    "district_panel": f"with {_PANEL} select * from panel",
    "monthly_conflicts": f"with {_MONTHLY} select * from monthly",
    "lag_lead": f"with {_PANEL} {_ALL}, cs_score, lag(cs_score) over {_W} as score_before, lag(cs_score, 3) over {_W} as score_3_before, lead(cs_score, 3) over {_W} as score_3_later from panel",
    "transitions_prev": f"""with {_PANEL}, f as (select *, coalesce(cast(cs_score <> lag(cs_score) over {_W} as integer), 1) as changed from panel),
  r as (select *, sum(changed) over {_W} as run from f)
  {_ALL}, changed, cast(lag(run) over {_W} as bigint) as transitions_prev, cast(sum(changed) over (partition by admin0, admin1, admin2) as bigint) as transitions_all from r""",
    "rolling_lagged": f"with {_MONTHLY} select region, period, {_rolls()} from monthly",
    "rolling_mean_least": f"""with {_PANEL} {_ALL}, round(avg(cs_score) over a, 9) as mean_3, case when count(cs_score) over b >= 2 then round(avg(cs_score) over b, 9) end as mean_6 from panel
  window a as (partition by admin0, admin1, admin2 order by period rows between 2 preceding and current row), b as (partition by admin0, admin1, admin2 order by period rows between 5 preceding and current row)""",
    "expanding_anomaly": f"""with {_MONTHLY}, u as (select *, avg(fatalities) over (partition by region order by period rows between unbounded preceding and 1 preceding) as m from monthly)
  select region, period, round(m, 9) as usual, round(fatalities - m, 9) as anomaly, cast(sum(fatalities) over {_R} as bigint) as so_far from u""",
    "forecast_targets": f"""with {_PANEL}, t as (select *, last_value(cs_score ignore nulls) over (partition by admin0, admin1, admin2 order by period rows between unbounded preceding and current row) as score_last,
  first_value(case when cs_score between 1 and 5 then cs_score end ignore nulls) over (partition by admin0, admin1, admin2 order by period rows between 1 following and unbounded following) as score_next from panel)
  {_ALL}, cs_score, score_last, score_next from t where score_last in (1, 2, 3, 4, 5)""",
    "region_mean_anomaly": f"with {_MONTHLY} select region, period, round(avg(conflicts) over (partition by region), 9) as usual, round(conflicts - avg(conflicts) over (partition by region), 9) as anomaly from monthly",
    "region_propagation": f"with {_PANEL} {_ALL}, cast(articles > 0 as integer) as has_articles, max(cast(articles > 0 as integer)) over (partition by admin0, admin1, period) as region_has_articles from panel",
    "escalation_ratio": f"""with {_MONTHLY}, r as (select *, avg(conflicts) over (partition by region order by period rows between 2 preceding and current row) as r3,
  avg(conflicts) over (partition by region order by period rows between 5 preceding and current row) as r6 from monthly)
  select region, period, round(r3 - r6, 9) as escalation, cast(coalesce(r3 > r6, false) as integer) as is_escalating, round(r3 / (r6 + 1e-6), 6) as intensity from r""",
    "pct_change": f"with {_MONTHLY}, l as (select *, lag(conflicts) over {_R} as b from monthly) select region, period, conflicts - b as change, round((conflicts - b) / nullif(b, 0), 9) as change_part from l",
    "sum_between_observations": f"""with {_PANEL}, c as (select admin0, period, max(case when {_VALID} then cs_score end) as s, cast(sum(articles) as bigint) as articles from panel where admin0 is not null group by 1, 2),
  o as (select *, case when substr(period, 5, 2) in ('02', '06', '10') then s end as seen from c),
  i as (select *, coalesce(sum(cast(seen is not null as integer)) over (partition by admin0 order by period rows between unbounded preceding and 1 preceding), 0) as island from o)
  select admin0, period, seen, articles, case when seen is not null and island > 0 then cast(sum(articles) over (partition by admin0, island) as bigint) end as between from i""",
    "latest_periods": f"with {_PANEL} {_ALL}, cs_score from panel where period in (select distinct period from panel order by period desc limit 7)",
    "country_month_panel": f"""with {_PANEL}, p as (select * from panel where admin0 is not null), s as (select admin0, period, max(cs_score) as cs_score, cast(sum(articles) as bigint) as articles from p group by 1, 2),
  b as (select admin0, period, lag(cs_score) over (partition by admin0 order by period) as score_before from s where {_VALID})
  select admin0, period, cs_score, coalesce(articles, 0) as articles, score_before from (select distinct admin0 from p) cross join (select distinct period from p) left join s using (admin0, period) left join b using (admin0, period)""",
    "baseline_previous": f"with {_PANEL}, {_SCORED}, {_PREV}, {_score_sql('period')} select * from result",
    "baseline_last_year": f"with {_PANEL}, {_SCORED}, {_YEAR}, {_score_sql('period')} select * from result",
    "baseline_max_two": f"with {_PANEL}, {_SCORED}, {_MAX2}, {_score_sql('')} select * from result",
    "confusion_matrix": f"""with {_PANEL}, {_SCORED}, {_PREV}, g as (select cast(a as double) as actual, cast(b as double) as predicted from range(1, 6) x(a), range(1, 6) y(b)),
  c as (select actual, predicted, count(*) as n from forecast group by 1, 2), f as (select actual, predicted, coalesce(n, 0) as n from g left join c using (actual, predicted))
  select actual, predicted, n, round(coalesce(n / nullif(sum(n) over (partition by actual), 0), 0), 9) as share from f""",
    "baseline_summary": f"""with {_PANEL}, {_SCORED}, a as (with {_PREV}, {_score_sql('period')} select 'previous' as model, accuracy from result), b as (with {_YEAR}, {_score_sql('period')} select 'last_year' as model, accuracy from result),
  v as (select model, list(accuracy order by accuracy) as v from (select * from a union all select * from b) group by 1)
  select model, cast(len(v) as integer) as n, round(list_avg(v), 9) as mean, round(case when len(v) > 2 then list_sum(v[2:len(v) - 1]) / (len(v) - 2) else list_avg(v) end, 9) as trimmed_mean,
  round(list_stddev_pop(v), 9) as std, round(list_stddev_pop(v) / nullif(list_avg(v), 0), 9) as cv, round(list_max(v) - list_min(v), 9) as range from v""",
    "period_splits": f"with {_PANEL}, {_SCORED} select t.period as test_period, s.period as train_period from steps t join steps s on s.step between t.step - 20 and t.step - 1 where t.step > (select max(step) from steps) - 3",
    "balanced_class_weights": "with c as (select impact_type, count(*) as n from labelled_text where impact_type is not null group by 1) select impact_type, n, round(sum(n) over () / (count(*) over () * n), 9) as weight from c",
    "coverage_breakdown": f"""with {_PANEL} select admin0, count(*) as n, cast(sum(cast(articles > 0 as integer)) as bigint) as with_articles, cast(sum(cast(coalesce({_VALID}, false) as integer)) as bigint) as with_score,
  round(avg(cast(articles > 0 as integer)) * 100, 6) as articles_pct, round(avg(cast(coalesce({_VALID}, false) as integer)) * 100, 6) as score_pct from panel group by 1""",
    "bucket_distribution": """with e as (select admin0, admin1, admin2, sourceurl from events_panel where admin2 is not null),
  n as (select admin0, admin1, admin2, count(distinct u) as n from (select admin0, admin1, admin2, unnest(case when len(sourceurl) > 0 then sourceurl else [null] end) as u from e) group by 1, 2, 3),
  b as (select unnest(['0', '1-5', '6-10', '11-20', '21-50', '50+']) as bin, unnest([-1, 0, 5, 10, 20, 50]) as lo, unnest([0, 5, 10, 20, 50, 1000000000]) as hi)
  select bin, count(n.n) as districts from b left join n on n.n > lo and n.n <= hi group by 1""",
    "pearson_corr": f"""with {_PANEL}, p as (select cs_score, cast(articles as double) as articles, cast(mentions as double) as mentions from panel where {_VALID})
  """ + " union all ".join(f"select '{a}' as x, '{b}' as y, round(corr({a}, {b}), 9) as r from p" for a in ("cs_score", "articles", "mentions") for b in ("cs_score", "articles", "mentions")),
    "previous_by_region": f"with {_PANEL} {_ALL}, cast(ceil(cs_score) as integer) as score_class, lag(cast(ceil(cs_score) as integer)) over (partition by admin0, admin1 order by period, admin2) as previous_class from panel",
    "transitions_total": f"with {_PANEL}, f as (select *, coalesce(cast(ceil(cs_score) <> lag(ceil(cs_score)) over {_W} as integer), 1) as flag from panel) {_ALL}, cast(sum(flag) over (partition by admin0, admin1, admin2) as bigint) as transitions from f",
    "panel_summary": f"with {_PANEL} " + " union all ".join(f"select '{c}' as column, count({c}) as count, round(avg({c}), 9) as mean, round(stddev_samp({c}), 9) as std, cast(min({c}) as double) as min, " + ", ".join(f"quantile_cont(cast({c} as double), 0.{q}) as p{q}" for q in (25, 50, 75)) + f", cast(max({c}) as double) as max from panel" for c in ("cs_score", "articles", "mentions")),
    "combined_scores": """with e as (select admin0, period_ym as period, cs_score, coalesce(len(sourceurl), 0) > 0 as has from events_panel where admin0 is not null and period_ym is not null),
  a as (select admin0, period, max(cs_score) as score_events from e where has group by 1, 2), b as (select admin0, period, max(cs_score) as score_records from e where not has group by 1, 2)
  select admin0, period, score_events, score_records, case when score_events is null then score_records when score_records is null then score_events else (score_events + score_records) / 2 end as score_combined,
  score_events - score_records as score_diff, cast(score_events is not null and score_records is not null as integer) as has_both from a full join b using (admin0, period)""",
    "dup_key_check": "select admin0, admin1, admin2, period_ym, count(*) as n from events_panel group by 1, 2, 3, 4 having count(*) > 1",
    "nunique_pivot": f"with {_PANEL} select admin0, " + ", ".join(f"count(distinct admin2) filter (substr(period, 1, 4) = '{y}') as y{y}" for y in range(K.FIRST_YEAR, K.LAST_YEAR + 1)) + f" from panel where {_VALID} group by 1",
    "topk_sorted": f"with {_PANEL} {_ALL}, mentions from panel order by mentions desc, admin0 nulls last, admin1 nulls last, admin2, period limit 20",
}
