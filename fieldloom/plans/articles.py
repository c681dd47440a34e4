"""Queries over articles: filters, text features, arrays per district, joins by address, near-duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions import arrays as A
from fieldloom.functions import constants as K
from fieldloom.functions import text as X
from fieldloom.operators import dedupe as D
from fieldloom.operators import joins as J
from fieldloom.operators import statistics as S
from fieldloom.session import table

LEXICON = ["harvest", "crop", "drought", "food aid", "malnourished", "fungus in the fields", "sorghum", "x"]
COUNTRIES = sorted(set(K.DEMONYMS.values()))


def lexicon_filter(spark: SparkSession, root: str) -> DataFrame:
    """Documents with a word of the lexicon."""
    return table(spark, root, "documents").filter(X.matches_lexicon("text", LEXICON)).select("doc_id", "lang", "n_chars")


def crisis_filter(spark: SparkSession, root: str) -> DataFrame:
    """Documents with a crisis term of either vocabulary, and which."""
    one, two = X.matches_crisis("text"), X.matches_crisis("text", K.CRISIS_TERMS_RECORDS)
    return table(spark, root, "documents").filter(one | two).select("doc_id", one.cast("int").alias("events_term"), two.cast("int").alias("records_term"))


def keyword_freq(spark: SparkSession, root: str) -> DataFrame:
    """Words of each category per document."""
    return table(spark, root, "documents").select("doc_id", *X.category_counts(F.translate("text", ".", " ")).values())


def truncate_words(spark: SparkSession, root: str) -> DataFrame:
    """The first 500 words of every labelled text."""
    return table(spark, root, "labelled_text").select("text_id", X.truncate_words("clean_text").alias("head"))


def _with_demonyms(spark: SparkSession, root: str) -> DataFrame:
    """Documents with two of the demonyms put behind the text, as the invented places have none."""
    names = F.array(*[F.lit(d.title()) for d in K.DEMONYMS])
    at = lambda k: F.get(names, F.pmod(F.col("doc_id") * k + k, F.lit(len(K.DEMONYMS))).cast("int"))
    return table(spark, root, "documents").select("doc_id", F.concat("text", F.lit(" A "), at(1), F.lit(" and a "), at(7), F.lit(" trader")).alias("text"))


_WITH_DEMONYMS = "d as (select doc_id, text || ' A ' || n[(doc_id + 1) % len(n) + 1] || ' and a ' || n[(doc_id * 7 + 7) % len(n) + 1] || ' trader' as text from documents, (select [" + ", ".join(f"'{d.title()}'" for d in K.DEMONYMS) + "] as n))"


def main_country(spark: SparkSession, root: str) -> DataFrame:
    """The country named most often, anywhere in the text or by the demonyms in it."""
    d = _with_demonyms(spark, root).select("doc_id", X.inject_countries("text").alias("text"))
    return d.select("doc_id", X.main_country("text", COUNTRIES).alias("main"))


def demonyms(spark: SparkSession, root: str) -> DataFrame:
    """Texts with the countries of the demonyms found in them appended."""
    return _with_demonyms(spark, root).select("doc_id", F.md5(X.inject_countries("text")).alias("digest"))


def url_domain(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").groupBy(X.domain("url").alias("domain")).agg(F.count("*").alias("n"))


def blacklisted(spark: SparkSession, root: str) -> DataFrame:
    """The host of each article, its failures (texts that are missing or ``Error``), and whether they are a hundred."""
    a = table(spark, root, "articles_events").withColumn("domain", X.domain("sourceurl"))
    failed = F.coalesce(F.col("clean_text").isin("Error", ""), F.lit(True))
    n = a.filter("domain is not null").groupBy("domain").agg(F.count_if(failed).alias("failures"))
    return a.join(n, "domain", "left").select("article_id", "domain", "failures", F.coalesce(F.col("failures") >= 100, F.lit(True)).alias("is_blacklisted"))


def normalized_names(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "admin_units").select("unit_id", X.normalize_name("admin2").alias("plain"), X.normalize_for_match("admin2").alias("matched"), X.normalize_for_hash("admin1").alias("hashed"))


def country_or_filter(spark: SparkSession, root: str) -> DataFrame:
    """Articles with a listed country in one of three columns."""
    listed = table(spark, root, "admin_units").select(F.lower("admin0").alias("name")).distinct()
    a = table(spark, root, "articles_events").select("article_id", "ner_admin0", "ner_admin1", "ner_admin2")
    named = a.select("article_id", F.explode(F.array(*[F.lower(c) for c in ("ner_admin0", "ner_admin1", "ner_admin2")])).alias("name"))
    hits = named.join(listed, "name", "left_semi").select("article_id").distinct()
    return a.join(hits, "article_id", "left_semi").select("article_id", "ner_admin0")


def article_features(articles: DataFrame) -> DataFrame:
    """One row per address (the last article id wins) with the features that are carried to the panel."""
    return J.last_per_key(articles.filter(F.col("sourceurl").isNotNull()).select("sourceurl", "article_id", "compound_score", "fatalities_count", "pred_impact_type"), ["sourceurl"], ["article_id"])


def mapped_features(spark: SparkSession, root: str) -> DataFrame:
    """Per panel row the features of its addresses as parallel arrays, addresses without an article left out."""
    panel = table(spark, root, "events_panel").select("panel_id", "sourceurl")
    return J.map_array(panel, "panel_id", "sourceurl", article_features(table(spark, root, "articles_events")), "sourceurl", ["article_id", "compound_score", "fatalities_count", "pred_impact_type"])


_FEATURES = """
last as (select sourceurl, article_id, compound_score, fatalities_count, pred_impact_type from (select *, row_number() over (partition by sourceurl order by article_id desc) as rn from articles_events where sourceurl is not null) where rn = 1),
items as (select panel_id, unnest(sourceurl) as sourceurl, generate_subscripts(sourceurl, 1) as pos from events_panel),
met as (select panel_id, pos, last.* from items join last using (sourceurl)),
mapped as (select panel_id, list(article_id order by pos) as article_id_list, list(compound_score order by pos) as compound_score_list, list(fatalities_count order by pos) as fatalities_count_list,
  list(pred_impact_type order by pos) as pred_impact_type_list from met group by 1),
feats as (select panel_id, coalesce(article_id_list, []) as article_id_list, coalesce(compound_score_list, []) as compound_score_list, coalesce(fatalities_count_list, []) as fatalities_count_list,
  coalesce(pred_impact_type_list, []) as pred_impact_type_list from events_panel left join mapped using (panel_id))
"""


def array_reducers(spark: SparkSession, root: str) -> DataFrame:
    """Mean, max, sum, count, deviation and min of the arrays of each panel row."""
    f = mapped_features(spark, root).select("panel_id", "compound_score_list", "fatalities_count_list")
    out = A.reduce_arrays(f, ["compound_score_list", "fatalities_count_list"], prefix="evt_").drop("compound_score_list", "fatalities_count_list")
    return out.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])


def _reduced_sql() -> str:
    out = []
    for c in ("compound_score", "fatalities_count"):
        n = f"list_filter(list_transform({c}_list, lambda x: cast(x as double)), lambda x: x is not null)"
        out += [
            f"round(list_avg({n}), 9) as evt_{c}_mean", f"round(list_max({n}), 9) as evt_{c}_max", f"round(list_sum({n}), 9) as evt_{c}_sum", f"cast(len({c}_list) as integer) as evt_{c}_count",
            f"round(list_stddev_pop({n}), 9) as evt_{c}_std", f"round(list_min({n}), 9) as evt_{c}_min",
        ]
    return ", ".join(out)


def capped_arrays(spark: SparkSession, root: str) -> DataFrame:
    """Counts with their ceiling, for rows with more than one article or a valid score."""
    f = mapped_features(spark, root).join(table(spark, root, "events_panel").select("panel_id", "cs_score"), "panel_id")
    kept = f.filter((A.raw_size("fatalities_count_list") > 1) | F.coalesce(F.col("cs_score").isin(K.VALID_SCORES), F.lit(False)))
    return kept.select("panel_id", *[A.cap("fatalities_count_list", K.COUNT_CAPS[c]).alias(f"capped_as_{c}") for c in ("fatalities", "torture")], A.safe_total("fatalities_count_list").alias("total"), A.non_empty("fatalities_count_list").alias("has_articles"))


def category_counter(spark: SparkSession, root: str) -> DataFrame:
    """How often each impact label stands in the arrays of a panel row."""
    f = mapped_features(spark, root)
    return f.select("panel_id", *[A.count_of("pred_impact_type_list", c).alias(f"impact_{c}") for c in K.IMPACT_LABELS])


def parallel_dedupe(spark: SparkSession, root: str) -> DataFrame:
    """Parallel arrays reduced to the first place of each event code."""
    p = table(spark, root, "events_panel").select("panel_id", "eventcode", "sqldate", "nummentions")
    return A.parallel_dedupe(p, "eventcode", ["sqldate", "nummentions"])


def flatten_parallel(spark: SparkSession, root: str) -> DataFrame:
    p = table(spark, root, "events_panel").select("panel_id", "sourceurl", "eventcode", "nummentions")
    return A.flatten_parallel(p, "sourceurl", ["eventcode", "nummentions"])


def fill_country(spark: SparkSession, root: str) -> DataFrame:
    """Country of panel rows, taken away where a row has no score and filled again by region and district."""
    p = table(spark, root, "events_panel").select("panel_id", F.when(F.col("cs_score").isNotNull(), F.col("admin0")).alias("admin0"), "admin1", "admin2")
    known = J.last_per_key(p.filter(F.col("admin0").isNotNull()).select("admin1", "admin2", "admin0", "panel_id"), ["admin1", "admin2"], ["panel_id"])
    return J.fill_from_lookup(p, known, ["admin1", "admin2"], "admin0")


def semi_valid(spark: SparkSession, root: str) -> DataFrame:
    """Addresses of panel rows that have an article, in order."""
    return J.keep_known(table(spark, root, "events_panel").select("panel_id", "sourceurl"), "panel_id", "sourceurl", table(spark, root, "articles_events").filter(F.col("clean_text").isNotNull()), "sourceurl", "valid_sourceurl")


def anti_processed(spark: SparkSession, root: str) -> DataFrame:
    """Distinct web addresses of the events that have no text yet (none fetched or the fetch failed), in order."""
    urls = table(spark, root, "gdelt_events").select("sourceurl").filter(F.col("sourceurl").startswith("http")).distinct()
    done = table(spark, root, "articles_events").filter(F.col("sourceurl").isNotNull() & ~F.col("clean_text").isin("Error", ""))
    return J.unprocessed(urls, done, "sourceurl").orderBy("sourceurl")


def union_by_name(spark: SparkSession, root: str) -> DataFrame:
    """Articles of both feeds in one table; columns one lacks are null."""
    e = table(spark, root, "articles_events").select("article_id", "ner_admin0", "compound_score", "pred_urgency", "eventcode", F.lit("events").alias("feed"))
    g = table(spark, root, "articles_gkg").select("article_id", "ner_admin0", "compound_score", "pred_urgency", "seen_at", F.lit("gkg").alias("feed"))
    return e.unionByName(g, allowMissingColumns=True)


def country_articles(spark: SparkSession, root: str) -> DataFrame:
    """Countries of the list with their articles; countries without one have 0 and no data."""
    n = table(spark, root, "articles_events").filter(F.col("ner_admin0").isNotNull()).groupBy(F.lower("ner_admin0").alias("k")).agg(F.count("*").alias("article_count"))
    c = table(spark, root, "admin_units").select("admin0").distinct()
    return c.join(n, F.lower("admin0") == F.col("k"), "left").select("admin0", F.coalesce("article_count", F.lit(0)).alias("article_count"), F.col("article_count").isNotNull().cast("int").alias("has_data"))


def label_modes(spark: SparkSession, root: str) -> DataFrame:
    """Most frequent urgency per impact type, the smallest on a tie."""
    return S.mode_of(table(spark, root, "labelled_text").filter(F.col("impact_type").isNotNull()), ["impact_type"], "urgency")


def label_flags(spark: SparkSession, root: str) -> DataFrame:
    """One column per resource label of the list that is stored as text."""
    labels = A.parse_text_list(F.coalesce("resource", F.lit("")))
    return table(spark, root, "labelled_text").select("text_id", *[F.array_contains(labels, r).cast("int").alias(f"resource_{r}") for r in K.RESOURCE_LABELS])


def text_features(spark: SparkSession, root: str) -> DataFrame:
    """Sentiment and numbers per category of every document (approximate, by lexicon)."""
    d = table(spark, root, "documents").select("doc_id", "text")
    counted = X.count_categories(d, "text")
    return counted.withColumn("sentiment", X.sentiment("text")).select("doc_id", *[f"{c}_count" for c in K.NUMBER_CATEGORIES], F.col("sentiment.compound").alias("compound"), F.col("sentiment.neg").alias("neg"))


def cleaned_words(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "labelled_text").select("text_id", X.clean_words_column("clean_text").alias("words"))


def token_windows(spark: SparkSession, root: str) -> DataFrame:
    """Windows of 64 words, one starting at every 32nd."""
    words = F.filter(F.split(F.regexp_replace("clean_text", r"\s+", " "), " "), lambda w: w != "")
    t = table(spark, root, "labelled_text").select("text_id", F.posexplode(X.token_windows(words, 64, 32)).alias("window", "w"))
    return t.select("text_id", "window", F.size("w").alias("n_words"), F.get("w", F.lit(0)).alias("first_word"))


def found_places(spark: SparkSession, root: str) -> DataFrame:
    """Names of districts and regions in each article, in order, and the areas chosen from them."""
    units = table(spark, root, "admin_units")
    names = units.select(F.col("admin2").alias("name")).union(units.select("admin1")).union(units.select("admin0"))
    places = X.find_places(table(spark, root, "articles_gkg").select("article_id", "clean_text"), "clean_text", names, key="article_id")
    return places.withColumn("a", X.choose_admins("places")).select("article_id", F.size("places").alias("n_places"), "a.admin0", "a.admin1", "a.admin2")


def near_duplicates(spark: SparkSession, root: str) -> DataFrame:
    """Class, links and survival of every document: word sets at least 0.9 alike."""
    return D.deduplicate_by_similarity(table(spark, root, "documents").select("doc_id", "text"), "doc_id", "text", 0.9)


def shingle_duplicates(spark: SparkSession, root: str) -> DataFrame:
    """Class, links and survival of every document: runs of five words at least 0.8 alike."""
    return D.deduplicate_by_shingles(table(spark, root, "documents").select("doc_id", "text"), "doc_id", "text")


def minhash_dedupe(spark: SparkSession, root: str) -> DataFrame:
    """Class, links and survival of every document at the MinHash form's threshold, with the links its bands miss."""
    return D.deduplicate_by_minhash(table(spark, root, "documents").select("doc_id", "text"), "doc_id", "text")


def windowed_duplicates(spark: SparkSession, root: str) -> DataFrame:
    """Which documents survive where only the next 999 in the order of ids are compared: word sets 0.9 alike."""
    return D.deduplicate_in_window(table(spark, root, "documents").select("doc_id", "text"), "doc_id", "text")


def ratio_features(spark: SparkSession, root: str) -> DataFrame:
    """Ratios per country and month of events: mentions and articles per source, coverage, logs."""
    e = table(spark, root, "gdelt_events").filter(F.col("globaleventid").isNotNull())
    m, s, a = (F.coalesce(c, F.lit(0)) for c in ("nummentions", "numsources", "numarticles"))
    return e.select(
        "globaleventid", F.round(m / (s + 1), 9).alias("mentions_per_source"), F.round(a / (s + 1), 9).alias("articles_per_source"), (m * s).cast("bigint").alias("coverage"), F.round(F.log1p(F.greatest(m, F.lit(0))), 9).alias("log_mentions"),
        F.round(F.abs("avgtone") / (F.abs("avgtone") + 1), 9).alias("tone_part"), A.row_total(["nummentions", "numsources"]).cast("bigint").alias("total"), F.round(A.row_mean(["nummentions", "numsources", "numarticles"]), 9).alias("average"),
        F.coalesce("name_2", "name_1", "name_0").isNotNull().cast("int").alias("is_placed"),
    ).distinct()


def html_extract(spark: SparkSession, root: str) -> DataFrame:
    """Title and paragraphs of pages made from the eval items, with a script that holds a paragraph end."""
    d = table(spark, root, "eval_items")
    html = F.concat(F.lit("<html><head><title>Item "), F.col("item_id"), F.lit("</title><script>var x='</p>';</script></head><body><p> "), F.regexp_replace("text", "[<>&]", " "), F.lit(" </p><div>aside</div><p>end</p></body></html>"))
    return X.extract_pages(d.select("item_id", html.alias("html")), "html").select("item_id", "header", F.md5("body").alias("body_digest"))


TOPIC_LISTS = {"Conflict": ["soldiers", "militia", "clashes"], "Climate": ["drought", "floods", "rain"], "Food Security": ["harvest", "maize", "sorghum"]}


def topic_labels(spark: SparkSession, root: str) -> DataFrame:
    """Topic of each document by keyword lists, later lists overriding earlier ones, and how grave its source's tone is."""
    from fieldloom.operators.learning import topic_label

    words = table(spark, root, "documents").select("doc_id", F.split(F.lower("text"), "[^a-z]+").alias("words"))
    return words.select("doc_id", topic_label("words", TOPIC_LISTS).alias("topic"))


def tone_by_topic(spark: SparkSession, root: str) -> DataFrame:
    """Mean severity (the negated compound score) and rows per urgency, to three places, half to even."""
    a = table(spark, root, "articles_gkg")
    return a.groupBy("pred_urgency").agg(F.count("*").alias("n"), F.bround(-F.avg("compound_score"), 3).alias("severity"))


def single_elements(spark: SparkSession, root: str) -> DataFrame:
    """The only element of arrays of one, else null, and how long the arrays are."""
    p = table(spark, root, "events_panel")
    return p.select("panel_id", A.flatten_single("eventcode").alias("only_code"), A.flatten_single("nummentions").alias("only_mentions"), A.raw_size("eventcode").alias("n"))


def text_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Accuracy, micro and macro F1 of guessing each text's urgency by the most frequent one of its impact type."""
    t = table(spark, root, "labelled_text").filter(F.col("urgency").isNotNull() & F.col("impact_type").isNotNull())
    guess = S.mode_of(t, ["impact_type"], "urgency").withColumnRenamed("urgency", "guess")
    pairs = t.join(guess, "impact_type").groupBy(F.col("urgency").alias("a"), F.col("guess").alias("b")).agg(F.count("*").alias("n"))
    labels = F.array(*[F.lit(x) for x in K.URGENCY_LABELS])
    per = pairs.select(F.explode(labels).alias("l"), "a", "b", "n").groupBy("l").agg(
        F.sum(F.when((F.col("a") == F.col("l")) & (F.col("b") == F.col("l")), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when((F.col("a") == F.col("l")) != (F.col("b") == F.col("l")), F.col("n")).otherwise(0)).alias("wrong"),
        F.sum(F.when(F.col("a") == F.col("l"), F.col("n")).otherwise(0)).alias("support"),
    )
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("wrong")), F.lit(0.0))
    return per.agg(F.round(F.try_divide(F.sum("tp"), F.sum("support")), 9).alias("accuracy"), F.round(F.try_divide(2 * F.sum("tp"), 2 * F.sum("tp") + F.sum("wrong")), 9).alias("micro_f1"), F.round(F.avg(f1), 9).alias("macro_f1"))


QUERIES = {
    "html_extract": html_extract, "topic_labels": topic_labels, "tone_by_urgency": tone_by_topic, "single_elements": single_elements, "text_metrics": text_metrics,
    "lexicon_filter": lexicon_filter, "crisis_filter": crisis_filter, "keyword_freq": keyword_freq, "truncate_words": truncate_words, "main_country": main_country, "demonym_injection": demonyms,
    "url_domain": url_domain, "blacklisted_domains": blacklisted, "normalized_names": normalized_names, "country_or_filter": country_or_filter, "mapped_features": mapped_features,
    "array_collect_reduce": array_reducers, "array_cap": capped_arrays, "category_counter": category_counter, "parallel_dedupe": parallel_dedupe, "flatten_parallel": flatten_parallel,
    "lookup_fill_admin0": fill_country, "semi_valid_docs": semi_valid, "anti_processed": anti_processed, "union_by_name": union_by_name, "country_articles": country_articles,
    "label_modes": label_modes, "label_flags": label_flags, "text_features": text_features, "cleaned_words": cleaned_words, "token_windows": token_windows, "found_places": found_places,
    "near_duplicates": near_duplicates, "shingle_duplicates": shingle_duplicates, "minhash_dedupe": minhash_dedupe,
    "windowed_duplicates": windowed_duplicates, "ratio_features": ratio_features,
}


def _plain(c: str) -> str:
    return f"translate({c}, '{X.ACCENTED}', '{X.PLAIN}')"


def _match(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace(lower({_plain(c)}), '\\bal\\b', '', 'g'), '[^a-z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g'))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_LISTED = ", ".join(_quoted(c) for c in COUNTRIES)
_HITS = ", ".join(f"case when contains(lower(text), {_quoted(d)}) then {_quoted(c)} end" for d, c in K.DEMONYMS.items())
_INJECTED = f"select doc_id, case when len(c) > 0 then text || ' ' || array_to_string(list_sort(list_distinct(c)), ' ') || ' ' else text end as text from (select *, list_filter([{_HITS}], lambda x: x is not null) as c from d)"
_LEX = "|".join(X.lexicon_terms(LEXICON))
_FAILED = "(clean_text is null or clean_text in ('Error', ''))"
_DOMAIN = "nullif(replace(lower(regexp_extract({}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), 'www.', ''), '')"
SQL = {
    "html_extract": "select item_id, 'Item ' || item_id as header, md5(trim(regexp_replace(text, '[<>&]', ' ', 'g')) || ' end') as body_digest from eval_items",
    "topic_labels": "with w as (select doc_id, regexp_split_to_array(lower(text), '[^a-z]+') as w from documents) select doc_id, case when list_has_any(w, ['harvest', 'maize', 'sorghum']) then 'Food Security' when list_has_any(w, ['drought', 'floods', 'rain']) then 'Climate' when list_has_any(w, ['soldiers', 'militia', 'clashes']) then 'Conflict' else 'Other' end as topic from w",
    "tone_by_urgency": "select pred_urgency, count(*) as n, round_even(-avg(compound_score), 3) as severity from articles_gkg group by 1",
    "single_elements": "select panel_id, case when len(eventcode) = 1 then eventcode[1] end as only_code, case when len(nummentions) = 1 then nummentions[1] end as only_mentions, cast(coalesce(len(eventcode), 0) as integer) as n from events_panel",
    "text_metrics": """with t as (select impact_type, urgency from labelled_text where urgency is not null and impact_type is not null),
  g as (select impact_type, urgency as guess from (select impact_type, urgency, row_number() over (partition by impact_type order by count(*) desc, urgency) as rn from t group by 1, 2) where rn = 1),
  p as (select urgency as a, guess as b from t join g using (impact_type)), l as (select unnest(['low', 'moderate', 'high', 'unclear']) as l),
  c as (select l, count(*) filter (a = l and b = l) as tp, count(*) filter ((a = l) <> (b = l)) as wrong, count(*) filter (a = l) as support from l cross join p group by 1)
  select round(sum(tp) / sum(support), 9) as accuracy, round(2 * sum(tp) / (2 * sum(tp) + sum(wrong)), 9) as micro_f1, round(avg(coalesce(2 * tp / nullif(2 * tp + wrong, 0), 0)), 9) as macro_f1 from c""",
    "lexicon_filter": f"select doc_id, lang, n_chars from documents where regexp_matches(text, '\\b(?:{_LEX})\\b', 'i')",
    "crisis_filter": "with r as (select doc_id, " + ", ".join(f"cast(coalesce(regexp_matches(text, '{'|'.join(t)}', 'i'), false) as integer) as {n}" for n, t in (("events_term", K.CRISIS_TERMS_EVENTS), ("records_term", K.CRISIS_TERMS_RECORDS))) + " from documents) select * from r where events_term + records_term > 0",
    "keyword_freq": "with t as (select doc_id, lower(replace(coalesce(text, ''), '.', ' ')) as t from documents) select doc_id, " + ", ".join(f"cast(len(regexp_extract_all(t, '\\b(?:{'|'.join(w)})\\b')) as integer) as {c}_freq" for c, w in K.WORD_CATEGORIES.items()) + " from t",
    "truncate_words": "select text_id, array_to_string(string_split(trim(regexp_replace(clean_text, '\\s+', ' ', 'g')), ' ')[1:500], ' ') as head from labelled_text",
    "main_country": f"with {_WITH_DEMONYMS}, i as ({_INJECTED}), c as (select doc_id, t as name, o, lower(text) as l from i, (select unnest([{_LISTED}]) as t, unnest(range({len(COUNTRIES)})) as o)), n as (select *, (length(l) - length(replace(l, name, ''))) // length(name) as n from c) select doc_id, case when max(n) > 0 then first(name order by n desc, o) end as main from n group by 1",
    "demonym_injection": f"with {_WITH_DEMONYMS}, i as ({_INJECTED}) select doc_id, md5(text) as digest from i",
    "url_domain": f"select {_DOMAIN.format('url')} as domain, count(*) as n from documents group by 1",
    "blacklisted_domains": f"with a as (select article_id, clean_text, {_DOMAIN.format('sourceurl')} as domain from articles_events), n as (select domain, count(*) filter ({_FAILED}) as failures from a where domain is not null group by 1) select article_id, a.domain, failures, coalesce(failures >= 100, true) as is_blacklisted from a left join n using (domain)",
    "normalized_names": f"select unit_id, translate(replace(trim(lower({_plain('admin2')})), '-', ' '), '''`', '') as plain, {_match('admin2')} as matched, trim(regexp_replace(regexp_replace(lower(admin1), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')) as hashed from admin_units",
    "country_or_filter": "with l as (select lower(admin0) as c from (select distinct admin0 from admin_units)) select article_id, ner_admin0 from articles_events where coalesce(lower(ner_admin0) in (select c from l), false) or coalesce(lower(ner_admin1) in (select c from l), false) or coalesce(lower(ner_admin2) in (select c from l), false)",
    "mapped_features": f"with {_FEATURES} select * from feats",
    "array_collect_reduce": f"with {_FEATURES} select panel_id, {_reduced_sql()} from feats",
    "array_cap": f"with {_FEATURES} select f.panel_id, list_transform(fatalities_count_list, lambda x: case when x > 50 then 50 else x end) as capped_as_fatalities, list_transform(fatalities_count_list, lambda x: case when x > 10 then 10 else x end) as capped_as_torture, coalesce(list_sum(list_transform(fatalities_count_list, lambda x: cast(coalesce(x, 0) as double))), 0.0) as total, cast(len(fatalities_count_list) > 0 as integer) as has_articles from feats f join events_panel using (panel_id) where len(fatalities_count_list) > 1 or coalesce(cs_score in (1, 2, 3, 4, 5), false)",
    "category_counter": f"with {_FEATURES} select panel_id, " + ", ".join(f"cast(len(list_filter(pred_impact_type_list, lambda x: x = '{c}')) as integer) as impact_{c}" for c in K.IMPACT_LABELS) + " from feats",
    "parallel_dedupe": "with p as (select panel_id, eventcode, sqldate, nummentions, list_filter(range(1, len(eventcode) + 1), lambda i: list_position(eventcode, eventcode[i]) = i) as places from events_panel) select panel_id, " + ", ".join(f"list_transform(places, lambda i: {c}[i]) as {c}" for c in ("eventcode", "sqldate", "nummentions")) + " from p",
    "flatten_parallel": "with p as (select panel_id, unnest(sourceurl) as sourceurl, generate_subscripts(sourceurl, 1) as i, eventcode, nummentions from events_panel) select panel_id, cast(i - 1 as integer) as pos, sourceurl, eventcode[i] as eventcode, cast(nummentions[i] as varchar) as nummentions from p",
    "lookup_fill_admin0": "with p as (select panel_id, case when cs_score is not null then admin0 end as admin0, admin1, admin2 from events_panel), k as (select admin1, admin2, first(admin0 order by panel_id desc) as v from p where admin0 is not null group by 1, 2) select panel_id, coalesce(p.admin0, v) as admin0, p.admin1, p.admin2 from p left join k on p.admin1 is not distinct from k.admin1 and p.admin2 is not distinct from k.admin2",
    "semi_valid_docs": "with i as (select panel_id, unnest(sourceurl) as u, generate_subscripts(sourceurl, 1) as pos from events_panel), k as (select panel_id, list(u order by pos) as l from i where u in (select sourceurl from articles_events where clean_text is not null and sourceurl is not null) group by 1) select panel_id, coalesce(l, []) as valid_sourceurl from events_panel left join k using (panel_id)",
    "anti_processed": "select distinct sourceurl from gdelt_events where sourceurl like 'http%' and sourceurl not in (select sourceurl from articles_events where sourceurl is not null and clean_text not in ('Error', '')) order by 1",
    "union_by_name": "select article_id, ner_admin0, compound_score, pred_urgency, eventcode, cast(null as timestamp) as seen_at, 'events' as feed from articles_events union all select article_id, ner_admin0, compound_score, pred_urgency, null, seen_at, 'gkg' from articles_gkg",
    "country_articles": "with n as (select lower(ner_admin0) as k, count(*) as c from articles_events where ner_admin0 is not null group by 1) select admin0, coalesce(c, 0) as article_count, cast(c is not null as integer) as has_data from (select distinct admin0 from admin_units) left join n on lower(admin0) = k",
    "label_modes": "select impact_type, urgency from (select impact_type, urgency, row_number() over (partition by impact_type order by count(*) desc, urgency) as rn from labelled_text where impact_type is not null and urgency is not null group by 1, 2) where rn = 1",
    "label_flags": "select text_id, " + ", ".join(f"cast(coalesce(contains(resource, '''{r}'''), false) as integer) as resource_{r}" for r in K.RESOURCE_LABELS) + " from labelled_text",
    "token_windows": "with t as (select text_id, list_filter(string_split(regexp_replace(clean_text, '\\s+', ' ', 'g'), ' '), lambda w: w <> '') as w from labelled_text), s as (select text_id, w, unnest(range(0, len(w), 32)) as i from t) select text_id, cast(i // 32 as integer) as window, cast(least(64, len(w) - i) as integer) as n_words, w[i + 1] as first_word from s",
    "ratio_features": """with e as (select *, coalesce(nummentions, 0) as m, coalesce(numsources, 0) as s, coalesce(numarticles, 0) as a from gdelt_events where globaleventid is not null)
  select distinct globaleventid, round(m / (s + 1), 9) as mentions_per_source, round(a / (s + 1), 9) as articles_per_source, cast(m * s as bigint) as coverage, round(ln(1 + greatest(m, 0)), 9) as log_mentions,
  round(abs(avgtone) / (abs(avgtone) + 1), 9) as tone_part, cast(m + s as bigint) as total,
  round((m + s + a) / nullif(cast(nummentions is not null as integer) + cast(numsources is not null as integer) + cast(numarticles is not null as integer), 0), 9) as average,
  cast(coalesce(name_2, name_1, name_0) is not null as integer) as is_placed from e""",
}
