import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.functions import arrays as A
from fieldloom.functions import constants as K
from fieldloom.functions import text as X


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first().y


def test_array_reducers(spark):
    a = [1.0, None, 4.0, float("nan"), float("inf"), 1.0]
    got = spark.createDataFrame([(a, []), (None, None)], "a_list array<double>, b_list array<double>")
    rows = A.reduce_arrays(got, ["a_list", "b_list"]).collect()
    assert rows[0].a_mean == 2.0 and rows[0].a_max == 4.0 and rows[0].a_sum == 6.0 and rows[0].a_count == 6 and rows[0].a_min == 1.0
    assert rows[0].a_std == pytest.approx(np.std([1, 4, 1])) and rows[0].b_mean is None and rows[0].b_count == 0
    assert rows[1].a_sum is None and rows[1].a_count == 0
    assert one(spark, ["1", "x", None, "2.5"], "array<string>", A.safe_total("x")) == 3.5
    assert one(spark, None, "array<string>", A.safe_total("x")) == 0.0
    assert A.reduced_kinds("fatalities_count") == ["mean", "count", "sum", "max"] and A.reduced_kinds("body", True) == ["count"]


def test_parallel_arrays(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a", None, None], [1, 2, 3, 4, 5], [9]), (2, None, [1], None), (3, [], [], [])], "id int, k array<string>, v array<int>, w array<int>")
    rows = {r.id: r for r in A.parallel_dedupe(df, "k", ["v", "w"]).collect()}
    assert rows[1].k == ["a", "b", None] and rows[1].v == [1, 2, 4] and rows[1].w == [9, None, None]
    assert rows[2].k is None and rows[2].v == [1] and rows[3].k == []
    flat = A.flatten_parallel(df, "k", ["v", "w"]).filter("id = 1").orderBy("pos").collect()
    assert [r.v for r in flat] == ["1", "2", "3", "4", "5"] and [r.w for r in flat] == ["9"] * 5


def test_array_helpers(spark):
    assert one(spark, [3, None, 9], "array<int>", A.cap("x", 5)) == [3, None, 5]
    assert one(spark, ["a\x00b", " ", None, "c"], "array<string>", A.strip_controls("x")) == ["ab", "c"]
    assert one(spark, "['food', 'cash_aid']", "string", A.parse_text_list("x")) == ["food", "cash_aid"]
    assert one(spark, "[]", "string", A.parse_text_list("x")) == []
    assert one(spark, [7], "array<int>", A.flatten_single("x")) == 7 and one(spark, [7, 8], "array<int>", A.flatten_single("x")) is None
    df = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double").select(A.row_mean(["a", "b"]).alias("m"), A.row_total(["a", "b"]).alias("t"))
    assert [tuple(r) for r in df.collect()] == [(1.0, 1.0), (None, 0.0)]


def test_names(spark):
    assert one(spark, " Thô-shâdait's ", "string", X.normalize_name("x")) == "tho shadaits"
    assert one(spark, "Al Wadjouma (Nord)", "string", X.normalize_for_match("x")) == "wadjouma nord"
    assert one(spark, "A  b-C!", "string", X.normalize_for_hash("x")) == "a b c"


def test_lexicons(spark):
    assert one(spark, "The CROP failed", "string", X.matches_lexicon("x", ["crop", "a"])) is True
    assert one(spark, "microcrops", "string", X.matches_lexicon("x", ["crop"])) is False
    assert one(spark, "microcrops", "string", X.matches_crisis("x")) is True
    assert one(spark, None, "string", X.matches_lexicon("x", ["crop"])) is False
    assert X.lexicon_terms([" Crop", "crop", None, "x", ""]) == ["crop"]
    counts = spark.createDataFrame([("Two killed. Lost lives, 1.5 killed",), (None,)], "x string").select(*X.category_counts("x").values()).collect()
    assert counts[0].fatalities_freq == 3 and counts[1].fatalities_freq == 0


def test_countries_and_records(spark):
    assert one(spark, "a Somalian man", "string", X.inject_countries("x")) == "a Somalian man mali somalia "
    assert one(spark, None, "string", X.inject_countries("x")) is None
    assert one(spark, "Nigeria and niger", "string", X.main_country("x", ["niger", "nigeria"])) == "niger"
    assert one(spark, "nothing", "string", X.main_country("x", ["niger"])) is None
    assert one(spark, "FOOD,1; war ,2;;", "string", X.theme_list("x")) == ["FOOD", "WAR"]
    assert one(spark, "1#Kenya#KE#KE##1#2,2#N#UG#", "string", X.fips_list("x")) == ["KE", "UG"]
    long = spark.createDataFrame([("KILL#1234567890123#x,KILL# 1 #,KILL#99999999999999999999#",), ("KILL#9223372036854775807,KILL#1",)], "x string").select(X.bucket_counts("x")["n_killed"]).collect()
    assert [r.n_killed for r in long] == [1234567890124, None]
    got = spark.createDataFrame([("KILL#5#x,CRISISLEX_T02_INJURED#3,CASUALTY#2,KILL#x,AID#10",), (None,)], "x string").select(*X.bucket_counts("x").values()).collect()
    assert (got[0].n_killed, got[0].n_injured, got[0].usd_aid, got[1].n_killed) == (7, 3, 10, 0)
    place = spark.createDataFrame([("1#A#XX#a#b#0#0,1#B#YY#a#b#1.5#2.5,1#C#KE#a#b#3#4",), ("1#B#YY#a#b#1.5#2.5",), ("x",), (None,)], "x string").select(X.first_coordinates("x", ["KE"]).alias("p")).collect()
    assert [(r.p.lat, r.p.lon) if r.p else None for r in place] == [(3.0, 4.0), (1.5, 2.5), None, None]
    assert one(spark, "-3.2,1", "string", X.tone("x")) == -3.2 and one(spark, "x", "string", X.tone("x")) is None
    assert one(spark, "https://www.A.org:8/x", "string", X.domain("x")) == "a.org:8" and one(spark, "no address", "string", X.domain("x")) is None


def test_words_and_numbers(spark):
    assert one(spark, "a  b\nc d", "string", X.truncate_words("x", 3)) == "a b c"
    assert X.value_of([2, 100, 5]) == 205 and X.value_of([]) == X.value_of([0, 0]) == 0 and X.value_of([1, 1_000_000, 2, 100]) == 1000002 * 100
    assert X.numbers_to_digits("Twenty  five men and zero") == "25 men and zero" and X.numbers_to_digits("One Hundred\nthousand, two; someone  ten") == "100 thousand, two; someone 10"
    assert X.numbers_to_digits("zero zero five zero") == "5" and X.numbers_to_digits("twenty-one hundred") == "twenty-one 100" and X.numbers_to_digits(" ") == ""
    assert X.clean_words("It can't see http://x.y two children, 1.2.3 men.") == "cannot see 2 child man ."
    assert X.clean_words(None) == "" and X.lemma("countries") == "country" and X.lemma("boss") == "boss"
    assert one(spark, list(range(5)), "array<int>", X.token_windows("x", 3, 2)) == [[0, 1, 2], [2, 3, 4], [4]]
    assert one(spark, [], "array<int>", X.token_windows("x", 3, 2)) is None


def test_counts_and_sentiment(spark):
    got = X.counted_categories("At least 25 people were killed. 3 days later 40 were displaced. Two were injured; nobody was held.")
    assert (got["fatalities"], got["displaced"], got["injured"], got["detained"]) == (25, 40, 2, 2)
    assert X.counted_categories(None)["fatalities"] == 0 and X.counted_categories("2 million fled")["displaced"] == 2_000_000
    up, down = X.sentiment_scores("good help and peace"), X.sentiment_scores("war and death")
    assert up[0] > 0.5 > 0 > down[0] and X.sentiment_scores(" ") == (0.0, 0.0, 0.0, 0.0) and X.sentiment_scores("not good")[0] < 0
    near = X.counted_categories("In 40 villages the floods of May left 7 dead and drove out others. They were held. 3 days on, 12 fled and 9 fled.", by_mention=True)
    assert (near["fatalities"], near["displaced"], near["detained"]) == (7, 12, 1) and X.counted_categories("In 40 villages 7 were killed")["fatalities"] == 40
    assert X.counted_categories("4 killed 6", by_mention=True)["fatalities"] == 4 and X.counted_categories(None, by_mention=True)["torture"] == 0
    lexicon = {"good": 1.9, "great": 3.1, "bad": -2.5, "horrible": -2.5}
    score = lambda t: X.sentiment_scores(t, lexicon)[0]
    assert score("good") == pytest.approx(1.9 / (1.9**2 + 15) ** 0.5, abs=1e-4) and score("very good") > score("good") > score("slightly good") > 0 > score("it isn't good")
    assert score("GOOD day") > score("good day") and score("GOOD DAY") == score("good day") and score("good!!") > score("good!") > score("good") and score("good!!!!!!") == score("good!!!!")
    assert score("good but bad") < score("good and bad") < score("bad but good") and X.sentiment_scores("so so", {"so": 1.0})[0] == 0 and score("?? bad ??") < score("bad")
    assert X.clean_words("He’s won't they'd policemen wolves; gonna") == "would policeman wolf going"
    df = X.count_categories(spark.createDataFrame([("5 killed",), (None,)], "t string"), "t").collect()
    assert df[0].fatalities_count == 5 and df[1].fatalities_count == 0


def test_pages(spark):
    html = "<html><head><title> A &amp; B </title><script>var p='<p>no</p>';</script></head><body><p> one </p><div>skip</div><p>two <b>x</b></p></body>"
    assert X.page_parts(html) == ("A & B", "one two x") and X.page_parts(None) == ("No Title", "")
    df = X.extract_pages(spark.createDataFrame([(html,), (None,)], "html string"), "html").collect()
    assert df[0].header == "A & B" and df[1].body == ""


def test_places(spark):
    docs = spark.createDataFrame([(1, "In North Kivu, Congo and Mali; Congo again"), (2, None), (3, "nothing")], "doc_id int, t string")
    names = spark.createDataFrame([("Congo",), ("North Kivu",), ("Kivu",), ("mali",), (None,), ("--",), ("The Old Town by the Great River",)], "name string")
    far = spark.createDataFrame([(9, "x the old town by the great river, the old")], "doc_id int, t string")
    assert X.find_places(far, "t", names).first().places == ["the old town by the great river"] and X.find_places(far, "t", names.limit(0)).count() == 0
    terms = spark.createDataFrame([("Kivu",), ("congo and mali",), ("x",), (None,)], "term string")
    assert [r.doc_id for r in X.keep_by_lexicon(docs, "t", terms).collect()] == [1] and X.keep_by_lexicon(docs, "t", terms.filter("term = 'x'")).count() == 0
    got = {r.doc_id: r.places for r in X.find_places(docs, "t", names).collect()}
    assert got == {1: ["north kivu", "congo", "mali", "congo"]}
    row = spark.createDataFrame([(got[1],)], "p array<string>").select(X.choose_admins("p", ["mali", "congo"]).alias("a"), X.choose_admins("p").alias("b")).first()
    assert tuple(row.a) == ("congo", "north kivu", "mali") and row.b.admin0 == "north kivu"


def test_fixed_values():
    assert len(K.FIPS) == len(K.ISO) == 25 and K.FIPS_TO_ISO["UV"] == "BF" and K.NUMBER_WORDS["nineteen"] == 19 and K.NUMBER_WORDS["ninety"] == 90
    assert len(K.COUNT_BUCKETS) == 13 and len(K.WORD_CATEGORIES) == 10 and len(K.NUMBER_WORDS) == 31
    assert dt.date(2016, 1, 1).year == K.FIRST_YEAR and F is not None
