"""Text functions. Expressions wherever built-ins can say it; Arrow UDFs for the rest."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce as fold_left
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.functions import constants as K
from fieldloom.functions.arrays import let

#: Accented letters and their plain forms, position by position.
ACCENTED = "áàâäãåāéèêëēíìîïīóòôöõōúùûüūçñýÿÁÀÂÄÃÅĀÉÈÊËĒÍÌÎÏĪÓÒÔÖÕŌÚÙÛÜŪÇÑÝ"
PLAIN = "aaaaaaaeeeeeiiiiioooooouuuuucnyyAAAAAAAEEEEEIIIIIOOOOOOUUUUUCNY"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def unaccent(x: Column | str) -> Column:
    return F.translate(_c(x), ACCENTED, PLAIN)


def normalize_name(x: Column | str) -> Column:
    """Plain letters and blanks, lower case, trimmed, hyphens as blanks, no apostrophes and backticks."""
    return F.translate(F.replace(F.trim(F.lower(unaccent(F.regexp_replace(_c(x), r"[\p{Z}\t\n\r]", " ")))), F.lit("-"), F.lit(" ")), "'`", "")


def normalize_for_match(x: Column | str) -> Column:
    """Plain letters and digits only, without the word ``al``, single blanks."""
    no_al = F.regexp_replace(F.lower(unaccent(x)), r"\bal\b", "")
    return F.trim(F.regexp_replace(F.regexp_replace(no_al, r"[^a-z0-9 ]", " "), r"\s+", " "))


def normalize_for_hash(x: Column | str) -> Column:
    """Lower case letters, digits and single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(_c(x)), r"[^a-z0-9\s]", " "), r"\s+", " "))


def alternation(terms: Sequence[str], words: bool = True, literal: bool = True) -> str:
    """A pattern that matches one of ``terms``, without case."""
    inner = "|".join(re.sub(r"([.^$*+?()\[\]{}|\\])", r"\\\1", t) if literal else t for t in terms)
    return rf"(?i)\b(?:{inner})\b" if words else f"(?i)(?:{inner})"


def lexicon_terms(terms: Sequence[str]) -> list[str]:
    """Lower case, trimmed, distinct terms of more than one character, in order."""
    return list(dict.fromkeys(t for x in terms if x and len(t := x.strip().lower()) > 1))


def matches_lexicon(x: Column | str, terms: Sequence[str]) -> Column:
    """Whether a term occurs as a word; false for null texts and empty lexicons."""
    kept = lexicon_terms(terms)
    return F.coalesce(_c(x).rlike(alternation(kept)), F.lit(False)) if kept else F.lit(False)


def matches_crisis(x: Column | str, terms: Sequence[str] = tuple(K.CRISIS_TERMS_EVENTS)) -> Column:
    """Whether a term occurs anywhere, inside words too; false for null texts."""
    return F.coalesce(_c(x).rlike(alternation(terms, words=False, literal=False)), F.lit(False))


def category_counts(x: Column | str, categories: dict[str, list[str]] | None = None) -> dict[str, Column]:
    """Per category how often one of its words occurs, non-overlapping; full stops count only between digits."""
    clean = F.regexp_replace(F.lower(F.coalesce(_c(x), F.lit(""))), r"\.(?!\d)", "")
    return {name: F.regexp_count(clean, F.lit(alternation(words).removeprefix("(?i)"))).alias(f"{name}_freq") for name, words in (categories or K.WORD_CATEGORIES).items()}


def truncate_words(x: Column | str, n: int = 500) -> Column:
    """The first ``n`` words with single blanks; an empty text for blank ones."""
    return F.array_join(F.slice(F.split(F.trim(F.regexp_replace(_c(x), r"\s+", " ")), " "), 1, n), " ")


def inject_countries(x: Column | str, demonyms: dict[str, str] | None = None) -> Column:
    """The text with the sorted, distinct countries of the demonyms found in it (inside words too) appended."""
    low = F.lower(_c(x))
    table = demonyms or K.DEMONYMS
    hits = F.filter(F.array(*[F.when(F.contains(low, F.lit(d)), F.lit(c)) for d, c in table.items()]), lambda v: v.isNotNull())
    names = F.array_join(F.array_sort(F.array_distinct(hits)), " ")
    return let(names, lambda n: F.when(n != "", F.concat(_c(x), F.lit(" "), n, F.lit(" "))).otherwise(_c(x)))


def main_country(x: Column | str, countries: Sequence[str]) -> Column:
    """The country named most often (anywhere in the text); on a tie the first listed; null if none is."""

    def best(low: Column) -> Column:
        def occurrences(name: str) -> Column:
            return F.try_divide(F.length(low) - F.length(F.replace(low, F.lit(name))), F.lit(len(name))).cast("int")

        entries = F.array(*[F.struct(occurrences(c).alias("n"), F.lit(-i).alias("order"), F.lit(c).alias("name")) for i, c in enumerate(countries)])
        return let(F.array_max(entries), lambda e: F.when(e["n"] > 0, e["name"]))

    return let(F.lower(_c(x)), best)


def theme_list(x: Column | str) -> Column:
    """Themes of a packed field: before the offset, trimmed, upper case, empty ones removed."""
    names = F.transform(F.split(_c(x), ";"), lambda e: F.upper(F.trim(F.get(F.split(e, ","), F.lit(0)))))
    return F.filter(names, lambda e: e != "")


def fips_list(x: Column | str) -> Column:
    """Country codes between ``#`` signs, in order, non-overlapping."""
    return F.regexp_extract_all(F.coalesce(_c(x), F.lit("")), F.lit("#([A-Z]{2})#"), 1)


def bucket_counts(x: Column | str, entries: str = ",", parts: str = "#", buckets: dict[str, list[str]] | None = None) -> dict[str, Column]:
    """Per bucket the sum of the whole numbers of the entries whose code holds one of its keywords.

    An entry counts for the first bucket that matches; entries without a whole number (of 64
    bits) are skipped, a sum beyond 64 bits is null; all buckets are 0 for a null field.
    """
    table = buckets or K.COUNT_BUCKETS
    items = F.split(F.coalesce(_c(x), F.lit("")), entries)
    parsed = F.transform(items, lambda e: F.struct(F.lower(F.get(F.split(e, parts), F.lit(0))).alias("code"), F.when(F.get(F.split(e, parts), F.lit(1)).rlike(r"^\s*\d+\s*$"), F.trim(F.get(F.split(e, parts), F.lit(1))).try_cast("bigint")).alias("n")))
    named = F.transform(parsed, lambda e: F.struct(_first_bucket(e["code"], table).alias("bucket"), e["n"].alias("n")))

    def total(bucket: str) -> Column:
        hits = F.filter(named, lambda e: (e["bucket"] == bucket) & e["n"].isNotNull())
        return F.aggregate(hits, F.lit(0).cast("bigint"), lambda s, e: F.try_add(s, e["n"])).alias(bucket)

    return {b: total(b) for b in table}


def _first_bucket(code: Column, table: dict[str, list[str]]) -> Column:
    out = F.lit(None).cast("string")
    for bucket, words in reversed(table.items()):
        out = F.when(code.rlike("|".join(words)), F.lit(bucket)).otherwise(out)
    return out


def tone(x: Column | str) -> Column:
    """The first number of the comma list, null if it isn't one."""
    return F.get(F.split(_c(x), ","), F.lit(0)).try_cast("double")


def first_coordinates(x: Column | str, countries: Sequence[str], entries: str = ",") -> Column:
    """``lat`` and ``lon`` of the first location in a wanted country, else of the first one at all; null without.

    A location has at least seven parts between ``#`` signs and coordinates other than 0, 0.
    """
    split = F.transform(F.split(_c(x), entries), lambda e: F.split(e, "#"))
    placed = F.transform(
        F.filter(split, lambda p: F.size(p) >= 7),
        lambda p: F.struct(F.get(p, F.lit(2)).alias("country"), F.get(p, F.lit(5)).try_cast("double").alias("lat"), F.get(p, F.lit(6)).try_cast("double").alias("lon")),
    )
    good = F.filter(placed, lambda p: p["lat"].isNotNull() & p["lon"].isNotNull() & ~((p["lat"] == 0) & (p["lon"] == 0)))
    return F.coalesce(F.get(F.filter(good, lambda p: p["country"].isin(list(countries))), F.lit(0)), F.get(good, F.lit(0)))


def domain(url: Column | str) -> Column:
    """Host of an address, lower case, without ``www.``; null if there is none."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_extract(_c(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), r"www\.", ""), F.lit(""))


def safe_text(x: Column | str) -> Column:
    return F.coalesce(_c(x), F.lit("Error"))


def token_windows(tokens: Column | str, size: int = 512, stride: int = 256) -> Column:
    """Overlapping windows of a token array, one starting at every ``stride``-th token."""

    def cut(a: Column) -> Column:
        starts = F.when(F.size(a) > 0, F.sequence(F.lit(0), F.size(a) - 1, F.lit(stride)))
        return F.transform(starts, lambda i: F.slice(a, i + 1, size))

    return let(_c(tokens), cut)


def value_of(numbers: Sequence[int]) -> int:
    """What a run of number words stands for: a multiplier applies to all before it.

    So "one million two hundred thousand" isn't read as 1,200,000; that is kept for equal results.
    """
    return fold_left(lambda v, n: max(v, 1) * n if n in K.MULTIPLIERS else v + n, numbers, 0)


_NUMBER_RUN = re.compile(rf"(?<!\S)(?:{'|'.join(K.NUMBER_WORDS)})(?:\s+(?:{'|'.join(K.NUMBER_WORDS)}))*(?!\S)", re.I)


def numbers_to_digits(text: str) -> str:
    """Runs of number words in digits, runs of 0 as they are; white space becomes single blanks."""
    digits = _NUMBER_RUN.sub(lambda run: str(value_of([K.NUMBER_WORDS[w] for w in run[0].lower().split()]) or run[0]), text)
    return " ".join(digits.split())


# English stop words.
STOP_WORDS = frozenset("""
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his himself she she's her hers herself it it's its itself they them their
theirs themselves what which who whom this that that'll these those am is are was were be been being have has had having do does did doing a an the and but if or because as until
while of at by for with about against between into through during before after above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s t can will just don don't should should've now d ll m o re ve y ain aren aren't
couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't
weren weren't won won't wouldn wouldn't
""".split())
# Contractions of whole words, and of endings.
CONTRACTIONS = {
    "can't": "cannot", "won't": "will not", "shan't": "shall not", "ain't": "are not", "let's": "let us", "it's": "it is", "he's": "he is", "she's": "she is", "that's": "that is",
    "there's": "there is", "here's": "here is", "what's": "what is", "who's": "who is", "where's": "where is", "when's": "when is", "how's": "how is", "y'all": "you all",
    "gonna": "going to", "wanna": "want to", "gotta": "got to", "'cause": "because", "o'clock": "of the clock", "ma'am": "madam",
    "n't": " not", "'re": " are", "'ve": " have", "'ll": " will", "'m": " am", "'d": " would",
}
IRREGULAR = {
    "men": "man", "women": "woman", "children": "child", "people": "people", "feet": "foot", "teeth": "tooth", "geese": "goose", "mice": "mouse", "oxen": "ox", "lives": "life", "wives": "wife",
    "knives": "knife", "leaves": "leaf", "halves": "half", "loaves": "loaf", "calves": "calf", "thieves": "thief", "wolves": "wolf", "shelves": "shelf", "crises": "crisis", "analyses": "analysis",
    "bases": "base", "criteria": "criterion", "phenomena": "phenomenon", "media": "medium", "data": "data", "news": "news", "series": "series", "species": "species",
}


def _contracted(table: dict[str, str]) -> re.Pattern:
    whole, ends = [re.escape(k) for k in table if k[0].isalpha() and k != "n't"], [re.escape(k) for k in table if not k[0].isalpha() or k == "n't"]
    return re.compile("|".join([*(rf"\b{k}\b" for k in whole), *(rf"(?<=\w){k}\b" for k in ends if k != "'cause"), r"(?<!\w)'cause\b"]), re.I)


def lemma(word: str, irregular: dict[str, str] = IRREGULAR) -> str:
    """The singular of a noun by rule; known irregular ones by table."""
    if word in irregular:
        return irregular[word]
    if len(word) > 4 and word.endswith("men"):
        return word[:-2] + "an"
    if len(word) > 4 and word.endswith("ies"):
        return word[:-3] + "y"
    if len(word) > 4 and re.search(r"(?:s|x|z|ch|sh)es$", word):
        return word[:-2]
    if len(word) > 3 and word.endswith("s") and not re.search(r"(?:ss|us|is)$", word):
        return word[:-1]
    return word


_CONTRACTED = _contracted(CONTRACTIONS)


def clean_words(text: str | None, stop: frozenset[str] = STOP_WORDS, contractions: dict[str, str] = CONTRACTIONS) -> str:
    """Contractions and number words written out, addresses and dotted numbers removed, stop words dropped, nouns in the singular."""
    if not text or not text.strip():
        return ""
    pattern = _CONTRACTED if contractions is CONTRACTIONS else _contracted(contractions)
    text = numbers_to_digits(pattern.sub(lambda m: contractions[m[0].lower()], text.replace("\u2019", "'")))
    text = re.sub(r"\b\d+(?:\.\d+)+\b", "", re.sub(r"http\S+", "", text))
    text = re.sub(r"[^a-z0-9.\s]", "", text.lower())
    tokens = re.findall(r"\d+(?:\.\d+)?|[a-z0-9]+|\.", text)
    return " ".join(lemma(t) for t in tokens if t not in stop)


def clean_words_column(x: Column | str) -> Column:
    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(clean_words)

    return run(_c(x))


_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_TOKEN = re.compile(r"\d[\d,]*(?:\.\d+)?|\w+|[^\w\s]")


def sentence_numbers(tokens: Sequence[str]) -> list[tuple[int, float]]:
    """Place and value of the numbers among the tokens of a sentence: none before a unit of time; one before "million" is in millions."""
    found = []
    for i, t in enumerate(tokens):
        after = tokens[i + 1].lower() if i + 1 < len(tokens) else ""
        value = float(t.replace(",", "")) if t[0].isdigit() else K.NUMBER_WORDS.get(t.lower())
        if value is not None and after not in K.TIME_UNITS:
            found.append((i, float(value) * (1_000_000 if after == "million" else 1)))
    return found


def counted_categories(text: str | None, by_mention: bool = False) -> dict[str, float]:
    """Per category the numbers of its sentences, 1 for a sentence without; the greatest for ``displaced``.

    A sentence counts for a category if one of its words stands anywhere in it, with the
    number nearest to the sentence's start. ``by_mention``: if a token holds such a word,
    with the number nearest to the first of these tokens (the earlier one on a tie).
    Sentences stand in for parsed subtrees.
    """
    out = dict.fromkeys(K.NUMBER_CATEGORIES, 0.0)
    for sentence in _SENTENCE.split(text or ""):
        tokens, low = _TOKEN.findall(sentence), sentence.lower()
        numbers = None
        for category in out:
            words = K.WORD_CATEGORIES[category]
            if by_mention:
                at = next((i for i, t in enumerate(tokens) if any(w in t.lower() for w in words)), None)
            else:
                at = 0 if any(w in low for w in words) else None
            if at is None:
                continue
            numbers = sentence_numbers(tokens) if numbers is None else numbers
            found = min(numbers, key=lambda n: abs(n[0] - at))[1] if numbers else 0.0
            out[category] = max(out[category], found) if category == "displaced" else out[category] + (found or 1.0)
    return out


def count_categories(df: DataFrame, text: str, by_mention: bool = False, suffix: str = "_count") -> DataFrame:
    """``df`` with ``<category>_count`` columns; see ``counted_categories``. A null text has zeros."""

    @F.pandas_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in K.NUMBER_CATEGORIES]))
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([counted_categories(t, by_mention) for t in texts], columns=K.NUMBER_CATEGORIES)

    return df.withColumn("__n", run(text)).select("*", *[F.col(f"__n.{c}").alias(f"{c}{suffix}") for c in K.NUMBER_CATEGORIES]).drop("__n")


#: A small polarity lexicon (-4 to 4); a project supplies its own (``sources.readers.polarity_lexicon``).
POLARITY = {
    "killed": -3.5, "dead": -3.3, "death": -2.9, "wounded": -2.2, "attack": -2.1, "famine": -3.0, "hunger": -2.0, "crisis": -3.1, "lost": -1.3, "fear": -2.2,
    "war": -2.9, "violence": -3.1, "good": 1.9, "better": 1.9, "best": 3.2, "help": 1.7, "relief": 2.1, "hope": 1.9, "peace": 2.5, "safe": 1.9, "support": 1.7,
}
# Fixed values of the published rule-based scoring: words that strengthen or weaken, negations, and weights.
STRONGER = frozenset("""absolutely amazingly awfully completely considerable considerably decidedly deeply enormously entirely especially exceptionally extremely fabulously flipping frickin
fully greatly hella highly hugely incredibly intensely major majorly more most particularly purely quite really remarkably so substantially thoroughly total totally tremendously uber
unbelievably unusually utterly very""".split())
WEAKER = frozenset("almost barely hardly kind-of kinda less little marginally occasionally partly scarcely slight slightly somewhat sort-of sorta".split())
NEGATIONS = frozenset("""aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt neednt neither never none nope nor not nothing nowhere oughtnt shant
shouldnt uhuh wasnt werent without wont wouldnt rarely seldom despite no nobody""".split())
BOOST, SHOUT, NEGATED = 0.293, 0.733, -0.74
BACK = (1.0, 0.95, 0.9)
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAIMED, ASKED = 0.292, 0.18


def sentiment_scores(text: str | None, lexicon: dict[str, float] = POLARITY) -> tuple[float, float, float, float]:
    """Compound, negative, neutral and positive scores by lexicon; zeros for blank texts.

    Of the three words before a word of the lexicon boosters add, less the farther they are,
    and a negation turns it; words in capitals count more where not all are; of a sentence
    with "but" the part after it counts more; exclamation and question marks add emphasis.
    """
    raw = re.findall(r"[\w'’-]+", text or "")
    if not raw:
        return 0.0, 0.0, 0.0, 0.0
    words = [w.lower().replace("’", "'") for w in raw]
    plain = [w.replace("'", "") for w in words]
    loud = [len(w) > 1 and w.isupper() for w in raw]
    differs = 0 < sum(loud) < len(loud)
    values = []
    for i, w in enumerate(words):
        v = 0.0 if w in STRONGER or w in WEAKER else lexicon.get(w, 0.0)
        if v:
            sign = 1 if v > 0 else -1
            v += sign * SHOUT * (loud[i] and differs)
            for k, part in enumerate(BACK, 1):
                if i >= k and words[i - k] not in lexicon:
                    step = BOOST * ((words[i - k] in STRONGER) - (words[i - k] in WEAKER))
                    v += sign * part * (step + (SHOUT if step > 0 and loud[i - k] and differs else 0.0))
            if any(x in NEGATIONS or y.endswith("n't") for x, y in zip(plain[max(0, i - 3) : i], words[max(0, i - 3) : i])):
                v *= NEGATED
        values.append(v)
    if "but" in words:
        at = words.index("but")
        values = [v * (BEFORE_BUT if i < at else AFTER_BUT if i > at else 1.0) for i, v in enumerate(values)]
    marks = text.count("?")
    emphasis = min(4, text.count("!")) * EXCLAIMED + (min(0.96, marks * ASKED) if marks > 1 else 0.0)
    s = sum(values)
    s += emphasis if s > 0 else -emphasis if s < 0 else 0.0
    up, down = sum(v + 1 for v in values if v > 0), sum(v - 1 for v in values if v < 0)
    up, down = (up + emphasis, down) if up > abs(down) else (up, down - emphasis) if up < abs(down) else (up, down)
    neutral = sum(1 for v in values if v == 0)
    size = up + abs(down) + neutral
    return round(s / (s * s + 15) ** 0.5, 4), round(abs(down) / size, 3), round(neutral / size, 3), round(up / size, 3)


def sentiment(x: Column | str, lexicon: dict[str, float] = POLARITY) -> Column:
    """Struct of ``compound``, ``neg``, ``neu``, ``pos``; see ``sentiment_scores``."""

    @F.pandas_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in ("compound", "neg", "neu", "pos")]))
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([sentiment_scores(t, lexicon) for t in texts], columns=["compound", "neg", "neu", "pos"])

    return run(_c(x))


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title, self.paragraphs, self.inside, self.skip = None, [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        elif tag == "title" and self.title is None:
            self.inside.append("title")
            self.title = ""
        elif tag == "p":
            self.inside = [x for x in self.inside if x != "p"] + ["p"]
            self.paragraphs.append("")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag in self.inside:
            self.inside.remove(tag)

    def handle_data(self, data):
        if self.skip or not self.inside:
            return
        if self.inside[-1] == "title":
            self.title += data
        else:
            self.paragraphs[-1] += data


def page_parts(html: str | None) -> tuple[str, str]:
    """Title (``No Title`` without one) and the stripped paragraphs joined by blanks."""
    page = _Page()
    page.feed(html or "")
    page.close()
    return (page.title or "").strip() or "No Title", " ".join(p for x in page.paragraphs if (p := x.strip()))


def extract_pages(df: DataFrame, html: str) -> DataFrame:
    """``df`` with ``header`` and ``body`` of the pages in ``html``."""

    @F.pandas_udf(T.StructType([T.StructField(c, T.StringType()) for c in ("header", "body")]))
    def run(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([page_parts(p) for p in pages], columns=["header", "body"])

    return df.withColumn("__p", run(html)).select("*", "__p.header", "__p.body").drop("__p")


def find_places(df: DataFrame, text: str, gazetteer: DataFrame, name: str = "name", key: str = "doc_id") -> DataFrame:
    """``key``, ``places`` (names of the gazetteer in the order they occur in the text).

    Names of any number of words are found. The words of a text first meet the first words
    of the names, which bring the lengths names with that first word have; only runs of
    these lengths meet the gazetteer. Both are equi-joins, so neither side needs to fit a
    task. Of overlapping names the longest counts.
    """
    words = F.split(F.trim(F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}'-]+", " ")), " ")
    plain = F.trim(F.regexp_replace(F.lower(F.col(name)), r"[^\p{L}\p{N}'-]+", " "))
    names = gazetteer.select(plain.alias("run")).filter("run <> ''").distinct()
    first = names.select(F.split("run", " ").alias("w")).groupBy(F.get("w", F.lit(0)).alias("first")).agg(F.collect_set(F.size("w")).alias("sizes"))
    at = df.select(F.col(key), words.alias("w")).filter(F.col("w").isNotNull()).select(key, "w", F.posexplode("w").alias("p", "first"))
    longest = names.agg(F.max(F.size(F.split("run", " ")))).first()[0] or 0
    begun = at.select(key, (F.col("p") + 1).alias("at"), "first", F.slice("w", F.col("p") + 1, F.lit(longest)).alias("w")).join(first, "first")
    runs = F.transform(F.filter("sizes", lambda n: n <= F.size("w")), lambda n: F.struct(n.alias("n"), F.array_join(F.slice("w", F.lit(1), n), " ").alias("run")))
    grams = begun.select(key, "at", F.explode(runs).alias("g")).select(key, "at", "g.*")
    met = grams.join(names, "run")
    listed = met.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("at", (-F.col("n")).alias("m"), "run"))).alias("hits"))

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def keep(hits: pd.Series) -> pd.Series:
        def one(rows) -> list[str]:
            out, end = [], 0
            for r in rows:
                if r["at"] >= end:
                    out.append(r["run"])
                    end = r["at"] - r["m"]
            return out

        return hits.map(one)

    return listed.select(key, keep("hits").alias("places"))


def keep_by_lexicon(df: DataFrame, text: str, lexicon: DataFrame, term: str = "term", key: str = "doc_id") -> DataFrame:
    """Rows of ``df`` in which a term of a lexicon of any size occurs, word by word (``key`` must be unique).

    For more than some thousand terms in place of ``matches_lexicon``, whose pattern grows
    with them; here terms are joined as ``find_places`` does. Terms of one character don't count.
    """
    used = lexicon.filter(F.length(F.trim(term)) > 1)
    return df.join(find_places(df, text, used, term, key).select(key), key, "left_semi")


def choose_admins(places: Column | str, countries: Sequence[str] = ()) -> Column:
    """Struct of three names: the listed country met most often (the earliest on a tie, else the first place), then the next two other places."""
    a = _c(places)
    wanted = F.filter(a, lambda x: x.isin(list(countries))) if countries else F.array().cast("array<string>")
    scored = F.transform(F.array_distinct(wanted), lambda x: F.struct(F.size(F.filter(wanted, lambda y: y == x)).alias("n"), (-F.array_position(a, x)).alias("at"), x.alias("name")))
    top = F.coalesce(F.array_max(scored)["name"], F.get(a, F.lit(0)))
    rest = F.filter(a, lambda x: x != top)
    return F.struct(top.alias("admin0"), F.get(rest, F.lit(0)).alias("admin1"), F.get(rest, F.lit(1)).alias("admin2"))
