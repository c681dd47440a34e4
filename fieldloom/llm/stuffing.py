"""Pages of heaped keywords, links or product tags.

Each text gets shares that tell heaps from sentences: of its repeated content words, of
the most frequent one, of repeated word pairs, of repeated lines, of words in links and
link items, of separators, and of function words. Every share is judged against the median
of all texts of the language, which is itself told from function words, as labels may be
wrong.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.leaks import fold
from fieldloom.session import reliable_checkpoint

# Common function words of each language, without case.
FUNCTION_WORDS = {
    "en": "the of and to a in that is was for on with as by at from are were has have had it this be an or which not but their they he she his her its than into after before because said about against between while will would who when where there been more no all one out over so if since near yet up down only also our we you your i",
    "fr": "le la les des de du et à un une pour dans est sont que qui sur par avec au aux plus pas ne se selon entre ce cette ces il elle ils elles on nous vous leur leurs son sa ses mais ou où donc ni car dont comme sans sous après avant depuis lorsque quand ont a été être fait y en d l n s qu c j",
    "es": "el la los las de del y que a en un una por con para se al su sus lo como más pero o no es son fue ha han sin sobre entre desde hasta cuando donde porque este esta estos estas ya le les si ni antes después según tras e u mi muy también cada",
    "pt": "o a os as de do da dos das e que em no na nos nas um uma por com para se ao aos à às seu sua seus suas mais mas ou não é são foi há sem sobre entre desde até quando onde porque este esta já lhe pelo pela pelos pelas antes depois segundo como nem muito também cada num numa",
    "de": "der die das und in zu den von mit ist des im für auf dem nicht ein eine als auch es an werden aus er hat dass sie nach bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man dann sein wird wurde wurden sich ihre ihr wir ich",
    "it": "il la di che e un in per è una con non del della si da le dei al i come anche nel alla sono dal più ha gli lo ma o delle nella degli questo dopo tra alle essere hanno ai su sul dalla se quando molto stato fra loro suo sua",
    "nl": "de het een en van in is dat op te zijn met voor niet aan er die om ook als bij door maar naar dan uit nog over hun of wordt werd worden heeft hebben zich ze hij wij was waren tot deze dit meer geen na tegen",
    "sw": "na ya wa kwa ni za katika la cha kuwa hiyo hii huo hizo kama au lakini pia baada watu hao yao wake vya yake hayo ambayo ambao kutoka mwa nchini sana kila bila tu zaidi hadi wakati alisema",
    "ha": "da na a ta ya su ne ba cikin wannan ce don sun yi daga ga kuma za mai ko suka amma kan wani wata bayan domin zuwa tare an shi ita mu kai inda lokacin yana tana suna",
    "so": "iyo oo ka ku u waa in ay uu la ee ah kale soo si aan waxaa waxay waxa ayaa kala badan kasta isaga iyada laakiin ama ugu kadib lagu loo lagaga inuu inay dalka",
    "ar": "في من على إلى أن عن مع هذا هذه التي الذي كان كانت بعد قبل ما لا هو هي كل بين قد لم أو ثم حتى عند منذ حيث ذلك تلك وقد وفي ومن كما غير إن لكن وهو وهي",
    "am": "እና ነው ላይ ውስጥ ወደ ከ በ ለ ግን ደግሞ ነበር ናቸው እንደ ሲሆን ይህ ያለ ጋር በኋላ ስለ ሁሉም ነገር ሆኖም አንድ እስከ ብሏል",
    "ru": "и в не на что с по к из у за от о для это как но его он она они мы я а так же то был была были бы до при или уже если только все со их чтобы после также ее",
    "tr": "ve bir bu da de için ile olarak çok daha en olan gibi kadar sonra ama ne var o ise ya mi her ki değil göre olduğu tarafından",
    "id": "yang dan di dari dengan untuk pada ini itu dalam tidak akan ke adalah oleh juga karena sebagai telah atau ada mereka kami kita dia sudah bisa lebih saat para setelah",
}
_LANGS = tuple(FUNCTION_WORDS)
_FUNCTION: dict[str, tuple[int, ...]] = {}  # for each function word the languages it belongs to
for _i, _lang in enumerate(_LANGS):
    for _w in FUNCTION_WORDS[_lang].split():
        _FUNCTION[_w] = (*_FUNCTION.get(_w, ()), _i)
_OWN = [frozenset(words.split()) for words in FUNCTION_WORDS.values()]

_LINK = re.compile(r"https?://\S+|\bwww\.\S+|(?<![\w@])(?:[a-z0-9][a-z0-9-]*\.)+[a-z]{2,}\b(?![(\w])")
_DOMAIN = re.compile(r"\.[a-z]{2}")
_NUMBERED = re.compile(r"\d\) ")
_ITEM = re.compile(r"\s\|\s|\s(?=\d{1,3}\)\s)|\s(?=»\s)|(?<=\))\s(?=\[)|\n")
_HEAD = re.compile(r"\s*(?:[»›▸►]|\d{1,3}\)|\[[^\]]*\]\()")
_TAG = re.compile(r"#(\w+)")
_TAG_PART = re.compile(r"[^\W\d_]+?(?=[A-ZÀ-Ý]|\d|_|$)|\d+")
_LATIN = re.compile(r"[a-zA-Z\u00aa-\u024f]")
_LETTER = re.compile(r"[^\W\d_]")
_SEPARATORS = ",;|/·•#»›"
#: Words of an item that belong to each link in it.
LINK_WORDS = 15


@dataclass(frozen=True)
class Stuffing:
    """Limits of the shares. ``few`` and ``normal`` are parts of the language's median share of
    function words, all others what a share is over the language's median of it."""

    few: float = 0.45
    normal: float = 0.85
    separators: float = 0.25
    heap: float = 0.2
    top: float = 0.15
    heap_with_pairs: float = 0.33
    pairs: float = 0.4
    links: float = 0.5
    repeated_lines: float = 0.5
    #: Texts of fewer words don't count for the medians.
    calibrate_words: int = 30
    #: A language with fewer texts takes the medians of all texts.
    calibrate_texts: int = 30


SHARES = ("function_share", "heap_share", "top_share", "pair_share", "link_share", "line_share", "separator_share")
FEATURES = "lang string, words int, " + ", ".join(f"{c} double" for c in SHARES)
#: The language of texts in a script for which there are no function words.
OTHER_SCRIPT = "other script"


def measure(text: str | None) -> tuple[str, int, float, float, float, float, float, float, float]:
    """The shares of one text, in the order of ``FEATURES``; a text without words has zeros and no language.

    The language is the one with most function words, empty without any, ``OTHER_SCRIPT``
    if it has none and most letters aren't Latin. Content words are heaped that occur three
    times or more and make up a hundredth of the words; likewise pairs.
    """
    if not text:
        return "", 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0
    plain = _TAG.sub(lambda m: " ".join(_TAG_PART.findall(m[1])), text) if "#" in text else text
    words = [w for w in fold(plain.replace("'", " ").replace("’", " ")).split(" ") if not w.isdigit()]
    if not words or words == [""]:
        return "", 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0
    n = len(words)
    by_lang, least, often = [0] * len(_LANGS), max(3, n // 100), []
    for w, c in Counter(words).items():
        if own := _FUNCTION.get(w):
            for i in own:
                by_lang[i] += c
        if c >= least:
            often.append((w, c))
    most = max(by_lang)
    own = _OWN[by_lang.index(most)] if most else frozenset()
    lang = _LANGS[by_lang.index(most)] if most else ""
    if not most and 2 * len(_LATIN.findall(text)) < len(_LETTER.findall(text)):
        lang = OTHER_SCRIPT
    heaped = [c for w, c in often if w not in own]
    pairs = sum(c for p, c in Counter(zip(words, words[1:])).items() if c >= least and not (p[0] in own and p[1] in own)) if often else 0
    link_share = 0.0
    if "»" in text or "](" in text or _DOMAIN.search(text) or _NUMBERED.search(text):
        linked = 0
        for item in _ITEM.split(text):
            size = len(item.split())
            linked += size if _HEAD.match(item) else min(size, LINK_WORDS * len(_LINK.findall(item))) if _DOMAIN.search(item) else 0
        link_share = linked / len(text.split())
    lines = [x.strip().lower() for x in text.split("\n") if x.strip()]
    seen = Counter(lines)
    repeated = sum(len(x) * c for x, c in seen.items() if c > 1) / sum(map(len, lines)) if len(seen) < len(lines) else 0.0
    separators = sum(map(text.count, _SEPARATORS)) / n
    return lang, n, most / n, sum(heaped) / n, max(heaped, default=0) / n, pairs / n, min(1.0, link_share), repeated, separators


def shares(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the ``FEATURES`` of every text; a null or empty text has 0 words."""
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, {FEATURES}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, *measure(t)) for k, t in zip(batch[key], batch[text])]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return docs.select(key, text).mapInPandas(run, schema)


def stuffed(limits: Stuffing = Stuffing()) -> Column:
    """Whether a row of ``shares`` joined with the language's medians is a heap."""
    part = F.when(F.col("usual_function_share") > 0, F.col("function_share") / F.col("usual_function_share")).otherwise(0.0)
    part = F.when(F.col("lang") == OTHER_SCRIPT, 1.0).otherwise(part)  # nothing is known of its function words
    over = {c: F.col(c) - F.col(f"usual_{c}") for c in SHARES}
    return (F.col("words") > 0) & (
        ((part < limits.few) & (over["separator_share"] > limits.separators))
        | ((part < limits.normal) & ((over["heap_share"] > limits.heap) | (over["top_share"] > limits.top)))
        | ((over["heap_share"] > limits.heap_with_pairs) & (over["pair_share"] > limits.pairs))
        | (over["link_share"] > limits.links)
        | (over["line_share"] > limits.repeated_lines)
    )


def find_stuffed(docs: DataFrame, key: str = "doc_id", text: str = "text", limits: Stuffing = Stuffing()) -> DataFrame:
    """``shares`` of every text with ``stuffed`` (boolean).

    The medians of the languages are taken over all texts with enough words; a language
    with few texts, and texts without a function word, take the medians of all texts. Of
    texts in a script without function words here nothing is concluded from these. Null
    and empty texts aren't heaps. Ties and repeated rows don't matter: each row is judged
    by itself. The shares (a few numbers a text) are checkpointed, so each text is read
    once; the medians of a dozen languages are put into the condition.
    """
    held = reliable_checkpoint(shares(docs, key, text))
    medians = [F.percentile_approx(c, 0.5, 10_000).alias(c) for c in SHARES]
    enough = held.filter(F.col("words") >= limits.calibrate_words)
    known = enough.filter(F.col("lang").isin(*_LANGS, OTHER_SCRIPT)).groupBy("lang").agg(F.count("*").alias("n"), *medians)
    by_lang = {r.lang: r for r in known.filter(F.col("n") >= limits.calibrate_texts).collect()}  # one row per language of FUNCTION_WORDS
    overall = enough.agg(*medians).first()

    def usual(share: str) -> Column:
        out = F.lit(float(overall[share] or 0.0))
        for lang, row in by_lang.items():
            out = F.when(F.col("lang") == lang, float(row[share])).otherwise(out)
        return out.alias(f"usual_{share}")

    filled = held.select("*", *[usual(c) for c in SHARES])
    return filled.withColumn("stuffed", stuffed(limits)).select(*held.columns, "stuffed")
