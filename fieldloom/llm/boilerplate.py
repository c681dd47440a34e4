"""The story of a web page told from what its site puts around and between it.

A page is a flat list of text blocks (its lines). Each block is described by its own
word count and link density, by those of its neighbours, and by where it stands; a
decision tree trained on a small labelled table says whether it belongs to the story. Page
texts have no markup: link density is the share of a block's words in short stretches
between separators that don't end as sentences do. Whether a block holds a phrase that is
common around stories is a mark of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from pathlib import Path

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages with one label per block; the tree is fitted on all of it, at most ``MAX_BLOCKS`` blocks.
LABELLED = Path(__file__).with_name("labelled_blocks.tsv")
MAX_BLOCKS = 5000
#: Words of a stretch that may be a link.
LINK_WORDS = 5
#: Blocks a worker remembers, as sites repeat theirs.
REMEMBERED = 200_000

# Phrases of what sites put around a story, in English and French, without case. "^" and "$" stand for the block's begin and end.
AROUND = {
    "consent": ["cookie", "privacy", "i agree", "accept all", "reject all", "preferences", "partners store", "adverts that fit", "without tracking", "partenaires, nous", "votre appareil", "sans accepter", "tout accepter", "tout refuser", "confidentialité", "paramétrer", "en poursuivant"],
    "account": ["subscribe", "subscription", "sign in", "sign up", "log in", "register", "free articles", "already a member", "newsletter", "weekly letter", "inbox", "donate", "support independent", "download our app", "s'abonner", "abonnez", "se connecter", "connectez-vous", "inscrivez-vous", "lettre hebdomadaire", "articles gratuits", "faire un don", "soutenez"],
    "share": ["tweet", "share this", "share on", "copy link", "follow us", "like us", "shares$", "on social media", "partager", "partages$", "suivez-nous", "réseaux", "email print", "imprimer"],
    "tags": ["^tag ", "^tags ", "^tag:", "^tags:", "^topic ", "^topics ", "^topic:", "^topics:", "^keyword ", "^keywords ", "^keyword:", "^keywords:", "^filed under", "^mots-clés", "^thème ", "^thèmes ", "^thème:", "^thèmes:", "^classé dans"],
    "comments": ["comment$", "comments$", "leave a reply", "to comment", "will not be published", " wrote: ", "commentaire$", "commentaires$", "laisser un commentaire", "pour commenter", "ne sera pas publiée", "a écrit : ", "a écrit: ", "was this article helpful", "article vous a"],
    "advert": ["^advert", "story continues below", "^publicité", "sponsored", "^sponsorisé", "video not available", "vidéo non disponible", "vidéo indisponible"],
    "pointer": ["^related ", "^related:", "^related$", "^read also", "^see also", "^read more", "^also read", "^à lire", "^lire aussi", "^voir aussi", "^»"],
    "footer": ["copyright", "©", "rights reserved", "droits réservés", "terms of use", "may not be copied", "not responsible", "rss feed", "back to top", "designed by", "registered office", "call the newsroom", "sitemap", "careers", "mentions légales", "reproduction", "n'est pas responsable", "haut de page", "plan du site", "flux rss", "réalisé par", "siège social", "appelez la rédaction", "qui sommes-nous"],
    "menu": ["^menu$", "☰", "🔍", "^search$", "^rechercher$", "skip to", "aller au contenu", "^edition ", "^edition:", "^édition ", "^édition:", "^home$", "^accueil$", "^contact$", "^about us$", "^à propos$"],
}
#: Kinds of phrases that stand between two paragraphs of a story.
BETWEEN = ("account", "advert", "pointer")
# Blocks that head a list of pointers to other stories.
HEADS = frozenset([
    "most read", "most popular", "trending", "trending now", "from our partners", "you may also like", "more stories", "latest headlines", "latest news", "les plus lus", "dernières dépêches", "sur le même sujet",
    "à la une", "vous aimerez aussi", "de nos partenaires", "plus d'articles", "tendances",
])
#: Ends of a teaser that is cut off or counted.
_CUT = re.compile(r"(?:…|\.\.\.|read more|lire la suite|\(video\)|\(vidéo\)|\bmin read|\bhours? ago|il y a \d+ \w+|min de lecture)$")


def _phrases() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, phrases in AROUND.items():
        for x in phrases:
            found.add_word(x.replace("^", "\n").replace("$", "\n"), kind in BETWEEN)
    found.make_automaton()
    return found


_PHRASES = _phrases()

_END = re.compile(r"[.!?][\"»”’')\]]*$|[\"»”]$")
_LIST = re.compile(r"^[*•\-–▪]\s+\S")
_NUMBERED = re.compile(r"^\d{1,2}[.)]\s")
_SEPARATED = re.compile(r"\s[|/·»>–-]\s|\s{2,}")
_EDGE = re.compile(r"\W+$")
_QUOTE = re.compile(r"^[\"“«]")
_SPACES = re.compile(r"\s+")
_PLAIN = re.compile(r"[^a-z0-9]")
_HOST = re.compile(r"\w+://(?:www\.|m\.)?([^/:]+)")


@lru_cache(REMEMBERED)
def block(line: str) -> tuple:
    """What is known of one block: the features ``_OWN``."""
    words, low, parts = line.split(), line.lower(), _SEPARATED.split(line)
    linked = sum(k for x in parts if (k := len(x.split())) <= LINK_WORDS and not _END.search(x))
    kinds = [between for _, between in _PHRASES.iter(f"\n{low}\n")]
    cut, head, numbered, listed = bool(_CUT.search(low[-80:])), _EDGE.sub("", low) in HEADS, bool(_NUMBERED.match(line)), bool(_LIST.match(line))
    ends, around, separators = bool(_END.search(line)) and not cut, bool(kinds), len(parts) - 1
    return (
        around, any(kinds), head, cut, around or head or cut or separators > 1, not (around or head or cut or numbered or listed or ends or separators),
        len(words), linked / max(1, len(words)), sum(1 for w in words if w[:1].isupper()) / max(1, len(words)), ends, listed, numbered, bool(_QUOTE.match(line)), separators,
        ends and len(words) >= 4 and not around,
    )


_OWN = ("around", "between", "head", "cut", "marked", "bare", "words", "links", "capitals", "ends", "listed", "numbered", "quoted", "separators", "paragraph")
_BESIDE = ("words", "links", "ends", "listed", "around", "paragraph")
FEATURES = (
    *_OWN, *(f"{f}_{k}" for k in ("prev", "next", "prev2", "next2") for f in _BESIDE),
    "is_title", "after_title", "has_title", "since_title", "paragraphs_before", "paragraphs_after", "short_run", "since_paragraph", "to_paragraph", "names_site", "since_head", "after_text", "follows",
)
_PICK = [_OWN.index(f) for f in _BESIDE]


def describe(lines: list[str], title: str | None, url: str | None) -> tuple[list[int], np.ndarray]:
    """Indexes of the non-blank lines and their ``FEATURES``."""
    at = [i for i, x in enumerate(lines) if x.strip()]
    texts = [lines[i].strip() for i in at]
    n = len(texts)
    if not n:
        return at, np.empty((0, len(FEATURES)))
    own = np.array([block(x) for x in texts], dtype=float)
    beside = np.vstack([np.zeros((2, len(_PICK))), own[:, _PICK], np.zeros((2, len(_PICK)))])
    wanted = _SPACES.sub(" ", (title or "").strip())
    is_title = np.array([bool(wanted) and _SPACES.sub(" ", x) == wanted for x in texts])
    first = int(np.argmax(is_title)) if is_title.any() else -1
    k = np.arange(n)
    paragraph = own[:, -1] > 0
    before = np.cumsum(paragraph)

    def since(mark: np.ndarray) -> np.ndarray:  # blocks since the last marked one before, 99 without
        last = np.maximum.accumulate(np.where(mark, k, -1))
        last = np.r_[-1, last[:-1]]
        return np.where(last >= 0, np.minimum(99, k - last), 99)

    of = lambda name: own[:, _OWN.index(name)]
    short = (of("words") <= 3) & (of("ends") == 0) & (of("listed") == 0)
    text = paragraph | (of("listed") > 0) | is_title
    last = np.maximum.accumulate(np.where(of("between") == 0, k, -1))  # the last block that isn't put in between
    last = np.r_[-1, last[:-1]]
    after = np.array([bool(text[max(j, 0) : i].any()) if i else False for i, j in enumerate(last)])
    head, stop = of("head") > 0, of("head").astype(bool) | paragraph
    lead = np.maximum.accumulate(np.where(stop, k, -1))
    since_head = np.where((lead >= 0) & head[lead], k - lead, 99)
    edge = np.flatnonzero(np.r_[True, short[1:] != short[:-1], True])
    run = np.where(short, np.repeat(np.diff(edge), np.diff(edge)), 0)
    site = _PLAIN.sub("", m[1].split(".")[0].lower()) if url and (m := _HOST.match(url)) else ""
    names = np.array([bool(site) and site in _PLAIN.sub("", x.lower()) for x in texts])
    page = np.stack([
        is_title, (first >= 0) & (k > first), np.full(n, first >= 0), k - first if first >= 0 else np.full(n, -1), before - paragraph, before[-1] - before, run,
        since(paragraph | is_title), since(paragraph[::-1])[::-1], names, since_head, after, (first >= 0) & (k > first) & after,
    ], 1)
    return at, np.hstack([own, beside[1 : n + 1], beside[3 : n + 3], beside[:n], beside[4:], page])


class DecisionTree:
    """A binary classification tree (Gini), grown to a depth and least leaf size."""

    def __init__(self, depth: int = 14, leaf: int = 3) -> None:
        self.depth, self.leaf = depth, leaf
        self.feature: list[int] = []
        self.limit: list[float] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.share: list[float] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> DecisionTree:
        self._grow(x, y.astype(float), self.depth)
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int) -> int:
        me = len(self.feature)
        for column, value in ((self.feature, -1), (self.limit, 0.0), (self.left, -1), (self.right, -1), (self.share, float(y.mean()))):
            column.append(value)
        best = self._split(x, y) if depth and 0 < y.mean() < 1 else None
        if best:
            f, limit = best
            low = x[:, f] <= limit
            self.feature[me], self.limit[me] = f, limit
            self.left[me] = self._grow(x[low], y[low], depth - 1)
            self.right[me] = self._grow(x[~low], y[~low], depth - 1)
        return me

    def _split(self, x: np.ndarray, y: np.ndarray) -> tuple[int, float] | None:
        n, total = len(y), y.sum()
        best, found = 2 * total * (n - total) / n - 1e-9, None
        for f in range(x.shape[1]):
            order = np.argsort(x[:, f], kind="stable")
            v, c = x[order, f], np.cumsum(y[order])
            k = np.arange(1, n)
            ok = (v[1:] > v[:-1]) & (k >= self.leaf) & (n - k >= self.leaf)
            if not ok.any():
                continue
            a, b = c[:-1], total - c[:-1]
            impurity = np.where(ok, 2 * a * (k - a) / k + 2 * b * (n - k - b) / (n - k), np.inf)
            i = int(np.argmin(impurity))
            if impurity[i] < best:
                best, found = float(impurity[i]), (f, float((v[i] + v[i + 1]) / 2))
        return found

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The share of positive training rows in the leaf of each row."""
        feature, limit = np.array(self.feature), np.array(self.limit)
        left, right, share = np.array(self.left), np.array(self.right), np.array(self.share)
        node = np.zeros(len(x), dtype=int)
        while (inner := np.flatnonzero(feature[node] >= 0)).size:
            f = feature[node[inner]]
            node[inner] = np.where(x[inner, f] <= limit[node[inner]], left[node[inner]], right[node[inner]])
        return share[node]


def labelled_pages(path: Path = LABELLED) -> list[tuple[str, str, list[str], np.ndarray]]:
    """Title, address, lines and labels (1: around the story) of each page of the labelled table."""
    pages: list[tuple[str, str, list[str], list[int]]] = []
    for row in path.read_text(encoding="utf-8").split("\n"):
        kind, _, text = row.partition("\t")
        if kind == "page":
            title, _, url = text.partition("\t")
            pages.append((title, url, [], []))
        elif kind:
            pages[-1][2].append(text)
            pages[-1][3].append(int(kind == "around"))
    return [(t, u, lines, np.array(labels)) for t, u, lines, labels in pages]


def fitted(pages: Sequence[tuple[str, str, list[str], np.ndarray]]) -> DecisionTree:
    """The tree of labelled pages."""
    return DecisionTree().fit(np.concatenate([describe(lines, title, url)[1] for title, url, lines, _ in pages]), np.concatenate([labels for *_, labels in pages]))


@lru_cache(1)
def trained() -> DecisionTree:
    """Fitted in well under a second on the labelled pages, up to ``MAX_BLOCKS`` blocks."""
    pages, held = [], 0
    for page in labelled_pages():
        held += len(page[2])
        if held > MAX_BLOCKS:
            break
        pages.append(page)
    return fitted(pages)


def _around(key: str, emit):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = trained()
        for b in batches:
            pages, rows = [], []
            for k, t, h, u in zip(b["k"], b["t"], b["h"], b["u"]):
                lines = t.split("\n") if t and t.strip() not in ("", "Error") else []
                at, x = describe(lines, h, u)
                pages.append((k, lines, at))
                rows.append(x)
            share = tree.predict(np.concatenate(rows)) > 0.5 if rows else np.empty(0, bool)
            yield emit(key, pages, share)

    return run


def _numbers(key: str, pages: list, around: np.ndarray) -> pd.DataFrame:
    keys = [k for k, _, at in pages for _ in at]
    return pd.DataFrame({key: keys, "line_no": np.array([i + 1 for _, _, at in pages for i in at], dtype=np.int32), "around": around})


def _stories(key: str, pages: list, around: np.ndarray) -> pd.DataFrame:
    rows, begin = [], 0
    for k, lines, at in pages:
        rows.append((k, "\n".join(lines[i] for i, p in zip(at, around[begin : begin + len(at)]) if not p) or None))
        begin += len(at)
    return pd.DataFrame(rows, columns=[key, "story"])


def _used(pages: DataFrame, key: str, text: str, title: str, url: str) -> DataFrame:
    return pages.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(title).alias("h"), F.col(url).alias("u"))


def find_boilerplate(pages: DataFrame, key: str = "article_id", text: str = "clean_text", title: str = "header", url: str = "sourceurl") -> DataFrame:
    """``key``, ``line_no`` (from 1, blank lines counted) and ``around`` of every non-blank line.

    ``around`` is true for lines that aren't part of the story. Null and blank texts and
    failed fetches (``Error``) have no line; a null title or address only leaves those
    features empty. Repeated pages give repeated rows; ties can't occur. Each page is
    judged by itself from the whole of its text, so nothing is shuffled.
    """
    schema = f"{key} {pages.schema[key].dataType.simpleString()}, line_no int, around boolean"
    used = pages.filter(F.col(text).isNotNull() & ~F.trim(text).isin("", "Error"))
    return _used(used, key, text, title, url).mapInPandas(_around(key, _numbers), schema)


def story_text(pages: DataFrame, key: str = "article_id", text: str = "clean_text", title: str = "header", url: str = "sourceurl") -> DataFrame:
    """``key`` and ``story``: the lines of the story in order, or null for pages that have none."""
    schema = f"{key} {pages.schema[key].dataType.simpleString()}, story string"
    return _used(pages, key, text, title, url).mapInPandas(_around(key, _stories), schema)
