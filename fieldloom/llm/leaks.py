"""Passages of held-out items inside a corpus.

One Aho-Corasick automaton holds every run of a few words of every item; each text is
normalised and scanned once. A run is so short that no passage can do without an equal
one (``seed_words``). From each hit both ends are extended by least edits, so a passage
is found if and only if the item and the text hold one within the limit of edits. Word
offsets are mapped back to the original text for the report.
"""

from __future__ import annotations

import math
import pickle
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words in a row of the item that make a passage.
PASSAGE_WORDS = 15
#: One word in so many may differ, rounded up.
WORDS_PER_EDIT = 8
#: Item text (in characters) of one automaton, pickled about 62 bytes a character; larger item sets are scanned in blocks.
BLOCK_CHARS = 2_000_000

_DROPPED = "'`\u2019\u02bc\u00ad\u200b\u200c\u200d\ufeff"
_MARKUP = re.compile(rf"<(?:[/?]?[a-zA-Z]|!)[^<>]*>|&(?:#\d{{1,6}}|[a-zA-Z]{{2,8}});|\\[nrt]|[{_DROPPED}]")
_FOREIGN = re.compile(rf"[{_DROPPED[2:]}]|[^\w\x00-\x7f{_DROPPED[2:]}]+")
_WORD = re.compile(r"[^\W_]+")
_ASCII = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))


def _unmarked(m: re.Match) -> str:
    return "" if m[0][0] in _DROPPED else " "


def fold(text: str) -> str:
    """``text`` without case, punctuation, markup and apostrophes: its words with one blank between.

    Works on whole strings (case folding, one pattern for characters outside ASCII, a byte
    table for the rest), as it runs over every text.
    """
    if "<" in text or "&" in text or "\\" in text:
        text = _MARKUP.sub(_unmarked, text)
    text = text.lower()
    if not text.isascii():
        text = _FOREIGN.sub(_unmarked, text)
    return b" ".join(text.encode("utf-8", "ignore").translate(_ASCII, b"'`").split()).decode()


def words_of(text: str) -> list[str]:
    """The words of ``fold(text)``."""
    return fold(text).split(" ") if text else []


def word_spans(text: str) -> list[tuple[int, int]]:
    """Begin and end in ``text`` of each of ``words_of(text)``."""
    plain: list[int] = []  # for each kept character of the unmarked text its place in the text
    parts, at = [], 0
    for m in _MARKUP.finditer(text):
        parts.append(text[at : m.start()])
        plain.extend(range(at, m.start()))
        if _unmarked(m):
            parts.append(" ")
            plain.append(m.start())
        at = m.end()
    parts.append(text[at:])
    plain.extend(range(at, len(text)))
    spans = []
    joined = "".join(parts)
    lowered = joined.lower()
    if len(lowered) != len(joined):  # a character that grows in lower case: fold one by one
        plain = [p for p, c in zip(plain, joined) for _ in c.lower()]
    for m in _WORD.finditer(lowered):
        spans.append((plain[m.start()], plain[m.end() - 1] + 1))
    return spans


def seed_words(passage_words: int = PASSAGE_WORDS, words_per_edit: int = WORDS_PER_EDIT) -> int:
    """Words of the longest run that every passage shares with the item.

    A passage of ``s`` words with ``e`` edits has ``s - e`` or more equal words in at most
    ``e + 1`` runs. Longer passages hold one of less than three times the least length (see
    ``PassageFinder``), so only these lengths count.
    """
    spans = range(passage_words, 3 * passage_words)
    return max(1, min(math.ceil((s - e) / (e + 1)) for s in spans for e in [most_edits(s, words_per_edit)]))


def most_edits(span: int, words_per_edit: int) -> int:
    """The words that may differ in a passage of so many words."""
    return -(-span // words_per_edit)


def reach(doc: list[str], item: list[str], d: int, i: int, step: int, edits: int) -> list[tuple[int, int]]:
    """For 0 to ``edits`` words changed, dropped or added: the most words of the item passed from (d, i) in the direction of ``step`` that end in an equal one, and the words of the document they take.

    The farthest places on each diagonal are carried from one edit to the next; the result
    for ``e`` edits is never less than for fewer. Where no word is equal it is (0, 0).
    """
    n, m = (len(doc) - d, len(item) - i) if step > 0 else (d + 1, i + 1)
    n, m = max(n, 0), max(m, 0)
    best, out = (0, 0), []
    ends: dict[int, int] = {0: 0}  # diagonal (document less item) to words of the item passed
    for e in range(edits + 1):
        if e:
            grown: dict[int, int] = {}
            for k, y in ends.items():
                for k2, y2 in ((k, y + 1), (k - 1, y + 1), (k + 1, y)):  # changed, dropped, added
                    if y2 <= m and y2 + k2 <= n and y2 > grown.get(k2, -1):
                        grown[k2] = y2
            ends = grown
        for k, y in ends.items():
            x = y0 = y
            while x < m and x + k < n and doc[d + step * (x + k)] == item[i + step * x]:
                x += 1
            ends[k] = x
            if x > y0 and x > best[0]:
                best = (x, x + k)
        out.append(best)
        if best[0] == m or not ends:
            out.extend([best] * (edits - e))
            break
    return out


class PassageFinder:
    """Finds passages of a set of items in texts.

    A passage begins and ends with an equal word. One of three times the least length or
    more, cut in two next to an equal word, has a part within the limit, as ``most_edits`` of
    the parts add up to that of the whole or more. So whether an item has a passage is told
    from shorter spans, and every one of these holds a seed; only for items that have one
    the longest passage is sought.
    """

    def __init__(self, items: list[tuple[int, str]], passage_words: int = PASSAGE_WORDS, words_per_edit: int = WORDS_PER_EDIT) -> None:
        self.least, self.per_edit = passage_words, words_per_edit
        self.seed = seed_words(passage_words, words_per_edit)
        self.few = most_edits(3 * passage_words - 1, words_per_edit)
        self.equal = passage_words - most_edits(passage_words, words_per_edit)
        # an edit parts at most ``seed`` of a passage's runs of that length
        self.hits = max(1, min(n - self.seed + 1 - self.seed * most_edits(n, words_per_edit) for n in range(passage_words, 3 * passage_words)))
        self.items = {key: words_of(text or "") for key, text in items}
        self.places: dict[int, dict[str, list[int]]] = {}
        seeds: dict[str, list[tuple[int, int]]] = {}
        for key, words in self.items.items():
            for at in range(len(words) - self.seed + 1):
                seeds.setdefault(" " + " ".join(words[at : at + self.seed]) + " ", []).append((key, at))
        self.automaton = ahocorasick.Automaton()
        for seed, places in seeds.items():
            self.automaton.add_word(seed, (len(seed), places))
        if seeds:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> Iterator[tuple[int, int, int, int, int]]:
        """(item, first word, words of the document, words of the item, edits) of the longest passage of each item that has one.

        Of equally long ones the one with the fewest edits counts, then the first.
        """
        if not text or not self.automaton:
            return
        folded = fold(text)
        hits = list(self.automaton.iter(f" {folded} "))
        if not hits:
            return
        doc = folded.split(" ")
        begins, at = [], 0
        for w in doc:
            begins.append(at)
            at += len(w) + 1
        places: dict[int, list[tuple[int, int]]] = {}
        for last, (size, at_items) in hits:
            first = bisect_right(begins, last - size + 1) - 1
            for key, i in at_items:
                places.setdefault(key, []).append((first, i))
        for key, seeds in places.items():
            item = self.items[key]
            if len(item) < self.least or len(seeds) < self.hits:
                continue
            runs = self._runs(doc, item, seeds)
            if any(self._worth(doc, key, *run) and self._joined(doc, item, *run, self.few) for run in runs):
                most = most_edits(len(item), self.per_edit)
                span, edits, first, size = max((p for run in runs if (p := self._joined(doc, item, *run, most))), key=lambda p: (p[0], -p[1], -p[2]))
                yield key, first, size, span, edits

    def _runs(self, doc: list[str], item: list[str], seeds: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """The equal runs around the seeds, each once: first word in the document and the item, words."""
        out, until = [], {}
        for d, i in sorted(seeds):
            if until.get(d - i, -1) >= d:
                continue
            a = d, i
            while a[0] and a[1] and doc[a[0] - 1] == item[a[1] - 1]:
                a = a[0] - 1, a[1] - 1
            end = d + self.seed
            while end < len(doc) and end - d + i < len(item) and doc[end] == item[end - d + i]:
                end += 1
            until[d - i] = end - 1
            out.append((*a, end - a[0]))
        return out

    def _worth(self, doc: list[str], key: int, d: int, i: int, n: int) -> bool:
        """Whether a passage of less than three times the least length around an equal run is possible.

        It has ``equal`` or more equal words, each at most ``few`` places off the run's diagonal.
        If it goes on for ``equal + few`` words on one side, there are as many there.
        """
        if n >= self.equal:
            return True
        places = self.places.get(key)
        if places is None:
            places = self.places[key] = {}
            for y, w in enumerate(self.items[key]):
                places.setdefault(w, []).append(y)
        have, few, far = n, self.few, self.equal + 2 * self.few
        for begin, end in ((max(0, d - far), d), (d + n, min(len(doc), d + n + far))):
            for x in range(begin, end):
                if (at := places.get(doc[x])) and any(-few <= x - d + i - y <= few for y in at):
                    have += 1
                    if have >= self.equal:
                        return True
        return False

    def _joined(self, doc: list[str], item: list[str], d: int, i: int, n: int, edits: int) -> tuple[int, int, int, int] | None:
        """Words of the item, edits, first word and words of the document of the longest passage around an equal run, ``edits`` at most."""
        if n >= self.least and edits == self.few:
            return n, 0, d, n
        left, right = reach(doc, item, d - 1, i - 1, -1, edits), reach(doc, item, d + n, i + n, 1, edits)
        best = None
        for a, (y0, x0) in enumerate(left):
            if a and left[a - 1][0] == y0:
                continue
            for b, (y1, x1) in enumerate(right[: edits - a + 1]):
                span = y0 + n + y1
                if (best is None or (span, -a - b) > best[:2]) and self.kept(span, a + b):
                    best = span, -a - b, d - x0, x0 + n + x1
        return (best[0], -best[1], *best[2:]) if best else None

    def kept(self, span: int, edits: int) -> bool:
        """Whether so many words of an item with so many edits make a passage."""
        return span >= self.least and edits <= most_edits(span, self.per_edit)


SCHEMA = "doc_id bigint, item_id bigint, begin int, end int, item_words int, edits int"


def find_leaks(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", doc_text: str = "text", item_key: str = "item_id", item_text: str = "text", offsets: bool = True, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and item of which it holds a passage.

    ``begin`` and ``end`` are character offsets in the original text (null without
    ``offsets``), ``item_words`` the words of the item the passage covers, ``edits``
    the words that differ. Null and empty texts, null keys and items of fewer than
    15 words give no row; repeated rows count once. Long texts are scanned whole.

    The items are a stated query set. They are read in blocks of up to ``block_chars``
    characters; the automaton of a block is built once, and broadcast pickled (about 62
    bytes a character, so some 125 MB at most by default, unpickled once per Python worker).
    The corpus is read once per block and isn't shuffled but for the removal of repeated
    result rows.
    """
    spark = docs.sparkSession
    rows = items.filter(F.col(item_key).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_key).cast("bigint").alias("k"), F.col(item_text).alias("t")).distinct().orderBy("k", "t")
    base = docs.filter(F.col(doc_key).isNotNull() & (F.length(doc_text) > 0)).select(F.col(doc_key).cast("bigint").alias("k"), F.col(doc_text).alias("t"))
    out = None
    for block in _blocks(((r.k, r.t) for r in rows.toLocalIterator()), block_chars):
        sent = spark.sparkContext.broadcast(pickle.dumps(PassageFinder(block)))  # bounded by ``block_chars``
        part = base.mapInPandas(_scanner(sent, offsets), SCHEMA)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], SCHEMA) if out is None else out.distinct()


def _blocks(rows: Iterator[tuple[int, str]], most: int) -> Iterator[list[tuple[int, str]]]:
    block, held = [], 0
    for key, text in rows:
        if block and held + len(text) > most:
            yield block
            block, held = [], 0
        block.append((key, text))
        held += len(text)
    if block:
        yield block


@lru_cache(1)
def _finder(data: bytes) -> PassageFinder:
    return pickle.loads(data)


def _scanner(sent, offsets: bool):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = _finder(sent.value)
        for batch in batches:
            out = []
            for key, text in zip(batch["k"], batch["t"]):
                spans = None
                for item, first, size, span, edits in finder.find(text):
                    begin = end = None
                    if offsets:
                        spans = spans or word_spans(text)
                        begin, end = spans[first][0], spans[first + size - 1][1]
                    out.append((key, item, begin, end, span, edits))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "begin", "end", "item_words", "edits"]).astype({"begin": "Int32", "end": "Int32"})

    return scan
