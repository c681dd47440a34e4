"""Texts cut into pieces under a limit, at natural boundaries, with an overlap.

A text is taken as tokens (words and the white space between them); the prefix sums of
their lengths are the token offsets. Boundaries between paragraphs, lines, sentences and
words are kept as sorted arrays; each cut is found by binary search as the last boundary
under the limit, the next piece starts a bounded step back, and where no boundary fits the
text is cut hard.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PieceLimits:
    """limit: most characters of a piece. overlap: most characters repeated from the piece before.
    fill: a paragraph, line or sentence is preferred over a word only if the piece gets this part of the limit."""

    limit: int = 2000
    overlap: int = 200
    fill: float = 0.5

    def __post_init__(self) -> None:
        if not 0 <= self.overlap < self.limit:
            raise ValueError("the overlap must be less than the limit")


_TOKEN = re.compile(r"\s+|\S+")
_SENTENCE_END = re.compile(r"[.!?…。！？؟।][\"'»”’)\]]*$")


def boundaries(text: str) -> list[np.ndarray]:
    """Sorted offsets at which a piece may start: of paragraphs, lines, sentences and words."""
    tokens = _TOKEN.findall(text)
    ends = np.cumsum([len(t) for t in tokens], dtype=np.int64)
    levels: list[list[int]] = [[], [], [], []]
    for i, token in enumerate(tokens):
        if i and i + 1 < len(tokens) and token.isspace():
            breaks = token.count("\n")
            level = 0 if breaks > 1 else 1 if breaks or " " in token else 2 if _SENTENCE_END.search(tokens[i - 1]) else 3
            for k in range(level, 4):
                levels[k].append(int(ends[i]))
    return [np.asarray(x, dtype=np.int64) for x in levels]


def _hard(text: str, least: int, at: int) -> int:
    """``at`` or a little before, so that no character is parted from its marks."""
    while at > least + 1 and at < len(text) and (unicodedata.combining(text[at]) or text[at] in "‍︎️" or text[at - 1] == "‍" or text[at - 1 : at + 1] == "\r\n"):
        at -= 1
    return at


def cut(text: str, limits: PieceLimits = PieceLimits()) -> list[tuple[int, int]]:
    """Begin and end of each piece. A text within the limit is one piece, an empty one none."""
    n = len(text)
    if not n:
        return []
    if n <= limits.limit:
        return [(0, n)]
    levels = boundaries(text)
    pieces, begin, done = [], 0, 0
    while n - begin > limits.limit:
        most = begin + limits.limit
        end = 0
        for level, starts in enumerate(levels):
            at = int(np.searchsorted(starts, most, side="right")) - 1
            floor = done if level == 3 else max(done, begin + int(limits.limit * limits.fill))
            if at >= 0 and starts[at] > floor:
                end = int(starts[at])
                break
        if not end:
            end = _hard(text, done, most)
        pieces.append((begin, end))
        done = end
        back = end - limits.overlap
        at = int(np.searchsorted(levels[3], back))
        begin = int(levels[3][at]) if at < len(levels[3]) and levels[3][at] <= end else back
    pieces.append((begin, n))
    return pieces


def split_oversized(df: DataFrame, key: str, text: str, limits: PieceLimits = PieceLimits(), only_oversized: bool = True) -> DataFrame:
    """Columns ``key``, ``piece_no`` (from 1), ``begin``, ``overlap`` (characters shared with the piece before) and ``piece``.

    The pieces without their overlaps, in order, are the text, white space included; no
    piece has more than ``limit`` characters (code points). Null texts give no row; texts
    within the limit, empty ones included, give one piece if ``only_oversized`` is false
    (an empty text: none). Repeated rows and ties give repeated pieces; a null key is kept.
    Each text is cut by itself, so nothing is shuffled and a text is one task's work at
    most in its own length; the size test runs before any text leaves the JVM.
    """
    schema = f"{key} {df.schema[key].dataType.simpleString()}, piece_no int, begin int, overlap int, piece string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, t in zip(batch["k"], batch["t"]):
                last = 0
                for i, (a, b) in enumerate(cut(t, limits)):
                    rows.append((k, i + 1, a, last - a, t[a:b]))
                    last = b
            yield pd.DataFrame(rows, columns=[key, "piece_no", "begin", "overlap", "piece"])

    used = df.filter(F.col(text).isNotNull() & (F.char_length(text) > (limits.limit if only_oversized else 0)))
    return used.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, schema)
