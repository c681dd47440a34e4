"""Several values packed in one field: a quote-aware tokenizer.

The tokenizer is a finite-state machine over the characters that can change its
state (quotes, brackets, escapes, delimiters); a compiled pattern jumps from one
to the next, so plain stretches cost nothing. States: at the start of a value,
inside quotes, inside a bare value (with a nesting depth).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CLOSERS = {"(": ")", "[": "]", "{": "}"}


@dataclass(frozen=True)
class PackedLayout:
    """How values are separated in a field.

    hard: characters that always end a value outside quotes and brackets.
    soft: a pattern matched at a position outside quotes; where it matches (and
        isn't empty) the matched text is a delimiter. Used for delimiters that may
        also be part of a value, by what follows them.
    absent: whole-field texts that mean "no value" (compared without surrounding blanks).
    brackets: opening brackets that raise the nesting depth: what they enclose isn't
        parted. Brackets that are never closed, or closed without being opened, don't count.
    escape: a character that takes the next one literally, within quotes too, or "".
    prepare: picks another layout by looking at the text (None: keep this one).
    clean: applied to bare values.
    """

    hard: str = ";|\t\n\r"
    soft: str = ""
    absent: tuple[str, ...] = ("", "None")
    brackets: str = ""
    escape: str = ""
    prepare: Callable[[str], "PackedLayout | None"] | None = None
    clean: Callable[[str], str] | None = None


class _Machine:
    def __init__(self, layout: PackedLayout) -> None:
        self.layout = layout
        hard = "[" + re.escape(layout.hard) + "]" if layout.hard else r"(?!)"
        self.delimiter = re.compile(rf"{hard}|{layout.soft}" if layout.soft else hard)
        self.after_quote = re.compile(rf"\s*(?:$|{self.delimiter.pattern})")
        special = "".join(layout.brackets) + "".join(_CLOSERS[b] for b in layout.brackets) + layout.escape
        parts = [self.delimiter.pattern] + ([f"[{re.escape(special)}]"] if special else [])
        self.stop = re.compile("|".join(f"(?:{p})" for p in parts))
        self.blank = re.compile(rf"[^\S{re.escape(layout.hard)}]*")
        inner = rf'[^"{re.escape(layout.escape)}]|""|{re.escape(layout.escape)}.' if layout.escape else '[^"]|""'
        self.quoted = re.compile(rf'"((?:{inner})*)"', re.S)
        self.literal = re.compile(rf'{re.escape(layout.escape)}(.)|"(")' if layout.escape else '()"(")', re.S)
        self.nesting = re.compile(rf"{self.quoted.pattern}|[{re.escape(special)}]", re.S) if layout.brackets else None

    def enclosed(self, text: str) -> dict[int, int]:
        """For each bracket that is closed the end of what it encloses, by a stack of open ones; quoted stretches and escaped characters are passed over."""
        ends: dict[int, int] = {}
        if not self.nesting or not any(b in text for b in self.layout.brackets):
            return ends
        opened: list[tuple[str, int]] = []
        waiting = dict.fromkeys(_CLOSERS.values(), 0)
        at = 0
        while m := self.nesting.search(text, at):
            c, at = m[0], m.end()
            if c == self.layout.escape:
                at += 1
            elif c in self.layout.brackets:
                opened.append((_CLOSERS[c], m.start()))
                waiting[_CLOSERS[c]] += 1
            elif waiting.get(c):
                while True:  # brackets left open within are ordinary characters
                    closer, begin = opened.pop()
                    waiting[closer] -= 1
                    if closer == c:
                        ends[begin] = at
                        break
        return ends

    def run(self, text: str) -> list[str]:
        values: list[str] = []
        ends = self.enclosed(text)
        at, end = 0, len(text)
        while at < end:
            at = self.blank.match(text, at).end()
            if at >= end:
                break
            if text[at] == '"' and (q := self.quoted.match(text, at)) and (a := self.after_quote.match(text, q.end())):
                if value := self.literal.sub(lambda m: m[1] or m[2], q[1]).strip():
                    values.append(value)
                at = max(a.end(), q.end())
                continue
            value, at = self.bare(text, at, ends)
            if value:
                values.append(value)
        return values

    def bare(self, text: str, begin: int, ends: dict[int, int]) -> tuple[str, int]:
        layout, taken, start, at = self.layout, [], begin, begin
        while m := self.stop.search(text, at):
            hit, at = m[0], m.end()
            if layout.escape and hit == layout.escape:
                taken.append(text[start : m.start()])
                start, at = m.end(), m.end() + 1
            elif m.start() in ends:
                at = ends[m.start()]
            elif at > m.start() and self.delimiter.match(text, m.start()):
                return self.cleaned("".join(taken) + text[start : m.start()]), at
        return self.cleaned("".join(taken) + text[start:]), len(text)

    def cleaned(self, value: str) -> str:
        value = value.strip()
        return self.layout.clean(value) if value and self.layout.clean else value


@lru_cache(256)
def _machine(layout: PackedLayout) -> _Machine:
    return _Machine(layout)


def split_packed(text: str | None, layout: PackedLayout) -> list[str]:
    """The non-empty values of ``text`` in order; none for null and absent texts."""
    if text is None or text.strip() in layout.absent:
        return []
    if layout.prepare and (other := layout.prepare(text)):
        layout = other
    return _machine(layout).run(text)


def _theme(value: str) -> str:
    return re.sub(r"\s*,\s*", ",", value)


#: What is in brackets is one value, and a backslash takes the next character as it is.
_NESTED = {"brackets": "([{", "escape": "\\"}
#: A comma or blank before a theme ends the value before it; a comma before an offset doesn't.
THEMES = PackedLayout(hard=";|\t\n\r", soft=r'\s*,(?!\s*\d)|(?<=[^\s,])\s+(?=[^\s,;|\d])', clean=_theme, **_NESTED)
#: A comma ends an entry if an entry follows.
LOCATIONS = PackedLayout(soft=r',(?=\s*(?:"?\d#|$))|,(?=\s*,)', **_NESTED)
COUNTS = PackedLayout(soft=r',(?=\s*(?:"?[A-Z][A-Z0-9_]+#|$))|,(?=\s*,)', **_NESTED)
_TONE_COMMA = PackedLayout(hard=",;|\t\n\r", soft=r"\s+")
_TONE_DECIMAL = PackedLayout(hard=";|\t\n\r", soft=r",(?!\d)|(?<!\d),|\s+")
_QUOTED = re.compile(r'"(?:[^"]|"")*"')


def _tone_layout(text: str) -> PackedLayout:
    """Whether commas outside quotes separate numbers or belong to them."""
    bare = _QUOTED.sub('"', text)
    if "." in bare or '"' in bare:
        return _TONE_COMMA
    inner = re.findall(r"(?<=\d),(?=\d)", bare)
    if not inner:
        return _TONE_COMMA
    if re.search(r"[;|\t\n]|\d\s+[-+\d]|,\s|\s,|,,", bare) or len(inner) == 1:
        return _TONE_DECIMAL
    return _TONE_COMMA


TONE = PackedLayout(prepare=_tone_layout)

#: The packed fields of the feed and their layouts.
FEED_LAYOUTS = {"v2themes": THEMES, "v2locations": LOCATIONS, "v2tone": TONE, "counts": COUNTS}


def _splitter(layout: PackedLayout):
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: split_packed(t, layout))

    return split


def unpack_fields(df: DataFrame, key: str, layouts: dict[str, PackedLayout], keep: Iterable[str] = ()) -> DataFrame:
    """One row per value: ``key``, ``field``, ``pos`` (from 1 over the non-empty values), ``item``.

    Null, blank and absent fields give no row; a null key is kept as null. Quotes
    that are never closed and brackets that are never closed count as ordinary
    characters. Rows aren't made distinct here. Each text is tokenized in one pass
    of an Arrow-batched UDF; no shuffle.
    """
    keep = list(keep)
    packed = F.array(*[F.struct(F.lit(f).alias("field"), _splitter(layout)(F.col(f)).alias("items")) for f, layout in layouts.items()])
    return (
        df.select(key, *keep, F.explode(packed).alias("f"))
        .select(key, *keep, F.col("f.field").alias("field"), F.posexplode("f.items").alias("p", "item"))
        .select(key, *keep, "field", (F.col("p") + 1).cast("int").alias("pos"), "item")
    )
