"""Likeness of short texts in per cent, by their longest common subsequence."""

from __future__ import annotations


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence, the characters of ``a`` as bits of one number."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    free = every = (1 << len(a)) - 1
    for c in b:
        met = free & places.get(c, 0)
        free = ((free + met) | (free - met)) & every
    return len(a) - free.bit_count()


def ratio(a: str, b: str) -> float:
    """Twice the common subsequence over both lengths."""
    return 200.0 * common(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial(a: str, b: str) -> float:
    """The best ``ratio`` of the shorter text with a stretch of the longer one of its length, or less at the ends."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 0.0 if long else 100.0
    n = len(short)
    return max(ratio(short, long[max(0, at) : at + n]) for at in range(1 - n, len(long)))


def _words(a: str, b: str) -> tuple[list[str], list[str], list[str]]:
    x, y = set(a.split()), set(b.split())
    return sorted(x & y), sorted(x - y), sorted(y - x)


def by_words(a: str, b: str) -> float:
    """The better of the texts with sorted words, and of their shared words with what either has besides."""
    both, one, two = _words(a, b)
    if both and not (one and two):
        return 100.0
    best = max(ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), ratio(" ".join(both + one), " ".join(both + two)))
    shared = " ".join(both)
    return max([best, *(ratio(shared, " ".join(both + rest)) for rest in (one, two))]) if both else best


def by_words_partial(a: str, b: str) -> float:
    """As ``by_words`` on stretches: 100 if a word is shared."""
    both, one, two = _words(a, b)
    return 100.0 if both else max(partial(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), partial(" ".join(one), " ".join(two)))


def weighted(a: str, b: str) -> float:
    """The widely used weighted ratio: the best of the plain ratio and those by words and on stretches, which count less.

    Words weigh 0.95. Where one text is 1.5 times as long as the other or more, stretches
    are compared, at 0.9, beyond 8 times at 0.6. Empty texts are 0.
    """
    if not a or not b:
        return 0.0
    longer = max(len(a), len(b)) / min(len(a), len(b))
    if longer < 1.5:
        return max(ratio(a, b), 0.95 * by_words(a, b))
    part = 0.9 if longer <= 8 else 0.6
    return max(ratio(a, b), part * partial(a, b), 0.95 * part * by_words_partial(a, b))
