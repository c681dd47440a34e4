"""Names typed by hand mapped to a reference list of districts.

Each distinct token is repaired first: it is joined to the tokens of the reference list
by edit distance (through shared deletion variants, an equi-join). The corrected tokens
of a whole entry then rank the list's entries by soft TF-IDF; entries below a limit are
reported as matching none. Names meet only entries with which they share one of the
entry's heaviest tokens, as without these no score reaches the limit.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.session import reliable_checkpoint

# Words that name a kind of area, or hedge a name, and identify nothing by themselves.
KIND_WORDS = """area arrondissement borough canton cercle city commune constituency county department departement dept departamento dist
lga reg terr gov mun
distrito district districts division governorate greater municipality municipio near nr of parish prefecture prov province provincia
provincial region regional rural sector state subcounty subdistrict territory the town township urban village ward zone around outside"""
# Abbreviations and translations of the points of the compass in names.
COMPASS_WORDS = {"north": "n nord norte", "south": "s sud sur sul", "east": "e est este leste", "west": "w ouest oeste"}
_COMPASS = {w: point for point, words in COMPASS_WORDS.items() for w in words.split()}
_KIND = frozenset(KIND_WORDS.split())
_SPLIT = re.compile(r"[^\w]+|_+")
_APOSTROPHES = re.compile(r"['’`´ʼ‘]")


def plain(name: str | None) -> str:
    """``name`` without accents, case and apostrophes."""
    if not name:
        return ""
    return _APOSTROPHES.sub("", "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c)).lower())


def tokens(name: str | None) -> list[str]:
    """The words of a name; hyphens and underscores part words, points of the compass are written out."""
    words = [t for t in _SPLIT.split(plain(name)) if t]
    return [_COMPASS.get(t, t) for t in words] if len(words) > 1 else words


def joined(words: list[str]) -> str:
    """The words without those that only name a kind of area, in one."""
    return "".join(w for w in words if w not in _KIND) or "".join(words)


def allowed(length: int) -> int:
    """The edit distance up to which a token of so many characters is repaired."""
    return 0 if length <= 2 else 1 if length <= 4 else 2 if length <= 7 else 3


#: The most edits that are repaired.
MOST_EDITS = 3
#: Characters of a token from which its deletion variants are made.
VARIED = 8


def edit_distances(a: list[str], b: list[str], most: int = MOST_EDITS) -> np.ndarray:
    """For each pair insertions, deletions, changes and swaps of neighbours (each pair once); ``most + 1`` if there are more.

    All pairs of about one length go through the band of the distance matrix together.
    """
    out = np.full(len(a), most + 1)
    la, lb = np.fromiter(map(len, a), int, len(a)), np.fromiter(map(len, b), int, len(b))
    near = np.flatnonzero(np.abs(la - lb) <= most)
    for size in np.unique(la[near] // 8):
        rows = near[la[near] // 8 == size]
        n, m = int(la[rows].max()), int(lb[rows].max())
        x = np.array([a[k] for k in rows], dtype=f"U{max(n, 1)}").view(np.uint32).reshape(len(rows), -1)
        y = np.array([b[k] for k in rows], dtype=f"U{max(m, 1)}").view(np.uint32).reshape(len(rows), -1)
        far = most + 1
        older, last = None, np.minimum(np.arange(m + 1), far)[None, :].repeat(len(rows), 0)
        done = np.where(la[rows] == 0, np.minimum(lb[rows], far), far)
        for i in range(1, n + 1):
            row = np.full_like(last, far)
            row[:, 0] = min(i, far)
            for j in range(max(1, i - most), min(m, i + most) + 1):
                d = np.minimum(np.minimum(last[:, j] + 1, row[:, j - 1] + 1), last[:, j - 1] + (x[:, i - 1] != y[:, j - 1]))
                if i > 1 and j > 1:
                    d = np.where((x[:, i - 1] == y[:, j - 2]) & (x[:, i - 2] == y[:, j - 1]), np.minimum(d, older[:, j - 2] + 1), d)
                row[:, j] = np.minimum(d, far)
            older, last = last, row
            end = np.flatnonzero(la[rows] == i)
            done[end] = row[end, lb[rows[end]]]
        out[rows] = done
    return out


def deletions(token: str) -> list[str]:
    """The first ``VARIED`` characters of ``token`` with up to the ``allowed`` ones left out.

    Two tokens within that distance share one: leaving a character out of each at a change or
    a swap of neighbours, and out of one at an addition, makes them equal. The part of that
    text which lies in the beginnings of both leaves no more characters unmatched there: where
    its next character stands behind one beginning, all unmatched ones of that beginning are
    left out, and the other, as long, has as many.
    """
    out = layer = {token[:VARIED]}
    for _ in range(allowed(len(token))):
        layer = {t[:i] + t[i + 1 :] for t in layer for i in range(len(t))}
        out = out | layer
    return list(out)


def similarities(a: list[str], b: list[str]) -> np.ndarray:
    """1 for equal tokens, less by the share of edits, 0 beyond the distance allowed to both."""
    d = edit_distances(a, b)
    la, lb = np.fromiter(map(len, a), int, len(a)), np.fromiter(map(len, b), int, len(b))
    most = np.fromiter((min(allowed(x), allowed(y)) for x, y in zip(la, lb)), int, len(a))
    return np.where(d > most, 0.0, 1.0 - d / np.maximum(1, np.maximum(la, lb)))


@dataclass(frozen=True)
class Matching:
    """``accept``: least score of the district. ``region_weight``: what the region adds to tell entries apart."""

    accept: float = 0.6
    region_weight: float = 0.25


def soft_tfidf(query: list[str], entry: list[str], sim: dict[tuple[str, str], float], weight: dict[str, float], unknown: float, ignore: frozenset[str] | set[str] = frozenset()) -> float:
    """Cosine of the weighted tokens, each query token standing for its most similar entry token.

    ``ignore``: query tokens that don't count where they match nothing.
    """
    if not query or not entry:
        return 0.0
    total, norm, used = 0.0, 0.0, set()
    for q in query:
        best, s = None, 0.0
        for e in entry:
            if e not in used and (x := sim.get((q, e), 0.0)) > s:
                best, s = e, x
        if best is None:
            if q not in ignore:
                norm += unknown * unknown
            continue
        used.add(best)
        w = weight.get(best, unknown)
        norm += w * w
        total += s * w * w
    size = sum(weight.get(e, unknown) ** 2 for e in entry)
    return total / math.sqrt(norm * size) if norm and size else 0.0


def entry_scores(qd: list[str], qr: list[str], entry: dict, sim: dict[tuple[str, str], float], limits: Matching) -> tuple[float, float]:
    """Score of the typed district, and of district and region together, for one entry of the list."""
    weight = dict(zip(entry["tokens"], entry["weights"]))
    of_region = {q for q in qd if any(sim.get((q, e), 0.0) > limits.accept for e in entry["region"])}
    whole = joined(entry["district"])
    district = max(soft_tfidf(qd, entry["district"], sim, weight, entry["unknown"], _KIND | of_region), sim.get((joined(qd), whole), 0.0))
    if not qr:
        return district, district + limits.region_weight / 2
    region = max(soft_tfidf(qr, entry["region"], sim, weight, entry["unknown"], _KIND), sim.get((joined(qr), joined(entry["region"])), 0.0))
    return district, district + limits.region_weight * region


_WORDS = T.ArrayType(T.StringType())


@F.pandas_udf(T.StructType([T.StructField(n, _WORDS) for n in ("qd", "qr", "keys", "all")]))
def _parsed(region: pd.Series, district: pd.Series) -> pd.DataFrame:
    rows = []
    for r, d in zip(region, district):
        qd, qr = tokens(d), tokens(r)
        keys = {*qd, joined(qd)} - {""}
        rows.append((qd, qr, sorted(keys), sorted((keys | {*qr, joined(qr)}) - {""})))
    return pd.DataFrame(rows, columns=["qd", "qr", "keys", "all"])


@F.pandas_udf(T.StructType([T.StructField(n, _WORDS) for n in ("region", "district", "vocabulary")] + [T.StructField("whole", T.StringType())]))
def _entry(region: pd.Series, district: pd.Series) -> pd.DataFrame:
    rows = []
    for r, d in zip(region, district):
        rt, dt = tokens(r), tokens(d)
        rows.append((rt, dt, sorted({*rt, *dt, joined(rt), joined(dt)} - {""}), joined(dt)))
    return pd.DataFrame(rows, columns=["region", "district", "vocabulary", "whole"])


def _heaviest(accept: float):
    @F.pandas_udf(_WORDS)
    def run(district: pd.Series, own: pd.Series, weights: pd.Series, whole: pd.Series) -> pd.Series:
        def one(d, o, w, x) -> list[str]:
            square = {t: v * v for t, v in zip(o, w)}
            least = accept * accept * sum(square[t] for t in d) - 1e-9
            left, keys = sum(square[t] for t in set(d)), {x} - {""}
            for t in sorted(set(d), key=lambda t: (-square[t], t)):
                if left < least:
                    break
                keys.add(t)
                left -= square[t]
            return sorted(keys)

        return pd.Series([one(*row) for row in zip(district, own, weights, whole)], dtype=object)

    return run


def indexed(units: DataFrame, limits: Matching = Matching()) -> DataFrame:
    """The list's entries with their tokens, the tokens' inverse document frequencies in the country, and ``keys``.

    ``keys`` are the district's heaviest tokens, so many that the others' squared weights add
    up to less than ``accept`` squared of all: the score is at most the root of the matched
    tokens' part, so an entry none of whose keys is met can't reach ``accept``. The district
    in one word is a key too. Frequencies are counted per country and token, so a large
    country isn't one task's work.
    """
    listed = units.filter(F.col("admin0").isNotNull() & F.col("admin2").isNotNull()).select("unit_id", F.col("admin0").alias("c"), "admin1", "admin2").distinct()
    parsed = listed.withColumn("e", _entry("admin1", "admin2")).select("c", "unit_id", F.xxhash64("admin1", "admin2").alias("row"), "e.*").withColumn("own", F.array_sort(F.array_union("region", "district")))
    parsed = reliable_checkpoint(parsed)
    size = parsed.groupBy("c").agg(F.count("*").alias("n"))
    held = parsed.select("c", "unit_id", "row", F.explode("own").alias("token"))
    weight = held.groupBy("c", "token").agg(F.count("*").alias("df")).join(size, "c").select("c", "token", F.log(1 + F.col("n") / F.col("df")).alias("w"))
    weighed = held.join(weight, ["c", "token"]).groupBy("c", "unit_id", "row").agg(F.array_sort(F.collect_list(F.struct("token", "w"))).alias("x"))
    full = parsed.drop("own").join(weighed, ["c", "unit_id", "row"]).join(size, "c")
    out = full.select("c", "unit_id", "row", "region", "district", F.col("x.token").alias("tokens"), F.col("x.w").alias("weights"), F.log(1.0 + F.col("n")).alias("unknown"), "vocabulary", "whole")
    return reliable_checkpoint(out.withColumn("keys", _heaviest(limits.accept)("district", "tokens", "weights", "whole")).drop("whole"))


@F.pandas_udf(_WORDS)
def _variants(tokens_: pd.Series) -> pd.Series:
    return tokens_.map(deletions)


@F.pandas_udf(T.DoubleType())
def _similar(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(similarities(a.tolist(), b.tolist()))


def repaired_tokens(typed: DataFrame, listed: DataFrame) -> DataFrame:
    """Columns ``c, token, entry, sim``: for each distinct token of a country all listed tokens within the allowed edit distance.

    Both inputs have ``c, token``. They meet in a deletion variant, so no token is compared
    with all others and none within the distance is missed. Tokens are few bytes but much
    work, so they're spread over a fixed number of tasks (by an expression of their own, as a
    repartition by the columns of the ``distinct`` would be dropped and its small partitions
    joined to one).
    """
    spark = typed.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    varied = lambda df: df.distinct().repartition(tasks, F.xxhash64("c", "token")).withColumn("v", F.explode(_variants("token")))
    near = F.abs(F.length("token") - F.length("entry")) <= MOST_EDITS
    met = varied(typed).join(varied(listed).withColumnRenamed("token", "entry"), ["c", "v"]).filter(near).select("c", "token", "entry").distinct().repartition(tasks, F.xxhash64("c", "token", "entry"))
    return reliable_checkpoint(met.withColumn("sim", _similar("token", "entry")).filter(F.col("sim") > 0))


def match_names(typed: DataFrame, units: DataFrame, limits: Matching = Matching()) -> DataFrame:
    """``src, row_key, unit_id`` for rows ``src, row_key, country, region, district`` typed by hand.

    Rows that are, character for character, an entry of ``units`` (``unit_id, admin0,
    admin1, admin2``) have no row, nor have those with a null key or district. ``unit_id``
    is the entry of the same country that is meant, 0 if none is; a null or unlisted
    country gives 0, a null region doesn't count. On a tie the smallest ``unit_id`` wins.
    Rows are distinct; an empty list gives 0 throughout.

    Names are made distinct before anything else, and everything up to the last join runs
    on distinct names or tokens. That join, on the name, is the only one on all rows; a hot
    name's rows are split by adaptive execution, as one row stands against them.
    """
    cases = typed.filter(F.col("row_key").isNotNull() & F.col("district").isNotNull())
    exact = units.select(F.col("admin0").alias("country"), F.col("admin1").alias("region"), F.col("admin2").alias("district")).distinct()
    cases = cases.join(exact, ["country", "region", "district"], "left_anti")
    gap = "\u0000"
    cases = cases.select("src", F.col("row_key").cast("bigint").alias("row_key"), F.coalesce("country", F.lit(gap)).alias("c"), F.coalesce("region", F.lit(gap)).alias("r"), F.col("district").alias("d"))
    index = indexed(units, limits)
    names = cases.select("c", "r", "d").distinct().withColumn("q", _parsed(F.when(F.col("r") != gap, F.col("r")), "d")).select("c", "r", "d", "q.*")
    names = reliable_checkpoint(names)
    repaired = repaired_tokens(names.select("c", F.explode("all").alias("token")), index.select("c", F.explode("vocabulary").alias("token")))
    met = names.select("c", "r", "d", F.explode("all").alias("token"), "keys").join(repaired, ["c", "token"])
    sims = met.groupBy("c", "r", "d").agg(F.collect_set(F.struct("token", "entry", "sim")).alias("sims"))
    entries = index.select("c", "unit_id", "row", F.explode("keys").alias("entry"))
    pairs = met.filter(F.array_contains("keys", F.col("token"))).join(entries, ["c", "entry"]).select("c", "r", "d", "unit_id", "row").distinct()
    full = pairs.join(names.drop("keys", "all"), ["c", "r", "d"]).join(sims, ["c", "r", "d"]).join(index.drop("vocabulary", "keys"), ["c", "unit_id", "row"])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = []
            for qd, qr, sims_, region, district, own, weights, unknown in zip(b["qd"], b["qr"], b["sims"], b["region"], b["district"], b["tokens"], b["weights"], b["unknown"]):
                sim = {(x["token"], x["entry"]): x["sim"] for x in sims_}
                entry = {"region": list(region), "district": list(district), "tokens": own, "weights": weights, "unknown": unknown}
                got.append(entry_scores(list(qd), list(qr), entry, sim, limits))
            yield pd.DataFrame({"c": b["c"], "r": b["r"], "d": b["d"], "unit_id": b["unit_id"], "own": [x for x, _ in got], "total": [x for _, x in got]})

    scored = full.mapInPandas(score, "c string, r string, d string, unit_id bigint, own double, total double").filter(F.col("own") >= limits.accept)
    best = scored.groupBy("c", "r", "d").agg(F.max(F.struct(F.round("total", 9), -F.col("unit_id"))).alias("x")).select("c", "r", "d", (-F.col("x.col2")).alias("unit_id"))
    return cases.join(best, ["c", "r", "d"], "left").select("src", "row_key", F.coalesce("unit_id", F.lit(0).cast("bigint")).alias("unit_id")).distinct()
