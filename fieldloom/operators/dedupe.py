"""Near-duplicate texts: exact set similarity joins, MinHash candidates and first-wins resolution."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.functions.text import normalize_for_hash
from fieldloom.session import reliable_checkpoint


def token_set(text: Column | str) -> Column:
    """Sorted distinct words of a text, without case."""
    t = F.col(text) if isinstance(text, str) else text
    return F.array_sort(F.array_distinct(F.filter(F.split(F.lower(t), r"\s+"), lambda w: w != "")))


#: Words whose hashes a Python worker remembers.
REMEMBERED = 500_000


@lru_cache(REMEMBERED)
def _word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


_NO_WORD = re.compile(r"[^a-z0-9]+")


def shingle_hashes(text: str, n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``n`` words (letters a to z and digits, without case); a shorter text is one run, one without words none."""
    words = _NO_WORD.sub(" ", text.lower()).split()
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(_word_hash, words), np.uint64, len(words))
    runs = np.zeros(max(1, len(h) - n + 1), np.uint64)
    for k in range(min(n, len(h))):  # a number of the base below, whose digits are the words' hashes
        runs = runs * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(runs)]
    runs = (runs ^ (runs >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique((runs ^ (runs >> np.uint64(32))).view(np.int64))


def shingles(text: Column | str, n: int = 5) -> Column:
    """``shingle_hashes`` of a text, null for a null one; over whole batches, which costs a fifth of array expressions."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else shingle_hashes(t, n))

    return run(F.col(text) if isinstance(text, str) else text)


#: Items are counted in so many buckets (8 bytes each on the driver and in the tasks) to tell rare from frequent ones.
COUNT_BUCKETS = 1 << 18
#: Pairs (16 bytes each) up to which their ids are broadcast to pick their sets.
FEW_PAIRS = 200_000
#: Bits of the summary of a set that rules out pairs before their sets are fetched.
SUMMARY_BITS = 256


def _prefixed(counts: np.ndarray, threshold: float):
    @F.pandas_udf("prefix array<bigint>, s0 bigint, s1 bigint, s2 bigint, s3 bigint")
    def run(sets: pd.Series) -> pd.DataFrame:
        prefix, summary = [], []
        for items in sets:
            x = np.asarray(items, dtype=np.int64)
            n = len(x)
            order = np.lexsort((x, counts[x & (COUNT_BUCKETS - 1)]))
            prefix.append(x[order[: n - math.ceil(n * threshold - 1e-9) + 1]])
            odd = (np.bincount((x >> 20) & (SUMMARY_BITS - 1), minlength=SUMMARY_BITS) & 1).astype(np.uint8)
            summary.append(np.packbits(odd).view(np.int64))
        bits = np.stack(summary) if summary else np.empty((0, SUMMARY_BITS // 64), np.int64)
        return pd.DataFrame({"prefix": prefix, **{f"s{i}": bits[:, i] for i in range(SUMMARY_BITS // 64)}})

    return run


def similar_sets(sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a < b`` of ids whose sets (``id``, ``items``: distinct) have a Jaccard similarity of at least ``threshold``, with it.

    Exact (for items of other types than bigint but for clashes of 64-bit hashes), by prefix
    filtering: in any order of all items two similar sets must share one of each other's
    first ``n - ceil(t n) + 1``, so rare items come first. How rare is told by counts in
    ``COUNT_BUCKETS`` buckets, which is all that's collected. Pairs that meet are dropped
    where their sizes, the places of the shared item, or the summaries rule the threshold
    out: an item that isn't common changes at most one bit of the summary, so the sets differ
    in at least as many items as the summaries in bits. What is left is compared in full.
    Equal sets are to be made one before; a pair of different sets is never left out, so a
    group of ``n`` similar sets has ``n ** 2 / 2`` pairs. Empty sets have no pair. Spark
    takes a set for one item when it estimates sizes, so the joins of items and sets are
    merge joins by hint: it would broadcast them, by way of the driver, whatever they hold.
    """
    if dict(sets.dtypes)["items"] != "array<bigint>":
        sets = sets.select("id", F.transform("items", lambda w: F.xxhash64(w)).alias("items"))
    sets = sets.filter(F.size("items") > 0)
    seen = sets.select(F.explode("items").alias("w")).groupBy(F.col("w").bitwiseAND(COUNT_BUCKETS - 1).alias("k")).agg(F.count("*").alias("n")).toLocalIterator()
    counts = np.zeros(COUNT_BUCKETS, np.int64)
    for r in seen:  # one row per bucket
        counts[r.k] = r.n
    words = [f"s{i}" for i in range(SUMMARY_BITS // 64)]
    cut = sets.withColumn("x", _prefixed(counts, threshold)("items")).select("id", F.size("items").cast("bigint").alias("n"), *[f"x.{c}" for c in words], F.posexplode("x.prefix").alias("at", "w"))
    rows = cut.select("id", (F.shiftleft("n", 32) + F.col("at")).alias("n_at"), *words, "w")  # as few bytes as may be; both sides only rename, so they are shuffled once
    a, b = (rows.select(*[F.col(c).alias(c if c == "w" else f"{c}_{k}") for c in rows.columns]) for k in "ab")
    na, nb, ata, atb = (F.shiftright("n_at_a", 32), F.shiftright("n_at_b", 32), F.col("n_at_a").bitwiseAND(0xFFFFFFFF), F.col("n_at_b").bitwiseAND(0xFFFFFFFF))
    least = F.ceil((na + nb) * (threshold / (1 + threshold)) - 1e-6)  # items in common
    bits = sum((F.bit_count(F.coalesce(f"{c}_a", F.lit(0)).bitwiseXOR(F.coalesce(f"{c}_b", F.lit(0)))) for c in words), F.lit(0))  # never null; else a filter would run the summaries twice
    possible = (
        (F.col("id_a") < F.col("id_b"))
        & (F.least(na, nb) >= F.greatest(na, nb) * threshold - 1e-9)
        & (F.least(na - ata, nb - atb) >= least)  # true at the first item in common
        & (na + nb - bits >= 2 * least)
    )
    met = reliable_checkpoint(a.join(b.hint("merge"), "w").filter(possible).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct())
    if met.limit(FEW_PAIRS + 1).count() <= FEW_PAIRS:  # then only their sets are moved
        ids = met.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        sets = sets.join(F.broadcast(ids), "id", "left_semi")
    both = met.join(sets.select(F.col("id").alias("a"), F.col("items").alias("x")).hint("merge"), "a").join(sets.select(F.col("id").alias("b"), F.col("items").alias("y")).hint("merge"), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.select("a", "b", (common / (F.size("x") + F.size("y") - common)).alias("similarity")).filter(F.col("similarity") >= threshold - 1e-12)


def classes(df: DataFrame, key: str, text: str, normalized: bool = False) -> DataFrame:
    """``id``, ``class_id``: exact copies of a text share the smallest id of them. Null texts form no class and keep their own id."""
    t = normalize_for_hash(text) if normalized else F.col(text)
    hashed = df.select(F.col(key).cast("bigint").alias("id"), F.struct(F.xxhash64(t).alias("h"), F.xxhash64(F.lit(1), t).alias("g")).alias("h"), t.isNotNull().alias("has")).filter(F.col("id").isNotNull())
    first = hashed.filter("has").groupBy("h").agg(F.min("id").alias("class_id"))
    return hashed.join(first, "h", "left").select("id", F.when(F.col("has"), F.col("class_id")).otherwise(F.col("id")).alias("class_id"))


def first_wins(pairs: DataFrame, a: str = "a", b: str = "b", one_task: int = 500_000) -> DataFrame:
    """``id``, ``kept``: an item is kept unless an earlier (smaller) kept one is similar.

    The lexicographically first maximal independent set, as a sequential pass would give:
    in each round the larger neighbours of the items without an undecided smaller neighbour
    are dropped, with all their pairs. Each round is checkpointed and decides at least the
    smallest item left. A chain of pairs settles few items a round, so at most ``one_task``
    open pairs are gone through in order by one task. Items in no pair aren't listed.
    """
    edges = reliable_checkpoint(pairs.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct())
    open_, dropped = edges, edges.select(F.col("b").alias("id")).limit(0)
    while n := open_.count():
        if n <= one_task:
            dropped = dropped.unionByName(open_.coalesce(1).mapInPandas(_dropped_in_order, f"id {edges.schema['a'].dataType.simpleString()}"))
            break
        first = open_.join(open_.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        more = reliable_checkpoint(first.select(F.col("b").alias("id")).distinct())
        dropped = reliable_checkpoint(dropped.unionByName(more))
        open_ = reliable_checkpoint(open_.join(more.withColumnRenamed("id", "a"), "a", "left_anti").join(more.withColumnRenamed("id", "b"), "b", "left_anti"))
    ids = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    return reliable_checkpoint(ids.join(dropped.withColumn("__d", F.lit(True)), "id", "left").select("id", F.col("__d").isNull().alias("kept")))


def _dropped_in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The larger items of all pairs that have a kept smaller one."""
    held = list(batches)
    if held:
        dropped: dict = {}
        for x, y in pd.concat(held).sort_values(["b", "a"])[["a", "b"]].itertuples(index=False):
            if x not in dropped:
                dropped[y] = True
        yield pd.DataFrame({"id": list(dropped)}, dtype=held[0]["b"].dtype)


def deduplicate_by_similarity(df: DataFrame, key: str, text: str, threshold: float = 0.9) -> DataFrame:
    """Per row ``key``, ``class_id`` (of exact copies), ``n_links`` (similar other classes) and ``is_kept``.

    Similarity is the Jaccard similarity of word sets. Copies of one text are one class and
    aren't expanded into pairs; of a class only the smallest id can be kept. Null, empty and
    blank texts are all kept. Every similar pair in the table counts, at any distance.
    """
    return _resolve(df, key, text, token_set(text), threshold)


def deduplicate_by_shingles(df: DataFrame, key: str, text: str, threshold: float = 0.8, words: int = 5) -> DataFrame:
    """As ``deduplicate_by_similarity`` on runs of five words, 0.8 or more."""
    return _resolve(df, key, text, shingles(text, words), threshold)


def _resolve(df: DataFrame, key: str, text: str, items: Column, threshold: float) -> DataFrame:
    # Texts with equal sets are one class: the class is that of the set, not of the spelling.
    if dict(df.select(items.alias("x")).dtypes)["x"] != "array<bigint>":
        items = F.transform(items, lambda w: F.xxhash64(w))
    once = F.explode(F.array(F.array_sort(F.coalesce(items, F.array().cast("array<bigint>")))))  # a generator, so that the sets aren't made anew for each column
    sets = df.filter(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"), once.alias("items"))
    hashed = sets.select("id", F.xxhash64("items").alias("h"), F.xxhash64(F.lit(1), "items").alias("g"), (F.size("items") > 0).alias("has"), "items")
    first = hashed.filter("has").groupBy("h", "g").agg(F.min("id").alias("class_id"), F.first("items").alias("items"))
    first = reliable_checkpoint(first)
    # As many rows as texts, so a merge join too.
    member = hashed.select("id", "h", "g", "has").join(first.select("h", "g", "class_id").hint("merge"), ["h", "g"], "left").select("id", "has", F.coalesce("class_id", "id").alias("class_id"))
    pairs = reliable_checkpoint(similar_sets(first.select(F.col("class_id").alias("id"), "items"), threshold))
    links = pairs.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n_links"))
    state = first_wins(pairs).withColumnRenamed("id", "class_id")
    out = member.join(links, "class_id", "left").join(state, "class_id", "left")
    kept = ~F.col("has") | ((F.col("id") == F.col("class_id")) & F.coalesce("kept", F.lit(True)))
    return out.select(F.col("id").alias(key), "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), kept.alias("is_kept"))


def minhash_bands(hashes: Column | str, size: int, bands: int, seed: int = 7) -> Column:
    """One number per band of a MinHash signature of an array of 64-bit hashes.

    ``size`` multiply-shift hash functions, vectorised; the rows of a band are folded into one number.
    """
    rng = np.random.default_rng(seed)
    factor, offset = rng.integers(1, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, size, dtype=np.uint64)
    mixer = rng.integers(1, 2**63, size // bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def run(sets: pd.Series) -> pd.Series:
        def one(items) -> np.ndarray:
            x = np.asarray(items, dtype=np.int64).view(np.uint64)
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            least = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
            for k in range(0, len(x), 1024):
                least = np.minimum(least, (x[k : k + 1024, None] * factor + offset).min(axis=0))
            rows = (least >> np.uint64(16)).reshape(bands, -1)
            return (rows * mixer).sum(axis=1, dtype=np.uint64).view(np.int64)

        return sets.map(one)

    return run(F.col(hashes) if isinstance(hashes, str) else hashes)


def minhash_pairs(df: DataFrame, key: str, text: str, threshold: float = 0.85, size: int = 240, bands: int = 20) -> DataFrame:
    """Pairs ``a < b`` of classes of equal sets that share a band of their signature and have at least ``threshold`` similarity.

    Candidates are verified exactly. Equal sets are one class before bands are formed, so a
    band gathers only different sets; the probability that a pair of similarity ``s`` is met
    is ``1 - (1 - s ** (size / bands)) ** bands``: 0.95 at 0.85 with the defaults, and half
    a per cent at 0.5, which texts made of common words easily reach.
    """
    sets = df.filter(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"), token_set(text).alias("items")).filter(F.size("items") > 0)
    one = sets.groupBy(F.xxhash64("items").alias("h"), F.xxhash64(F.lit(1), "items").alias("g")).agg(F.min("id").alias("id"), F.first("items").alias("items"))
    signed = reliable_checkpoint(one.select("id", "items", minhash_bands(F.transform("items", lambda w: F.xxhash64(w)), size, bands).alias("m")))
    keys = signed.select("id", F.posexplode("m").alias("band", "v"))
    met = keys.alias("x").join(keys.alias("y"), (F.col("x.band") == F.col("y.band")) & (F.col("x.v") == F.col("y.v")) & (F.col("x.id") < F.col("y.id"))).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    both = met.join(signed.select(F.col("id").alias("a"), F.col("items").alias("p")), "a").join(signed.select(F.col("id").alias("b"), F.col("items").alias("q")), "b")
    common = F.size(F.array_intersect("p", "q"))
    return both.select("a", "b", (common / (F.size("p") + F.size("q") - common)).alias("similarity")).filter(F.col("similarity") >= threshold)


def deduplicate_by_minhash(df: DataFrame, key: str, text: str, threshold: float = 0.85) -> DataFrame:
    """As ``deduplicate_by_similarity`` at the threshold of ``minhash_pairs``, 0.85 or more.

    Bands meet a pair by probability only, and what completes them (``similar_sets``) meets
    theirs too, so the links are taken from it alone and none is lost.
    """
    return _resolve(df, key, text, token_set(text), threshold)


def numbered(df: DataFrame, order: str) -> DataFrame:
    """``df`` with ``place``, from 0 in ``order``, without bringing all rows to one task: sorted by ranges, numbered within each and moved on by the rows before it."""
    laid = reliable_checkpoint(df.repartitionByRange(order).sortWithinPartitions(order).withColumn("__m", F.monotonically_increasing_id()))
    part, at = F.shiftright("__m", 33), F.col("__m").bitwiseAND((1 << 33) - 1)
    before, rows = 0, []
    for r in laid.groupBy(part.alias("p")).agg(F.count("*").alias("n")).orderBy("p").toLocalIterator():  # one row per task
        rows.append((r.p, before))
        before += r.n
    starts = df.sparkSession.createDataFrame(rows, "__p bigint, __start bigint")
    return laid.withColumn("__p", part).join(F.broadcast(starts), "__p").withColumn("place", at + F.col("__start")).drop("__m", "__p", "__start")


def _window_pairs(threshold: float, window: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        places, sets = rows["place"].tolist(), [frozenset(x) for x in rows["items"]]
        often = Counter(w for s in sets for w in s)
        met: dict[int, list[int]] = {}
        out = []
        for j, s in enumerate(sets):
            if not s:
                continue
            rare = sorted(s, key=lambda w: (often[w], w))[: len(s) - math.ceil(len(s) * threshold - 1e-9) + 1]
            for i in {i for w in rare for i in met.get(w, ())}:
                t = sets[i]
                if places[i] // window == key[0] and places[j] - places[i] < window and min(len(s), len(t)) >= threshold * max(len(s), len(t)) - 1e-9:
                    both = len(s & t)
                    if both / (len(s) + len(t) - both) >= threshold - 1e-12:
                        out.append((places[i], places[j]))
            for w in rare:
                met.setdefault(w, []).append(j)
        return pd.DataFrame(out, columns=["a", "b"])

    return run


def deduplicate_in_window(df: DataFrame, key: str, text: str, threshold: float = 0.9, window: int = 1000) -> DataFrame:
    """``key`` and ``is_kept``: a row goes if an earlier kept one of the ``window - 1`` before it, in the order of ``key``, has a similar word set.

    Rows are cut into blocks of ``window`` places; each block meets itself and the next one
    in a task, so a task has two windows of rows at most whatever the texts. Null, empty and
    blank texts are kept; null keys are left out.
    """
    sets = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.transform(F.coalesce(token_set(text), F.array().cast("array<string>")), lambda w: F.xxhash64(w)).alias("items"))
    rows = reliable_checkpoint(numbered(sets, "key"))
    own = F.floor(F.col("place") / window).cast("bigint")
    blocks = rows.select("place", "items", F.explode(F.filter(F.array(own, own - 1), lambda b: b >= 0)).alias("block"))
    pairs = blocks.groupBy("block").applyInPandas(_window_pairs(threshold, window), "a bigint, b bigint")
    state = first_wins(pairs)
    return rows.join(state, rows["place"] == state["id"], "left").select(F.col("key").alias(key), F.coalesce("kept", F.lit(True)).alias("is_kept"))
