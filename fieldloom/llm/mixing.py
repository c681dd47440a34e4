"""Records of several sources mixed to target shares of tokens.

Token weights of the cells (source, language, topic) are raked by iterative proportional
fitting to the target shares of sources and to shares of languages and topics, with a
ceiling of copies per source. Documents are then drawn with the cells' calibrated
probabilities; the last cut per source is placed by a histogram, so the drawn tokens meet
the target to about one document. Topics are a column or come from a classifier that is
fitted on labelled texts.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.session import reliable_checkpoint

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public pattern by which this tokenizer's texts are cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bins of the histogram that places the last cut of a source.
BINS = 4096
#: Words kept with their token counts in a Python worker.
CACHED_WORDS = 500_000
#: Buckets of words of the topic classifier, and the most topics it may have.
WORD_BUCKETS = 1 << 14
MOST_TOPICS = 200


class TokenCounter:
    """Exact token counts of a byte-level BPE tokenizer.

    The tokenizer never merges across a blank that follows a visible character, so a text
    is cut there and the counts of its words are kept; only texts with runs of blanks are
    encoded whole.
    """

    def __init__(self, vocabulary: bytes) -> None:
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
        self.encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        encode = self.encode

        class Counts(dict):
            def __missing__(self, word: str) -> int:
                if len(self) >= CACHED_WORDS:
                    self.clear()
                self[word] = n = len(encode(" " + word))
                return n

        self.counts = Counts()

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        if "  " in text:
            return len(self.encode(text))
        first, *rest = text.split(" ")
        return len(self.encode(first)) + sum(map(self.counts.__getitem__, rest))


@lru_cache(2)
def token_counter(vocabulary: bytes) -> TokenCounter:
    """One counter per Python worker, with the words it has met."""
    return TokenCounter(vocabulary)


def vocabulary_of(path: str = TOKENIZER) -> bytes:
    """A tokenizer's vocabulary file, read where the plan is made and sent to the tasks (a public one has a few MB)."""
    with open(path, "rb") as f:
        return f.read()


_WORD = re.compile(r"[^\W\d_]+")


def _buckets(text: str) -> list[int]:
    return [zlib.crc32(w.encode()) % WORD_BUCKETS for w in _WORD.findall(text.lower())]


class TopicModel:
    """Multinomial naive Bayes over hashed words."""

    def __init__(self, labels: list[str], counts: np.ndarray, texts: np.ndarray) -> None:
        """``counts``: words per bucket and label. ``texts``: texts per label."""
        self.labels = labels
        smooth = counts + 0.1
        self.words = np.log(smooth / smooth.sum(axis=0))
        self.prior = np.log(np.maximum(texts, 1) / max(1, texts.sum()))

    @classmethod
    def fit(cls, labelled: DataFrame, text: str, label: str) -> TopicModel | None:
        """Fitted on all rows with a text and a label; None without one.

        Words are counted where the texts are; what is collected are the counts by bucket and
        label, ``WORD_BUCKETS`` x ``MOST_TOPICS`` numbers at most. More labels are refused.
        """

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                held: Counter = Counter()
                for t, y in zip(b["t"], b["y"]):
                    held[y, -1] += 1
                    held.update((y, k) for k in _buckets(t))
                yield pd.DataFrame([(y, k, n) for (y, k), n in held.items()], columns=["y", "k", "n"])

        used = labelled.select(F.col(text).cast("string").alias("t"), F.col(label).cast("string").alias("y")).filter(F.col("t").isNotNull() & F.col("y").isNotNull())
        counted = reliable_checkpoint(used.mapInPandas(run, "y string, k int, n bigint").groupBy("y", "k").agg(F.sum("n").alias("n")))
        labels = sorted(r.y for r in counted.filter("k = -1").limit(MOST_TOPICS + 1).collect())
        if len(labels) > MOST_TOPICS:
            raise ValueError(f"more than {MOST_TOPICS} topics")
        if not labels:
            return None
        at = {y: i for i, y in enumerate(labels)}
        counts, texts = np.zeros((WORD_BUCKETS, len(labels))), np.zeros(len(labels))
        for r in counted.toLocalIterator():
            if r.k < 0:
                texts[at[r.y]] = r.n
            else:
                counts[r.k, at[r.y]] = r.n
        return cls(labels, counts, texts)

    def __call__(self, text: str | None) -> str:
        """The most likely label, the first on a tie; ``none`` for a text without words."""
        found = _buckets(text) if text else []
        return self.labels[int(np.argmax(self.prior + self.words[found].sum(axis=0)))] if found else "none"


def measured(docs: DataFrame, tokenizer: str = TOKENIZER, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", topic: str | TopicModel | None = None) -> DataFrame:
    """``key``, ``source`` (trimmed, lower case), ``lang``, ``topic`` and ``tokens`` of every record.

    ``topic`` is a column, a model, or None: then all records are of topic ``all``.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(vocabulary_of(tokenizer))  # a file of fixed size
    model = spark.sparkContext.broadcast(topic if isinstance(topic, TopicModel) else None)  # bounded by WORD_BUCKETS x MOST_TOPICS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, guess = token_counter(vocabulary.value), model.value
        for b in batches:
            texts = b["text"].fillna("")
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "lang": b["lang"], "topic": texts.map(guess) if guess else b["topic"], "tokens": texts.map(count)})

    given = F.coalesce(F.col(topic).cast("string"), F.lit("none")) if isinstance(topic, str) else F.lit("all")
    used = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.lower(F.trim(source)).alias("source"), F.coalesce(lang, F.lit("unknown")).alias("lang"), given.alias("topic"), F.col(text).alias("text"))
    return used.filter(F.col("source").isNotNull() & F.col("doc_id").isNotNull()).mapInPandas(run, "doc_id bigint, source string, lang string, topic string, tokens bigint")


@dataclass
class Raked:
    """Copies per token of each cell; targets and ceilings in tokens per source."""

    weights: dict[tuple[str, str, str], float]
    tokens: dict[str, float]
    goal: dict[str, float]
    share: dict[str, float]
    repeats: dict[str, int] = field(default_factory=dict)


def rake(
    cells: dict[tuple[str, str, str], float],
    targets: list[tuple[str, float, int]],
    total: float | None = None,
    lang_shares: dict[str, float] | None = None,
    topic_shares: dict[str, float] | None = None,
    rounds: int = 300,
) -> Raked:
    """Iterative proportional fitting of the cells' token weights.

    ``total`` is the size of the mixture. By default it is the largest at which every
    source with records can fill its share; a larger one can be asked for. A source that can't fill its share with ``max_repeats`` copies of all its records gives
    all it can; what is missing is spread over the others in proportion to their shares.
    Shares of languages and topics (default: the corpus's own) are met as far as sources
    and ceilings, which come first, allow.
    """
    share = {s: t for s, t, _ in targets}
    repeats = {s: r for s, _, r in targets}
    keys = [k for k in cells if k[0] in share and cells[k] > 0]
    have = np.array([cells[k] for k in keys], dtype=float)
    tokens = {s: float(sum(cells[k] for k in keys if k[0] == s)) for s in share}
    if total is None:
        held = {s for s in share if tokens[s] > 0 and share[s] > 0}
        limits = [tokens[s] * repeats[s] * sum(share[x] for x in held) / share[s] for s in held]
        total = min(limits) if held else 0.0
    total = float(total)
    goal, full = {}, set()
    while True:  # each turn fills at least one more source to its ceiling
        left = total - sum(tokens[s] * repeats[s] for s in full)
        open_share = sum(share[s] for s in share if s not in full)
        scale = left / open_share if open_share > 0 else 0.0
        goal = {s: tokens[s] * repeats[s] if s in full else share[s] * max(scale, 0.0) for s in share}
        more = {s for s in share if s not in full and goal[s] > tokens[s] * repeats[s]}
        if not more:
            break
        full |= more
    if not keys:
        return Raked({}, tokens, goal, share, repeats)
    cap = np.array([repeats[k[0]] for k in keys], dtype=float)
    out = float(sum(goal.values()))

    def margin(axis: int, wanted: dict[str, float] | None) -> tuple[np.ndarray, np.ndarray]:
        names = sorted({k[axis] for k in keys})
        index = np.array([names.index(k[axis]) for k in keys])
        own = np.bincount(index, weights=have, minlength=len(names))
        aim = np.array([wanted.get(n, 0.0) for n in names]) if wanted else own / own.sum()
        return index, aim * out / aim.sum() if aim.sum() else own

    margins = [margin(1, lang_shares), margin(2, topic_shares)]
    names = sorted({k[0] for k in keys})
    by_source = np.array([names.index(k[0]) for k in keys])
    aims = np.array([goal[n] for n in names])
    w = np.minimum(cap, aims[by_source] / np.maximum(1e-9, np.bincount(by_source, weights=have)[by_source]))
    for turn in range(rounds):
        before = w.copy()
        for index, aim in margins if turn < rounds - 50 else ():
            now = np.bincount(index, weights=w * have, minlength=len(aim))
            w = np.minimum(cap, w * np.where(now > 0, aim / np.maximum(now, 1e-9), 1.0)[index])
        for _ in range(30):  # sources last: exact but for ceilings, which push the rest up
            now = np.bincount(by_source, weights=w * have, minlength=len(names))
            w = np.minimum(cap, w * np.where(now > 0, aims / np.maximum(now, 1e-9), 1.0)[by_source])
        if turn < rounds - 50 and np.allclose(w, before, rtol=1e-9):
            break
    return Raked(dict(zip(keys, w.tolist())), tokens, goal, share, repeats)


def mix(
    docs: DataFrame,
    targets: DataFrame,
    total_tokens: float | None = None,
    tokenizer: str = TOKENIZER,
    lang_shares: dict[str, float] | None = None,
    topic_shares: dict[str, float] | None = None,
    topic: str | TopicModel | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mixture (``doc_id, source, lang, topic, tokens, copies``; only records drawn), the report per source, and that of languages and topics.

    The first report has ``source, target_share, share_reached, tokens_available,
    tokens_aimed, tokens_drawn, largest_record, records_drawn, max_copies, max_repeats,
    reachable``: also a source without records and one whose ceiling is too low
    (``reachable`` false) is listed. The second has ``axis`` (``lang`` or ``topic``),
    ``value, target_share, share_reached``: the shares of sources come first, so these are
    met as far as the sources' records allow. Records with a null or unlisted source or a
    null id aren't used; null and empty texts have no tokens and are drawn with their cell.
    A repeated listing of a source counts once (the largest share). The draw depends on the
    record's id only, so it's the same in every run and after a lost executor.

    What reaches the driver: the token sums of the cells (listed sources x languages x
    topics) and ``BINS`` sums per listed source; never records. Sums are pre-aggregated, so
    a source with a third of all records is no hot spot, and drawing is a map.
    """
    spark = docs.sparkSession
    listed = (
        targets.filter(F.col("source").isNotNull())
        .groupBy(F.lower(F.trim("source")).alias("source"))
        .agg(F.max("target_share").alias("target_share"), F.max("max_repeats").cast("int").alias("max_repeats"))
    )
    wanted = [(r.source, float(r.target_share or 0.0), int(r.max_repeats or 0)) for r in listed.orderBy("source").toLocalIterator()]
    names = [s for s, _, _ in wanted]
    held = reliable_checkpoint(measured(docs, tokenizer, topic=topic).filter(F.col("source").isin(names)))
    cells = {(r.source, r.lang, r.topic): float(r.n or 0) for r in held.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("n")).toLocalIterator()}
    raked = rake(cells, wanted, total_tokens, lang_shares, topic_shares)
    weights = spark.createDataFrame([(*k, w) for k, w in raked.weights.items()], "source string, lang string, topic string, w double")
    u = (F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    placed = (
        held.join(F.broadcast(weights), ["source", "lang", "topic"], "left")  # one row per cell
        .withColumn("w", F.coalesce("w", F.lit(0.0)))
        .withColumn("whole", F.floor(F.col("w") + 1e-9).cast("int"))
        .withColumn("part", F.greatest(F.col("w") - F.col("whole"), F.lit(0.0)))
        .withColumn("at", F.when(F.col("part") > 1e-9, u / F.col("part")))  # drawn once more if below the source's cut, about 1
        .withColumn("bin", F.when(F.col("at") < 4.0, F.floor(F.col("at") * (BINS / 4)).cast("int")))
    )
    sums = placed.groupBy("source", "bin").agg(F.sum("tokens").alias("n"), F.sum(F.col("tokens") * F.col("whole")).alias("fixed")).toLocalIterator()
    fixed: dict[str, float] = {}
    bins: dict[str, np.ndarray] = {}
    for r in sums:
        fixed[r.source] = fixed.get(r.source, 0.0) + float(r.fixed or 0)
        if r.bin is not None:
            bins.setdefault(r.source, np.zeros(BINS))[r.bin] += float(r.n or 0)
    cuts = []
    for s, counts in bins.items():
        reached = fixed[s] + np.concatenate([[0.0], np.cumsum(counts)])
        cuts.append((s, int(np.argmin(np.abs(reached - raked.goal[s])))))
    cut = spark.createDataFrame(cuts, "source string, cut int")
    drawn = (
        placed.join(F.broadcast(cut), "source", "left")  # one row per listed source
        .withColumn("copies", F.col("whole") + F.coalesce((F.col("bin") < F.col("cut")).cast("int"), F.lit(0)))
        .filter(F.col("copies") > 0)
        .select("doc_id", "source", "lang", "topic", "tokens", "copies")
    )
    weight = F.col("tokens") * F.col("copies")
    got = drawn.groupBy("source").agg(F.sum(weight).alias("tokens_drawn"), F.count("*").alias("records_drawn"), F.max("copies").alias("max_copies"))
    largest = held.groupBy("source").agg(F.max("tokens").alias("largest_record"))
    whole = sum(raked.goal.values())
    asked = spark.createDataFrame(
        [(s, t, r, float(raked.tokens[s]), float(raked.goal[s]), bool(raked.tokens[s] * r >= t * whole * (1 - 1e-12) and raked.tokens[s] > 0)) for s, t, r in wanted],
        "source string, target_share double, max_repeats int, tokens_available double, tokens_aimed double, reachable boolean",
    )
    sums = drawn.groupBy("lang", "topic").agg(F.sum(weight).alias("n")).collect()  # languages x topics
    all_tokens = sum(r.n or 0 for r in sums)
    report = asked.join(got, "source", "left").join(largest, "source", "left").select(
        "source", "target_share",
        F.round(F.coalesce("tokens_drawn", F.lit(0)) / F.lit(float(max(1, all_tokens))), 9).alias("share_reached"),
        F.col("tokens_available").cast("bigint").alias("tokens_available"), F.round("tokens_aimed", 3).alias("tokens_aimed"), F.coalesce("tokens_drawn", F.lit(0)).alias("tokens_drawn"),
        F.coalesce("largest_record", F.lit(0)).alias("largest_record"), F.coalesce("records_drawn", F.lit(0)).alias("records_drawn"), F.coalesce("max_copies", F.lit(0)).alias("max_copies"), "max_repeats", "reachable",
    )
    rows = []
    for axis, place, shares in (("lang", 1, lang_shares), ("topic", 2, topic_shares)):
        own, reached = Counter(), Counter()
        for cell, n in cells.items():
            own[cell[place]] += n
        for r in sums:
            reached[r[axis]] += int(r.n or 0)
        aim = {k: v for k, v in (shares or own).items() if k in own} if sum(own.values()) else {}
        for value in sorted(own):
            rows.append((axis, value, round(aim.get(value, 0.0) / (sum(aim.values()) or 1.0), 9), round(reached[value] / max(1, all_tokens), 9)))
    return drawn, report, spark.createDataFrame(rows, "axis string, value string, target_share double, share_reached double")
