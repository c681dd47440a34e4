"""Lines that recur over many documents of one source, found and removed by bitmaps.

The documents of a source get dense numbers within chunks. For each line (equal but for
letter case, white space and digits) and chunk the numbers of the documents that hold it
are kept as one compressed bitmap; those of a line's variants are united. Cardinalities
add up over the chunks of a source, and a line is removed from a document where the
document's number is set in the bitmap of the line.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.session import reliable_checkpoint

#: Documents of a source that must hold a line.
MIN_DOCUMENTS = 10
#: Documents a chunk has about; a greater source has several. Numbers take 16 bits.
CHUNK_DOCUMENTS = 16_384


class Bitmap:
    """A set of 16-bit numbers, stored as the shortest of a list, runs, and plain bits."""

    LIST, RUNS, BITS = b"\x00", b"\x01", b"\x02"

    def __init__(self, numbers: np.ndarray) -> None:
        self.numbers = numbers  # sorted, distinct, uint16

    def __len__(self) -> int:
        return len(self.numbers)

    def to_bytes(self) -> bytes:
        n = self.numbers
        if len(n) < 4:
            return self.LIST + n.tobytes()
        cut = np.flatnonzero(np.diff(n) != 1)
        runs = 4 * (len(cut) + 1)
        bits = int(n[-1]) // 8 + 1
        if 2 * len(n) <= min(runs, bits):
            return self.LIST + n.tobytes()
        if runs <= bits:
            first, last = n[np.r_[0, cut + 1]], n[np.r_[cut, len(n) - 1]]
            return self.RUNS + np.stack([first, last], 1).tobytes()
        held = np.zeros(bits * 8, np.uint8)
        held[n] = 1
        return self.BITS + np.packbits(held).tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Bitmap:
        kind, body = data[:1], data[1:]
        if kind == cls.BITS:
            return cls(np.flatnonzero(np.unpackbits(np.frombuffer(body, np.uint8))).astype(np.uint16))
        held = np.frombuffer(body, np.uint16)
        if kind == cls.RUNS:
            held = np.concatenate([np.arange(a, int(b) + 1) for a, b in held.reshape(-1, 2)]).astype(np.uint16)
        return cls(held)

    @classmethod
    def union(cls, bitmaps: Sequence[Bitmap]) -> Bitmap:
        return cls(np.unique(np.concatenate([b.numbers for b in bitmaps])))

    def contains(self, numbers: np.ndarray) -> np.ndarray:
        held = np.zeros(1 << 16, bool)
        held[self.numbers] = True
        return held[numbers]


def line_key(line: Column) -> Column:
    """What is left of a line without case, white space and digits."""
    return F.regexp_replace(F.lower(line), r"[\s\x{85}\p{Z}\p{Nd}]+", "")


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def _row(source: str, text: str) -> Column:
    """Tells rows with one key but other texts apart."""
    return F.xxhash64(F.lower(source), text)


def _spread(docs: DataFrame, key: str, source: str, text: str, chunk: int) -> DataFrame:
    """``id``, ``row``, ``src``, ``chunk`` and per line ``a``, ``b`` (128 bits of its key, 0 for lines with nothing to compare) and ``v`` (its variant), laid out by source and chunk.

    Sources with more rows than a chunk, of which there are at most rows / ``chunk``, are
    parted by the hash of the document; so none is one task's work.
    """
    src = F.lower(F.col(source))
    rows = docs.filter(F.col(key).isNotNull() & F.col(source).isNotNull())
    parts = rows.groupBy(src.alias("src")).agg(F.ceil(F.count("*") / chunk).cast("int").alias("parts")).filter("parts > 1")
    keys = F.transform(_lines(text), line_key)
    hashed = lambda *x: F.transform(keys, lambda k: F.when(k != "", F.xxhash64(*x, k)).otherwise(F.lit(0)).cast("bigint"))
    used = rows.filter(F.col(text).isNotNull()).select(
        F.col(key).cast("bigint").alias("id"), _row(source, text).alias("row"), src.alias("src"), hashed(F.lit(1)).alias("a"), hashed(F.lit(2)).alias("b"), F.transform(_lines(text), lambda x: F.hash(x)).alias("v")
    )
    placed = used.join(F.broadcast(parts), "src", "left")  # at most rows / chunk rows
    placed = placed.withColumn("chunk", F.coalesce(F.pmod(F.xxhash64("id"), F.col("parts")), F.lit(0)).cast("int")).drop("parts")
    return reliable_checkpoint(placed.repartition("src", "chunk"))


def _by_line(spread: DataFrame) -> DataFrame:
    at = spread.select("src", "chunk", "id", "row", F.posexplode(F.arrays_zip("a", "b", "v")).alias("p", "x"))
    return at.select("src", "chunk", "id", "row", (F.col("p") + 1).cast("int").alias("line_no"), "x.a", "x.b", "x.v").filter((F.col("a") != 0) | (F.col("b") != 0))


_BITMAPS = "src string, chunk int, a bigint, b bigint, n bigint, bitmap binary"


def _numbers(ids: np.ndarray) -> np.ndarray:
    """The dense numbers of a chunk's documents: their places in the order of their keys."""
    known, number = np.unique(ids, return_inverse=True)
    if len(known) > 1 << 16:
        raise ValueError("a chunk has more documents than numbers")
    return number.reshape(-1).astype(np.uint16)


def _built(key: tuple, lines: pd.DataFrame) -> pd.DataFrame:
    a, b, v, n = lines["a"].to_numpy(), lines["b"].to_numpy(), lines["v"].to_numpy(), _numbers(lines["id"].to_numpy())
    order = np.lexsort((n, v, b, a))
    a, b, v, n = a[order], b[order], v[order], n[order]
    new_line = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
    new_variant = new_line | np.r_[True, v[1:] != v[:-1]]
    keep = new_variant | np.r_[True, n[1:] != n[:-1]]
    a, b, n, new_line, new_variant = a[keep], b[keep], n[keep], new_line[keep], new_variant[keep]
    begins = np.flatnonzero(new_variant)
    variants = np.split(n, begins[1:])
    first = np.flatnonzero(new_line[begins])
    size, data = [], []
    for i, j in zip(first, np.r_[first[1:], len(begins)]):
        held = Bitmap(variants[i]) if j == i + 1 else Bitmap.union([Bitmap(x) for x in variants[i:j]])
        size.append(len(held))
        data.append(held.to_bytes())
    at = begins[first]
    return pd.DataFrame({"src": key[0], "chunk": key[1], "a": a[at], "b": b[at], "n": size, "bitmap": data})


def _looked_up(key: str):
    def run(lines: pd.DataFrame, bitmaps: pd.DataFrame) -> pd.DataFrame:
        lines = lines.assign(number=_numbers(lines["id"].to_numpy()))
        met = lines.merge(bitmaps[["a", "b"]].assign(k=np.arange(len(bitmaps))), on=["a", "b"]).sort_values("k", kind="stable")
        k, number, hit = met["k"].to_numpy(), met["number"].to_numpy(), np.zeros(len(met), bool)
        begins = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.empty(0, int)
        for i, j in zip(begins, np.r_[begins[1:], len(k)]):
            hit[i:j] = Bitmap.from_bytes(bitmaps["bitmap"].iat[k[i]]).contains(number[i:j])
        return met.loc[hit, ["id", "row", "line_no"]].rename(columns={"id": key})

    return run


def line_bitmaps(docs: DataFrame, key: str = "article_id", source: str = "sourcecommonname", text: str = "clean_text", chunk: int = CHUNK_DOCUMENTS) -> DataFrame:
    """``src``, ``chunk``, ``a``, ``b`` (the line's hash), ``n`` and ``bitmap``: which of the chunk's documents hold the line."""
    return _by_line(_spread(docs, key, source, text, chunk)).groupBy("src", "chunk").applyInPandas(_built, _BITMAPS)


def _repeated(docs: DataFrame, key: str, source: str, text: str, min_documents: int, chunk: int) -> DataFrame:
    lines = _by_line(_spread(docs, key, source, text, chunk))
    bitmaps = reliable_checkpoint(lines.groupBy("src", "chunk").applyInPandas(_built, _BITMAPS))
    often = bitmaps.groupBy("src", "a", "b").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_documents).select("src", "a", "b")
    kept = bitmaps.join(often, ["src", "a", "b"], "left_semi")
    return lines.groupBy("src", "chunk").cogroup(kept.groupBy("src", "chunk")).applyInPandas(_looked_up(key), f"{key} bigint, row bigint, line_no int")


def repeated_line_numbers(docs: DataFrame, key: str = "article_id", source: str = "sourcecommonname", text: str = "clean_text", min_documents: int = MIN_DOCUMENTS, chunk: int = CHUNK_DOCUMENTS) -> DataFrame:
    """``key`` and ``line_no`` (from 1, blank lines counted) of every line that recurs in its source.

    Documents with a null key, source or text, and lines of nothing but white space and
    digits, aren't counted and have no row. Sources are compared without case. Rows are
    distinct; ties can't occur. An empty table gives an empty result. Cardinalities are exact
    numbers of different documents, also if a document's row is repeated.

    A chunk of a source, some ``chunk`` documents, is one task's work; a bitmap has at most
    8 KB and a hot line one in every chunk.
    """
    return _repeated(docs, key, source, text, min_documents, chunk).select(key, "line_no").distinct()


def remove_repeated_lines(docs: DataFrame, key: str = "article_id", source: str = "sourcecommonname", text: str = "clean_text", min_documents: int = MIN_DOCUMENTS, chunk: int = CHUNK_DOCUMENTS) -> DataFrame:
    """``docs`` with ``kept_text``: ``text`` without the lines that recur in its source.

    Every row comes out, with all its columns; where nothing recurs, or key, source or
    text is null, ``kept_text`` is the text as it was. The order of lines is kept.
    """
    numbers = _repeated(docs, key, source, text, min_documents, chunk).groupBy(F.col(key).alias("__id"), F.col("row").alias("__row")).agg(F.collect_set("line_no").alias("__drop"))
    marked = docs.join(numbers, (F.col(key).cast("bigint") == F.col("__id")) & (_row(source, text) == F.col("__row")), "left")
    numbered = F.filter(F.transform(_lines(text), lambda x, i: F.struct(x.alias("line"), (i + 1).alias("at"))), lambda x: ~F.array_contains("__drop", x["at"]))
    kept = F.when(F.col("__drop").isNull() | F.col(source).isNull(), F.col(text)).otherwise(F.array_join(F.transform(numbered, lambda x: x["line"]), "\n"))
    return marked.withColumn("kept_text", kept).drop("__id", "__row", "__drop")
