"""Areas from GeoPackages and shapefiles, as rows with ``geometry``: array<array<struct<lon, lat>>>, all rings of all parts."""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RINGS = "array<array<struct<lon:double,lat:double>>>"
_Rings = list[list[dict[str, float]]]


def wkb_rings(data: bytes) -> _Rings:
    """The rings of a polygon or multipolygon in well-known binary; none for other kinds. Heights and measures are passed over."""
    rings: _Rings = []
    _read_wkb(data, 0, rings)
    return rings


def _read_wkb(data: bytes, at: int, rings: _Rings) -> int:
    order = "<" if data[at] else ">"
    (kind,) = struct.unpack_from(order + "I", data, at + 1)
    at += 9 if kind & 0x20000000 else 5  # a reference system follows
    extra = (kind >> 31 & 1) + (kind >> 30 & 1) or (0, 1, 1, 2)[min(3, (kind & 0xFFFFFF) // 1000)]
    base, step = (kind & 0xFFFFFF) % 1000, 16 + 8 * extra
    if base not in (3, 6):
        return len(data)
    (n,) = struct.unpack_from(order + "I", data, at)
    at += 4
    for _ in range(n):
        if base == 6:
            at = _read_wkb(data, at, rings)
            continue
        (points,) = struct.unpack_from(order + "I", data, at)
        at += 4
        rings.append([dict(zip(("lon", "lat"), struct.unpack_from(order + "dd", data, at + k * step))) for k in range(points)])
        at += points * step
    return at


def package_rings(blob: bytes | None) -> _Rings | None:
    """The rings of a geometry as a GeoPackage stores it: a header, an envelope, then well-known binary."""
    if not blob or blob[:2] != b"GP":
        return None
    return wkb_rings(blob[8 + (0, 32, 48, 48, 64)[blob[3] >> 1 & 7] :])


def geopackage(spark: SparkSession, path: str, layer: str, columns: Sequence[str], geometry: str = "geom", rows_per_task: int = 2_000) -> DataFrame:
    """``columns`` (as text) and ``geometry`` of a layer. The file must be readable by all workers; each task reads a range of rows."""
    name = lambda x: '"' + x.replace('"', '""') + '"'
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        least, most = db.execute(f"select min(rowid), max(rowid) from {name(layer)}").fetchone()
    schema = ", ".join(f"`{c}` string" for c in columns) + f", geometry {RINGS}"
    if least is None:
        return spark.createDataFrame([], schema)
    picked = ", ".join(map(name, [*columns, geometry]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
            for b in batches:
                for begin in b["id"].tolist():
                    rows = db.execute(f"select {picked} from {name(layer)} where rowid between ? and ? order by rowid", (begin, begin + rows_per_task - 1)).fetchall()
                    held = [[*(None if v is None else str(v) for v in r[:-1]), package_rings(r[-1])] for r in rows]
                    yield pd.DataFrame(held, columns=[*columns, "geometry"])

    tasks = -(-(most - least + 1) // rows_per_task)
    return spark.range(least, most + 1, rows_per_task, min(tasks, 1000)).mapInPandas(run, schema)


def shape_rings(data: bytes) -> list[_Rings | None]:
    """The rings of each record of a ``.shp`` file; None for records that aren't polygons."""
    out, at = [], 100
    while at + 12 <= len(data):
        (size,) = struct.unpack_from(">i", data, at + 4)
        (kind,) = struct.unpack_from("<i", data, at + 8)
        if kind in (5, 15, 25):
            parts, points = struct.unpack_from("<ii", data, at + 44)
            begins = [*struct.unpack_from(f"<{parts}i", data, at + 52), points]
            first = at + 52 + 4 * parts
            out.append([[dict(zip(("lon", "lat"), struct.unpack_from("<dd", data, first + 16 * k))) for k in range(a, b)] for a, b in zip(begins, begins[1:])])
        else:
            out.append(None)
        at += 8 + 2 * size
    return out


def table_rows(data: bytes, encoding: str = "utf-8") -> tuple[list[str], list[list[str | None]]]:
    """Names and texts (trimmed, None if blank) of a ``.dbf`` file, deleted rows too, as each belongs to a record."""
    n, head, width = struct.unpack_from("<IHH", data, 4)
    fields = []
    for at in range(32, head - 1, 32):
        if data[at] == 0x0D:
            break
        fields.append((data[at : at + 11].split(b"\0")[0].decode(encoding, "replace"), data[at + 16]))
    rows = []
    for k in range(n):
        at, row = head + k * width + 1, []
        for _, size in fields:
            row.append(data[at : at + size].decode(encoding, "replace").strip() or None)
            at += size
        rows.append(row)
    return [f for f, _ in fields], rows


def shapefile(spark: SparkSession, path: str, columns: Sequence[str], encoding: str = "utf-8") -> DataFrame:
    """``columns`` (as text) and ``geometry`` of shapefiles: ``path`` is one without ending, or a pattern of several; each pair of files is one task's work."""
    files = spark.read.format("binaryFile").load([f"{path}.shp", f"{path}.dbf"]).select(F.regexp_extract("path", r"^(.*)\.(?:shp|dbf)$", 1).alias("stem"), F.col("path").endswith(".shp").alias("is_shape"), "content")

    def run(pair: pd.DataFrame) -> pd.DataFrame:
        by = dict(zip(pair["is_shape"], pair["content"]))
        names, rows = table_rows(by[False], encoding)
        at = [names.index(c) for c in columns]
        return pd.DataFrame([[*(row[i] for i in at), rings] for row, rings in zip(rows, shape_rings(by[True]))], columns=[*columns, "geometry"])

    return files.groupBy("stem").applyInPandas(run, ", ".join(f"`{c}` string" for c in columns) + f", geometry {RINGS}")
