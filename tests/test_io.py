import datetime as dt

from pyspark.sql import functions as F

from fieldloom import schemas
from fieldloom.sources import readers as R
from fieldloom.sources import writers as Wr
from fieldloom.streaming import feeds


def event_line(i, code="010", lat="1.5", date="20200102"):
    row = [""] * len(schemas.EVENT_COLUMNS)
    at = schemas.EVENT_COLUMNS.index
    row[at("globaleventid")], row[at("eventcode")], row[at("actiongeo_lat")], row[at("sqldate")], row[at("nummentions")] = str(i), code, lat, date, "3"
    return "\t".join(row)


def test_events_and_records(spark, tmp_path):
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "20200101.csv").write_text("\n".join([event_line(1), event_line(2, lat="north"), "\t" * 57, "short\tline"]) + "\n")
    df = R.events_tsv(spark, str(tmp_path / "e"))
    rows = {r.globaleventid: r for r in df.collect()}
    assert rows[1].eventcode == "010" and rows[1].actiongeo_lat == 1.5 and rows[2].actiongeo_lat is None and len(df.columns) == 58
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "a.csv").write_bytes(("\t".join(["r1", "20200101000000", "1", 'The "Süd', *["x"] * 23]) + "\nbad\tline\n").encode("latin1"))
    got = R.records_tsv(spark, str(tmp_path / "g")).collect()
    assert len(got) == 1 and got[0].sourcecommonname == 'The "Süd' and "gcam" not in got[0].asDict()


def test_lists(spark, tmp_path):
    (tmp_path / "l.csv").write_text('Keyword,Concept\nCrop,"Food, safe"\ncrop,Aid\nx,\n')
    assert R.lexicon(spark, str(tmp_path / "l.csv")) == ["aid", "crop", "food, safe"] and R.lexicon(spark, str(tmp_path / "l.csv"), False) == ["crop"]
    (tmp_path / "t.csv").write_text("other\nB\nA\n")
    assert R.theme_list(spark, str(tmp_path / "t.csv")) == ["A", "B"] and R.theme_list(spark, str(tmp_path / "none.csv")) == []
    (tmp_path / "m.json").write_text('{"a": "b",\n "b": "a"}')
    assert {tuple(r) for r in R.names_map(spark, str(tmp_path / "m.json")).collect()} == {("a", "b"), ("b", "a")}
    (tmp_path / "c.json").write_text('{"Aid": ["Food aid ", "relief", "relief"], "None": []}')
    assert {tuple(r) for r in R.concept_lexicon(spark, str(tmp_path / "c.json")).collect()} == {("Aid", "food aid"), ("Aid", "relief")}
    (tmp_path / "d.csv").write_text("clean_text,impact_type,resource\nhello,death,\"['food', 'water']\"\n")
    assert R.labelled_csv(spark, str(tmp_path / "d.csv")).first().resource == ["food", "water"]


def test_ranges():
    assert R.day_names(dt.date(2020, 2, 28), dt.date(2020, 3, 1)) == ["20200228", "20200229", "20200301"]
    assert len(R.quarter_hours("2020-01-01", "2020-01-01")) == 96 and R.quarter_hours("2020-01-01T23:30", "2020-01-02T00:15")[-1] == "20200102001500"


def test_pages(spark):
    f = spark.createDataFrame([("http://a.b/1", 200, "<title>T</title><p>x</p>"), ("http://bad.c/2", 200, "<p>y</p>"), ("http://a.b/3", 403, None), ("nohost", 200, ""), ("http://a.b/4", None, None)], "url string, status int, html string")
    rows = {r.url: r for r in R.routed_pages(f, spark.createDataFrame([("bad.c",)], "domain string")).collect()}
    assert (rows["http://a.b/1"].header, rows["http://a.b/1"].body) == ("T", "x") and rows["http://bad.c/2"].status == 499 and rows["http://a.b/3"].outcome == "fallback" and rows["nohost"].outcome == "failed"
    assert [tuple(r) for r in R.failing_domains(f, 2).collect()] == [("a.b", 2)]


def test_writers(spark, tmp_path):
    df = spark.range(50).select("id", F.when(F.col("id") < 30, "202001").otherwise("202002").alias("period"))
    Wr.by_period(df, str(tmp_path / "p"))
    Wr.by_period(df.filter("period = '202002'").limit(5), str(tmp_path / "p"))
    back = R.parquet(spark, str(tmp_path / "p"))
    assert {(r.period, r.n) for r in back.groupBy("period").agg(F.count("*").alias("n")).collect()} == {("202001", 30), ("202002", 5)}
    assert Wr.missing_periods(df.withColumn("period", F.lit("202003")), back).count() == 50
    Wr.chunks(df.coalesce(1), str(tmp_path / "c"), 20)
    assert len(list((tmp_path / "c").glob("*.parquet"))) == 3
    Wr.plain_tsv(df, str(tmp_path / "t"))
    Wr.csv_with_header(df, str(tmp_path / "h"))
    assert spark.read.option("header", True).csv(str(tmp_path / "h")).columns == ["id", "period"] and spark.read.option("sep", "\t").csv(str(tmp_path / "t")).count() == 50
    (tmp_path / "n").mkdir()
    (tmp_path / "n" / "chunk_7.parquet").write_bytes(b"x")
    assert R.next_chunk(spark, str(tmp_path / "n")) == 8 and R.next_chunk(spark, str(tmp_path / "none")) == 0
    assert R.unfetched(spark.createDataFrame([("a",), ("b",)], "url string"), spark.createDataFrame([("a",)], "url string")).collect()[0].url == "b"


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i % 40, dt.datetime(2020, 1, 1, 0, i % 50), "ab"[i % 2], float(i)) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, ts timestamp, kind string, v double")
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = feeds.parquet_stream(spark, str(tmp_path / "in"), df.schema, 1)
    q = feeds.window_counts(stream, "ts", "kind", "v").writeStream.format("memory").queryName("w").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    batch = df.groupBy(F.window("ts", "15 minutes").start.alias("start"), "kind").agg(F.count("*").alias("n"), F.sum("v").alias("total"))
    assert {tuple(r) for r in spark.table("w").collect()} == {tuple(r) for r in batch.collect()}
    q = feeds.first_deliveries(stream, "id", "ts").writeStream.format("memory").queryName("f").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("f").count() == 40
    q = feeds.upsert_periods(stream.withColumn("period", F.date_format("ts", "yyyyMM")), str(tmp_path / "out"), str(tmp_path / "cp3"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 80


def test_feed_to_area_months(spark, tmp_path):
    from fieldloom.plans.mapping import write_area_months

    at = schemas.EVENT_COLUMNS.index

    def line(i, lat, lon, date, country="UG"):
        row = event_line(i, "010", lat, date).split("\t")
        row[at("actiongeo_long")], row[at("actiongeo_countrycode")], row[at("event_year")], row[at("dateadded")] = lon, country, date[:4], date
        return "\t".join(row)

    box = lambda x: [[{"lon": float(a + x), "lat": float(b)} for a, b in ((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))]]
    areas = spark.createDataFrame([(1, "Uganda", "Apac", "Maruzi", box(0)), (2, "Uganda", "Kampála", "Kampala", box(10))], "poly_id bigint, name_0 string, name_1 string, name_2 string, geometry array<array<struct<lon:double,lat:double>>>")
    feed, out = tmp_path / "feed", str(tmp_path / "out")
    feed.mkdir()
    (feed / "20200102.csv").write_text("\n".join([line(1, "1", "1", "20200102"), line(1, "1", "1", "20200102"), line(2, "1", "9", "20200103"), line(3, "1", "1", "20200103", "FR"), "\t" * 57]) + "\n")
    assert write_area_months(spark, str(feed), areas, out) == ["202001"]
    (feed / "20200201.csv").write_text("\n".join([line(4, "1", "11", "20200201"), line(5, "1", "1", "20200104")]) + "\n")
    assert write_area_months(spark, str(feed), areas, out) == ["202002"]
    got = {(r.name_0, r.name_1, r.name_2, str(r.period), r.n, r.mentions) for r in spark.read.parquet(out).collect()}
    assert got == {("uganda", "northern", "apac", "202001", 1, 3), ("uganda", "central", "kampala", "202001", 1, 3), ("uganda", "central", "kampala", "202002", 1, 3)}


def test_areas_from_files(spark, tmp_path):
    import sqlite3
    import struct

    from fieldloom.sources import shapes

    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 0.0)]
    hole = [(0.5, 0.5), (1.0, 0.5), (1.0, 1.0), (0.5, 0.5)]
    points = lambda ring, order, z=False: b"".join(struct.pack(order + ("ddd" if z else "dd"), *p, *([7.0] if z else [])) for p in ring)
    wkb = lambda rings, order="<", kind=3: bytes([order == "<"]) + struct.pack(order + "II", kind, len(rings)) + b"".join(struct.pack(order + "I", len(r)) + points(r, order, kind == 1003) for r in rings)
    many = b"\x01" + struct.pack("<II", 6, 2) + wkb([square, hole]) + wkb([hole], ">")
    plain = lambda rings: [[(p["lon"], p["lat"]) for p in r] for r in rings]
    assert plain(shapes.wkb_rings(many)) == [square, hole, hole] and plain(shapes.wkb_rings(wkb([square], kind=1003))) == [square] and shapes.wkb_rings(b"\x01" + struct.pack("<Idd", 1, 1, 2)) == []
    path = str(tmp_path / "a.gpkg")
    with sqlite3.connect(path) as db:
        db.execute('create table "my layer" (fid integer primary key, NAME_0 text, geom blob)')
        head = b"GP\0" + bytes([3]) + struct.pack("<i4d", 4326, 0, 2, 0, 2)
        db.executemany('insert into "my layer" values (?, ?, ?)', [(1, "Mali", head + many), (9, None, head + wkb([square])), (10, "x", None)])
    got = [(r.NAME_0, r.geometry and plain([[p.asDict() for p in ring] for ring in r.geometry])) for r in shapes.geopackage(spark, path, "my layer", ["NAME_0"], rows_per_task=4).collect()]
    assert sorted(got, key=str) == sorted([("Mali", [square, hole, hole]), (None, [square]), ("x", None)], key=str)
    record = lambda n, body: struct.pack(">ii", n, len(body) // 2) + body
    polygon = struct.pack("<i4dii2i", 5, 0, 0, 2, 2, 2, 8, 0, 4) + points(square, "<") + points(hole, "<")
    (tmp_path / "w.shp").write_bytes(b"\0" * 100 + record(1, polygon) + record(2, struct.pack("<i", 0)))
    field = b"NAME\0\0\0\0\0\0\0" + b"C" + b"\0" * 4 + bytes([6]) + b"\0" * 15
    (tmp_path / "w.dbf").write_bytes(struct.pack("<4BIHH", 3, 0, 0, 0, 2, 65, 7) + b"\0" * 20 + field + b"\x0d" + b" Mali  " + b"       ")
    rows = shapes.shapefile(spark, str(tmp_path / "w"), ["NAME"]).collect()
    assert [(r.NAME, r.geometry and [len(x) for x in r.geometry]) for r in rows] == [("Mali", [4, 4]), (None, None)]
