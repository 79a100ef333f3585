import gzip
import json

from pyspark.sql import functions as F

from brightreel.sources import extract, readers, sinks


def test_tsv(spark, tmp_path):
    p = str(tmp_path / "basics.tsv.gz")
    with gzip.open(p, "wt") as f:
        f.write("tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\truntimeMinutes\ntt1\tmovie\tA \"b\t\\N\t0\t1999\t\\N\n")
    r = readers.read_tsv(spark, p, readers.BASICS, 2).first()
    assert (r.primaryTitle, r.originalTitle, r.startYear, r.runtimeMinutes) == ('A "b', None, 1999, None)


def test_feed_and_folder(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"region": "r", "venues": [{"id": "v1", "name": "n"}], "screenings": [{"venueId": "v1", "freshness": {"status": "fresh"}}]}))
    (tmp_path / "b.json").write_text("{ not json")
    feed = readers.read_feed(spark, str(tmp_path)).cache()
    assert feed.count() == 2 and feed.where("_corrupt is not null").count() == 1
    assert feed.where("region = 'r'").select(F.explode("venues").alias("v")).first().v.id == "v1"
    assert readers.read_json_folder(spark, str(tmp_path), "region string").where("region = 'r'").count() == 1


def test_markers(spark, tmp_path):
    (tmp_path / "m.txt").write_text("A | B | 2024-01-05\nbad line\nC | 2024-02-31\n")
    rows = readers.read_markers(spark, str(tmp_path / "m.txt")).collect()
    assert [(r.theatre, str(r.show_date)) for r in rows] == [("A | B", "2024-01-05")]


def test_payload(spark, tmp_path):
    (tmp_path / "p.html").write_text('<html><script id="data" type="application/json">{"n": 3}</script></html>')
    assert readers.payload(readers.read_pages(spark, str(tmp_path)), "data", "n int").first().payload.n == 3


def test_previous_report(spark):
    df = spark.createDataFrame([(0,), (10 * 3_600_000_000,), (50 * 3_600_000_000,)], "w bigint")
    assert [r.w // 3_600_000_000 for r in readers.previous_report(df, "w", 40 * 3_600_000_000).collect()] == [10]


def test_walk_inherits_titles():
    doc = {"movieTitle": "Outer", "shows": [{"startTime": "t1"}, {"title": "Inner", "x": {"time": "t2"}}, {"startTime": 5}]}
    assert list(extract.walk(doc)) == [("Outer", "t1"), ("Inner", "t2")]


def test_flight_records():
    body = r'\"movieTitle\":\"One &amp; Two\", \"showtimeId\":\"11\", \"status\":\"Sellable\", \"showDateTimeUtc\":\"2024-01-01T00:00:00Z\"'
    gone = r' \"showtimeId\":\"12\", \"status\":\"Canceled\", \"showDateTimeUtc\":\"2024-01-01T00:00:00Z\"'
    far = "x" * 13_000 + r' \"showtimeId\":\"13\", \"status\":\"Sellable\", \"showDateTimeUtc\":\"2024-01-01T00:00:00Z\"'
    assert extract.flight(body + gone + far) == [("11", "One & Two", "2024-01-01T00:00:00Z")]


def test_regions_and_metadata():
    page = '<meta property="og:title" content="T"><title>other</title><div aria-label="Showtimes for Film A"><p><a href="/showtimes/5">7:00 pm</a></p><a href="/showtimes/6">soon</a></div><a href="/showtimes/7">8:00 pm</a>'
    assert extract.regions(page) == [("5", "Film A", "7:00 pm")]
    assert extract.metadata(page) == {"title": "T", "poster_url": None}


def test_infobox_image(spark):
    texts = ["{{Infobox film\n| name = A\n| image = Poster A.jpg\n}}", "x" * 30_000 + "\n|image=[[File:B c.png|thumb]]", "no image", None, "| image =\n| alt = z"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert {r.i: r.n for r in df.select("i", extract.infobox_image(F.col("t")).alias("n")).collect()} == {0: "Poster A.jpg", 1: "B c.png", 2: None, 3: None, 4: None}


def test_showings(spark):
    pages = [(1, '<script>{"title": "A", "startTime": "t"}</script>'), (2, None), (3, "")]
    df = spark.createDataFrame(pages, "page_id int, html string")
    assert [tuple(r) for r in extract.showings(df).collect()] == [(1, "script", None, "A", "t")]


def test_blob(spark):
    df = spark.createDataFrame([("m", "# T1\n* 2024-01-05: 7:00 pm, 9:00 pm\n* bad\n# T2\n* 2024-01-06: 1:00 pm"), ("n", None), ("o", "")], "k string, b string")
    got = sorted((r.theatre, str(r.show_date), r.show_time) for r in extract.parse_blob(df, "k", "b").collect())
    assert got == [("T1", "2024-01-05", "7:00 pm"), ("T1", "2024-01-05", "9:00 pm"), ("T2", "2024-01-06", "1:00 pm")]


def test_sinks(spark, tmp_path):
    at = str(tmp_path / "cells")
    sinks.write_cells(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), at, ["k"])
    sinks.write_cells(spark.createDataFrame([("b", 3)], "k string, v int"), at, ["k"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(at).collect()) == [("a", 1), ("b", 3)]
    sinks.append(spark.createDataFrame([(1,)], "v int"), str(tmp_path / "d"))
    sinks.append(spark.createDataFrame([(2,)], "v int"), str(tmp_path / "d"))
    assert spark.read.json(str(tmp_path / "d")).count() == 2
    old, new = spark.createDataFrame([("b",), ("a",)], "x string"), spark.createDataFrame([("a",), ("c",)], "x string")
    assert [r.x for r in sinks.merged_markers(old, new).collect()] == ["a", "b", "c"]
    assert sinks.html_rows(spark.createDataFrame([("<&>", None)], "x string, y int")).first().value == "<tr><td>&lt;&amp;&gt;</td><td></td></tr>"
    sinks.write_payload(old, str(tmp_path / "p"))
    assert sorted(json.loads(r.value)["x"] for r in spark.read.text(str(tmp_path / "p")).collect()) == ["a", "b"]
