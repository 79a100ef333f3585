from pyspark.sql import functions as F

from brightreel.functions import text
from brightreel.sources import extract


def test_heading_blocks():
    linked = '<nav><h1>Showtimes</h1></nav><h2><a href="/movies/a-1">Film A</a></h2><p>1 hr 30 min</p><div><a href="/showtimes/5"><span>7:00 pm</span> 3D</a><button>9:00pm</button></div><h2><a href="/movies/b">Film &amp; B</a></h2><ul><li class="time"><span>8:15 PM</span></li></ul>'
    assert extract.heading_blocks(linked) == [("5", "Film A", "7:00 pm"), (None, "Film A", "9:00pm"), (None, "Film & B", "8:15 PM")]
    plain = '<h3>Film C</h3><p>95 min</p><div><a href="/showtimes/6">1:00 pm</a></div><h3>IMAX</h3><a href="/showtimes/7">2:00<b> pm</b></a><h3>About</h3>'
    assert extract.heading_blocks(plain) == [("6", "Film C", "1:00 pm"), ("7", "Film C", "2:00 pm")]
    assert extract.heading_blocks('<a href="/movies/z">Zed</a><a href="/showtimes/6">1:00 pm</a>') == [("6", "Zed", "1:00 pm")]
    assert extract.heading_blocks("<h2>Film D</h2><p>no clock") == []


def test_headings_only_without_regions(spark):
    heading = '<h2>Film</h2><a href="/x/1">7:00 pm</a>'
    script = '<script>{"title": "S", "startTime": "t"}</script>'
    pages = [(1, heading), (2, heading + script), (3, f'<div aria-label="Showtimes for R"><a href="/showtimes/9">8:00 pm</a></div>{heading}')]
    got = sorted(tuple(r) for r in extract.showings(spark.createDataFrame(pages, "page_id int, html string")).select("page_id", "kind", "title", "time").collect())
    assert got == [(1, "heading", "Film", "7:00 pm"), (2, "heading", "Film", "7:00 pm"), (2, "script", "S", "t"), (3, "rendered", "R", "8:00 pm")]


def test_languages(spark):
    titles = ["Film (Hindi)", "Film [in Tamil with English subs] (2024)", "Film - Mandarin Chinese Dubbed", "Film (Korean War)", "Hindi", None, "Film [Subtitled]"]
    df = spark.createDataFrame(list(enumerate(titles)), "i int, d string")
    got = {r.i: r.v for r in df.select("i", text.version_languages(F.col("d")).alias("v")).collect()}
    assert {i: v or [] for i, v in got.items()} == {0: ["hindi"], 1: ["tamil"], 2: ["mandarin chinese"], 3: [], 4: [], 5: [], 6: []}
    spoken = spark.createDataFrame([("Hindi Spoken with X [Tamil  spoken with Y]; hindi Spoken with",)], "d string")
    assert spoken.select(text.spoken_languages(F.col("d")).alias("v")).first().v == ["hindi", "tamil"]


def test_claims():
    entity = '{"claims": {"P1": [{"mainsnak": {"datavalue": {"value": "a"}}}, {}, 3, {"mainsnak": {"datavalue": {"value": {"id": "Q1"}}}}], "P2": null}}'
    assert list(extract.flat_claims(entity)) == [("P1", 0, "a"), ("P1", 3, '{"id": "Q1"}')]
    assert [list(extract.flat_claims(x)) for x in (None, "", "{", "[]", '{"claims": 1}', "5")] == [[]] * 6
