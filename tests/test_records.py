import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from brightreel.functions import naming, parsing
from brightreel.operators import relational, stateful
from brightreel.plans import records
from brightreel.sources import json_walk
from brightreel.streaming import recent


def _each(spark, column, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r.v for r in df.select("i", column(F.col("c")).alias("v")).orderBy("i").collect()]


def test_titles_are_peeled_to_a_fixpoint(spark):
    cases = {
        "Amber Harbor 40th Anniversary - Kino Fest 2026": "Amber Harbor", "Amber Harbor (HP26)": "Amber Harbor", "Amber Harbor Early Access Screening with Cast Q&A": "Amber Harbor", "Fan Event": "Fan Event",
        "Amber Harbor - Encore (20th Anniversary)": "Amber Harbor", "The Event": "The Event", "Amber Harbor (2026 Event) Sensory Friendly Screening": "Amber Harbor", "": "", "x" * 5000: "x" * 5000, "A Harbor Remastered": "A Harbor",
    }
    assert _each(spark, naming.canonical_title, [*cases, None]) == [*cases.values(), None]


def test_years_and_variants(spark):
    df = spark.createDataFrame([("Ann Lee's Amber Harbor 20th Anniversary - Kino Fest 2024",), ("Amber & Harbor by Ann B. Lee",), ("Amber Harbor (1999)",), (None,)], "d string")
    own = df.select("d", naming.canonical_title(F.col("d")).alias("c"), *[c.alias(n) for n, c in naming.title_years(F.col("d"), 2026).items()])
    rows = own.withColumn("v", naming.title_variants(F.col("d"), F.col("c"))).collect()
    assert rows[0].inferred_release_year == 2004 and "Amber Harbor" in rows[0].v and rows[0].v[0] == "Ann Lee's Amber Harbor"
    assert rows[1].v[:2] == ["Amber & Harbor by Ann B. Lee", "Amber and Harbor by Ann B. Lee"] and "Amber & Harbor" in rows[1].v
    assert rows[2].explicit_year == 1999 and rows[2].v == ["Amber Harbor (1999)", "Amber Harbor"] and rows[3].v == []


def test_parsers(spark):
    assert _each(spark, parsing.last_clock, ["at 7 pm, then 10:40 PM", "12:05 am", "21:30", "from 9:00 to 23:15", "none", "", None]) == [1360, 5, 1290, 1395, None, None, None]
    assert _each(spark, lambda c: parsing.date_key(c, 2026), ["on 2025-03-01", "3/1", "12/31/24", "1/2/1999", "soon", None]) == ["2025-03-01", "2026-03-01", "2024-12-31", "1999-01-02", None, None]
    assert _each(spark, parsing.score_text, ["8.0", "7.25", "unrated", "N/A", "", None, "-3.5 of 5"]) == ["8", "7.2", "unrated", "", "", "", "-3.5"]
    assert _each(spark, parsing.widest_picture, ["https://a 1w, https://b 300w,x 900w", "https://a,https://b", "data:x 5w", "", None]) == ["https://b", "https://a", None, None, None]
    assert _each(spark, lambda c: parsing.query_url("u", {"q": c, "z": F.lit(None)}), ["a b&c", None]) == ["u?q=a+b%26c", "u?"]
    assert _each(spark, lambda c: F.size(parsing.local_dates(c, "America/Los_Angeles")), ['"2024-01-02T03:00:00Z" "2024-01-01T23:00:00.5Z" 2024-13-01T00:00:00Z', "x"]) == [1, 0]


def test_objects_of_unknown_shape(spark):
    x = {"Format": "Dolby", "tags": ["Not eligible for A-List", {"a": "3D", "b": ["no"]}], "deep": [{"runtime": True}, {"y": {"Duration": "1hr 35min"}}]}
    assert json_walk.label(x) == "Dolby / 3D" and json_walk.flagged(x) and json_walk.runtime(x) == 95 and json_walk.strings(["a", {"b": "c", "d": ["e"]}, 5]) == ["a", "c"]
    assert len(json_walk.listed({"@graph": [{"@type": ["Movie", "Work"]}, 3]}, "Movie")) == 1 and json_walk.listed(None, "Movie") == [] and json_walk.runtime([1] * 10) is None
    df = spark.createDataFrame([(1, json.dumps(x), "c"), (2, None, "c"), (3, "{broken", "c"), (4, "[" * 100_000, "c")], "i int, j string, label string")
    assert [(r.id, r.runtime, r.flagged) for r in json_walk.object_facts(df, "i", "j").orderBy("id").collect()] == [(1, 95, True), (2, None, False), (3, None, False), (4, None, False)]


def test_circuit_waits_for_the_grid(spark):
    t = [("k", i, f, x, p, d) for i, (f, x, p, d) in enumerate([(True, True, 0, 0), (True, True, 1, 1), (False, False, 0, 1), (True, True, 1, 0), (True, True, 0, 0), (True, True, 1, 1), (True, False, 1, 1)])]
    out = stateful.circuit_opens(spark.createDataFrame([*t, ("other", 0, True, True, 0, 0)], "k string, i int, failed boolean, explicit boolean, place int, day int"), "k", ["i"], 4)
    assert [(r.i, r.opens) for r in out.orderBy("i").collect()] == [(0, False), (1, False), (3, False), (4, False), (5, True), (6, True)]


def test_plans_part_the_films(spark):
    day = dt.date(2024, 1, 5)
    shows = spark.createDataFrame([(1, day, "A", 600, 700, 0, 0), (2, day, "A", 710, 800, 0, 0), (2, day, "B", 705, 800, 0, 0), (3, dt.date(2024, 1, 6), "A", 600, 700, 1, 2)], "film bigint, day date, place string, begins int, ends int, place_rank int, format_rank int")
    asked = spark.createDataFrame([(1, [1, 2]), (2, [1, 2, 3]), (3, [1]), (4, [1, 9]), (5, [3, 3, 1]), (6, None)], "request int, ids array<bigint>")
    got = {r.request: (round(r.cost, 3), r.way) for r in records.watch_plans(asked, shows).collect()}
    assert got == {1: (60.0, "01"), 2: (1310.6, "01,2"), 5: (1301.2, "0,1")}
    assert records.watch_plans(asked.limit(0), shows).count() == 0 and records.watch_plans(asked, shows.limit(0)).count() == 0


def test_union_of_parts_keeps_the_order(spark):
    df = spark.createDataFrame([("k", 1, 2, "b; a"), ("k", 1, 1, "a;c"), ("k", 1, 3, None), ("e", 1, 4, None)], "k string, r int, s int, f string")
    assert {r.k: r.f for r in relational.ranked_merge(df, "k", "r", "s", [], [], [], ["f"]).collect()} == {"k": "a; c; b", "e": ""}


def test_late_rows_are_turned_away(spark, tmp_path):
    cols = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    for i, rows in enumerate([[(1, at(0), 1, "a", 1.0, ""), (2, at(9), 1, "a", 1.0, "")], [(6, at(10), 1, "a", 1.0, "")], [(3, at(0, 30), 1, "a", 1.0, ""), (4, at(8), 1, "a", 1.0, ""), (5, at(20), 1, "a", 1.0, "")]]):
        folder = tmp_path / f"{i}"
        spark.createDataFrame(rows, cols).coalesce(1).write.parquet(str(folder))
        part = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
        os.makedirs(tmp_path / "in", exist_ok=True)
        os.rename(folder / part, tmp_path / "in" / f"{i}.parquet")
        os.utime(tmp_path / "in" / f"{i}.parquet", (1_700_000_000 + i * 100,) * 2)
    out = recent.run_available(recent.hourly(recent.event_stream(spark, str(tmp_path / "in"), "*.parquet", 1)))
    assert sorted((r.w.start.hour, r.n) for r in out.collect()) == [(0, 1), (8, 1), (9, 1), (10, 1)]  # the row of 0:30 came too late


def test_a_cluster_must_name_its_shared_folder(monkeypatch):
    from brightreel import session

    class Context:
        master, getCheckpointDir = "spark://host:7077", staticmethod(lambda: None)

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *_: None)

    with pytest.raises(ValueError):
        session.shared_dir(Session())
