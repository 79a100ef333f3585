"""Timestamps against an independent reading with zoneinfo."""

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from brightreel.functions.timestamps import clock_instant_us, instant_us, known_zone, local_to_utc
from brightreel.operators.instants import feed_instants, normalise_instants

LA = "America/Los_Angeles"


def us(y, mo, d, h=0, mi=0, s=0, micro=0, zone="UTC", fold=0):
    at = datetime(y, mo, d, h, mi, s, micro, tzinfo=ZoneInfo(zone), fold=fold).astimezone(timezone.utc)
    return (at - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


CASES = [
    ("2025-10-31T22:10:00Z", us(2025, 10, 31, 22, 10)),
    ("2026-04-07T11:15:08.030Z", us(2026, 4, 7, 11, 15, 8, 30_000)),
    ("2025-06-18T13:50:00.000-07", us(2025, 6, 18, 20, 50)),
    ("2025-06-18T13:50:00-0700", us(2025, 6, 18, 20, 50)),
    ("20240331T021500Z", us(2024, 3, 31, 2, 15)),
    ("1760162100", 1760162100 * 10**6),
    ("1774931100000", 1774931100 * 10**6),
    ("Sat, 30 Mar 2024 14:55:00 -0600", us(2024, 3, 30, 20, 55)),
    ("Wed, 25 Jun 2025 04:45:00 GMT", us(2025, 6, 25, 4, 45)),
    ("June 24, 2025 2:25 am PDT", us(2025, 6, 24, 9, 25)),
    ("May 17, 2026 at 9:05 pm", us(2026, 5, 17, 21, 5, zone=LA)),
    ("January 15, 2025 2:20 pm PT", us(2025, 1, 15, 14, 20, zone=LA)),
    ("17.06.2025 16:38", us(2025, 6, 17, 16, 38, zone=LA)),
    ("17.12.2025 21:00 UTC", us(2025, 12, 17, 21)),
    ("8/6/25 17:00", us(2025, 8, 6, 17, zone=LA)),
    ("12/22/2024 12:40pm CST", us(2024, 12, 22, 18, 40)),
    ("2025-08-03T09:27:24[America/Denver]", us(2025, 8, 3, 9, 27, 24, zone="America/Denver")),
    ("2024-11-03 01:30:00", us(2024, 11, 3, 1, 30, zone=LA, fold=0)),  # twice: the earlier
    ("2024-03-10 02:30:00", us(2024, 3, 10, 3, 30, zone=LA)),  # never: shifted forward
    ("2024-02-30 10:00", None), ("2024-13-01 10:00", None), ("2024-01-01 25:00", None), ("13:00 pm", None), ("TBA", None), ("", None), (None, None), ("2025-01-01", None),
    ("2025-08-03T09:27:24[Mars/Base]", None), ("x" * 5000, None),
]


def test_cascade(spark):
    df = spark.createDataFrame([(i, t, LA) for i, (t, _) in enumerate(CASES)], "i int, t string, z string")
    got = {r.i: r.u for r in df.select("i", instant_us(F.col("t"), F.col("z")).alias("u")).collect()}
    assert {CASES[i][0]: got[i] for i in got} == dict(CASES)


def test_zone_is_needed(spark):
    df = spark.createDataFrame([("2025-01-01 10:00", None), ("2025-01-01T10:00:00Z", None)], "t string, z string")
    assert [r.u for r in df.select(instant_us(F.col("t"), F.col("z")).alias("u")).collect()] == [None, us(2025, 1, 1, 10)]


@pytest.mark.parametrize("policy,fold", [("earlier", 0), ("later", 1)])
def test_ambiguous(spark, policy, fold):
    local = us(2024, 11, 3, 1, 15)
    u = spark.range(1).select(local_to_utc(F.lit(local), F.lit(LA), policy).alias("u")).first().u
    assert u == us(2024, 11, 3, 1, 15, zone=LA, fold=fold)


def test_null_policies(spark):
    row = spark.range(1).select(local_to_utc(F.lit(us(2024, 11, 3, 1, 15)), F.lit(LA), "null").alias("a"), local_to_utc(F.lit(us(2024, 3, 10, 2, 15)), F.lit(LA), "earlier", "null").alias("b")).first()
    assert row.a is None and row.b is None


def test_every_half_hour_of_a_year(spark):
    first = us(2024, 1, 1)
    df = spark.range(0, 366 * 48).select((F.lit(first) + F.col("id") * 1_800_000_000).alias("l"))
    for r in df.select("l", local_to_utc(F.col("l"), F.lit("America/Denver")).alias("u")).collect():
        at = datetime(1970, 1, 1) + timedelta(microseconds=r.l)
        want = at.replace(tzinfo=ZoneInfo("America/Denver"), fold=0).astimezone(timezone.utc)
        assert r.u == (want - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def test_clock_on_a_local_date(spark):
    day = date(2024, 1, 6)
    cases = [("7:26 PM", us(2024, 1, 6, 19, 26, zone=LA)), ("4 : 31 pm", us(2024, 1, 6, 16, 31, zone=LA)), ("5.02 p.m.", us(2024, 1, 6, 17, 2, zone=LA)), ("20h55", us(2024, 1, 6, 20, 55, zone=LA)), ("0905", us(2024, 1, 6, 9, 5, zone=LA)),
             ("03:26Z", us(2024, 1, 7, 3, 26)), ("20:26 UTC", us(2024, 1, 6, 20, 26)), ("19:25-08:00", us(2024, 1, 7, 3, 25)), ("2024-01-07T03:47:00Z", us(2024, 1, 7, 3, 47)), ("Orbis 7", None), (None, None)]
    df = spark.createDataFrame([(i, t, day, LA) for i, (t, _) in enumerate(cases)], "i int, t string, d date, z string")
    got = {r.i: r.u for r in df.select("i", clock_instant_us(F.col("t"), F.col("d"), F.col("z")).alias("u")).collect()}
    assert [got[i] for i in range(len(cases))] == [u for _, u in cases]


def test_tables_with_nulls_and_other_columns(spark):
    sc = spark.createDataFrame([(1, "v1", "2025-01-01 10:00", None, "x"), (1, "v1", "2025-01-01 10:00", None, "x"), (2, None, "2025-01-01T10:00:00Z", "never", "x"), (3, "v9", "2025-01-01 10:00", "", "x")], "screening_id bigint, venueId string, startsAt string, verified_at string, zone string")
    v = spark.createDataFrame([("v1", LA), ("v1", LA), (None, LA)], "id string, timezone string")
    sh = spark.createDataFrame([(7, date(2025, 1, 1), "7:00 pm", "lumen A-1", "y"), (8, date(2025, 1, 1), "7:00 pm", "other", "y"), (9, None, "7:00 pm", "Lumen A1", "y"), (10, date(2025, 1, 1), None, None, "y")], "ingest_seq bigint, show_date date, show_time string, theatre string, zone string")
    th = spark.createDataFrame([("Lumen A 1", LA), (None, LA)], "name string, timezone string")
    got = sorted(map(tuple, feed_instants(sc, v, sh, th).collect()))
    assert got == [("show_time", 7, us(2025, 1, 1, 19, zone=LA)), ("startsAt", 1, us(2025, 1, 1, 10, zone=LA)), ("startsAt", 1, us(2025, 1, 1, 10, zone=LA)), ("startsAt", 2, us(2025, 1, 1, 10))]
    assert feed_instants(sc.limit(0), v, sh.limit(0), th).count() == 0


def test_known_zone(spark):
    df = spark.createDataFrame([("Nowhere/Else",), (LA,), (None,)], "z string")
    assert [r.k for r in df.select(known_zone(F.col("z")).alias("k")).collect()] == [None, LA, None]
    assert normalise_instants(df.withColumn("i", F.lit(1)).limit(0), "i", ["z"], "z").count() == 0
