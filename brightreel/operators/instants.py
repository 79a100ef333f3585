"""Problem 5: every time of the feeds as one instant in UTC.

``normalise_instants`` works on any table with a text column and a lookup of
default zones; ``feed_instants`` applies it to ``screenings`` and
``showtime``.

Defined results: null, blank and word values give no row; an unknown venue or
theatre leaves zone-less values without a row (they have no instant) while
values with their own zone keep theirs; repeated rows each give a row; empty
tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightreel.functions.timestamps import clock_instant_us, instant_us, known_zone, name_key
from brightreel.session import table

#: ``theatre`` is a list of fixed length (see the data notes); broadcast only below this many rows.
MAX_BROADCAST_PLACES = 100_000


def stated(df: DataFrame, field_name: str, row_id: str, instant: Column) -> DataFrame:
    """(field_name, row_id, utc_us) of the rows whose ``instant`` is not null.

    The partition number keeps the filter above the projection: pushed below
    it, the filter would compute every instant a second time.
    """
    once = df.select(F.col(field_name), F.col(row_id), instant.alias("utc_us"), F.spark_partition_id().alias("_once"))
    return once.where("utc_us is not null").drop("_once")


def normalise_instants(df: DataFrame, row_id: str, columns: list[str], default_zone: str) -> DataFrame:
    """(field_name, row_id, utc_us): one row per value of ``columns`` that states a time."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("text")) for c in columns]))
    long = df.select(F.col(row_id).alias("row_id"), F.col(default_zone).alias("zone"), pairs.alias("x")).select("row_id", "zone", "x.field_name", "x.text")
    return stated(long.where("text is not null"), "field_name", "row_id", instant_us(F.col("text"), F.col("zone")))


def place_zones(theatre: DataFrame) -> DataFrame:
    """(place_key, zone) of a theatre list; a key that names two zones names none."""
    keyed = theatre.select(name_key(F.col("name")).alias("place_key"), known_zone(F.col("timezone")).alias("zone")).where("place_key != ''")
    return keyed.groupBy("place_key").agg(F.min("zone").alias("zone"), F.max("zone").alias("other")).where("zone = other").drop("other")


def small(df: DataFrame, most: int) -> bool:
    """Whether ``df`` has at most ``most`` rows; reads no more than that."""
    return df.limit(most + 1).count() <= most


def feed_instants(screenings: DataFrame, venues: DataFrame, showtime: DataFrame, theatre: DataFrame) -> DataFrame:
    zones = venues.select(F.col("id").alias("_venue"), known_zone(F.col("timezone")).alias("_zone")).where("_venue is not null")
    zones = zones.groupBy("_venue").agg(F.min("_zone").alias("_zone"))
    feed = screenings.select("screening_id", "venueId", "startsAt", "verified_at").join(zones, F.col("venueId") == F.col("_venue"), "left")
    places = place_zones(theatre)
    if small(theatre, MAX_BROADCAST_PLACES):
        places = F.broadcast(places)
    shows = showtime.select("ingest_seq", "show_date", "show_time", name_key(F.col("theatre")).alias("place_key")).join(places, "place_key")
    shows = shows.where("show_time is not null").select(F.lit("show_time").alias("field_name"), F.col("ingest_seq").alias("row_id"), "show_time", "show_date", "zone")
    clock = stated(shows, "field_name", "row_id", clock_instant_us(F.col("show_time"), F.col("show_date"), F.col("zone")))
    return normalise_instants(feed, "screening_id", ["startsAt", "verified_at"], "_zone").unionByName(clock)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: table(spark, sf_dir, n) for n in ("screenings", "venues", "showtime", "theatre")}
    return feed_instants(t["screenings"], t["venues"], t["showtime"], t["theatre"])


# The same instants by another road: DuckDB's zones and text functions; its local times that occur twice are moved to the earlier instant.
P5_SQL = r"""
WITH zone_of AS (SELECT id, min(timezone) AS z FROM venues WHERE id IS NOT NULL GROUP BY 1),
raw AS (
  SELECT 'startsAt' AS field_name, screening_id AS row_id, startsAt AS v, z, NULL::DATE AS day FROM screenings LEFT JOIN zone_of ON venueId = id
  UNION ALL SELECT 'verified_at', screening_id, verified_at, z, NULL FROM screenings LEFT JOIN zone_of ON venueId = id
  UNION ALL SELECT 'show_time', ingest_seq, show_time, t.timezone, show_date FROM showtime s
    JOIN theatre t ON lower(regexp_replace(s.theatre, '[^\p{L}\p{M}\p{N}]+', '', 'g')) = lower(regexp_replace(t.name, '[^\p{L}\p{M}\p{N}]+', '', 'g'))),
tidy AS (SELECT field_name, row_id, z, day, trim(regexp_replace(v, '[\s\x{00A0}\x{2000}-\x{200A}\x{202F}\x{3000}]+', ' ', 'g')) AS t FROM raw WHERE v IS NOT NULL),
zoned AS (SELECT *, regexp_extract(t, '(?i)[\d\]m] ?(Z|UTC|GMT|[PMCE][SD]?T|\[[A-Za-z_/]+\]|(?:[T ]?\d{1,2}:\d{2}(?::\d{2})?(?:\.\d+)?) ?[+-]\d{2}(?::?\d{2})?)$', 1) AS tail FROM tidy),
split AS (SELECT * EXCLUDE (tail), CASE WHEN regexp_matches(tail, '[+-]\d{2}(:?\d{2})?$') AND tail LIKE '%:%' THEN regexp_extract(tail, '([+-]\d{2}(?::?\d{2})?)$', 1) ELSE tail END AS zt FROM zoned),
body AS (SELECT *, trim(CASE WHEN zt = '' THEN t ELSE substring(t, 1, length(t) - length(zt)) END) AS b FROM split),
parts AS (SELECT *,
  CASE WHEN regexp_full_match(b, '\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}.*') THEN substring(b, 1, 10)
       WHEN regexp_full_match(b, '\d{8}T\d{6}') THEN substring(b, 1, 4) || '-' || substring(b, 5, 2) || '-' || substring(b, 7, 2)
       WHEN regexp_full_match(b, '\d{1,2}/\d{1,2}/\d{2,4} .*') THEN right('20' || regexp_extract(b, '^\d+/\d+/(\d+)', 1), 4) || '-' || lpad(regexp_extract(b, '^(\d+)/', 1), 2, '0') || '-' || lpad(regexp_extract(b, '^\d+/(\d+)', 1), 2, '0')
       WHEN regexp_full_match(b, '\d{2}\.\d{2}\.\d{4} .*') THEN substring(b, 7, 4) || '-' || substring(b, 4, 2) || '-' || substring(b, 1, 2)
       WHEN regexp_full_match(b, '[A-Z][a-z]{2}, \d{1,2} [A-Z][a-z]{2} \d{4} .*') THEN strftime(try_strptime(regexp_extract(b, ', (\d+ \w+ \d{4})', 1), '%d %b %Y'), '%Y-%m-%d')
       WHEN regexp_full_match(b, '[A-Z][a-z]+ \d{1,2}, \d{4} .*') THEN strftime(try_strptime(regexp_extract(b, '^(\w+ \d+, \d{4})', 1), '%B %d, %Y'), '%Y-%m-%d') END AS iso,
  CASE WHEN regexp_full_match(b, '\d{8}T\d{6}') THEN substring(b, 10, 2) || ':' || substring(b, 12, 2) || ':' || substring(b, 14, 2)
       WHEN regexp_full_match(b, '\d{4}') THEN substring(b, 1, 2) || ':' || substring(b, 3, 2)
       WHEN regexp_full_match(b, '(?i)\d{1,2} ?[:.h] ?\d{2}(:\d{2})?( ?[ap]\.?m\.?)?') THEN regexp_replace(b, '(?i)^(\d+) ?[:.h] ?(\d{2})', '\1:\2')
       ELSE regexp_extract(b, '(?i)[T ](\d{1,2}:\d{2}(?::\d{2})?(?:\.\d+)?(?: ?[ap]\.?m\.?)?)$', 1) END AS clock
  FROM body),
nums AS (SELECT *, try_cast(regexp_extract(clock, '^(\d+):', 1) AS INT) AS h, try_cast(regexp_extract(clock, ':(\d{2})', 1) AS INT) AS mi, coalesce(try_cast(nullif(regexp_extract(clock, ':\d{2}:(\d{2})', 1), '') AS INT), 0) AS s,
  coalesce(try_cast(nullif(rpad(regexp_extract(clock, '\.(\d+)', 1), 6, '0'), '000000') AS INT), 0) AS us, lower(regexp_extract(clock, '(?i)([ap])\.?m', 1)) AS half FROM parts),
clocks AS (SELECT *, CASE WHEN mi <= 59 AND s <= 59 AND (half = '' AND h <= 23 OR half <> '' AND h BETWEEN 1 AND 12)
    THEN ((CASE WHEN half = '' THEN h ELSE h % 12 + CASE WHEN half = 'p' THEN 12 ELSE 0 END END)::BIGINT * 3600 + mi * 60 + s) * 1000000 + us END AS c,
  CASE WHEN iso IS NOT NULL THEN try_cast(iso AS DATE) WHEN field_name = 'show_time' THEN day END AS d FROM nums),
loc AS (SELECT *, epoch_us(d::TIMESTAMP) + c AS l,
  CASE WHEN zt = '' OR upper(zt) IN ('PT', 'MT', 'CT', 'ET') THEN z WHEN zt LIKE '[%' THEN substring(zt, 2, length(zt) - 2) END AS region,
  CASE WHEN regexp_matches(zt, '^[+-]') THEN (CASE WHEN zt LIKE '-%' THEN -1 ELSE 1 END) * (substring(zt, 2, 2)::INT * 60 + coalesce(try_cast(nullif(substring(replace(zt, ':', ''), 4, 2), '') AS INT), 0))
       ELSE 60 * CASE upper(zt) WHEN 'Z' THEN 0 WHEN 'UTC' THEN 0 WHEN 'GMT' THEN 0 WHEN 'EST' THEN -5 WHEN 'EDT' THEN -4 WHEN 'CST' THEN -6 WHEN 'CDT' THEN -5 WHEN 'MST' THEN -7 WHEN 'MDT' THEN -6 WHEN 'PST' THEN -8 WHEN 'PDT' THEN -7 END END AS off FROM clocks),
fixed AS (SELECT *, l - off::BIGINT * 60000000 AS f, CASE WHEN region IS NOT NULL THEN timezone(region, make_timestamp(l)) END AS g FROM loc),
out AS (SELECT field_name, row_id, CASE
    WHEN regexp_full_match(t, '\d{10}') AND day IS NULL THEN t::BIGINT * 1000000 WHEN regexp_full_match(t, '\d{13}') AND day IS NULL THEN t::BIGINT * 1000
    WHEN region IS NOT NULL THEN CASE WHEN timezone(region, g - INTERVAL 1 HOUR) = make_timestamp(l) THEN epoch_us(g) - 3600000000 ELSE epoch_us(g) END
    WHEN iso IS NOT NULL THEN f
    ELSE f + date_diff('day', CAST(timezone(z, timezone('UTC', make_timestamp(f))) AS DATE), day)::BIGINT * 86400000000 END AS utc_us FROM fixed)
SELECT field_name, row_id, utc_us FROM out WHERE utc_us IS NOT NULL
"""
