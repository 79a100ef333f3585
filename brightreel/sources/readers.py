"""Scans of captured files (S7, S9, S14-S18). Nothing here reaches a network."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASICS = "tconst string, titleType string, primaryTitle string, originalTitle string, isAdult string, startYear int, runtimeMinutes int"
RATINGS = "tconst string, averageRating double, numVotes int"
FEED = """region string, timezone string, data_as_of string, generated string,
 venues array<struct<id:string,name:string,short:string,website:string,platform:string,scenef_url:string>>,
 films array<struct<key:string,title:string,runtimeMin:int>>,
 screenings array<struct<venueId:string,filmKey:string,startsAt:string,nightOf:string,verified_at:string,confidence:string,source_tier:string,
  freshness:struct<status:string,source_status:string,retained:boolean>,provenance:struct<lastVerifiedAt:string,confidence:string>,tags:array<string>>>"""


def read_tsv(spark: SparkSession, path: str, schema: str, partitions: int | None = None) -> DataFrame:
    r"""Tab-separated files, also gzipped, with header; ``\N`` is null. A gzip file can't be
    split, so its rows are spread right after the scan when ``partitions`` is given."""
    df = spark.read.schema(schema).options(sep="\t", header=True, nullValue="\\N", quote="", mode="PERMISSIVE").csv(path)
    return df.repartition(partitions) if partitions else df


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Nested JSON documents; a document that is no JSON has its text in ``_corrupt``."""
    return spark.read.schema(FEED + ", _corrupt string").options(multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt").json(path)


def read_json_folder(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder of JSON files, corrupt ones left out."""
    return spark.read.schema(schema).options(multiLine=True, mode="DROPMALFORMED").json(path)


def read_markers(spark: SparkSession, path: str) -> DataFrame:
    """Lines 'theatre | date', split on the last separator; lines without a real date are left out."""
    line = spark.read.text(path).select(F.regexp_extract("value", r"^(.*) \| (\d{4}-\d{2}-\d{2})\s*$", 1).alias("theatre"), F.regexp_extract("value", r"^(.*) \| (\d{4}-\d{2}-\d{2})\s*$", 2).try_cast("date").alias("show_date"))
    return line.where("theatre != '' and show_date is not null")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per captured page."""
    return spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("url"), F.col("value").alias("html"))


def payload(pages: DataFrame, element_id: str, schema: str) -> DataFrame:
    """The JSON embedded in ``<script id=...>`` of each page, typed; pages without it give null."""
    raw = F.regexp_extract("html", rf'(?s)<script[^>]*id="{element_id}"[^>]*>(.*?)</script>', 1)
    return pages.select("url", F.from_json(raw, schema).alias("payload"))


def previous_report(pages: DataFrame, written_us: str, now_us: int, most_hours: int = 36) -> DataFrame:
    """Reports not more than an hour ahead and not older than ``most_hours``."""
    age = (F.lit(now_us) - F.col(written_us)) / 3_600_000_000
    return pages.where((age >= -1) & (age <= most_hours))
