"""Scalar parsers of clock, date, runtime, score, link and picture texts (F18, F19, F35, F36, F38, F40, X13), as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brightreel.functions.text import collapse


def _int(c: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit("")).try_cast("int")


def last_clock(c: Column) -> Column:
    """minutes of the last 12-hour time in a text, else of the last 24-hour time; null without one."""
    t = F.regexp_replace(c, "[  ]", " ")
    twelve = F.get(F.reverse(F.regexp_extract_all(t, F.lit(r"(?i)(\d{1,2}(?::\d{2})?\s*(?:am|pm)\b)"), F.lit(1))), F.lit(0))
    full = F.get(F.reverse(F.regexp_extract_all(t, F.lit(r"\b((?:[01]?\d|2[0-3]):[0-5]\d)\b"), F.lit(1))), F.lit(0))
    hour = _int(twelve, r"^(\d{1,2})")
    first = F.when(hour == 12, 0).otherwise(hour) * 60 + F.coalesce(_int(twelve, r":(\d{2})"), F.lit(0)) + F.when(twelve.rlike(r"(?i)pm$"), 720).otherwise(0)
    return F.coalesce(first, _int(full, r"^(\d{1,2})") * 60 + _int(full, r":(\d{2})$"))


def clock_label(minutes: Column) -> Column:
    """minutes, also beyond a day, as '7:05 PM'."""
    m = F.pmod(minutes, F.lit(1440))
    h = F.floor(m / 60)
    return F.concat(F.when(h % 12 == 0, 12).otherwise(h % 12).cast("string"), F.lit(":"), F.lpad((m % 60).cast("string"), 2, "0"), F.when(h >= 12, F.lit(" PM")).otherwise(F.lit(" AM")))


def date_key(c: Column, this_year: int) -> Column:
    """the first ISO date in a text, else the first m/d with or without a year of two or four digits."""
    iso = F.nullif(F.regexp_extract(c, r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))
    rx = r"(\d{1,2})/(\d{1,2})(?:/(\d{2,4}))?"
    y = _int(c, rx, 3)
    year = F.when(y < 100, y + 2000).otherwise(F.coalesce(y, F.lit(this_year)))
    pad = lambda g: F.lpad(F.regexp_extract(c, rx, g), 2, "0")
    return F.coalesce(iso, F.when(c.rlike(rx), F.concat_ws("-", year.cast("string"), pad(1), pad(2))))


def runtime_loose(c: Column) -> Column:
    """F35, of a cell: hours and minutes, h:mm, minutes, else the first number."""
    t = F.lower(F.trim(c))
    h, m = _int(t, r"(\d+)\s*h"), _int(t, r"(\d+)\s*m")
    return F.coalesce(h * 60 + F.coalesce(m, F.lit(0)), _int(t, r"(\d+)\s*:\s*\d{2}") * 60 + _int(t, r"\d+\s*:\s*(\d{2})"), _int(t, r"(\d{2,3})\s*(?:min|mins|minute|minutes)\b"), _int(t, r"(\d+)"))


def runtime_of_row(cells: Column) -> Column:
    """F35, of a row: the first cell with hours and minutes, else the first with minutes."""
    pick = lambda test: F.get(F.filter(cells, test), F.lit(0))
    both = pick(lambda x: x.rlike(r"(?i)\b\d+\s*h\b") & x.rlike(r"(?i)\b\d+\s*m\b"))
    return F.coalesce(runtime_loose(both), runtime_loose(pick(lambda x: x.rlike(r"(?i)\b\d{2,3}\s*(?:min|mins|minute|minutes)\b"))))


def runtime_strict(c: Column) -> Column:
    """F35, of prose: hours at a word's beginning with their minutes, else two or three digits of minutes."""
    t = F.lower(collapse(c))
    return F.coalesce(_int(t, r"\b(\d+)\s*h") * 60 + F.coalesce(_int(t, r"\b(\d+)\s*m"), F.lit(0)), _int(t, r"\b(\d{2,3})\s*(?:min|mins|minute|minutes)\b"))


def runtime_gated(c: Column) -> Column:
    """F35, of a number: minutes from 30 to 400, else none."""
    return F.when(c.between(30, 400), c)


# Words for no score.
NO_SCORE = ["none", "nan", "null", "n/a"]


def score_text(c: Column) -> Column:
    """the first number of a text, whole or with one decimal; a text without number as it is, words for none empty."""
    t = F.trim(F.coalesce(c, F.lit("")))
    number = F.nullif(F.regexp_extract(t, r"-?\d+(?:\.\d+)?", 0), F.lit("")).try_cast("double")
    text = F.when(F.abs(number - F.round(number)) < 1e-9, F.round(number).cast("bigint").cast("string")).otherwise(F.regexp_replace(F.bround(number, 1).cast("string"), r"\.0$", ""))
    return F.when(F.lower(t).isin(*NO_SCORE), "").otherwise(F.coalesce(text, t))


def query_url(base: str, parameters: dict[str, Column]) -> Column:
    """a link with encoded parameters, blanks as plus; parameters without value are left out."""
    pairs = F.array_compact(F.array(*[F.concat(F.lit(f"{k}="), F.url_encode(v)) for k, v in parameters.items()]))
    return F.concat(F.lit(base + "?"), F.array_join(pairs, "&"))


def path_encoded(c: Column) -> Column:
    """a text as part of a link's path, blanks as %20."""
    return F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))


def widest_picture(srcset: Column) -> Column:
    """The link of the greatest width of a srcset, the first of equal ones; only http links count."""
    pieces = F.transform(F.split(srcset, ","), lambda p: F.trim(p))
    each = F.transform(pieces, lambda p, i: F.struct(F.coalesce(_int(p, r"^\S+\s+(\d+)w$"), F.lit(0)).alias("w"), (-i).alias("i"), F.regexp_extract(p, r"^(\S+)", 1).alias("url")))
    return F.array_max(F.filter(each, lambda x: x["url"].rlike("^https?://")))["url"]


def local_dates(c: Column, zone: str) -> Column:
    """the distinct local dates, in order, of all UTC times that stand in a text."""
    times = F.regexp_extract_all(c, F.lit(r"(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2})?)(?:\.\d+)?Z"), F.lit(1))
    local = F.transform(times, lambda x: F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), x.try_cast("timestamp_ntz"))))
    return F.array_sort(F.array_distinct(F.array_compact(local)))
