"""Scalar text functions (F1-F8, F14-F18, F34-F39) as Columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label rules in order; the first that matches names the label.
LABEL_RULES = [
    ("open caption", "Open Caption"), ("closed caption", "Closed Caption"), ("subtitled", "Subtitled"), ("laser", "Laser"), ("dolby", "Dolby"),
    ("imax", "IMAX"), ("prime", "Prime"), ("reald|3d", "3D"), ("no trailers", "No Trailers"),
]


def collapse(c: Column) -> Column:
    """any run of white space to one space, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"[ \t\n\r\u00a0\u202f]+", " "))


def literal_key(c: Column) -> Column:
    """lower case, & as and, letters and digits separated by single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), "&", " and "), r"[^a-z0-9]+", " "))


def match_key(c: Column) -> Column:
    """literal_key without articles."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.concat(F.lit(" "), literal_key(c), F.lit(" ")), r" (?:the|an|a) ", " "), " +", " "))


def identity_key(c: Column) -> Column:
    """literal_key of the title without a trailing bracketed year or kind."""
    return literal_key(F.regexp_replace(c, r"(?i)\s*\((?:[^()]*\b(?:film|movie)|\d{4})\)\s*$", ""))


def slug(c: Column, sep: str = "-") -> Column:
    """F8."""
    return F.btrim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", sep), F.lit(sep))


def place_variants(c: Column) -> Column:
    """the key of a place, without its leading chain word, without its screen count, without what follows 'at'."""
    key = literal_key(c)
    bare = F.regexp_replace(key, r"^\S+ ", "")
    less = F.regexp_replace(bare, r" \d+\b", "")
    short = F.regexp_replace(bare, r" at .*$", "")
    return F.array_distinct(F.filter(F.array(key, bare, less, short), lambda x: x != ""))


def format_label(c: Column) -> Column:
    """first matching rule, else the text."""
    low = F.lower(c)
    chain = reduce(lambda acc, r: acc.when(low.rlike(r[0]), F.lit(r[1])), LABEL_RULES[1:], F.when(low.rlike(LABEL_RULES[0][0]), F.lit(LABEL_RULES[0][1])))
    return chain.otherwise(c)


# Languages a title version may name, longer ones first.
LANGUAGES = ["mandarin chinese", "malayalam", "vietnamese", "assamese", "cantonese", "gujarati", "filipino", "japanese", "mandarin", "bengali", "chinese", "kannada", "marathi", "punjabi", "spanish", "tagalog", "korean", "telugu", "hindi", "tamil", "odia", "thai"]


def spoken_languages(c: Column) -> Column:
    """the distinct languages X of 'X Spoken with', in order of the alphabet."""
    found = F.regexp_extract_all(c, F.lit(r"(?i)\b([A-Za-z][A-Za-z '&-]{1,40}?)\s+Spoken\s+with\b"), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.lower(collapse(x)))))


def version_languages(c: Column) -> Column:
    """the languages of a bracket or dash suffix that is nothing but a language qualifier; a year may follow."""
    title = F.regexp_replace(collapse(c), r"\s*\(\d{4}\)\s*$", "")
    one = r"(?i)^\s*(?:in\s+|original\s+)?(" + "|".join(LANGUAGES) + r")(?:[\s-]+(?:language|version|dubbed|dub|subtitled))?(?:\s*(?:[,/]|with|w/?)\s*english\s*(?:subtitles?|subs|cc))?\s*$"
    suffixes = F.array(*[F.regexp_extract(title, rx, 1) for rx in (r"\(([^()]*)\)\s*$", r"\[([^\[\]]*)\]\s*$", r"\s+[-–—]\s+([^()\[\]]{1,80})\s*$")])
    return F.array_distinct(F.filter(F.transform(suffixes, lambda x: F.lower(F.regexp_extract(x, one, 1))), lambda x: x != ""))


def truncate(c: Column, most: int = 40) -> Column:
    """F16."""
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 3), F.lit("..."))).otherwise(c)


def clock_minutes(c: Column) -> Column:
    """minutes since midnight of a 12-hour clock text; 10^9 where there is none."""
    h, m = F.regexp_extract(c, r"(?i)^\s*(\d{1,2}):(\d{2})\s*([ap])m\s*$", 1).try_cast("int"), F.regexp_extract(c, r"(?i)^\s*(\d{1,2}):(\d{2})\s*([ap])m\s*$", 2).try_cast("int")
    p = F.lower(F.regexp_extract(c, r"(?i)^\s*(\d{1,2}):(\d{2})\s*([ap])m\s*$", 3))
    return F.coalesce(F.when(h.between(1, 12) & (m <= 59), h % 12 * 60 + m + F.when(p == "p", 720).otherwise(0)), F.lit(1_000_000_000))


def clock_key(minutes: Column) -> Column:
    """the canonical clock text of minutes since midnight."""
    hour = F.floor(minutes / 60)
    return F.concat(F.when(hour % 12 == 0, 12).otherwise(hour % 12).cast("string"), F.lit(":"), F.lpad((minutes % 60).cast("string"), 2, "0"), F.when(hour < 12, F.lit(" am")).otherwise(F.lit(" pm")))


def runtime_text(minutes: Column) -> Column:
    """97 -> 1h 37m."""
    return F.concat(F.floor(minutes / 60).cast("string"), F.lit("h "), (minutes % 60).cast("string"), F.lit("m"))


def runtime_minutes(c: Column) -> Column:
    """'1h 37m', '97 min' -> 97."""
    h, m = F.regexp_extract(c, r"(?i)(\d+)\s*h", 1).try_cast("int"), F.regexp_extract(c, r"(?i)(\d+)\s*m", 1).try_cast("int")
    return F.when(h.isNotNull() | m.isNotNull(), F.coalesce(h, F.lit(0)) * 60 + F.coalesce(m, F.lit(0)))


def score_pair(a: Column, b: Column) -> Column:
    """'a/b' with '-' for a missing side, null when both are missing."""
    return F.when(a.isNotNull() | b.isNotNull(), F.concat(F.coalesce(a.cast("string"), F.lit("-")), F.lit("/"), F.coalesce(b.cast("string"), F.lit("-"))))
