"""Mixed timestamp notations to UTC instants, as Column expressions.

An ordered cascade of anchored patterns reads a text; the first pattern that
matches the whole value decides, and its parts are checked strictly (a
calendar date that exists, a clock time that exists). Local times get their
zone from the text or from a default zone column, under an explicit policy
for local times that occur twice or never. No Python runs per row.

Null, blank and word values give null. Ties do not arise: a value has one
result. Very long texts fail every anchored pattern and give null.
"""

from __future__ import annotations

import zoneinfo
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000

# Offsets in hours of zone abbreviations that fix summer or standard time.
FIXED_ZONES = {
    "Z": 0, "UTC": 0, "GMT": 0, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5,
    "MST": -7, "MDT": -6, "PST": -8, "PDT": -7, "AKST": -9, "AKDT": -8, "HST": -10,
}
# Abbreviations that leave summer time open; the default zone decides.
OPEN_ZONES = ["PT", "MT", "CT", "ET"]
# Month names.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

_WORD_ZONE = "|".join([*sorted(FIXED_ZONES, key=len, reverse=True), *OPEN_ZONES])
_ZONE = rf"(?: ?({_WORD_ZONE}|[+-]\d{{2}}(?::?\d{{2}})?|\[[A-Za-z_]+(?:/[A-Za-z_+\-0-9]+)*\]))?"
_FRAC = r"(?:[.,](\d{1,9})\d*)?"
_AMPM = r"(?: ?([ap])\.?m\.?)"
_MONTH = r"([a-z]{3})[a-z]*\.?"

# (pattern, order of parts): parts are year, month, day, hour, minute, second, fraction, a/p, zone; "" where absent.
# The order of this list is the order of the cascade.
DATED = [
    (rf"(\d{{4}})-(\d{{2}})-(\d{{2}})(?:t| )(\d{{2}}):(\d{{2}})(?::(\d{{2}}){_FRAC})?{_ZONE}", "$1|$2|$3|$4|$5|$6|$7||$8"),
    (rf"(\d{{4}})(\d{{2}})(\d{{2}})t(\d{{2}})(\d{{2}})(\d{{2}})?{_FRAC}{_ZONE}", "$1|$2|$3|$4|$5|$6|$7||$8"),
    (rf"(?:[a-z]{{3}},? )?(\d{{1,2}}) {_MONTH} (\d{{4}}) (\d{{2}}):(\d{{2}})(?::(\d{{2}}))?{_ZONE}", "$3|$2|$1|$4|$5|$6|||$7"),
    (rf"(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}|\d{{2}}),? (\d{{1,2}}):(\d{{2}})(?::(\d{{2}}))?{_AMPM}?{_ZONE}", "$3|$1|$2|$4|$5|$6||$7|$8"),
    (rf"(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}}|\d{{2}}),? (\d{{1,2}}):(\d{{2}})(?::(\d{{2}}))?{_AMPM}?{_ZONE}", "$3|$2|$1|$4|$5|$6||$7|$8"),
    (rf"{_MONTH} (\d{{1,2}}),? (\d{{4}}),?(?: at)? (\d{{1,2}}):(\d{{2}})(?::(\d{{2}}))?{_AMPM}?{_ZONE}", "$3|$1|$2|$4|$5|$6||$7|$8"),
]
CLOCKS = [
    (rf"(\d{{1,2}}) ?[:.h] ?(\d{{2}})(?::(\d{{2}}))?{_AMPM}?{_ZONE}", "|||$1|$2|$3||$4|$5"),
    (rf"(\d{{2}})(\d{{2}}){_ZONE}", "|||$1|$2||||$3"),
    (rf"(\d{{1,2}}){_AMPM}{_ZONE}", "|||$1|||||"),
]


def tidy(text: Column) -> Column:
    """Outer spaces off, inner runs of any kind of space to one."""
    return F.trim(F.regexp_replace(text, r"[\s\u00A0\u2000-\u200A\u202F\u3000]+", " "))


def _cascade(text: Column, patterns: list[tuple[str, str]]) -> Column:
    tried = [F.when(text.rlike(f"^(?i:{p})$"), F.split(F.regexp_replace(text, f"^(?i:{p})$", order), "\\|")) for p, order in patterns]
    return F.coalesce(*tried)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once.

    A part that is used many times would otherwise be copied into every use,
    and again into every filter that is pushed down, until the plan explodes.
    """
    return F.transform(F.array(value), body)[0]


def _int(text: Column) -> Column:
    return F.when(text == "", F.lit(0)).otherwise(text.try_cast("int"))


def _month(x: Column) -> Column:
    by_name = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(x, 1, 3))).cast("int")
    return F.when(x.rlike(r"^\d"), x.try_cast("int")).when(by_name > 0, by_name)


def _clock_us(p: Column) -> Column:
    """Microseconds since midnight of parts ``p``, null for a clock time that does not exist."""

    def body(v: Column) -> Column:
        h, m, s = v["h"], v["m"], v["s"]
        hour = F.when(p[7] == "", F.when(h <= 23, h)).when(h.between(1, 12), h % 12 + F.when(F.lower(p[7]) == "p", 12).otherwise(0))
        frac = F.rpad(F.substring(p[6], 1, 6), 6, "0").try_cast("bigint")
        return F.when((m <= 59) & (s <= 59), (hour.cast("bigint") * 3600 + m * 60 + s) * 1_000_000 + F.coalesce(frac, F.lit(0).cast("bigint")))

    return let(F.struct(_int(p[3]).alias("h"), _int(p[4]).alias("m"), _int(p[5]).alias("s")), body)


def _date_us(p: Column) -> Column:
    """Midnight of the date in parts ``p`` as microseconds on a zone-less line, null for no date."""
    year = F.when(F.length(p[0]) == 2, F.concat(F.lit("20"), p[0])).otherwise(p[0])
    iso = F.concat_ws("-", year, F.lpad(_month(p[1]).cast("string"), 2, "0"), F.lpad(p[2], 2, "0"))
    return F.unix_date(F.when(F.length(iso) == 10, iso).try_cast("date")).cast("bigint") * DAY_US


def offset_us(at_us: Column, zone: Column) -> Column:
    """Offset from UTC, in microseconds, of ``zone`` at the instant ``at_us``."""
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(at_us), zone)) - at_us


def local_to_utc(local_us: Column, zone: Column, ambiguous: str = "earlier", nonexistent: str = "shift_forward") -> Column:
    """The UTC instant, in microseconds, of a local time in ``zone``.

    ambiguous: ``earlier`` or ``later`` of the two instants, or ``null``.
    nonexistent: ``shift_forward`` keeps the offset that held before the gap
    (02:30 becomes 03:30), or ``null``.
    """
    if ambiguous not in ("earlier", "later", "null") or nonexistent not in ("shift_forward", "null"):
        raise ValueError("unknown policy")
    none = F.lit(None).cast("bigint")

    def changing(at: Column, before: Column, after: Column) -> Column:
        first, last = at - F.greatest(before, after), at - F.least(before, after)
        is_first, is_last = first + offset_us(first, zone) == at, last + offset_us(last, zone) == at
        both = {"earlier": first, "later": last, "null": none}[ambiguous]
        neither = at - before if nonexistent == "shift_forward" else none
        return F.when(is_first & is_last, both).when(is_first, first).when(is_last, last).otherwise(neither)

    def body(at: Column) -> Column:
        offsets = F.struct(offset_us(at - DAY_US, zone).alias("before"), offset_us(at + DAY_US, zone).alias("after"))
        return let(offsets, lambda o: F.when(o["before"] == o["after"], at - o["before"]).otherwise(changing(at, o["before"], o["after"])))

    return F.when(zone.isNotNull(), let(local_us, body))


def _fixed_offset(zone: Column) -> Column:
    """Offset in microseconds that the zone text fixes by itself, else null."""
    up = F.upper(zone)
    hours_of = F.create_map(*[F.lit(x) for kv in FIXED_ZONES.items() for x in kv])
    digits = F.regexp_replace(zone, "[^0-9]", "")
    hours, minutes = F.substring(digits, 1, 2).try_cast("int"), F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
    numeric = F.when((hours <= 18) & (minutes <= 59), (hours * 3600 + minutes * 60) * F.when(zone.startswith("-"), -1).otherwise(1))
    return F.when(zone.rlike(r"^[+-]\d"), numeric).otherwise(F.try_element_at(hours_of, up) * 3600).cast("bigint") * 1_000_000


def known_zone(zone: Column) -> Column:
    """``zone`` if it is a zone of the public time-zone database, else null."""
    return F.when(zone.isin(sorted(zoneinfo.available_timezones())), zone)


def _is_local(zone_text: Column) -> Column:
    return (zone_text == "") | zone_text.startswith("[") | F.upper(zone_text).isin(OPEN_ZONES)


def instant_us(text: Column, default_zone: Column, ambiguous: str = "earlier", nonexistent: str = "shift_forward") -> Column:
    """UTC microseconds of a text with date and time, or an epoch; else null.

    ``default_zone`` must hold null or known zones (see known_zone).
    """

    def dated(p: Column) -> Column:
        local = _date_us(p) + _clock_us(p)
        region = F.when(p[8].startswith("["), known_zone(F.regexp_extract(p[8], r"^\[(.*)\]$", 1))).otherwise(default_zone)
        by_region = let(region, lambda z: local_to_utc(local, z, ambiguous, nonexistent))
        return F.when(_is_local(p[8]), by_region).otherwise(local - _fixed_offset(p[8]))

    def body(t: Column) -> Column:
        epoch = F.when(t.rlike(r"^\d{10}$"), t.try_cast("bigint") * 1_000_000).when(t.rlike(r"^\d{13}$"), t.try_cast("bigint") * 1000)
        return F.coalesce(epoch, let(_cascade(t, DATED), dated))

    return let(tidy(text), body)


def clock_instant_us(text: Column, local_date: Column, zone: Column, ambiguous: str = "earlier", nonexistent: str = "shift_forward") -> Column:
    """UTC microseconds of a clock time that belongs to ``local_date`` in ``zone``.

    A text that names its own date is read by instant_us. A clock time with a
    fixed offset gets the date that makes the local date at the place equal to
    ``local_date``.
    """
    midnight = F.unix_date(local_date).cast("bigint") * DAY_US

    def placed(us: Column) -> Column:
        local_midnight = F.floor((us + offset_us(us, zone)) / DAY_US) * DAY_US
        return us + (midnight - local_midnight)

    def clocked(p: Column) -> Column:
        local = midnight + _clock_us(p)
        return F.when(_is_local(p[8]), local_to_utc(local, zone, ambiguous, nonexistent)).otherwise(let(local - _fixed_offset(p[8]), placed))

    return F.coalesce(let(_cascade(tidy(text), CLOCKS), clocked), instant_us(text, zone, ambiguous, nonexistent))


def name_key(text: Column) -> Column:
    """Letters and digits in lower case: equal but for case, spaces and punctuation."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{M}\p{N}]+", ""))
