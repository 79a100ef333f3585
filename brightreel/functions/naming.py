"""Titles as announced: wording peeled to a fixpoint, years, variants, search terms (F9-F13), as Columns.

Everything stays in the JVM: a pass over a title is an array of what each
pattern would leave, of which the first that differs is taken; passes follow
each other in a fold, behind one test that most titles fail.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from brightreel.functions.text import collapse

PASSES = 12
EDGE = " -–—:"
_LEAD = r"\s*(?:[-–—:]\s*)?"
# The code of a programme, and wordings at the end of a title, in the order in which they are tried.
CODE = r"\s*\(([A-Z]{2,}\d{2,})\)\s*$"
SUFFIXES = [
    r"\s*[-–—:]\s*[A-Za-z0-9&'’.,+\- ]{1,80}\b(?:fest|festival|series|showcase)(?:\s+\d{4})?\s*$",
    _LEAD + r"sensory\s+friendly(?:\s+(?:screening|film))?\s*$",
    _LEAD + r"open\s+caption(?:ed)?(?:\s*\(on[- ]screen\s+subtitles\))?(?:\s+screening)?\s*$",
    _LEAD + r"early\s+access(?:\s+(?:screening|event))?(?:\s+with\s+.{1,80}?\s+q\s*&\s*a)?\s*$",
    _LEAD + r"(?:special\s+)?in[-\s]?person\s+q\s*&\s*a\s*$",
    _LEAD + r"q\s*&\s*a\s+with\s+.{1,160}$",
    _LEAD + r"q\s*&\s*a\s*$",
    _LEAD + r"sneak\s+peek\s*$",
    _LEAD + r"fan\s+event\s*$",
    _LEAD + r"opening\s+night\s*$",
    _LEAD + r"live\s+event\s*$",
    _LEAD + r"double\s+feature\s*$",
    _LEAD + r"re-?release\s*$",
    _LEAD + r"the\s+imax\s+experience\s*$",
    _LEAD + r"(?:\(\s*)?(?:\d{4}\s+(?:event|presentation|screening)|(?:event|presentation|screening)\s+\d{4})(?:\s*\))?\s*$",
    _LEAD + r"(?:the\s+)?sing[- ]along\s+version\s*$",
    _LEAD + r"remaster(?:ed)?\s*$",
    r"\s*[-–—:]\s*encore\s*$",
    r"\s*\(\s*\d{1,3}(?:st|nd|rd|th)\s+anniversary\s*\)\s*$",
    r"(?:\s*[-–—:]\s*|\s+)\d{1,3}(?:st|nd|rd|th)\s+anniversary\s*$",
]
# Where years stand in a title.
YEAR = r"(18(?:8[8-9]|9\d)|19\d{2}|20\d{2}|21\d{2})"
EXPLICIT = r"(?:^|\s|[-–—:])\(" + YEAR + r"\)\s*$"
ANNIVERSARY = r"\b(\d{1,3})(?:st|nd|rd|th)\s+anniversary\b"
EVENT_YEARS = [r"(?:fest|festival|series|showcase)\s+(\d{4})\b", r"(?:event|presentation|screening)\s+(\d{4})", r"(\d{4})\s+(?:event|presentation|screening)"]
FIRST_YEAR = 1888
# Words that show that "by ..." names no person.
NO_CREATOR = r"\d|[@#]|\b(?:edition|version|event|screening|tour|concert)\b"
PERSON = r"[A-Za-zÀ-ÖØ-öø-ÿ][A-Za-zÀ-ÖØ-öø-ÿ'’.-]*"


def canonical_title(c: Column) -> Column:
    """the title without wording at its end, one wording a pass until none is left; never empty."""
    patterns = [CODE, *[f"(?i){p}" for p in SUFFIXES]]
    any_of = F.concat(*[F.lit(x) for x in ("(?:" + "|".join(f"(?i:{p})" for p in SUFFIXES) + "|" + CODE + ")",)])
    left = lambda t: F.array(*[collapse(F.btrim(F.regexp_replace(t, p, ""), F.lit(EDGE))) for p in patterns])
    one = lambda t: F.coalesce(F.get(F.filter(left(t), lambda x: (x != "") & (x != t)), F.lit(0)), t)
    step = lambda t, _: F.when(F.regexp(t, any_of), one(t)).otherwise(t)
    return F.aggregate(F.sequence(F.lit(1), F.lit(PASSES)), collapse(c), step)


def _int(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).try_cast("int")


def title_years(c: Column, reference_year: int) -> dict[str, Column]:
    """anniversary, event year, explicit year, and the release year that follows from the first two."""
    t = collapse(c)
    event = F.coalesce(*[_int(t, f"(?i){p}") for p in EVENT_YEARS])
    anniversary = _int(t, f"(?i){ANNIVERSARY}")
    inferred = F.coalesce(event, F.lit(reference_year)) - anniversary
    return {"anniversary_years": anniversary, "event_year": event, "explicit_year": _int(t, EXPLICIT), "inferred_release_year": F.when(inferred.between(FIRST_YEAR, reference_year), inferred)}


def search_terms(canonical: Column) -> Column:
    """words and numbers of the canonical title, separated by single spaces."""
    return collapse(F.regexp_replace(F.replace(F.replace(canonical, F.lit("&"), F.lit(" and ")), F.lit("*"), F.lit("")), r"[^\p{L}\p{M}\p{N}_']+", " "))


def distinct_titles(values: Column) -> Column:
    """Collapsed, not empty, distinct without regard to case, the first spelling kept."""
    v = F.filter(F.transform(values, collapse), lambda x: x != "")
    both = F.struct(v.alias("v"), F.transform(v, F.lower).alias("k"))
    return F.transform(F.array(both), lambda b: F.filter(b["v"], lambda x, i: F.array_position(b["k"], F.lower(x)) == i + 1))[0]


def spellings(c: Column) -> Column:
    """the mechanical spellings of one title, itself first."""
    none = F.lit(None).cast("string")
    return F.array_compact(F.array(
        c, F.replace(c, F.lit("’"), F.lit("'")), F.replace(c, F.lit("'"), F.lit("’")),
        F.when(c.contains("&"), F.regexp_replace(c, r"\s*&\s*", " and ")).otherwise(none),
        F.when(c.rlike(r"(?i)\band\b"), F.regexp_replace(c, r"(?i)\band\b", "&")).otherwise(none),
        F.when(c.contains("*"), F.replace(c, F.lit("*"), F.lit(""))).otherwise(none),
    ))


def without_presenter(display: Column, canonical: Column) -> Column:
    """what follows the possessive of several words, where the display title tells of an event; else null."""
    prefix = F.regexp_extract(canonical, r"(?i)^(.+?)[’']s\s+(.+)$", 1)
    event = reduce(lambda a, b: a | b, [display.rlike(f"(?i){p}") for p in (ANNIVERSARY, *EVENT_YEARS)])
    words = F.size(F.regexp_extract_all(prefix, F.lit(r"[A-Za-z0-9]+"), F.lit(0)))
    return F.when(event & (words >= 2), collapse(F.regexp_extract(canonical, r"(?i)^(.+?)[’']s\s+(.+)$", 2)))


def without_creator(canonical: Column) -> Column:
    """what stands before "by" and a person of two to five words; else null."""
    rx = r"(?i)^(.+?)\s+by\s+([^:;!?]{3,80})$"
    creator, title = F.regexp_extract(canonical, rx, 2), F.btrim(F.regexp_extract(canonical, rx, 1), F.lit(EDGE))
    words = F.size(F.regexp_extract_all(creator, F.lit(PERSON), F.lit(0)))
    return F.when(words.between(2, 5) & ~creator.rlike(f"(?i){NO_CREATOR}") & (title != ""), title)


def title_variants(display: Column, canonical: Column) -> Column:
    """titles under which a catalogue may have it, the canonical one first."""
    bare = F.trim(F.regexp_replace(canonical, r"\s*\(" + YEAR + r"\)\s*$", ""))
    more = lambda c: F.when(c.isNotNull(), spellings(c)).otherwise(F.array().cast("array<string>"))
    unlike = lambda c: F.when((c != "") & (F.lower(c) != F.lower(canonical)), c)
    return distinct_titles(F.concat(spellings(canonical), more(without_presenter(display, canonical)), more(without_creator(canonical)), more(unlike(bare)), more(unlike(display))))


def page_titles(variants: Column, explicit: Column, inferred: Column, reference_year: int) -> Column:
    """names of pages for each variant: with years, with the kind, bare."""
    dated = lambda base, y: F.concat(base, F.lit(" ("), y.cast("string"), F.lit(" film)"))

    def of(name: Column) -> Column:
        base = F.trim(F.regexp_replace(name, r"\s*\(" + YEAR + r"\)\s*$", ""))
        base = F.when(base == "", name).otherwise(base)
        around = [dated(base, F.lit(y)) for y in (reference_year, reference_year - 1, reference_year + 1)]
        return F.array_compact(F.array(dated(base, explicit), dated(base, inferred), *around, F.concat(base, F.lit(" (film)")), name, base))

    return distinct_titles(F.flatten(F.transform(variants, of)))
