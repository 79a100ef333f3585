"""Queries of titles as announced: F9-F13."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightreel.functions import naming
from brightreel.functions.text import collapse
from brightreel.plans.base import query

REFERENCE_YEAR = 2026
BARE = r"\s*\(" + naming.YEAR + r"\)\s*$"


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _clean(c: str) -> str:
    return f"trim(regexp_replace({c}, '[ \\t\\n\\r  ]+', ' ', 'g'), ' ')"


_LEFT = ", ".join(_clean(f"trim(regexp_replace(s, {_sql(p)}, ''{flag}), {_sql(naming.EDGE)})") for p, flag in [(naming.CODE, ""), *[(p, ", 'i'") for p in naming.SUFFIXES]])
#: (d, s): distinct display titles with the canonical one.
PEELED = f"""RECURSIVE peel(d, s, n) AS (SELECT DISTINCT {_clean('display_title')}, {_clean('display_title')}, 0 FROM movie_context WHERE display_title IS NOT NULL
 UNION ALL SELECT d, new, n + 1 FROM (SELECT d, s, n, list_filter([{_LEFT}], lambda x: x <> '' AND x <> s)[1] AS new FROM peel) WHERE new IS NOT NULL AND n < {naming.PASSES}),
c AS (SELECT d, arg_max(s, n) AS canonical FROM peel GROUP BY 1)"""


def _year(c: str, p: str) -> str:
    return f"try_cast(nullif(regexp_extract({c}, {_sql(p)}, 1, 'i'), '') AS INT)"


_YEARS = f"""y AS (SELECT d, canonical, {_year('d', naming.ANNIVERSARY)} AS anniversary_years, coalesce({', '.join(_year('d', p) for p in naming.EVENT_YEARS)}) AS event_year, {_year('d', naming.EXPLICIT)} AS explicit_year FROM c),
z AS (SELECT *, CASE WHEN coalesce(event_year, {REFERENCE_YEAR}) - anniversary_years BETWEEN {naming.FIRST_YEAR} AND {REFERENCE_YEAR} THEN coalesce(event_year, {REFERENCE_YEAR}) - anniversary_years END AS inferred_release_year FROM y)"""


def _titles(t):
    d = t.movie_context.where("display_title is not null").select("context_id", collapse(F.col("display_title")).alias("d"))
    # Peeled once for each distinct title.
    own = d.select("d").distinct().select("d", naming.canonical_title(F.col("d")).alias("canonical"))
    return d, own.select("d", "canonical", *[c.alias(n) for n, c in naming.title_years(F.col("d"), REFERENCE_YEAR).items()])


@query(f"""WITH {PEELED}, {_YEARS} SELECT context_id, z.*, {_clean("regexp_replace(replace(replace(canonical, '&', ' and '), '*', ''), '[^\\p{L}\\p{M}\\p{N}_'']+', ' ', 'g')")} AS terms FROM movie_context JOIN z ON {_clean('display_title')} = d""")
def q_title_analysis(t):
    """Wording peeled to a fixpoint, the years in a title, search terms."""
    d, own = _titles(t)
    return d.join(own.withColumn("terms", naming.search_terms(F.col("canonical"))), "d")


def _spell(c: str) -> str:
    return f"""[{c}, replace({c}, '’', ''''), replace({c}, '''', '’'), CASE WHEN contains({c}, '&') THEN regexp_replace({c}, '\\s*&\\s*', ' and ', 'g') END, CASE WHEN regexp_matches({c}, '\\band\\b', 'i') THEN regexp_replace({c}, '\\band\\b', '&', 'gi') END, CASE WHEN contains({c}, '*') THEN replace({c}, '*', '') END]"""


def _bare(c: str) -> str:
    return f"trim(regexp_replace({c}, {_sql(BARE)}, ''), ' ')"


_BY, _OF = r"^(.+?)\s+by\s+([^:;!?]{3,80})$", r"^(.+?)[’'']s\s+(.+)$"
_EVENT = " OR ".join(f"regexp_matches(d, {_sql(p)}, 'i')" for p in (naming.ANNIVERSARY, *naming.EVENT_YEARS))
_VARIANTS = f"""p AS (SELECT *, CASE WHEN ({_EVENT}) AND len(regexp_extract_all(regexp_extract(canonical, '{_OF}', 1, 'i'), '[A-Za-z0-9]+')) >= 2 THEN {_clean(f"regexp_extract(canonical, '{_OF}', 2, 'i')")} END AS work,
 CASE WHEN len(regexp_extract_all(regexp_extract(canonical, '{_BY}', 2, 'i'), {_sql(naming.PERSON)})) BETWEEN 2 AND 5 AND NOT regexp_matches(regexp_extract(canonical, '{_BY}', 2, 'i'), {_sql(naming.NO_CREATOR)}, 'i') AND trim(regexp_extract(canonical, '{_BY}', 1, 'i'), {_sql(naming.EDGE)}) <> '' THEN trim(regexp_extract(canonical, '{_BY}', 1, 'i'), {_sql(naming.EDGE)}) END AS made, {_bare('canonical')} AS bare FROM z),
q AS (SELECT p.*, CASE WHEN bare <> '' AND lower(bare) <> lower(canonical) THEN bare END AS b, CASE WHEN d <> '' AND lower(d) <> lower(canonical) THEN d END AS e FROM p),
l AS (SELECT d, explicit_year, inferred_release_year, list_filter(list_concat({_spell('canonical')}, {_spell('work')}, {_spell('made')}, {_spell('b')}, {_spell('e')}), lambda x: x IS NOT NULL) AS v FROM q),
m AS (SELECT d, explicit_year, inferred_release_year, {_clean('v[i]')} AS variant, i FROM l, unnest(range(1, 31)) AS u(i) WHERE i <= len(v)),
v AS (SELECT d, any_value(explicit_year) AS explicit_year, any_value(inferred_release_year) AS inferred_release_year, arg_min(variant, i) AS variant, min(i) AS i FROM m WHERE variant <> '' GROUP BY d, lower(variant))"""


@query(f"""WITH {PEELED}, {_YEARS}, {_VARIANTS} SELECT d, CAST(row_number() OVER (PARTITION BY d ORDER BY i) - 1 AS INT) AS place, variant FROM v""")
def q_title_variants(t):
    """Titles under which a catalogue may have a film, most useful first; presenter and creator off."""
    _, own = _titles(t)
    return own.select("d", F.posexplode(naming.title_variants(F.col("d"), F.col("canonical"))).alias("place", "variant"))


_Y = REFERENCE_YEAR
_BASE = f"coalesce(nullif({_bare('variant')}, ''), variant)"


@query(f"""WITH {PEELED}, {_YEARS}, {_VARIANTS},
w AS (SELECT d, i, variant, b, [b || ' (' || explicit_year || ' film)', b || ' (' || inferred_release_year || ' film)', b || ' ({_Y} film)', b || ' ({_Y - 1} film)', b || ' ({_Y + 1} film)', b || ' (film)', variant, b] AS names FROM (SELECT *, {_BASE} AS b FROM v)),
x AS (SELECT d, i * 10 + k AS spot, {_clean('names[k]')} AS page FROM w, unnest(range(1, 9)) AS u(k) WHERE names[k] IS NOT NULL),
g AS (SELECT d, arg_min(page, spot) AS page, min(spot) AS spot FROM x WHERE page <> '' GROUP BY d, lower(page))
SELECT d, CAST(row_number() OVER (PARTITION BY d ORDER BY spot) - 1 AS INT) AS place, page FROM g""")
def q_page_titles(t):
    """names that a page of the film may have, in order."""
    _, own = _titles(t)
    pages = naming.page_titles(naming.title_variants(F.col("d"), F.col("canonical")), F.col("explicit_year"), F.col("inferred_release_year"), REFERENCE_YEAR)
    return own.select("d", F.posexplode(pages).alias("place", "page"))
