"""Queries of merged records, parsers, predicates, claims, tags and plans."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from brightreel.functions import parsing
from brightreel.functions.text import collapse
from brightreel.operators import relational as R
from brightreel.plans.base import query

_LOW = "lower(trim({0}))"


@query(r"""WITH s AS (SELECT * REPLACE (nullif(trim(format_label), '') AS format_label), nullif(trim(showtime_id), '') AS sid, lower(trim(movie_title)) AS kt, lower(trim(theatre)) AS kp, lower(trim(show_time)) AS kc, coalesce(lower(trim(format_label)), '') AS kf FROM showtime WHERE trim(movie_title) <> '' AND trim(show_time) <> ''),
own AS (SELECT sid, arg_max(movie_title, (source_rank, ingest_seq)) AS movie_title, arg_max(theatre, (source_rank, ingest_seq)) AS theatre, arg_max(show_date, (source_rank, ingest_seq)) AS show_date, arg_max(show_time, (source_rank, ingest_seq)) AS show_time,
 arg_min(runtime_min, CASE WHEN runtime_min IS NOT NULL THEN ingest_seq END) AS runtime_min, bool_or(coalesce(a_list_excluded, false)) AS a_list_excluded FROM s WHERE sid IS NOT NULL GROUP BY 1),
slot AS (SELECT DISTINCT kt, kp, show_date, kc FROM s WHERE sid IS NOT NULL),
free AS (SELECT kt, kp, show_date, kc, kf, arg_min(movie_title, ingest_seq) AS movie_title, arg_min(theatre, ingest_seq) AS theatre, arg_min(show_time, ingest_seq) AS show_time, arg_min(format_label, ingest_seq) AS format_label,
 arg_min(runtime_min, CASE WHEN runtime_min IS NOT NULL THEN ingest_seq END) AS runtime_min, bool_or(coalesce(a_list_excluded, false)) AS a_list_excluded, min(ingest_seq) AS q FROM s WHERE sid IS NULL GROUP BY 1, 2, 3, 4, 5),
alone AS (SELECT f.* FROM free f LEFT JOIN slot USING (kt, kp, show_date, kc) WHERE slot.kt IS NULL)
SELECT sid AS showtime_id, movie_title, theatre, show_date, show_time, runtime_min, a_list_excluded, NULL AS format_label FROM own
UNION ALL SELECT NULL, movie_title, theatre, show_date, show_time, runtime_min, a_list_excluded, format_label FROM alone""")
def q_merge_two_keys(t):
    """A10 key 2: showings with an id merge by it, and stay apart from other ids at the same time; those without merge
    by title, theatre, date, time and format in lower case, unless a showing with an id has their slot."""
    low = lambda c: F.lower(F.trim(c))
    s = t.showtime.where("trim(movie_title) != '' and trim(show_time) != ''").withColumn("sid", F.nullif(F.trim("showtime_id"), F.lit(""))).withColumn("format_label", F.nullif(F.trim("format_label"), F.lit("")))
    s = s.select("*", low("movie_title").alias("kt"), low("theatre").alias("kp"), low("show_time").alias("kc"), F.coalesce(low("format_label"), F.lit("")).alias("kf"))
    best = lambda c: F.max_by(c, F.struct("source_rank", "ingest_seq")).alias(c)
    first = lambda c: F.min_by(c, "ingest_seq").alias(c)
    facts = [R.first_known("runtime_min", "ingest_seq").alias("runtime_min"), F.bool_or(F.coalesce("a_list_excluded", F.lit(False))).alias("a_list_excluded")]
    own = s.where("sid is not null").groupBy("sid").agg(*[best(c) for c in ("movie_title", "theatre", "show_date", "show_time")], *facts)
    slot = ["kt", "kp", "show_date", "kc"]
    taken = s.where("sid is not null").select(*slot).distinct()
    free = s.where("sid is null").groupBy(*slot, "kf").agg(*[first(c) for c in ("movie_title", "theatre", "show_time", "format_label")], *facts).join(taken, slot, "left_anti")
    out = ["showtime_id", "movie_title", "theatre", "show_date", "show_time", "runtime_min", "a_list_excluded", "format_label"]
    return own.withColumn("showtime_id", F.col("sid")).withColumn("format_label", F.lit(None).cast("string")).select(*out).unionByName(free.withColumn("showtime_id", F.lit(None).cast("string")).select(*out))


@query(r"""WITH c AS (SELECT ingest_seq, regexp_replace(show_time, '[\x{00A0}\x{202F}]', ' ', 'g') AS s FROM showtime),
m AS (SELECT ingest_seq, list_last(regexp_extract_all(s, '(\d{1,2}(?::\d{2})?\s*(?:am|pm)\b)', 1, 'i')) AS a, list_last(regexp_extract_all(s, '\b((?:[01]?\d|2[0-3]):[0-5]\d)\b', 1)) AS b FROM c),
k AS (SELECT ingest_seq, coalesce(CAST(regexp_extract(a, '^(\d{1,2})', 1) AS INT) % CASE WHEN regexp_extract(a, '^(\d{1,2})', 1) = '12' THEN 12 ELSE 1000 END * 60 + coalesce(try_cast(nullif(regexp_extract(a, ':(\d{2})', 1), '') AS INT), 0) + CASE WHEN lower(a) LIKE '%pm' THEN 720 ELSE 0 END,
 CAST(regexp_extract(b, '^(\d{1,2})', 1) AS INT) * 60 + CAST(regexp_extract(b, ':(\d{2})$', 1) AS INT)) AS minutes FROM m)
SELECT ingest_seq, minutes, CASE WHEN minutes % 1440 // 60 % 12 = 0 THEN '12' ELSE CAST(minutes % 1440 // 60 % 12 AS VARCHAR) END || ':' || lpad(CAST(minutes % 60 AS VARCHAR), 2, '0') || CASE WHEN minutes % 1440 // 60 >= 12 THEN ' PM' ELSE ' AM' END AS label FROM k""")
def q_clock_last(t):
    """the last time of a text in either notation, and its label."""
    k = t.showtime.select("ingest_seq", parsing.last_clock(F.col("show_time")).alias("minutes"))
    return k.withColumn("label", parsing.clock_label(F.col("minutes")))


@query(r"""SELECT screening_id, coalesce(nullif(regexp_extract(s, '(\d{4}-\d{2}-\d{2})', 1), ''), CASE WHEN regexp_matches(s, '\d{1,2}/\d{1,2}') THEN
CASE WHEN regexp_extract(s, rx, 3) = '' THEN '2026' WHEN CAST(regexp_extract(s, rx, 3) AS INT) < 100 THEN CAST(2000 + CAST(regexp_extract(s, rx, 3) AS INT) AS VARCHAR) ELSE CAST(CAST(regexp_extract(s, rx, 3) AS INT) AS VARCHAR) END || '-' || lpad(regexp_extract(s, rx, 1), 2, '0') || '-' || lpad(regexp_extract(s, rx, 2), 2, '0') END) AS date_key
FROM (SELECT screening_id, startsAt AS s, '(\d{1,2})/(\d{1,2})(?:/(\d{2,4}))?' AS rx FROM screenings)""".replace(", rx,", r", '(\d{1,2})/(\d{1,2})(?:/(\d{2,4}))?',"))
def q_date_key(t):
    """ISO dates, and month/day with or without year."""
    return t.screenings.select("screening_id", parsing.date_key(F.col("startsAt"), 2026).alias("date_key"))


_FORMS = ["' ' || h || 'h ' || m || 'm'", "h || ':' || lpad(m, 2, '0')", "r || ' minutes'", "'about ' || r || ', 2h'", "r"]


@query(r"""WITH f AS (SELECT film_id, runtimeMin AS r, CAST(runtimeMin // 60 AS VARCHAR) AS h, CAST(runtimeMin % 60 AS VARCHAR) AS m FROM films),
c AS (SELECT film_id, r, CASE film_id % 5 """ + " ".join(f"WHEN {i} THEN CAST({f} AS VARCHAR)" for i, f in enumerate(_FORMS)) + r""" END AS s FROM f),
x AS (SELECT *, try_cast(nullif(regexp_extract(lower(s), '(\d+)\s*h', 1), '') AS INT) AS ah, try_cast(nullif(regexp_extract(lower(s), '(\d+)\s*m', 1), '') AS INT) AS am, try_cast(nullif(regexp_extract(s, '(\d+)\s*:\s*\d{2}', 1), '') AS INT) AS ch, try_cast(nullif(regexp_extract(s, '\d+\s*:\s*(\d{2})', 1), '') AS INT) AS cm,
 try_cast(nullif(regexp_extract(lower(s), '(\d{2,3})\s*(?:min|mins|minute|minutes)\b', 1), '') AS INT) AS mm, try_cast(nullif(regexp_extract(s, '(\d+)', 1), '') AS INT) AS any1 FROM c)
SELECT film_id, coalesce(ah * 60 + coalesce(am, 0), ch * 60 + cm, mm, any1) AS loose, coalesce(CASE WHEN regexp_matches(s, '\b\d+\s*h\b', 'i') AND regexp_matches(s, '\b\d+\s*m\b', 'i') THEN ah * 60 + coalesce(am, 0) END, mm) AS of_row,
coalesce(ah * 60 + coalesce(am, 0), mm) AS strict, CASE WHEN r BETWEEN 30 AND 400 THEN r END AS gated FROM x""")
def q_runtime_orders(t):
    """the four orders of rules for a runtime, over five notations."""
    f = t.films.select("film_id", F.col("runtimeMin").alias("r"), F.floor(F.col("runtimeMin") / 60).cast("string").alias("h"), (F.col("runtimeMin") % 60).cast("string").alias("m"))
    forms = [F.format_string(" %sh %sm", "h", "m"), F.concat("h", F.lit(":"), F.lpad("m", 2, "0")), F.concat("r", F.lit(" minutes")), F.concat(F.lit("about "), "r", F.lit(", 2h")), F.col("r").cast("string")]
    text = F.when(F.col("r").isNotNull(), F.element_at(F.array(*forms), (F.col("film_id") % 5 + 1).cast("int")))
    c = f.select("film_id", "r", text.alias("s"))
    s = F.col("s")
    return c.select("film_id", parsing.runtime_loose(s).alias("loose"), parsing.runtime_of_row(F.array(F.lit("no runtime"), s)).alias("of_row"), parsing.runtime_strict(s).alias("strict"), parsing.runtime_gated(F.col("r")).alias("gated"))


@query(r"""SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN 'unrated' ELSE CASE WHEN abs(v - round(v)) < 1e-9 THEN CAST(CAST(round(v) AS BIGINT) AS VARCHAR) ELSE regexp_replace(printf('%.1f', v), '\.0$', '') END END AS score FROM (SELECT *, l_quantity + CASE WHEN l_linenumber % 2 = 0 THEN 0.25 ELSE 0 END AS v FROM lineitem)""")
def q_score_text(t):
    """whole scores without, others with one decimal; words for none are empty."""
    v = F.col("l_quantity") + F.when(F.col("l_linenumber") % 2 == 0, 0.25).otherwise(0.0)
    text = F.when(F.col("l_linenumber") == 1, " N/A ").when(F.col("l_linenumber") == 2, "unrated").otherwise(F.concat(v.cast("string"), F.lit(" of 60")))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", parsing.score_text(text).alias("score"))


@query("""SELECT page_id, CASE WHEN poster_url IS NOT NULL THEN poster_url || '?w=' || CASE WHEN page_id % 3 = 0 THEN 900 ELSE 600 + page_id % 300 END END AS widest FROM rt_page""")
def q_srcset(t):
    """The widest picture of a set of candidates."""
    u, w = F.col("poster_url"), F.when(F.col("page_id") % 3 == 0, 900).otherwise(600 + F.col("page_id") % 300)
    srcset = F.concat(u, F.lit("?w=300 300w, data:image/gif 2000w,"), u, F.lit("?w="), w, F.lit(" "), w, F.lit("w ,,"), u, F.lit("?plain"))
    return t.rt_page.select("page_id", parsing.widest_picture(srcset).alias("widest"))


@query("""SELECT page_id, 'https://video.example/results?search_query=' || replace(url_encode(title || ' official trailer'), '%20', '+') || CASE WHEN release_year IS NOT NULL THEN '&year=' || release_year ELSE '' END AS link, url_encode(title) AS path FROM letterboxd_page WHERE regexp_full_match(title, '[A-Za-z0-9 &,:''é]+')""")
def q_url_build(t):
    """links with encoded parameters, those without value left out; path parts."""
    p = t.letterboxd_page.where(F.col("title").rlike("^[A-Za-z0-9 &,:'é]+$"))
    link = parsing.query_url("https://video.example/results", {"search_query": F.concat("title", F.lit(" official trailer")), "year": F.col("release_year").cast("string")})
    return p.select("page_id", link.alias("link"), parsing.path_encoded(F.col("title")).alias("path"))


@query("""WITH d AS (SELECT user_id, CAST(timezone('America/Los_Angeles', timezone('UTC', ts)) AS DATE) AS day FROM events WHERE event_type <> 'error'), g AS (SELECT user_id, list_sort(list_distinct(list(day))) AS days FROM d GROUP BY 1)
SELECT u.user_id, coalesce(len(days), 0) AS n_days, days[1] AS first_day, coalesce(list_contains(days, DATE '2024-01-05'), user_id % 2 = 0) AS wanted FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN g USING (user_id)""")
def q_observed_dates(t):
    """The local dates of all UTC times in a page; whether the wanted date is among them, else what the address says."""
    times = F.when(F.col("event_type") != "error", F.concat(F.lit('{"start":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('Z"}')))
    pages = t.events.groupBy("user_id").agg(F.array_join(F.collect_list(times), ",").alias("page"))
    days = pages.select("user_id", parsing.local_dates(F.col("page"), "America/Los_Angeles").alias("days"))
    wanted = F.when(F.size("days") > 0, F.array_contains("days", F.lit("2024-01-05").cast("date"))).otherwise(F.col("user_id") % 2 == 0)
    return days.select("user_id", F.size("days").cast("bigint").alias("n_days"), F.get("days", F.lit(0)).alias("first_day"), wanted.alias("wanted"))


# Wording of events whose runtime is not the film's; pictures that stand for none; words of film items.
RELAXED = r"\b(?:q\s*&\s*a|double\s+feature|marathon|live\s+event|cast\s+member|filmmaker|world\s+tour|concert(?:\s+film)?|cheering\s+party)\b"
NO_PICTURE = "placeholder|default|missing"
FILM_WORDS = ["film", "movie", "documentary", "motion picture", "concert film"]


@query(rf"""WITH c AS (SELECT *, len(regexp_extract_all(canonical_title, '[\p{{L}}\p{{M}}\p{{N}}_]+')) AS n FROM movie_context),
p AS (SELECT title, min(page_id) AS page_id, arg_min(release_year, page_id) AS release_year, arg_min(runtime_min, page_id) AS page_runtime, arg_min(poster_url, page_id) AS poster_url FROM rt_page GROUP BY 1)
SELECT context_id, regexp_matches(display_title, '{RELAXED}', 'i') AS relaxed, len(coalesce(spoken_languages, [])) = 0 AND n BETWEEN 1 AND 2 AS english_tiebreak,
coalesce(regexp_matches(lower(poster_url), '{NO_PICTURE}'), true) OR expected_year IS NOT NULL OR len(coalesce(spoken_languages, [])) > 0 OR n <= 2 AS revalidate,
page_id IS NOT NULL AND NOT coalesce(abs(release_year - expected_year) > 3, false) AND NOT coalesce(NOT relax_runtime AND abs(page_runtime - runtime_min) > 20, false) AS accepted FROM c LEFT JOIN p ON canonical_title = title WHERE canonical_title IS NOT NULL AND display_title IS NOT NULL""")
def q_match_rules(t):
    """Wording that relaxes the runtime, the language tie-break, what must be validated again, accepted pages; what is missing never rejects."""
    c = t.movie_context.where("canonical_title is not null and display_title is not null").withColumn("n", F.size(F.regexp_extract_all("canonical_title", F.lit(r"[\p{L}\p{M}\p{N}_]+"), F.lit(0))))
    first = lambda col, name: F.min_by(col, "page_id").alias(name)
    p = t.rt_page.groupBy(F.col("title").alias("canonical_title")).agg(F.min("page_id").alias("page_id"), first("release_year", "release_year"), first("runtime_min", "page_runtime"), first("poster_url", "poster_url"))
    silent = F.size(F.coalesce("spoken_languages", F.array().cast("array<string>"))) == 0
    never = lambda x: ~F.coalesce(x, F.lit(False))
    return c.join(p, "canonical_title", "left").select(
        "context_id", F.col("display_title").rlike(f"(?i){RELAXED}").alias("relaxed"), (silent & F.col("n").between(1, 2)).alias("english_tiebreak"),
        (F.coalesce(F.lower("poster_url").rlike(NO_PICTURE), F.lit(True)) | F.col("expected_year").isNotNull() | ~silent | (F.col("n") <= 2)).alias("revalidate"),
        (F.col("page_id").isNotNull() & never(F.abs(F.col("release_year") - F.col("expected_year")) > 3) & never(~F.col("relax_runtime") & (F.abs(F.col("page_runtime") - F.col("runtime_min")) > 20))).alias("accepted"),
    )


# --- claims ----------------------------------------------------------------


def _entities(t):
    """Entities as a claims text: an id in capitals, the page of another provider, a kind."""
    p = t.letterboxd_page.where("imdb_id is not null")
    kind = F.when(F.col("page_id") % 4 == 0, "Q5").otherwise("Q11424")
    claims = F.format_string('{"claims": {"P345": [{"mainsnak": {"datavalue": {"value": "%s"}}}], "P1258": [{"mainsnak": {"datavalue": {"value": "m/%s"}}}], "P31": [{"mainsnak": {"datavalue": {"value": {"id": "%s"}}}}]}}', F.upper("imdb_id"), F.col("page_id").cast("string"), kind)
    return p.select(F.col("page_id").alias("entity_id"), claims.alias("entity"), F.when(F.col("page_id") % 8 == 0, "2019 Concert Film").otherwise("thing").alias("description"))


@query("""WITH e AS (SELECT *, page_id % 4 <> 0 OR page_id % 8 = 0 AS film FROM letterboxd_page WHERE imdb_id IS NOT NULL)
SELECT e.page_id AS asked, e.page_id AS entity_id, film, CASE WHEN film AND r.page_id IS NOT NULL AND NOT coalesce(abs(r.release_year - e.release_year) > 3, false) THEN r.page_id END AS bridged FROM e LEFT JOIN rt_page r ON r.page_id = e.page_id""")
def q_claims_bridge(t):
    """An id leads to the entity that holds it to the letter, the entity to the id of another provider, that to a page, which must agree."""
    from brightreel.sources.extract import claim_values

    e = _entities(t)
    # Claims become rows of (entity, property, value); ids meet without regard to case.
    values = claim_values(e, "entity_id", "entity")
    of = lambda p, name: values.where(F.col("property") == p).select("entity_id", F.col("value").alias(name))
    kinds = of("P31", "kind").groupBy("entity_id").agg(F.bool_or(F.get_json_object("kind", "$.id") == "Q11424").alias("by_class"))
    films = e.join(kinds, "entity_id", "left").select("entity_id", (F.coalesce("by_class", F.lit(False)) | F.lower("description").rlike("|".join(FILM_WORDS))).alias("film"))
    asked = t.letterboxd_page.where("imdb_id is not null").select(F.col("page_id").alias("asked"), F.lower("imdb_id").alias("id"), F.col("release_year").alias("year"))
    first = asked.join(of("P345", "held").select("entity_id", F.lower("held").alias("id")), "id").join(films, "entity_id").join(of("P1258", "slug"), "entity_id", "left")
    pages = t.rt_page.select(F.col("page_id").alias("bridged"), F.concat(F.lit("m/"), F.col("page_id").cast("string")).alias("slug"), "release_year")
    agrees = F.col("film") & ~F.coalesce(F.abs(F.col("release_year") - F.col("year")) > 3, F.lit(False))
    return first.join(pages, "slug", "left").select("asked", "entity_id", "film", F.when(agrees, F.col("bridged")).alias("bridged"))


@query("""WITH prior AS (SELECT l_orderkey, l_linenumber, l_partkey AS k, CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS a, CASE WHEN l_returnflag <> 'A' THEN l_linenumber END AS b, CAST(l_quantity AS INT) AS runtime, CASE WHEN l_tax < 0.03 THEN 'x' WHEN l_tax < 0.06 THEN 'x|y' ELSE 'y' END AS evidence FROM lineitem),
cur AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 3 <> 0 THEN p_partkey % 100 END AS a, CASE WHEN p_partkey % 5 <> 0 THEN p_partkey % 7 + 1 END AS b, p_size AS runtime FROM part WHERE p_partkey % 3 <> 0 OR p_partkey % 5 <> 0),
m AS (SELECT k, count(*) AS n, count(DISTINCT evidence) AS kinds, min(evidence) AS evidence FROM cur JOIN prior USING (k) WHERE NOT coalesce(cur.a <> prior.a, false) AND NOT coalesce(cur.b <> prior.b, false) AND (coalesce(cur.a = prior.a, false) OR coalesce(cur.b = prior.b, false)) AND NOT coalesce(abs(cur.runtime - prior.runtime) > 15, false) GROUP BY 1)
SELECT k, coalesce(n, 0) AS matches, CASE WHEN kinds = 1 THEN evidence || ' (retained)' END AS kept FROM cur LEFT JOIN m USING (k)""")
def q_continuity_evidence(t):
    """Earlier records with an equal id of one provider and no unequal one of another; their evidence is kept, with a note added once, if all agree."""
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    prior = t.lineitem.select(F.col("l_partkey").alias("k"), F.when(flag != "R", F.col("l_suppkey")).alias("pa"), F.when(flag != "A", line).alias("pb"), F.col("l_quantity").cast("int").alias("p_runtime"), F.when(F.col("l_tax") < 0.03, "x").when(F.col("l_tax") < 0.06, "x|y").otherwise("y").alias("evidence"))
    # Equal earlier records say the same; each is compared once.
    prior = prior.groupBy("k", "pa", "pb", "p_runtime", "evidence").agg(F.count(F.lit(1)).alias("n"))
    k = F.col("p_partkey")
    cur = t.part.where("p_partkey % 3 <> 0 or p_partkey % 5 <> 0").select(k.alias("k"), F.when(k % 3 != 0, k % 100).alias("a"), F.when(k % 5 != 0, k % 7 + 1).alias("b"), F.col("p_size").alias("runtime"))
    yes, no = lambda c: F.coalesce(c, F.lit(False)), lambda c: ~F.coalesce(c, F.lit(False))
    fit = no(F.col("a") != F.col("pa")) & no(F.col("b") != F.col("pb")) & (yes(F.col("a") == F.col("pa")) | yes(F.col("b") == F.col("pb"))) & no(F.abs(F.col("runtime") - F.col("p_runtime")) > 15)
    m = cur.join(prior, "k").where(fit).groupBy("k").agg(F.sum("n").alias("n"), F.min("evidence").alias("low"), F.max("evidence").alias("high"))
    note = " (retained)"
    kept = F.when(F.col("low") == F.col("high"), F.when(F.col("low").endswith(note), F.col("low")).otherwise(F.concat("low", F.lit(note))))
    return cur.join(m, "k", "left").select("k", F.coalesce("n", F.lit(0).cast("bigint")).alias("matches"), kept.alias("kept"))


@query("""WITH s AS (SELECT *, c_acctbal > 0 AS has_rows FROM customer), o AS (SELECT o_custkey, bool_and(o_orderstatus = 'F') AS complete, bool_or(o_orderpriority = '5-LOW') AS fallback FROM orders GROUP BY 1), l AS (SELECT DISTINCT user_id FROM events)
SELECT c_custkey, has_rows AND coalesce(complete, false) AND NOT coalesce(fallback, true) AND user_id IS NOT NULL AND c_nationkey > 4 AS skip FROM s LEFT JOIN o ON c_custkey = o_custkey LEFT JOIN l ON c_custkey = user_id""")
def q_retry_skip(t):
    """What needs no second try: rows, a complete status without fallback and a live mark, joined from three tables."""
    status = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.bool_and(F.col("o_orderstatus") == "F").alias("complete"), F.bool_or(F.col("o_orderpriority") == "5-LOW").alias("fallback"))
    live = t.events.select(F.col("user_id").alias("c_custkey")).distinct().withColumn("live", F.lit(True))
    s = t.customer.join(status, "c_custkey", "left").join(live, "c_custkey", "left")
    return s.select("c_custkey", ((F.col("c_acctbal") > 0) & F.coalesce("complete", F.lit(False)) & ~F.coalesce("fallback", F.lit(True)) & F.coalesce("live", F.lit(False)) & (F.col("c_nationkey") > 4)).alias("skip"))


# --- tags ------------------------------------------------------------------

# Languages and countries of a market, in the order of the tags.
MARKETS = {
    "Indian": (["hindi", "telugu", "tamil", "malayalam", "kannada", "bengali", "marathi", "gujarati", "punjabi", "odia", "assamese"], ["india"]),
    "Korean": (["korean"], ["south korea", "republic of korea"]),
    "Chinese": (["chinese", "mandarin", "mandarin chinese", "cantonese"], ["china", "people's republic of china", "hong kong", "taiwan"]),
    "Vietnamese": (["vietnamese"], ["vietnam"]),
    "Japanese": (["japanese"], ["japan"]),
    "Filipino": (["filipino", "tagalog"], ["philippines"]),
    "Thai": (["thai"], ["thailand"]),
    "Spanish-language": (["spanish"], []),
}
# Wording of events in titles, of genres, of films in prose.
MUSIC_TITLE = r"\bworld\s+tour\b|\bconcert(?:\s+film)?\b|\bcheering\s+party\b"
KIDS_GENRE = r"kids?\s*(?:&|and)\s*family|children['’]?s?\s+(?:films?|movies?|cinema)|kids?\s+(?:films?|movies?|cinema)"
PROSE = [("Indian", r"\bindian (?:[a-z-]+ )*film\b"), ("Korean", r"\bsouth korean (?:[a-z-]+ )*film\b|\bkorean-language\b"), ("Japanese", r"\bjapanese (?:[a-z-]+ )*film\b|\bjapanese-language\b"), ("Thai", r"\bthai (?:[a-z-]+ )*film\b|\bthai-language\b")]
# Themes that a text states, and organisations known for one.
THEMES = [("Faith-oriented", r"\bfaith[- ]based\b|\bbiblical\b|\bgospel\b|\bmessiah\b"), ("Music/Concert", r"\bconcert\b|\bmusic\s+(?:film|documentary|special|concert)\b")]
ORGANISATIONS = {"angel studios": "Faith-oriented", "bet films": "Black-focused", "codeblack films": "Black-focused", "pantaya": "Latino/Hispanic-focused", "vix": "Latino/Hispanic-focused"}
KNOWN = [x for names, _ in MARKETS.values() for x in names]
TAG_ORDER = ["Music/Concert", "Kids-focused", "Faith-oriented", "Black-focused", "Latino/Hispanic-focused", *MARKETS]


def tags_of(languages, countries, title, genres, prose, organisations):
    """Tags in their order, 'General' if nothing speaks for one; all arguments are lower case.

    A market needs languages and countries to agree where both are known; a
    language of no market gives a tag of its own, English none.
    """
    tag = lambda cond, name: F.when(F.coalesce(cond, F.lit(False)), F.lit(name))
    lit = lambda xs: F.array(*[F.lit(x) for x in xs]) if xs else F.array().cast("array<string>")
    market = []
    for name, (tongues, lands) in MARKETS.items():
        by_tongue, by_land = F.arrays_overlap(languages, lit(tongues)), F.arrays_overlap(countries, lit(lands))
        both = (F.size(languages) > 0) & (F.size(countries) > 0)
        market.append(tag(F.when(F.lit(not lands), by_tongue).when(both, by_tongue & by_land).otherwise(by_tongue | by_land), name))
    themes = [tag(title.rlike(MUSIC_TITLE) | F.exists(genres, lambda g: g.rlike(r"\b(?:music|concert)\b")), "Music/Concert"), tag(F.exists(genres, lambda g: F.trim(g).rlike(f"^(?:{KIDS_GENRE})$")), "Kids-focused")]
    themes += [tag(prose.rlike(rx), name) for name, rx in [*THEMES, *PROSE]]
    firms = [tag(F.array_contains(organisations, k), name) for k, name in ORGANISATIONS.items()]
    # A language of no market speaks for itself only where no country could contradict it.
    other = F.transform(F.filter(languages, lambda x: ~x.isin(*KNOWN, "english")), lambda x: F.concat(F.initcap(x), F.lit("-language")))
    found = F.array_distinct(F.array_compact(F.array(*themes, *firms, *market)))
    ordered = F.filter(lit(TAG_ORDER), lambda x: F.array_contains(found, x))
    tags = F.concat(ordered, F.array_sort(F.array_distinct(other)))
    return F.when(F.size(tags) > 0, tags).otherwise(lit(["General"]))


_LANDS = ["india", "japan", "south korea", "france"]
_SQL_MARKETS = ", ".join("CASE WHEN " + (f"len(list_intersect(l, {t})) > 0" if not c else f"CASE WHEN len(l) > 0 AND len(c) > 0 THEN len(list_intersect(l, {t})) > 0 AND len(list_intersect(c, {c})) > 0 ELSE len(list_intersect(l, {t})) > 0 OR len(list_intersect(c, {c})) > 0 END").replace('"', "'") + f" THEN '{name}' END" for name, (t, c) in ((n, (str(a), str([x.replace("'", "") for x in b]) if b else "")) for n, (a, b) in MARKETS.items()))


@query(rf"""WITH p AS (SELECT page_id, list_transform(coalesce(languages, []), lambda x: lower(x)) AS l, CASE page_id % 3 WHEN 0 THEN ['{_LANDS[0]}', '{_LANDS[1]}'] WHEN 1 THEN ['{_LANDS[2]}', '{_LANDS[3]}'] ELSE [] END AS c, lower(coalesce(title, '')) AS d, list_transform(coalesce(genres, []), lambda x: lower(x)) AS g,
 CASE page_id % 7 WHEN 0 THEN 'a thai crime film' WHEN 1 THEN 'the gospel of a faith-based town' WHEN 2 THEN 'an indian-language essay' ELSE '' END AS w, CASE page_id % 11 WHEN 0 THEN ['angel studios', 'x'] WHEN 1 THEN ['vix'] ELSE [] END AS o FROM rt_page),
f AS (SELECT page_id, l, [CASE WHEN regexp_matches(d, '{MUSIC_TITLE}') OR len(list_filter(g, lambda x: regexp_matches(x, '\b(?:music|concert)\b'))) > 0 THEN 'Music/Concert' END, CASE WHEN len(list_filter(g, lambda x: regexp_full_match(trim(x), '{KIDS_GENRE.replace("'", "''")}'))) > 0 THEN 'Kids-focused' END,
 {", ".join(f"CASE WHEN regexp_matches(w, '{rx}') THEN '{n}' END" for n, rx in [*THEMES, *PROSE])}, {", ".join(f"CASE WHEN list_contains(o, '{k}') THEN '{n}' END" for k, n in ORGANISATIONS.items())}, {_SQL_MARKETS}] AS found FROM p),
r AS (SELECT page_id, list_concat(list_filter({TAG_ORDER}, lambda x: list_contains(found, x)), list_sort(list_distinct(list_transform(list_filter(l, lambda x: NOT list_contains({KNOWN + ['english']}, x)), lambda x: upper(x[1:1]) || x[2:] || '-language')))) AS tags FROM f)
SELECT page_id, CASE WHEN len(tags) > 0 THEN array_to_string(tags, '|') ELSE 'General' END AS tags FROM r""")
def q_market_tags(t):
    """Tags of language, country, prose, themes, organisations and genres."""
    k = F.col("page_id")
    words = lambda *xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    low = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.lower(x))
    lands = F.when(k % 3 == 0, words(*_LANDS[:2])).when(k % 3 == 1, words(*_LANDS[2:])).otherwise(words())
    prose = F.when(k % 7 == 0, "a thai crime film").when(k % 7 == 1, "the gospel of a faith-based town").when(k % 7 == 2, "an indian-language essay").otherwise("")
    firms = F.when(k % 11 == 0, words("angel studios", "x")).when(k % 11 == 1, words("vix")).otherwise(words())
    p = t.rt_page.select("page_id", low("languages").alias("l"), lands.alias("c"), F.lower(F.coalesce("title", F.lit(""))).alias("d"), low("genres").alias("g"), prose.alias("w"), firms.alias("o"))
    return p.select("page_id", F.array_join(tags_of(*[F.col(x) for x in "lcdgwo"]), "|").alias("tags"))


# --- plans -----------------------------------------------------------------

TRANSIT, OTHER_PLACE, BREAK, PER_GROUP, MOST = 35, 5000, 30, 50, 10
#: The ways to part two to four members into groups of one or two, by their places.
PARTITIONS = {
    2: ["0,1", "01"],
    3: ["0,1,2", "0,12", "01,2", "02,1"],
    4: ["0,1,2,3", "0,1,23", "0,12,3", "0,13,2", "01,2,3", "01,23", "02,1,3", "02,13", "03,1,2", "03,12"],
}


def watch_plans(asked, shows):
    """(request, cost, plan): the cheapest way to see the two to four films of each request, each group of films on a day of its own.

    ``asked``: (request, ids); ``shows``: (film, day, place, begins, ends, place_rank, format_rank). Pairs of showings
    are made only for pairs of films that a request names, and each pair of films is settled once for all requests.
    Of each group the MOST cheapest days are kept, as the plan is defined; a request without a plan has none.
    """
    members = asked.select("request", F.array_sort(F.array_distinct("ids")).alias("ids")).where(F.size("ids").between(2, 4))
    single = shows.groupBy("film", "day").agg(F.min(F.struct((F.col("place_rank") * 1000 + F.col("format_rank") * 100 + F.col("begins") / 1000).alias("cost"), "begins", "place")).alias("s"))
    single = single.select("film", F.lit(-1).cast("bigint").alias("film2"), "day", F.col("s.cost").alias("cost"))
    each = members.select(F.posexplode("ids").alias("i", "film"), "ids")
    pairs = each.select("film", F.explode(F.filter("ids", lambda x: x > F.col("film"))).alias("film2")).distinct()
    one = lambda n: shows.select(F.col("film").alias(f"film{n}"), "day", *[F.col(c).alias(c + n) for c in ("place", "begins", "ends", "place_rank", "format_rank")])
    both = pairs.withColumnRenamed("film", "film1").join(one("1"), "film1").join(one("2"), ["film2", "day"])
    same = F.col("place1") == F.col("place2")
    gap = lambda a, b: F.col(f"begins{b}") - F.col(f"ends{a}") - F.when(same, 0).otherwise(TRANSIT)
    least = F.least(F.when(gap("1", "2") >= 0, gap("1", "2")), F.when(gap("2", "1") >= 0, gap("2", "1")))
    cost = F.when(same, 0).otherwise(OTHER_PLACE) + (F.col("place_rank1") + F.col("place_rank2")) * 1000 + (F.col("format_rank1") + F.col("format_rank2")) * 100 + least
    double = both.where(least.isNotNull()).groupBy(F.col("film1").alias("film"), "film2", "day").agg(F.min(cost.cast("double")).alias("cost"))
    best = single.unionByName(double).withColumn("rn", F.row_number().over(Window.partitionBy("film", "film2").orderBy("cost", "day"))).where(F.col("rn") <= MOST)
    ways = F.when(F.size("ids") == 2, F.array(*map(F.lit, PARTITIONS[2]))).when(F.size("ids") == 3, F.array(*map(F.lit, PARTITIONS[3]))).otherwise(F.array(*map(F.lit, PARTITIONS[4])))
    groups = members.select("request", "ids", F.explode(ways).alias("way")).select("request", "ids", "way", F.posexplode(F.split("way", ",")).alias("g", "part"))
    at = lambda k: F.element_at("ids", F.substring("part", k, 1).cast("int") + 1)
    groups = groups.select("request", "way", "g", at(1).alias("film"), F.when(F.length("part") == 2, at(2)).otherwise(F.lit(-1)).cast("bigint").alias("film2"))
    days = groups.join(best.select("film", "film2", "day", "cost"), ["film", "film2"]).groupBy("request", "way", "g").agg(F.array_sort(F.collect_list(F.struct("cost", "day"))).alias("days"))  # at most MOST
    # The other groups take one day each, so of as many cheapest days as there are groups one is free.
    days = days.withColumn("days", F.slice("days", F.lit(1), F.size(F.split("way", ","))))
    per_way = days.groupBy("request", "way").agg(F.array_sort(F.collect_list(F.struct("g", "days"))).alias("gs")).where(F.size("gs") == F.size(F.split("way", ",")))
    start = F.array(F.struct(F.lit(0.0).alias("cost"), F.array().cast("array<date>").alias("days")))

    def step(acc, g):
        return F.flatten(F.transform(acc, lambda a: F.transform(F.filter(g["days"], lambda d: ~F.array_contains(a["days"], d["day"])), lambda d: F.struct((a["cost"] + d["cost"]).alias("cost"), F.concat(a["days"], F.array(d["day"])).alias("days")))))

    plans = per_way.select("request", "way", F.array_min(F.aggregate("gs", start.cast("array<struct<cost:double,days:array<date>>>"), step)).alias("p")).where("p is not null")
    total = F.round(F.col("p.cost") + PER_GROUP * F.size("p.days"), 3)
    return plans.groupBy("request").agg(F.min(F.struct(total.alias("cost"), "way", F.col("p.days").alias("days"))).alias("b")).select("request", "b.cost", "b.way")


_SHOWS = """shows AS (SELECT user_id AS film, CAST(ts AS DATE) AS day, event_type AS place, hour(ts) * 60 + minute(ts) AS begins, hour(ts) * 60 + minute(ts) + 90 + CAST(user_id % 3 AS INT) * 10 + 30 AS ends, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS place_rank, CAST(event_id % 3 AS INT) AS format_rank FROM events)"""
_WAYS = ", ".join(f"({n}, '{w}', {i}, {g[0]}, {g[1] if len(g) == 2 else 'NULL'}, {len(w.split(','))})" for n, ws in PARTITIONS.items() for w in ws for i, g in enumerate(w.split(",")))


@query(f"""WITH {_SHOWS}, asked AS (SELECT film_id AS request, list_sort(list_distinct([film_id % 40, (film_id * 7) % 40, (film_id * 11) % 40, (film_id * 13) % 40][1:CAST(film_id % 5 AS INT)])) AS ids FROM films),
m AS (SELECT * FROM asked WHERE len(ids) BETWEEN 2 AND 4), w(n, way, g, a, b, gs) AS (VALUES {_WAYS}),
grp AS (SELECT request, way, g, gs, ids[a + 1] AS film, coalesce(ids[b + 1], -1) AS film2 FROM m JOIN w ON len(ids) = n),
pr AS (SELECT DISTINCT film, film2 FROM grp WHERE film2 >= 0),
d AS (SELECT pr.film, pr.film2, x.day, min(CASE WHEN x.place = y.place THEN 0 ELSE {OTHER_PLACE} END + (x.place_rank + y.place_rank) * 1000 + (x.format_rank + y.format_rank) * 100 + CAST(y.begins - x.ends - CASE WHEN x.place = y.place THEN 0 ELSE {TRANSIT} END AS DOUBLE)) AS cost
 FROM pr JOIN shows x ON x.film IN (pr.film, pr.film2) JOIN shows y ON y.film = CASE WHEN x.film = pr.film THEN pr.film2 ELSE pr.film END AND x.day = y.day WHERE y.begins - x.ends - CASE WHEN x.place = y.place THEN 0 ELSE {TRANSIT} END >= 0 GROUP BY 1, 2, 3),
s AS (SELECT film, -1 AS film2, day, min(place_rank * 1000 + format_rank * 100 + begins / 1000.0) AS cost FROM shows GROUP BY 1, 3),
k AS (SELECT * FROM (SELECT film, film2, day, cost, row_number() OVER (PARTITION BY film, film2 ORDER BY cost, day) AS rn FROM (SELECT * FROM s UNION ALL SELECT * FROM d)) WHERE rn <= {MOST}),
c AS (SELECT request, way, g, gs, day, cost FROM grp JOIN k USING (film, film2)),
p AS (SELECT a.request, a.way, a.gs, a.cost + coalesce(b.cost, 0) + coalesce(c3.cost, 0) + coalesce(c4.cost, 0) AS cost FROM c a LEFT JOIN c b ON a.gs >= 2 AND b.g = 1 AND b.request = a.request AND b.way = a.way AND b.day <> a.day
 LEFT JOIN c c3 ON a.gs >= 3 AND c3.g = 2 AND c3.request = a.request AND c3.way = a.way AND c3.day <> a.day AND c3.day <> b.day LEFT JOIN c c4 ON a.gs >= 4 AND c4.g = 3 AND c4.request = a.request AND c4.way = a.way AND c4.day NOT IN (a.day, b.day, c3.day)
 WHERE a.g = 0 AND (a.gs < 2 OR b.day IS NOT NULL) AND (a.gs < 3 OR c3.day IS NOT NULL) AND (a.gs < 4 OR c4.day IS NOT NULL))
SELECT request, min(round(cost + {PER_GROUP} * gs, 3)) AS cost, arg_min(way, (round(cost + {PER_GROUP} * gs, 3), way)) AS way FROM p GROUP BY 1""")
def q_watch_plans(t):
    """Two to four films a request, in groups on distinct days at the least cost."""
    e, minute = t.events, F.hour("ts") * 60 + F.minute("ts")
    shows = e.select(F.col("user_id").cast("bigint").alias("film"), F.to_date("ts").alias("day"), F.col("event_type").alias("place"), minute.alias("begins"), (minute + 90 + (F.col("user_id") % 3) * 10 + BREAK).alias("ends"),
                     F.when(F.col("event_type") == "click", 0).when(F.col("event_type") == "view", 1).otherwise(2).alias("place_rank"), (F.col("event_id") % 3).cast("int").alias("format_rank"))
    k = F.col("film_id")
    ids = F.slice(F.array(k % 40, k * 7 % 40, k * 11 % 40, k * 13 % 40), F.lit(1), (k % 5).cast("int"))
    return watch_plans(t.films.select(k.alias("request"), ids.alias("ids")), shows)


# --- objects, grids, failures, scores --------------------------------------


@query("""SELECT film_id AS id, CAST(4 + (film_id % 2) AS INT) AS n_strings, CASE film_id % 3 WHEN 0 THEN 'Laser / Open Caption' ELSE 'Open Caption' END AS label, film_id % 5 = 0 AS flagged, CASE WHEN runtimeMin BETWEEN 30 AND 400 THEN runtimeMin ELSE 95 END AS runtime, CAST(film_id % 2 AS INT) AS movies FROM films""")
def q_json_objects(t):
    """Strings, labels, flags, the first runtime and typed objects of JSON of unknown shape."""
    from brightreel.sources.json_walk import object_facts

    k = F.col("film_id")
    text = F.concat(
        F.lit('{"format": "'), F.when(k % 3 == 0, "Laser").otherwise("none"), F.lit('", "badges": [{"text": "Open  Caption", "n": 5}, "'), F.when(k % 5 == 0, "Excluded from A-List").otherwise("plain"),
        F.lit('"], "details": {"deep": [{"runtime": '), F.coalesce(F.col("runtimeMin").cast("string"), F.lit("null")), F.lit('}], "x": {"duration": "1h 35m"}}, "@type": '), F.when(k % 2 == 1, F.lit('"Movie", "url": "u"')).otherwise(F.lit('["Event"]')), F.lit("}"))
    # Five strings one level down with a type of one word and its link, four with a list of types.
    facts = object_facts(t.films.select("film_id", text.alias("j")), "film_id", "j")
    return facts


@query("""WITH th AS (SELECT theatre_id, row_number() OVER (ORDER BY theatre_id) - 1 AS i, count(*) OVER () AS nt FROM theatre), d AS (SELECT DISTINCT show_date FROM showtime WHERE show_date IS NOT NULL), dd AS (SELECT show_date, row_number() OVER (ORDER BY show_date) - 1 AS j, count(*) OVER () AS nd FROM d),
ph AS (SELECT max(show_date) - DATE '0001-01-01' + 1 AS day FROM d), g AS (SELECT theatre_id, show_date, i, j, nt, nd, day % (nt * nd) % nt AS ts, day % (nt * nd) // nt AS ds FROM th, dd, ph)
SELECT theatre_id, show_date, CAST(((j - ds - (((i - ts) % nt + nt) % nt)) % nd + nd) % nd * nt + ((i - ts) % nt + nt) % nt AS BIGINT) AS place FROM g""")
def q_request_grid(t):
    """Each theatre and date once, in a rotation that begins elsewhere each day; dates are made distinct, empty lists give no grid."""
    theatres = R.global_row_number(t.theatre.select("theatre_id").distinct(), [F.col("theatre_id").asc()], "i").withColumn("i", F.col("i") - 1)
    dates = R.global_row_number(t.showtime.where("show_date is not null").select("show_date").distinct(), [F.col("show_date").asc()], "j").withColumn("j", F.col("j") - 1)
    sizes = theatres.agg(F.count(F.lit(1)).alias("nt")).join(dates.agg(F.count(F.lit(1)).alias("nd"), (F.unix_date(F.max("show_date")) + 719163).alias("day")), F.lit(True))
    g = theatres.join(F.broadcast(sizes), F.lit(True)).join(dates, F.lit(True))  # the grid is the result: theatres x dates
    phase = F.col("day") % (F.col("nt") * F.col("nd"))
    p = F.pmod(F.col("i") - phase % F.col("nt"), F.col("nt"))
    turn = F.pmod(F.col("j") - F.floor(phase / F.col("nt")) - p, F.col("nd"))
    return g.select("theatre_id", "show_date", (turn * F.col("nt") + p).cast("bigint").alias("place"))


@query("""WITH e AS (SELECT event_id, user_id, ts, event_type = 'error' OR value < 8 AS failed, event_type = 'error' AS explicit, event_id % 3 AS place, event_id % 4 AS day FROM events),
s AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seen FROM e),
g AS (SELECT user_id, seen, place * 4 + day AS combo, row_number() OVER (PARTITION BY user_id, place * 4 + day ORDER BY seen) AS nth FROM s), probed AS (SELECT user_id, max(seen) AS full_at FROM g WHERE nth = 1 GROUP BY 1 HAVING count(*) = 12),
l AS (SELECT *, list({'p': place, 'd': day, 'x': explicit}) OVER (PARTITION BY user_id, island ORDER BY ts, event_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS raw FROM s WHERE failed),
f AS (SELECT *, raw AS w, raw[-3:] AS r FROM l)
SELECT f.event_id, seen >= full_at AND ((len(r) = 3 AND len(list_filter(r, lambda x: x.x)) = 3 AND len(list_distinct(list_transform(r, lambda x: x.p * 4 + x.d))) = 3 AND len(list_distinct(list_transform(r, lambda x: x.p))) >= 2 AND len(list_distinct(list_transform(r, lambda x: x.d))) >= 2)
 OR (len(w) >= 4 AND len(list_distinct(list_transform(w, lambda x: x.p))) >= 2 AND len(list_distinct(list_transform(w, lambda x: x.d))) >= 2)) AS opens FROM f JOIN probed USING (user_id)""")
def q_circuit_grid(t):
    """A streak of failures opens the circuit: three explicit ones over two theatres and dates at least, or four over as many; only when the whole grid has been tried."""
    from brightreel.operators.stateful import circuit_opens

    e = t.events.select("event_id", "user_id", "ts", ((F.col("event_type") == "error") | (F.col("value") < 8)).alias("failed"), (F.col("event_type") == "error").alias("explicit"), (F.col("event_id") % 3).alias("place"), (F.col("event_id") % 4).alias("day"))
    return circuit_opens(e, "user_id", ["ts", "event_id"], 12).select("event_id", "opens")


def _jaccard(a, b):
    x, y = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


_KEY = "trim(regexp_replace(regexp_replace(lower({0}), '&', ' and ', 'g'), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""WITH c AS (SELECT *, {_KEY.format('canonical_title')} AS k FROM movie_context WHERE canonical_title IS NOT NULL), p AS (SELECT *, {_KEY.format('title')} AS pk FROM letterboxd_page WHERE title IS NOT NULL),
n AS (SELECT DISTINCT context_id, page_id FROM (SELECT context_id, unnest(string_split(k, ' ')) AS w FROM c) JOIN (SELECT page_id, unnest(string_split(pk, ' ')) AS w FROM p) USING (w)),
s AS (SELECT c.context_id, p.page_id, CAST(len(list_intersect(list_distinct(string_split(k, ' ')), list_distinct(string_split(pk, ' ')))) AS DOUBLE) / len(list_distinct(list_concat(string_split(k, ' '), string_split(pk, ' ')))) AS sim, abs(p.release_year - c.expected_year) AS dy, abs(p.runtime_min - c.runtime_min) AS dr, p.release_year, p.poster_url, c.expected_year, coalesce(relax_runtime, false) AS relax, len(coalesce(spoken_languages, [])) AS spoken FROM n JOIN c USING (context_id) JOIN p USING (page_id)),
v AS (SELECT *, sim * 100 + CASE WHEN dy <= 3 THEN greatest(0, 15 - 4 * dy) ELSE 0 END + CASE WHEN NOT relax AND dr <= 20 THEN greatest(0, 10 - dr / 2.0) ELSE 0 END + CASE WHEN spoken > 0 THEN 0 ELSE 4 END AS entity_score,
 sim * 100 + CASE WHEN release_year IS NULL THEN 0 WHEN expected_year IS NOT NULL THEN greatest(-25, 12 - 4 * dy) ELSE greatest(-30, 10 - 2.5 * abs(release_year - 2026)) END + CASE WHEN NOT relax AND dr IS NOT NULL THEN greatest(0, 10 - dr / 2.0) ELSE 0 END + CASE WHEN poster_url IS NOT NULL THEN 2 ELSE 0 END AS page_score,
 CASE WHEN dy IS NULL THEN 0 WHEN dy = 0 THEN 2 WHEN dy = 1 THEN 1 ELSE -1 END AS year_match, CASE WHEN sim = 1 THEN 1 ELSE 0 END AS exact, CASE WHEN dr IS NULL THEN 0 WHEN dr <= 5 THEN 3 WHEN dr <= 10 THEN 2 WHEN dr <= 20 THEN 1 ELSE -2 END AS runtime_rank FROM s WHERE sim >= 0.82 AND NOT coalesce(dy > 3, false) AND NOT coalesce(NOT relax AND dr > 20, false))
SELECT context_id, arg_max(page_id, (round(entity_score, 6), -page_id)) AS by_entity, round(max(entity_score), 6) AS entity_score, arg_max(page_id, (round(page_score, 6), -page_id)) AS by_page, round(max(page_score), 6) AS page_score, arg_max(page_id, (year_match, exact, round(sim, 6), runtime_rank, -page_id)) AS by_key FROM v GROUP BY 1""")
def q_match_scores(t):
    """Candidates that share a rare word, a similarity of 0.82 at least, vetoes, then three scores, each with its best page; ties go to the earlier page."""
    from brightreel.functions.text import literal_key

    c = t.movie_context.where("canonical_title is not null").withColumn("k", literal_key(F.col("canonical_title")))
    p = t.letterboxd_page.where("title is not null").select("page_id", "release_year", "poster_url", F.col("runtime_min").alias("page_runtime"), literal_key(F.col("title")).alias("pk"))
    # Equal titles are compared once. Titles as like as that share one of their rarest words, so many as may be unlike and one.
    left, right = c.select("k").distinct(), p.select("pk").distinct()
    counts = left.union(right).select(F.explode(F.array_distinct(F.split("k", " "))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))

    def word(df, col):
        each = df.select(col, F.explode(F.array_distinct(F.split(col, " "))).alias("w")).join(counts, "w")
        rarest = each.groupBy(col).agg(F.array_sort(F.collect_list(F.struct("n", "w"))).alias("ws"))
        return rarest.select(col, F.explode(F.slice("ws", F.lit(1), (F.size("ws") - F.ceil(F.size("ws") * 0.82 - 1e-9) + 1).cast("int"))).alias("x")).select(col, "x.w")

    met = word(left, "k").join(word(right, "pk"), "w").select("k", "pk").distinct().withColumn("sim", _jaccard(F.col("k"), F.col("pk"))).where("sim >= 0.82")
    s = met.join(p, "pk").join(c, "k").withColumn("dy", F.abs(F.col("release_year") - F.col("expected_year"))).withColumn("dr", F.abs(F.col("page_runtime") - F.col("runtime_min")))
    relax, dy, dr = F.coalesce("relax_runtime", F.lit(False)), F.col("dy"), F.col("dr")
    s = s.where(~F.coalesce(dy > 3, F.lit(False)) & ~F.coalesce(~relax & (dr > 20), F.lit(False)))
    near = F.when(~relax & dr.isNotNull(), F.greatest(F.lit(0.0), 10 - dr / 2)).otherwise(0.0)
    entity = F.col("sim") * 100 + F.when(dy <= 3, F.greatest(F.lit(0), 15 - 4 * dy)).otherwise(0) + F.when(dr <= 20, near).otherwise(0.0) + F.when(F.size(F.coalesce("spoken_languages", F.array().cast("array<string>"))) > 0, 0).otherwise(4)
    year = F.when(F.col("release_year").isNull(), 0.0).when(F.col("expected_year").isNotNull(), F.greatest(F.lit(-25), 12 - 4 * dy).cast("double")).otherwise(F.greatest(F.lit(-30.0), 10 - 2.5 * F.abs(F.col("release_year") - 2026)))
    page = F.col("sim") * 100 + year + near + F.when(F.col("poster_url").isNotNull(), 2).otherwise(0)
    match = F.when(dy.isNull(), 0).when(dy == 0, 2).when(dy == 1, 1).otherwise(-1)
    rank = F.when(dr.isNull(), 0).when(dr <= 5, 3).when(dr <= 10, 2).when(dr <= 20, 1).otherwise(-2)
    v = s.select("context_id", "page_id", F.round(entity, 6).alias("es"), F.round(page, 6).alias("ps"), match.alias("y"), F.when(F.col("sim") == 1, 1).otherwise(0).alias("x"), F.round("sim", 6).alias("sim"), rank.alias("r"))
    earlier = (-F.col("page_id")).alias("o")
    return v.groupBy("context_id").agg(F.max_by("page_id", F.struct("es", earlier)).alias("by_entity"), F.max("es").alias("entity_score"), F.max_by("page_id", F.struct("ps", earlier)).alias("by_page"), F.max("ps").alias("page_score"), F.max_by("page_id", F.struct("y", "x", "sim", "r", earlier)).alias("by_key"))


# What stands on pages that block, and in texts that are no title.
BLOCKS = ["the site requires javascript to be enabled", "queue.", "global safety net", "enable-javascript.com", "access denied", "verify you are human", "checking your browser before accessing", "attention required", "cf-chl", "captcha", "bot protection"]
NO_TITLE = ["showtimes", "get tickets", "buy tickets", "read more", "find showtimes", "stubs", "excluded from a-list", "reserved seating", "details", "watch trailer", "trailer", "movie theater", "available at", "fan faves", "closed caption", "open caption", "spoken subtitles", "subtitle", "imax", "dolby", "reald", "ticket"]
DAY_OR_MONTH = r"^(?:sat|sun|mon|tue|wed|thu|fri|jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\b"
TIME_OR_RUNTIME = r"\b\d{1,2}:\d{2}\s*[ap]m\b|\d+\s*hr\s*\d+\s*min|\b\d{2,3}\s*min\b"


@query(rf"""WITH s AS (SELECT ingest_seq, trim(regexp_replace(movie_title, '\s+', ' ', 'g')) AS x FROM showtime WHERE movie_title IS NOT NULL)
SELECT ingest_seq, length(x) BETWEEN 2 AND 160 AND NOT regexp_matches(x, '{TIME_OR_RUNTIME}', 'i') AND NOT ({" OR ".join(f"contains(lower(x), '{b}')" for b in NO_TITLE)}) AND NOT regexp_matches(lower(x), '{DAY_OR_MONTH}') AND regexp_matches(x, '\p{{L}}') AS title_like FROM s""")
def q_title_text(t):
    """Text that may be a title, by all its rules."""
    s = t.showtime.where("movie_title is not null").select("ingest_seq", F.trim(F.regexp_replace("movie_title", r"\s+", " ")).alias("x"))
    x, low = F.col("x"), F.lower("x")
    return s.select("ingest_seq", (F.length(x).between(2, 160) & ~x.rlike(f"(?i){TIME_OR_RUNTIME}") & ~low.rlike("|".join(NO_TITLE)) & ~low.rlike(DAY_OR_MONTH) & x.rlike(r"\p{L}")).alias("title_like"))


@query(f"""SELECT doc_id, {" OR ".join(f"contains(lower(text), '{b}')" for b in BLOCKS)} AS blocked FROM documents WHERE text IS NOT NULL""")
def q_page_blocked(t):
    """Pages that block, by all their marks, over whole texts."""
    from functools import reduce

    low = F.lower("text")
    return t.documents.where("text is not null").select("doc_id", reduce(lambda a, b: a | b, [low.contains(b) for b in BLOCKS]).alias("blocked"))
