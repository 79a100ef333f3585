"""Queries of joins, matching, vetoes and planning: J*, P*, L*, Q*."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from brightreel.functions import text
from brightreel.operators import relational as R
from brightreel.plans.base import query

KEY = "trim(regexp_replace(regexp_replace(lower({0}), '&', ' and ', 'g'), '[^a-z0-9]+', ' ', 'g'))"
BARE = "trim(regexp_replace(regexp_replace(' ' || " + KEY + " || ' ', ' (?:the|an|a) ', ' ', 'g'), ' +', ' ', 'g'))"


@query("""SELECT c.c_custkey, coalesce(o.n, 0) AS n_orders, coalesce(o.cents, 0) AS cents FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) o ON c_custkey = o_custkey""")
def q_left_join_default(t):
    """Left join of an aggregate, 0 where nothing matches."""
    o = t.orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    return t.customer.select("c_custkey").join(o, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"), F.coalesce("cents", F.lit(0)).alias("cents"))


@query(f"""WITH v AS (SELECT DISTINCT context_id, k FROM (SELECT context_id, {BARE.format('display_title')} AS k FROM movie_context UNION ALL SELECT context_id, {BARE.format('canonical_title')} FROM movie_context) WHERE k <> ''),
c AS (SELECT film_id, {BARE.format('title')} AS a, replace(film_key, 'fk-', '') AS b FROM films)
SELECT DISTINCT context_id, film_id FROM v JOIN c ON k = a UNION SELECT context_id, film_id FROM v JOIN c ON k = b""")
def q_variant_probe(t):
    """Exploded variants against a catalogue with two names: two equi-joins, distinct."""
    m = t.movie_context
    v = m.select("context_id", F.explode(F.array(text.match_key(F.col("display_title")), text.match_key(F.col("canonical_title")))).alias("k")).where("k != ''").distinct()
    c = t.films.select("film_id", text.match_key(F.col("title")).alias("a"), F.replace("film_key", F.lit("fk-"), F.lit("")).alias("b"))
    return R.probe_variants(v, c, "k", ["a", "b"]).select("context_id", "film_id").distinct()


@query(f"""WITH v AS (SELECT venue_row, 0 AS tier, {KEY.format('name')} AS k FROM venues UNION ALL SELECT venue_row, 1, {KEY.format('short')} FROM venues),
t AS (SELECT theatre_id, u.k FROM (SELECT theatre_id, {KEY.format('name')} AS k0 FROM theatre), unnest([k0, regexp_replace(k0, '^[^ ]+ ', ''), regexp_replace(regexp_replace(k0, '^[^ ]+ ', ''), ' [0-9]+', '', 'g')]) AS u(k)),
m AS (SELECT venue_row, tier, count(DISTINCT theatre_id) AS n, min(theatre_id) AS theatre_id FROM v JOIN t USING (k) WHERE k <> '' GROUP BY 1, 2),
b AS (SELECT venue_row, min(tier) AS tier FROM m GROUP BY 1)
SELECT venue_row, theatre_id, tier FROM m JOIN b USING (venue_row, tier) WHERE n = 1""")
def q_unambiguous_match(t):
    """The only theatre of the best tier (name, then short name); none where it has several."""
    v = t.venues.select("venue_row", F.posexplode(F.array(text.literal_key(F.col("name")), text.literal_key(F.col("short")))).alias("tier", "k")).where("k != ''")
    key = text.literal_key(F.col("name"))
    bare = F.regexp_replace(key, "^[^ ]+ ", "")
    th = t.theatre.select("theatre_id", F.explode(F.array(key, bare, F.regexp_replace(bare, " [0-9]+", ""))).alias("k")).distinct()
    return R.unambiguous(v.join(th, "k"), "venue_row", "tier", "theatre_id").select("venue_row", "theatre_id", "tier")


@query(f"""WITH a AS (SELECT context_id, {BARE.format('canonical_title')} AS x FROM movie_context), b AS (SELECT page_id, {BARE.format('title')} AS y FROM rt_page)
SELECT context_id, page_id, levenshtein(x, y) AS distance FROM a JOIN b ON string_split(x, ' ')[1] = string_split(y, ' ')[1] WHERE x <> '' AND levenshtein(x, y) <= 3""")
def q_fuzzy_block_match(t):
    """Blocking on the first word, then edit distance."""
    a = t.movie_context.select("context_id", text.match_key(F.col("canonical_title")).alias("x")).where("x != ''").withColumn("w", F.split("x", " ")[0])
    b = t.rt_page.select("page_id", text.match_key(F.col("title")).alias("y")).withColumn("w", F.split("y", " ")[0])
    return a.join(b, "w").withColumn("distance", F.levenshtein("x", "y", 3)).where("distance between 0 and 3").select("context_id", "page_id", "distance")


@query("""WITH e AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'error'), p AS (SELECT user_id, ts AS pts, max(value) AS v FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT e.event_id, p.pts AS prev_at, p.v AS prev_value FROM e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts >= p.pts""")
def q_asof_prev(t):
    """The last purchase at or before each error."""
    e = t.events.where("event_type = 'error'").select("user_id", "ts", "event_id")
    p = t.events.where("event_type = 'purchase'").groupBy("user_id", F.col("ts").alias("pts")).agg(F.max("value").alias("v"))
    return R.as_of(e, p, "user_id", "ts", "pts", "v").select("event_id", "prev_at", "prev_value")


@query("""WITH e AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'error'), c AS (SELECT user_id, ts AS cts FROM events WHERE event_type = 'click'),
d AS (SELECT event_id, abs(epoch_us(ts) - epoch_us(cts)) AS gap FROM e JOIN c USING (user_id)) SELECT event_id, min(gap) AS gap FROM d GROUP BY 1""")
def q_nearest_abs(t):
    """Distance to the nearest click, before or after: two carried values, no pairs."""
    e = t.events.where("event_type in ('error', 'click')").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    w = Window.partitionBy("user_id").orderBy("us", F.col("event_type"), "event_id")
    click = F.when(F.col("event_type") == "click", F.col("us"))
    n = e.withColumn("before", F.last(click, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("after", F.first(click, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    return n.where("event_type = 'error'").select("event_id", F.least(F.col("us") - F.col("before"), F.col("after") - F.col("us")).alias("gap")).where("gap is not null")


@query("""WITH m AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type AS place, CAST(epoch_us(ts) // 60000000 AS BIGINT) AS start, event_id FROM events WHERE event_type IN ('purchase', 'signup', 'error'))
SELECT user_id, day, count(*) AS pairs, min(CASE WHEN a.place <> b.place THEN 5000 ELSE 0 END + b.start - a.start - 30) AS least_cost FROM m a JOIN m b USING (user_id, day)
WHERE b.start >= a.start + 30 + CASE WHEN a.place = b.place THEN 0 ELSE 35 END GROUP BY 1, 2""")
def q_interval_pairs(t):
    """Pairs of a day that do not overlap, with the least cost."""
    m = t.events.where("event_type in ('purchase', 'signup', 'error')").select("user_id", F.to_date("ts").alias("day"), F.col("event_type").alias("place"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 60_000_000).alias("start"))
    b = m.select("user_id", "day", F.col("place").alias("place2"), F.col("start").alias("start2"))
    same = F.col("place") == F.col("place2")
    j = m.join(b, ["user_id", "day"]).where(F.col("start2") >= F.col("start") + 30 + F.when(same, 0).otherwise(35))
    return j.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("pairs"), F.min(F.when(~same, 5000).otherwise(0) + F.col("start2") - F.col("start") - 30).alias("least_cost"))


@query("""SELECT n_nationkey, m, CASE WHEN t.k IS NULL THEN 'error' ELSE 'warning' END AS severity FROM nation CROSS JOIN (SELECT unnest(range(1, 31)) AS m)
LEFT JOIN (SELECT DISTINCT c_nationkey AS k FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) = 2000 AND month(o_orderdate) = 6 AND day(o_orderdate) <= 5) t ON t.k = n_nationkey
WHERE NOT EXISTS (SELECT 1 FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = n_nationkey AND day(o_orderdate) = m AND month(o_orderdate) = 6 AND year(o_orderdate) = 2000)""")
def q_anti_missing(t):
    """Cells of a grid that no row fills, with severity. The grid is of two dimensions of fixed length."""
    seen = t.orders.where("o_orderdate >= '2000-06-01' and o_orderdate < '2000-07-01'").join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("n_nationkey"), F.day("o_orderdate").cast("bigint").alias("m")).distinct()
    grid = t.nation.select("n_nationkey", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(30).cast("bigint"))).alias("m"))
    any_ = seen.where("m <= 5").select("n_nationkey").distinct().withColumn("some", F.lit(True))
    return grid.join(seen, ["n_nationkey", "m"], "left_anti").join(any_, "n_nationkey", "left").select("n_nationkey", "m", F.when(F.col("some"), "warning").otherwise("error").alias("severity"))


@query("""WITH c AS (SELECT 25 AS nt, 5 AS nd, (date_diff('day', DATE '1970-01-01', DATE '2026-02-14') + 719163) % 125 AS phase)
SELECT r, p, (p + phase % nt) % nt AS place, (p + r + phase // nt) % nd AS day, row_number() OVER (ORDER BY r, p) AS ordinal FROM c, unnest(range(0, 5)) AS a(r), unnest(range(0, 25)) AS b(p)""")
def q_grid_rotation(t):
    """Balanced rotation of a grid of places and days."""
    nt, nd = 25, 5
    phase = F.pmod(F.unix_date(F.lit("2026-02-14").cast("date")) + 719163, F.lit(nt * nd)).cast("bigint")
    g = t.spark.range(nt * nd).select(F.expr(f"id div {nt}").alias("r"), F.expr(f"id % {nt}").alias("p"), (F.col("id") + 1).alias("ordinal"))
    return g.select("r", "p", ((F.col("p") + phase % nt) % nt).alias("place"), ((F.col("p") + F.col("r") + F.floor(phase / nt)) % nd).alias("day"), "ordinal")


@query("""WITH l AS (SELECT url, imdb_id, title, release_year, runtime_min, page_id FROM letterboxd_page)
SELECT a.page_id, b.page_id AS other_id, CASE WHEN a.imdb_id = b.imdb_id THEN 'same id' WHEN a.imdb_id IS NOT NULL AND b.imdb_id IS NOT NULL THEN 'other id' WHEN abs(a.runtime_min - b.runtime_min) <= 3 THEN 'same runtime' ELSE 'unknown' END AS verdict
FROM l a JOIN l b ON lower(a.title) = lower(b.title) WHERE a.page_id < b.page_id""")
def q_continuity_match(t):
    """Identity of two records of one title: equal id, else unequal ids, else runtime."""
    a = t.letterboxd_page.select("page_id", F.lower("title").alias("k"), "imdb_id", "runtime_min")
    b = a.select(F.col("page_id").alias("other_id"), "k", F.col("imdb_id").alias("i2"), F.col("runtime_min").alias("r2"))
    v = F.when(F.col("imdb_id") == F.col("i2"), "same id").when(F.col("imdb_id").isNotNull() & F.col("i2").isNotNull(), "other id").when(F.abs(F.col("runtime_min") - F.col("r2")) <= 3, "same runtime").otherwise("unknown")
    return a.join(b, "k").where("page_id < other_id").select("page_id", "other_id", v.alias("verdict"))


@query("""SELECT n_name, count(*) AS n_lines, count(DISTINCT o_orderkey) AS n_orders FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE l_returnflag = 'R' GROUP BY 1""")
def q_id_bridge(t):
    """Batched lookups as joins; a chain of key joins from line to nation, each verified by equality."""
    l = t.lineitem.where("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    j = l.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(F.sum("n").alias("n_lines"), F.count(F.lit(1)).alias("n_orders"))


@query(f"""SELECT context_id, page_id, CASE WHEN abs(expected_year - release_year) > 3 THEN 'year' WHEN abs(m.runtime_min - p.runtime_min) > 20 THEN 'runtime' WHEN len(m.spoken_languages) > 0 AND len(p.languages) > 0 AND NOT list_has_any(m.spoken_languages, p.languages) THEN 'language' ELSE 'kept' END AS verdict
FROM movie_context m JOIN rt_page p ON {BARE.format('canonical_title')} = {BARE.format('title')} WHERE {BARE.format('title')} <> ''""")
def q_veto_filter(t):
    """Contradictions of year, runtime, language; what is missing never rejects."""
    m = t.movie_context.select("context_id", text.match_key(F.col("canonical_title")).alias("k"), "expected_year", "runtime_min", "spoken_languages")
    p = t.rt_page.select("page_id", text.match_key(F.col("title")).alias("k"), "release_year", F.col("runtime_min").alias("r2"), "languages")
    yes = lambda c: F.coalesce(c, F.lit(False))
    lang = (F.size("spoken_languages") > 0) & (F.size("languages") > 0) & ~F.arrays_overlap("spoken_languages", "languages")
    v = F.when(yes(F.abs(F.col("expected_year") - F.col("release_year")) > 3), "year").when(yes(F.abs(F.col("runtime_min") - F.col("r2")) > 20), "runtime").when(yes(lang), "language").otherwise("kept")
    return m.join(p, "k").where("k != ''").select("context_id", "page_id", v.alias("verdict"))


@query(f"""SELECT context_id, page_id, release_year IS NOT NULL AND expected_year IS NOT NULL AND abs(expected_year - release_year) <= 1 OR release_year IS NULL AND coalesce(abs(m.runtime_min - p.runtime_min) <= 20, false) AS strict,
coalesce(abs(expected_year - release_year) <= 3, true) AND (m.relax_runtime OR coalesce(abs(m.runtime_min - p.runtime_min) <= 20, true)) AS lenient FROM movie_context m JOIN letterboxd_page p ON {KEY.format('canonical_title')} = {KEY.format('title')}""")
def q_accept_gate(t):
    """A lenient gate, and a strict one in which the unknown rejects."""
    m = t.movie_context.select("context_id", text.literal_key(F.col("canonical_title")).alias("k"), "expected_year", "runtime_min", "relax_runtime")
    p = t.letterboxd_page.select("page_id", text.literal_key(F.col("title")).alias("k"), "release_year", F.col("runtime_min").alias("r2"))
    dy, dr = F.abs(F.col("expected_year") - F.col("release_year")), F.abs(F.col("runtime_min") - F.col("r2"))
    strict = (F.col("release_year").isNotNull() & F.col("expected_year").isNotNull() & F.coalesce(dy <= 1, F.lit(False))) | (F.col("release_year").isNull() & F.coalesce(dr <= 20, F.lit(False)))
    lenient = F.coalesce(dy <= 3, F.lit(True)) & (F.col("relax_runtime") | F.coalesce(dr <= 20, F.lit(True)))
    return m.join(p, "k").select("context_id", "page_id", strict.alias("strict"), lenient.alias("lenient"))


@query("""SELECT screening_id, CASE WHEN v.id IS NULL THEN 'venue' WHEN f.film_key IS NULL THEN 'film' WHEN startsAt IS NULL OR trim(startsAt) = '' THEN 'time' WHEN freshness.status IN ('stale', 'unknown') THEN 'stale'
WHEN freshness.retained THEN 'retained' WHEN confidence IS NULL OR confidence NOT IN ('venue-published', 'corroborated', 'single-source') THEN 'confidence' ELSE 'valid' END AS reason
FROM screenings s LEFT JOIN venues v ON s.venueId = v.id LEFT JOIN films f ON s.filmKey = f.film_key""")
def q_reason_cascade(t):
    """The first failing reason of a screening."""
    s = t.screenings.join(t.venues.select(F.col("id").alias("venueId"), F.lit(True).alias("v")), "venueId", "left").join(t.films.select(F.col("film_key").alias("filmKey"), F.lit(True).alias("f")), "filmKey", "left")
    r = F.when(F.col("v").isNull(), "venue").when(F.col("f").isNull(), "film").when(F.coalesce(F.trim("startsAt"), F.lit("")) == "", "time").when(F.col("freshness.status").isin("stale", "unknown"), "stale").when(F.col("freshness.retained"), "retained")
    r = r.when(~F.coalesce(F.col("confidence").isin("venue-published", "corroborated", "single-source"), F.lit(False)), "confidence").otherwise("valid")
    return s.select("screening_id", r.alias("reason"))


@query("""SELECT p_name, arg_min(p_partkey, (tier, -p_size, p_partkey)) AS chosen, min(tier) AS tier FROM (SELECT *, CASE WHEN p_type = 'ECONOMY' THEN 1 WHEN p_size > 40 THEN 2 ELSE 3 END AS tier FROM part) GROUP BY 1""")
def q_tiered_fallback(t):
    """The best of the first tier that has any."""
    tier = F.when(F.col("p_type") == "ECONOMY", 1).when(F.col("p_size") > 40, 2).otherwise(3)
    p = t.part.withColumn("tier", tier)
    return p.groupBy("p_name").agg(F.min_by("p_partkey", F.struct("tier", (-F.col("p_size")).alias("s"), "p_partkey")).alias("chosen"), F.min("tier").alias("tier"))


@query("""WITH al AS (SELECT DISTINCT p_name AS alias, regexp_replace(p_name, '^(small|red|large) ', '') AS target FROM part) SELECT target, count(*) AS n, count(DISTINCT alias) AS aliases FROM part JOIN al ON p_name = alias GROUP BY 1""")
def q_alias_redirect(t):
    """Alias to target to rows."""
    al = t.part.select(F.col("p_name").alias("alias")).distinct().withColumn("target", F.regexp_replace("alias", "^(small|red|large) ", ""))
    n = t.part.groupBy(F.col("p_name").alias("alias")).agg(F.count(F.lit(1)).alias("n"))
    return n.join(al, "alias").groupBy("target").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("aliases"))


@query("""WITH u AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(min(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cost FROM events WHERE event_type = 'purchase' GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY cost, day) AS rn FROM u)
SELECT a.user_id, min(a.cost + b.cost + 100) AS plan_cost FROM k a JOIN k b ON a.user_id = b.user_id AND a.day < b.day WHERE a.rn <= 10 AND b.rn <= 10 GROUP BY 1""")
def q_plan_partitions(t):
    """Best candidate per day, ten per member, two groups on distinct days at least cost."""
    u = t.events.where("event_type = 'purchase'").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.min(F.round(F.col("value") * 100).cast("bigint")).alias("cost"))
    k = u.withColumn("rn", F.row_number().over(Window.partitionBy("user_id").orderBy("cost", "day"))).where("rn <= 10").drop("rn")
    b = k.select("user_id", F.col("day").alias("d2"), F.col("cost").alias("c2"))
    return k.join(b, "user_id").where("day < d2").groupBy("user_id").agg(F.min(F.col("cost") + F.col("c2") + 100).alias("plan_cost"))


@query("""SELECT event_type, CASE WHEN n_ids < 2 OR n_ids > 4 THEN 'pick 2 to 4' WHEN usable = 0 THEN 'nothing usable' ELSE 'ok' END AS message, usable, best FROM (SELECT event_type, count(DISTINCT user_id % 5) AS n_ids, count(*) FILTER (WHERE value > 20) AS usable,
min(CASE WHEN value > 20 THEN 1000 * (CASE WHEN event_type = 'click' THEN 0 ELSE 1 END) + 100 * (user_id % 3) + hour(ts) * 60 + minute(ts) END) AS best FROM events GROUP BY 1)""")
def q_plan_single(t):
    """L3: usable rows, ranks, least cost, validation messages."""
    cost = 1000 * F.when(F.col("event_type") == "click", 0).otherwise(1) + 100 * (F.col("user_id") % 3) + F.hour("ts") * 60 + F.minute("ts")
    g = t.events.groupBy("event_type").agg(F.countDistinct(F.col("user_id") % 5).alias("n_ids"), F.count_if(F.col("value") > 20).alias("usable"), F.min(F.when(F.col("value") > 20, cost)).alias("best"))
    return g.select("event_type", F.when(~F.col("n_ids").between(2, 4), "pick 2 to 4").when(F.col("usable") == 0, "nothing usable").otherwise("ok").alias("message"), "usable", "best")


@query("""SELECT theatre, count(DISTINCT show_date) AS dates, count(*) FILTER (WHERE movie_title IS NULL OR movie_title LIKE '%Rental%') AS not_films, CASE WHEN count(DISTINCT show_date) < 3 THEN 'error' WHEN count(*) FILTER (WHERE show_time IS NULL) > 0 THEN 'warning' ELSE 'complete' END AS severity FROM showtime WHERE theatre IS NOT NULL GROUP BY 1""")
def q_guard_report(t):
    """Q1 Q3 Q4: completeness with severity instead of an exception."""
    g = t.showtime.where("theatre is not null").groupBy("theatre").agg(F.countDistinct("show_date").alias("dates"), F.count_if(F.expr("movie_title is null or movie_title like '%Rental%'")).alias("not_films"), F.count_if(F.col("show_time").isNull()).alias("no_time"))
    return g.select("theatre", "dates", "not_films", F.when(F.col("dates") < 3, "error").when(F.col("no_time") > 0, "warning").otherwise("complete").alias("severity"))


@query("""SELECT context_id, display_title, regexp_full_match(lower(trim(display_title)), '(private (theater|theatre) rental|gift card weekend|trivia night|mystery screening).*') AS not_film FROM movie_context WHERE display_title IS NOT NULL AND lower(display_title) NOT LIKE '%lobby%'""")
def q_inventory_filter(t):
    """Inventory that is no film by full match, ignored members by substring."""
    m = t.movie_context.where("display_title is not null and lower(display_title) not like '%lobby%'")
    return m.select("context_id", "display_title", F.lower(F.trim("display_title")).rlike("^(?:private (?:theater|theatre) rental|gift card weekend|trivia night|mystery screening).*$").alias("not_film"))
