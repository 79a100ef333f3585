"""Queries of extraction round trips, likeness ratios and streams: X4-X6, F4, F20, T4, T9."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightreel.functions import fuzzy, text
from brightreel.plans.base import query
from brightreel.sources.extract import escape_html, escape_part, parse_blob, showings
from brightreel.streaming import recent


@query(r"""SELECT movie_title, theatre, show_date, show_time FROM showtime WHERE movie_title IS NOT NULL AND theatre IS NOT NULL AND regexp_matches(show_time, '^\d{1,2}:\d{2} [ap]m$') AND NOT contains(theatre, chr(10))""")
def q_blob_parse(t):
    """The programme of a title as one text, read back into rows; only times like '7:00 pm', q_blob_parse_all has every notation."""
    s = t.showtime.where(F.col("movie_title").isNotNull() & F.col("theatre").isNotNull() & F.col("show_time").rlike(r"^\d{1,2}:\d{2} [ap]m$") & ~F.col("theatre").contains("\n"))
    days = s.groupBy("movie_title", "theatre", "show_date").agg(F.concat(F.lit("* "), F.date_format("show_date", "yyyy-MM-dd"), F.lit(": "), F.array_join(F.array_sort(F.collect_list("show_time")), ", ")).alias("line"))
    places = days.groupBy("movie_title", "theatre").agg(F.concat(F.lit("# "), "theatre", F.lit("\n"), F.array_join(F.array_sort(F.collect_list("line")), "\n")).alias("part"))
    blobs = places.groupBy("movie_title").agg(F.array_join(F.array_sort(F.collect_list("part")), "\n").alias("blob"))
    return parse_blob(blobs, "movie_title", "blob")


@query(r"""SELECT ingest_seq AS page_id, 'rendered' AS kind, showtime_id AS showing_id, movie_title AS title, show_time AS time FROM showtime WHERE regexp_matches(showtime_id, '^s\d+$') AND regexp_matches(movie_title, '^[A-Za-z ]+$') AND regexp_matches(movie_title, '^\S.*\S$') AND regexp_matches(show_time, '^\d{1,2}:\d{2} [ap]m$')""")
def q_page_showings(t):
    """Rows out of rendered pages; only titles of letters and spaces, q_page_showings_all has every title."""
    s = t.showtime.where(F.col("showtime_id").rlike(r"^s\d+$") & F.col("movie_title").rlike("^[A-Za-z ]+$") & F.col("movie_title").rlike(r"^\S.*\S$") & F.col("show_time").rlike(r"^\d{1,2}:\d{2} [ap]m$"))
    page = F.concat(F.lit('<html><title>x</title><section aria-label="Showtimes for '), "movie_title", F.lit('"><div><a href="/showtimes/'), "showtime_id", F.lit('">'), "show_time", F.lit("</a></div></section></html>"))
    return showings(s.select(F.col("ingest_seq").alias("page_id"), page.alias("html")))


@query(r"""WITH s AS (SELECT ingest_seq, showtime_id, regexp_extract(show_time, '(?i)\d{1,2}:\d{2}[\s\x{00A0}\x{202F}]*[ap]m') AS time FROM showtime WHERE regexp_matches(showtime_id, '^\w+$') AND movie_title IS NOT NULL)
SELECT ingest_seq AS page_id, 'heading' AS kind, showtime_id AS showing_id, 'Film ' || ingest_seq AS title, regexp_replace(time, '[\s\x{00A0}\x{202F}]+', ' ', 'g') AS time FROM s WHERE time <> ''""")
def q_page_headings(t):
    """Rows out of pages with headings but no labelled region."""
    s = t.showtime.where(F.col("showtime_id").rlike(r"^\w+$") & F.col("movie_title").isNotNull() & F.col("show_time").isNotNull())
    page = F.concat(F.lit("<html><h1>Showtimes</h1><h2>Film "), F.col("ingest_seq").cast("string"), F.lit('</h2><p>95 min</p><div><a href="/showtimes/'), "showtime_id", F.lit('">'), escape_html(F.col("show_time")), F.lit("</a></div></html>"))
    return showings(s.select(F.col("ingest_seq").alias("page_id"), page.alias("html")))


@query(r"""SELECT movie_title, theatre, show_date, show_time FROM showtime WHERE movie_title IS NOT NULL AND theatre IS NOT NULL AND show_date IS NOT NULL AND regexp_matches(show_time, '[^ \t\n\r\f]')""")
def q_blob_parse_all(t):
    """q_blob_parse over every row with all parts, in any notation; separators inside a part are escaped."""
    s = t.showtime.where(F.col("movie_title").isNotNull() & F.col("theatre").isNotNull() & F.col("show_date").isNotNull() & F.col("show_time").rlike(r"[^ \t\n\r\f]"))
    days = s.groupBy("movie_title", "theatre", "show_date").agg(F.concat(F.lit("* "), F.date_format("show_date", "yyyy-MM-dd"), F.lit(": "), F.array_join(F.array_sort(F.collect_list(escape_part(F.col("show_time")))), ", ")).alias("line"))
    places = days.groupBy("movie_title", "theatre").agg(F.concat(F.lit("# "), escape_part(F.col("theatre")), F.lit("\n"), F.array_join(F.array_sort(F.collect_list("line")), "\n")).alias("part"))
    blobs = places.groupBy("movie_title").agg(F.array_join(F.array_sort(F.collect_list("part")), "\n").alias("blob"))
    return parse_blob(blobs, "movie_title", "blob", escaped=True)


@query(r"""WITH s AS (SELECT ingest_seq, showtime_id, regexp_replace(movie_title, '^[\s\x{00A0}\x{202F}]+|[\s\x{00A0}\x{202F}]+$', '', 'g') AS title, regexp_extract(show_time, '(?i)\b\d{1,2}:\d{2}[\s\x{00A0}\x{202F}]*[ap]m\b') AS time FROM showtime WHERE regexp_matches(showtime_id, '^\w[^/]*$') AND movie_title IS NOT NULL)
SELECT ingest_seq AS page_id, 'rendered' AS kind, showtime_id AS showing_id, title, time FROM s WHERE time <> ''""")
def q_page_showings_all(t):
    """Rows out of rendered pages, of every row with an id and a clock link; texts are escaped in the page."""
    s = t.showtime.where(F.col("showtime_id").rlike(r"^\w[^/]*$") & F.col("movie_title").isNotNull() & F.col("show_time").isNotNull())
    page = F.concat(F.lit('<html><title>x</title><section aria-label="Showtimes for '), escape_html(F.col("movie_title")), F.lit('"><div><a href="/showtimes/'), escape_html(F.col("showtime_id")), F.lit('">'), escape_html(F.col("show_time")), F.lit("</a></div></section></html>"))
    return showings(s.select(F.col("ingest_seq").alias("page_id"), page.alias("html")))


@query()
def q_likeness(t):
    """Three ratios after blocking; no SQL engine has them, tests hold them against their definitions.

    A block is a first word, with or without leading articles and 'when'. Only
    distinct titles meet, and within a block no pair of ratio 82 is left out.
    """
    a = t.movie_context.select("context_id", fuzzy.fold_udf("canonical_title").alias("x"))
    b = t.films.select("film_id", fuzzy.fold_udf("title").alias("y"))
    like = fuzzy.like_titles(a.select(F.col("x").alias("title")), b.select(F.col("y").alias("title")), 82)
    return a.join(like, "x").join(b, "y").select("context_id", "film_id", "ratio", "token_set", "sequence")


@query("""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY date_trunc('hour', ts), event_type HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""")
def q_stream_hourly(t):
    """Windowed counts over a file stream, each hour written once, when the watermark has passed it; later rows are turned away."""
    out = recent.run_available(recent.hourly(recent.event_stream(t.spark, t.sf_dir)))
    return out.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("hour"), "event_type", "n", "cents")


@query("""WITH a AS (SELECT *, count(*) FILTER (WHERE event_type <> 'error') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM events),
s AS (SELECT user_id, ts, count(*) FILTER (WHERE event_type = 'error') OVER (PARTITION BY user_id, g ORDER BY ts, event_id) AS streak, event_type FROM a) SELECT user_id, ts AS opened_at FROM s WHERE streak = 3 AND event_type = 'error'""")
def q_stream_breaker(t):
    """A stateful stream that opens at three failures in a row."""
    return recent.run_available(recent.breaker(recent.event_stream(t.spark, t.sf_dir)))


@query(r"""WITH k AS (SELECT context_id, trim(regexp_replace(regexp_replace(lower(canonical_title), '&', ' and ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS x FROM movie_context), b AS (SELECT page_id, trim(regexp_replace(regexp_replace(lower(title), '&', ' and ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS x FROM rt_page)
SELECT x AS title, count(DISTINCT context_id) AS contexts, count(DISTINCT page_id) AS pages FROM k JOIN b USING (x) GROUP BY 1""")
def q_title_groups(t):
    """Records of two sources per title; both sides are counted before the join, so that no pair is built."""
    k = t.movie_context.groupBy(text.literal_key(F.col("canonical_title")).alias("title")).agg(F.countDistinct("context_id").alias("contexts"))
    b = t.rt_page.groupBy(text.literal_key(F.col("title")).alias("title")).agg(F.countDistinct("page_id").alias("pages"))
    return k.join(b, "title").select("title", "contexts", "pages")
