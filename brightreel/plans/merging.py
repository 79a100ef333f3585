"""Queries of merging, summarising, ranking: A*, D*, W*, X10, X15, F51."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from brightreel.functions import text
from brightreel.operators import relational as R
from brightreel.plans.base import query

CLOCK = r"""CASE WHEN regexp_matches(show_time, '^\s*\d{1,2}:\d{2}\s*[aApP][mM]\s*$')
 AND CAST(regexp_extract(show_time, '(\d{1,2}):', 1) AS INT) BETWEEN 1 AND 12 AND CAST(regexp_extract(show_time, ':(\d{2})', 1) AS INT) <= 59
 THEN CAST(regexp_extract(show_time, '(\d{1,2}):', 1) AS INT) % 12 * 60 + CAST(regexp_extract(show_time, ':(\d{2})', 1) AS INT)
 + CASE WHEN lower(show_time) LIKE '%p%' THEN 720 ELSE 0 END ELSE 1000000000 END"""


@query(f"""
WITH s AS (SELECT movie_title, theatre, show_date, show_time, {CLOCK} AS m, ingest_seq, runtime_min, a_list_excluded FROM showtime),
d AS (SELECT movie_title, theatre, show_date, string_agg(show_time, ', ' ORDER BY m, ingest_seq) AS times FROM s WHERE show_time IS NOT NULL GROUP BY 1, 2, 3),
t AS (SELECT movie_title, theatre, string_agg(strftime(show_date, '%Y-%m-%d') || ': ' || times, ' | ' ORDER BY show_date) AS dates FROM d WHERE theatre IS NOT NULL GROUP BY 1, 2),
b AS (SELECT movie_title, string_agg(theatre || ' > ' || dates, chr(10) ORDER BY theatre) AS showtimes FROM t GROUP BY 1),
a AS (SELECT movie_title, bool_or(coalesce(a_list_excluded, false)) AS any_excluded, count(*) AS n_rows,
      arg_min(runtime_min, CASE WHEN runtime_min IS NOT NULL THEN ingest_seq END) AS report_runtime FROM s WHERE movie_title IS NOT NULL GROUP BY 1)
SELECT a.movie_title, any_excluded, n_rows, showtimes,
  coalesce(f.runtimeMin, report_runtime) AS runtime, CASE WHEN f.runtimeMin IS NOT NULL THEN 0 WHEN report_runtime IS NOT NULL THEN 1 ELSE 2 END AS sort_rank,
  row_number() OVER (ORDER BY CASE WHEN f.runtimeMin IS NOT NULL THEN 0 WHEN report_runtime IS NOT NULL THEN 1 ELSE 2 END, coalesce(f.runtimeMin, report_runtime) DESC NULLS LAST, a.movie_title) AS movie_id
FROM a LEFT JOIN b USING (movie_title) LEFT JOIN films f ON a.movie_title = f.title""")
def q_movie_summary(t):
    """One row per title with its ordered programme, null-aware rank and number."""
    s = t.showtime.select("movie_title", "theatre", "show_date", "show_time", "ingest_seq", "runtime_min", "a_list_excluded").where("movie_title is not null")
    timed = s.where("show_time is not null and theatre is not null").withColumn("m", text.clock_minutes(F.col("show_time")))
    ordered = lambda c: F.array_sort(F.collect_list(c))
    join = lambda c, sep, field: F.array_join(F.transform(ordered(c), lambda x: x[field]), sep)
    days = timed.groupBy("movie_title", "theatre", "show_date").agg(join(F.struct("m", "ingest_seq", "show_time"), ", ", "show_time").alias("times"))
    places = days.groupBy("movie_title", "theatre").agg(join(F.struct("show_date", F.concat(F.date_format("show_date", "yyyy-MM-dd"), F.lit(": "), "times").alias("x")), " | ", "x").alias("dates"))
    blobs = places.groupBy("movie_title").agg(join(F.struct("theatre", F.concat("theatre", F.lit(" > "), "dates").alias("x")), "\n", "x").alias("showtimes"))
    facts = s.groupBy("movie_title").agg(F.bool_or(F.coalesce("a_list_excluded", F.lit(False))).alias("any_excluded"), F.count(F.lit(1)).alias("n_rows"), R.first_known("runtime_min", "ingest_seq").alias("report_runtime"))
    films = t.films.select(F.col("title").alias("movie_title"), "runtimeMin")
    out = facts.join(blobs, "movie_title", "left").join(films, "movie_title", "left")
    rank = F.when(F.col("runtimeMin").isNotNull(), 0).when(F.col("report_runtime").isNotNull(), 1).otherwise(2)
    out = out.select("movie_title", "any_excluded", "n_rows", "showtimes", F.coalesce("runtimeMin", "report_runtime").alias("runtime"), rank.alias("sort_rank"))
    return R.global_row_number(out, [F.col("sort_rank").asc(), F.col("runtime").desc_nulls_last(), F.col("movie_title").asc()], "movie_id")


@query("""WITH s AS (SELECT * FROM showtime WHERE trim(showtime_id) <> ''),
p AS (SELECT showtime_id, trim(string_split(format_label, ';')[i]) AS p, min((ingest_seq, i)) AS k FROM s, unnest(range(1, 20)) AS u(i)
 WHERE format_label IS NOT NULL AND i <= len(string_split(format_label, ';')) GROUP BY 1, 2),
f AS (SELECT showtime_id, string_agg(p, '; ' ORDER BY k) AS format_label FROM p GROUP BY 1),
a AS (SELECT showtime_id, arg_max(movie_title, (source_rank, ingest_seq)) AS movie_title, arg_max(show_date, (source_rank, ingest_seq)) AS show_date,
 arg_min(runtime_min, CASE WHEN runtime_min IS NOT NULL THEN ingest_seq END) AS runtime_min, bool_or(coalesce(a_list_excluded, false)) AS a_list_excluded, count(*) AS n_rows FROM s GROUP BY 1)
SELECT a.*, coalesce(format_label, '') AS format_label FROM a LEFT JOIN f USING (showtime_id)""")
def q_source_rank_merge(t):
    """A10: one row per showing id; per-field rules of rank, first known value, OR, ordered distinct union."""
    s = t.showtime.where("trim(showtime_id) != ''")
    return R.ranked_merge(s, "showtime_id", "source_rank", "ingest_seq", ["movie_title", "show_date"], ["runtime_min"], ["a_list_excluded"], ["format_label"])


@query("""SELECT movie_title, theatre, show_date, show_time, ingest_seq FROM showtime
QUALIFY row_number() OVER (PARTITION BY movie_title, theatre, show_date, show_time ORDER BY ingest_seq) = 1""")
def q_dedupe_first(t):
    """First row per key by arrival."""
    s = t.showtime.select("movie_title", "theatre", "show_date", "show_time", "ingest_seq")
    return s.groupBy("movie_title", "theatre", "show_date", "show_time").agg(F.min("ingest_seq").alias("ingest_seq"))


@query("""WITH ids AS (SELECT movie_title, theatre, show_date, show_time, min(showtime_id) AS sid, count(DISTINCT showtime_id) AS n FROM showtime WHERE trim(showtime_id) <> '' GROUP BY 1, 2, 3, 4)
SELECT s.ingest_seq, CASE WHEN n = 1 THEN sid END AS absorbed_into, coalesce(n, 0) AS n_ids FROM showtime s LEFT JOIN ids USING (movie_title, theatre, show_date, show_time)
WHERE s.showtime_id IS NULL OR trim(s.showtime_id) = ''""")
def q_absorb_idless(t):
    """Rows without id join the only id row of the same title, place, date and time."""
    s, key = t.showtime, ["movie_title", "theatre", "show_date", "show_time"]
    ids = s.where("trim(showtime_id) != ''").groupBy(*key, "showtime_id").agg(F.count(F.lit(1))).groupBy(*key).agg(F.min("showtime_id").alias("sid"), F.count(F.lit(1)).alias("n"))
    free = s.where("showtime_id is null or trim(showtime_id) = ''").select(*key, "ingest_seq")
    return free.join(ids, key, "left").select("ingest_seq", F.when(F.col("n") == 1, F.col("sid")).alias("absorbed_into"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n_ids"))


@query("""SELECT user_id, event_type, CAST(ts AS DATE) AS day, string_agg(strftime(ts, '%H:%M'), ', ' ORDER BY ts, event_id) AS times, count(*) AS n FROM events GROUP BY 1, 2, 3""")
def q_nested_listagg(t):
    """A2: ordered joined strings per group."""
    e = t.events.groupBy("user_id", "event_type", F.to_date("ts").alias("day"))
    times = F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id"))), lambda x: F.date_format(x["ts"], "HH:mm"))
    return e.agg(F.array_join(times, ", ").alias("times"), F.count(F.lit(1)).alias("n"))


@query("""SELECT theatre, show_date, arg_min(runtime_min, CASE WHEN runtime_min IS NOT NULL THEN ingest_seq END) AS first_runtime,
bool_or(coalesce(a_list_excluded, false)) AS any_excluded, count(*) AS n FROM showtime GROUP BY 1, 2""")
def q_first_non_null(t):
    """A1 A3: first known value and OR with null as false."""
    return t.showtime.groupBy("theatre", "show_date").agg(R.first_known("runtime_min", "ingest_seq").alias("first_runtime"), F.bool_or(F.coalesce("a_list_excluded", F.lit(False))).alias("any_excluded"), F.count(F.lit(1)).alias("n"))


@query("""SELECT context_id, CASE WHEN expected_year IS NOT NULL THEN 0 WHEN runtime_min IS NOT NULL THEN 1 ELSE 3 END AS rank,
CASE WHEN expected_year IS NOT NULL THEN expected_year WHEN runtime_min IS NOT NULL THEN runtime_min * 10 END AS score,
CASE WHEN expected_year IS NOT NULL THEN 'YEAR' WHEN runtime_min IS NOT NULL THEN 'RUNTIME' ELSE 'NONE' END AS source,
row_number() OVER (ORDER BY CASE WHEN expected_year IS NOT NULL THEN 0 WHEN runtime_min IS NOT NULL THEN 1 ELSE 3 END, CASE WHEN expected_year IS NOT NULL THEN expected_year WHEN runtime_min IS NOT NULL THEN runtime_min * 10 END DESC NULLS LAST, context_id) AS place FROM movie_context""")
def q_primary_cascade(t):
    """Ordered fallback of scores with its source, and the null-last order as a number."""
    y, r = F.col("expected_year"), F.col("runtime_min")
    c = t.movie_context.select("context_id", F.when(y.isNotNull(), 0).when(r.isNotNull(), 1).otherwise(3).alias("rank"), F.when(y.isNotNull(), y).when(r.isNotNull(), r * 10).alias("score"), F.when(y.isNotNull(), "YEAR").when(r.isNotNull(), "RUNTIME").otherwise("NONE").alias("source"))
    return R.global_row_number(c, [F.col("rank").asc(), F.col("score").desc_nulls_last(), F.col("context_id").asc()], "place")


@query("""WITH w AS (SELECT title_row, i, string_split(trim(regexp_replace(lower(display_title), '[^a-z0-9]+', ' ', 'g')), ' ')[i] AS k FROM title_info, unnest(range(1, 200)) AS u(i)
 WHERE i <= len(string_split(trim(regexp_replace(lower(display_title), '[^a-z0-9]+', ' ', 'g')), ' '))),
f AS (SELECT title_row, k, min(i) AS i FROM w WHERE k <> '' GROUP BY 1, 2) SELECT title_row, string_agg(k, ' ' ORDER BY i) AS words, count(*) AS n FROM f GROUP BY 1""")
def q_ordered_distinct(t):
    """Distinct words in order of first appearance."""
    words = F.array_distinct(F.filter(F.split(text.literal_key(F.regexp_replace("display_title", "&", " ")), " "), lambda x: x != ""))
    return t.title_info.select("title_row", words.alias("w")).where("size(w) > 0").select("title_row", F.array_join("w", " ").alias("words"), F.size("w").cast("bigint").alias("n"))


@query("""SELECT 1 + (r.n - 1) AS n_types, t.event_type, t.n AS n_events, t.users FROM (SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1) t, (SELECT count(DISTINCT event_type) AS n FROM events) r""")
def q_distinct_counts(t):
    """Distinct values and counters per bucket."""
    per = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"), F.countDistinct("user_id").alias("users"))
    return per.withColumn("n_types", F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))))


@query("""WITH s AS (SELECT user_id, CAST(ts AS DATE) AS day, list_sort(list(DISTINCT event_type)) AS kinds FROM events GROUP BY 1, 2),
p AS (SELECT *, lag(kinds) OVER (PARTITION BY user_id ORDER BY day) AS prev FROM s)
SELECT user_id, day, array_to_string(kinds, ',') AS kinds, array_to_string(list_sort(list_filter(kinds, lambda x: NOT list_contains(prev, x))), ',') AS added,
array_to_string(list_sort(list_filter(kinds, lambda x: list_contains(prev, x))), ',') AS kept, len(list_filter(prev, lambda x: NOT list_contains(kinds, x))) = 0 AS covers,
len(list_filter(prev, lambda x: NOT list_contains(kinds, x))) = 0 AND len(kinds) > len(prev) AS beyond, array_to_string(kinds[1:2], ',') AS first_two FROM p WHERE prev IS NOT NULL""")
def q_set_aggregates(t):
    """Sets per user and day against the day before."""
    s = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.array_sort(F.collect_set("event_type")).alias("kinds"))
    p = s.withColumn("prev", F.lag("kinds").over(Window.partitionBy("user_id").orderBy("day"))).where("prev is not null")
    gone = F.size(F.array_except("prev", "kinds"))
    return p.select("user_id", "day", F.array_join("kinds", ",").alias("kinds"), F.array_join(F.array_sort(F.array_except("kinds", "prev")), ",").alias("added"), F.array_join(F.array_sort(F.array_intersect("kinds", "prev")), ",").alias("kept"),
                    (gone == 0).alias("covers"), ((gone == 0) & (F.size("kinds") > F.size("prev"))).alias("beyond"), F.array_join(F.slice("kinds", 1, 2), ",").alias("first_two"))


@query("""SELECT theatre, arg_max(show_date, (titles, slots, known, -first_seq)) AS best_date, max((titles, slots, known, -first_seq))[1] AS best_titles FROM (
SELECT theatre, show_date, count(DISTINCT movie_title) AS titles, count(DISTINCT show_time) AS slots, count(runtime_min) AS known, min(ingest_seq) AS first_seq FROM showtime WHERE theatre IS NOT NULL GROUP BY 1, 2) GROUP BY 1""")
def q_argmax_snapshot(t):
    """The best snapshot by a list of keys, the first wins a tie."""
    snap = t.showtime.where("theatre is not null").groupBy("theatre", "show_date").agg(F.countDistinct("movie_title").alias("titles"), F.countDistinct("show_time").alias("slots"), F.count("runtime_min").alias("known"), F.min("ingest_seq").alias("first_seq"))
    key = F.struct("titles", "slots", "known", (-F.col("first_seq")).alias("f"))
    return snap.groupBy("theatre").agg(F.max_by("show_date", key).alias("best_date"), F.max(key)["titles"].alias("best_titles"))


@query("""SELECT theatre, count(DISTINCT movie_title) AS films, count(DISTINCT (movie_title, show_time)) AS slots, count(*) FILTER (WHERE showtime_id IS NULL) AS no_id,
count(*) FILTER (WHERE runtime_min IS NULL OR runtime_min NOT BETWEEN 30 AND 400) AS bad_runtime, count(*) FILTER (WHERE show_time IS NULL) AS no_time, count(*) AS n,
array_to_string(list_sort(list(DISTINCT strftime(show_date, '%Y-%m-%d')))[1:8], ',') AS first_dates FROM showtime WHERE theatre IS NOT NULL GROUP BY 1""")
def q_coverage_counts(t):
    """Distinct films and slots, conditional counters, first dates."""
    return t.showtime.where("theatre is not null").groupBy("theatre").agg(
        F.countDistinct("movie_title").alias("films"), F.countDistinct(F.struct("movie_title", "show_time")).alias("slots"), F.count_if(F.col("showtime_id").isNull()).alias("no_id"),
        F.count_if(F.expr("runtime_min is null or not runtime_min between 30 and 400")).alias("bad_runtime"), F.count_if(F.col("show_time").isNull()).alias("no_time"), F.count(F.lit(1)).alias("n"),
        F.array_join(F.slice(F.array_sort(F.collect_set(F.date_format("show_date", "yyyy-MM-dd"))), 1, 8), ",").alias("first_dates"))


@query("""SELECT o_custkey, min(o_orderdate) AS first_order, min(abs(CAST(o_totalprice * 100 AS BIGINT) - 10000000)) AS nearest, max(CAST(o_totalprice * 100 AS BIGINT)) AS largest, count(DISTINCT (o_orderstatus, o_orderpriority)) = 1 AS agrees FROM orders GROUP BY 1""")
def q_min_max_over_set(t):
    """Least, least distance, largest, agreement of tuples."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"), F.min(F.abs(cents - 10_000_000)).alias("nearest"), F.max(cents).alias("largest"), (F.countDistinct(F.struct("o_orderstatus", "o_orderpriority")) == 1).alias("agrees"))


@query("""SELECT p_brand, p_partkey, p_name, place FROM (SELECT p_brand, p_partkey, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY (p_name LIKE 'red%') DESC, (p_size <= 10) DESC,
CASE WHEN abs(p_size - 25) <= 5 THEN 3 WHEN abs(p_size - 25) <= 10 THEN 2 WHEN abs(p_size - 25) <= 20 THEN 1 ELSE -2 END DESC, p_retailprice DESC, p_partkey) AS place FROM part) WHERE place <= 4""")
def q_score_topk(t):
    """Rank by a list of keys, four per group."""
    d = F.abs(F.col("p_size") - 25)
    step = F.when(d <= 5, 3).when(d <= 10, 2).when(d <= 20, 1).otherwise(-2)
    w = Window.partitionBy("p_brand").orderBy(F.col("p_name").like("red%").desc(), (F.col("p_size") <= 10).desc(), step.desc(), F.col("p_retailprice").desc(), "p_partkey")
    return t.part.withColumn("place", F.row_number().over(w)).where("place <= 4").select("p_brand", "p_partkey", "p_name", "place")


@query("""SELECT o_custkey, arg_max(o_orderkey, (score, -o_orderkey)) AS best_order, max(score) AS best_score FROM (SELECT o_custkey, o_orderkey,
greatest(-25, 12 - 4 * abs(year(o_orderdate) - 1998)) + CASE WHEN o_orderstatus = 'F' THEN 10 ELSE 0 END + greatest(0, 15 - CAST(floor(o_totalprice / 50000) AS INT)) + CASE WHEN o_orderpriority LIKE '1%' THEN 2 ELSE 0 END AS score FROM orders) GROUP BY 1""")
def q_additive_score(t):
    """Clamped additive score, the smallest key wins a tie."""
    score = F.greatest(F.lit(-25), 12 - 4 * F.abs(F.year("o_orderdate") - 1998)) + F.when(F.col("o_orderstatus") == "F", 10).otherwise(0) + F.greatest(F.lit(0), 15 - F.floor(F.col("o_totalprice") / 50000).cast("int")) + F.when(F.col("o_orderpriority").like("1%"), 2).otherwise(0)
    s = t.orders.select("o_custkey", "o_orderkey", score.alias("score"))
    return s.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("score", (-F.col("o_orderkey")).alias("k"))).alias("best_order"), F.max("score").alias("best_score"))


@query("""SELECT event_type, CAST(ts AS DATE) AS day FROM events WHERE value > 50 UNION SELECT 'none', DATE '2024-01-01' EXCEPT SELECT event_type, CAST(ts AS DATE) FROM events WHERE value < 1""")
def q_set_ops(t):
    """Union, difference."""
    e = t.events.select("event_type", F.to_date("ts").alias("day"), "value")
    one = t.spark.range(1).select(F.lit("none").alias("event_type"), F.lit("2024-01-01").cast("date").alias("day"))
    return e.where("value > 50").select("event_type", "day").union(one).distinct().subtract(e.where("value < 1").select("event_type", "day"))


@query("""SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC NULLS LAST, c_name) AS movie_id FROM customer""")
def q_sequential_id(t):
    """Consecutive numbers in an order."""
    return R.global_row_number(t.customer.select("c_custkey", "c_acctbal", "c_name"), [F.col("c_acctbal").desc_nulls_last(), F.col("c_name").asc()], "movie_id").select("c_custkey", "movie_id")


@query("""SELECT p_name, arg_max(p_brand, p_partkey) AS last_brand, count(*) AS n FROM part GROUP BY 1""")
def q_lookup_last_wins(t):
    """The last value per key wins."""
    return t.part.groupBy("p_name").agg(F.max_by("p_brand", "p_partkey").alias("last_brand"), F.count(F.lit(1)).alias("n"))
