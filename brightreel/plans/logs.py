"""Queries over logs and state: W10, W12, A11, A15, D6, T*, P9."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from brightreel.operators import stateful as S
from brightreel.plans.base import query


def _us(c="ts"):
    return F.unix_micros(F.col(c).cast("timestamp"))


@query("""WITH a AS (SELECT *, count(*) FILTER (WHERE event_type <> 'error') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM events)
SELECT event_id, count(*) FILTER (WHERE event_type = 'error') OVER (PARTITION BY user_id, g ORDER BY ts, event_id) AS streak,
(count(*) FILTER (WHERE event_type = 'error') OVER (PARTITION BY user_id, g ORDER BY ts, event_id)) >= 3 AS is_open FROM a""")
def q_streak_circuit(t):
    """Failures since the last success; three open the circuit."""
    s = S.streaks(t.events.select("event_id", "user_id", "ts", "event_type"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")
    return s.select("event_id", "streak", (F.col("streak") >= 3).alias("is_open"))


@query("""WITH e AS (SELECT event_id, user_id, event_type, ts, epoch_us(ts) AS u FROM events),
w AS (SELECT *, lag(u) OVER x AS prev, max(CASE WHEN event_type = 'error' THEN u END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS block FROM e WINDOW x AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, greatest(0, coalesce(600000000 - (u - prev), 0), coalesce(3600000000 - (u - block), 0)) AS wait_us FROM w""")
def q_cooldown_wait(t):
    """Wait that spacing and cooldown leave."""
    e = t.events.select("event_id", "user_id", "event_type", "ts", _us().alias("u"))
    return S.waits(e, "user_id", ["ts", "event_id"], "u", F.col("event_type") == "error", 600_000_000, 3_600_000_000).select("event_id", "wait_us")


@query("""SELECT event_id FROM (SELECT event_id, coalesce(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM events) WHERE spent < 50000""")
def q_budget_prefix(t):
    """Rows begun within a budget."""
    e = t.events.select("event_id", "user_id", "ts", F.round(F.col("value") * 100).cast("bigint").alias("c"))
    return S.within_budget(e, "user_id", ["ts", "event_id"], "c", 50_000).select("event_id")


@query("""SELECT event_id, epoch_us(TIMESTAMP '2024-01-15 00:00:00') - epoch_us(ts) AS age_us FROM events WHERE epoch_us(TIMESTAMP '2024-01-15 00:00:00') - epoch_us(ts) BETWEEN -300000000 AND 172800000000""")
def q_recency_window(t):
    """Not more than 300 s ahead, not older than 48 h, from a given now."""
    now = F.unix_micros(F.lit("2024-01-15 00:00:00").cast("timestamp"))
    # The bound on ts itself reaches the scan.
    e = t.events.where("ts >= timestamp_ntz'2024-01-13 00:00:00' and ts <= timestamp_ntz'2024-01-15 00:05:00'")
    return e.select("event_id", (now - _us()).alias("age_us")).where("age_us between -300000000 and 172800000000")


@query("""WITH m AS (SELECT movie_title, theatre, show_date, max(source_rank) >= 2 AS fresh FROM showtime WHERE theatre IS NOT NULL GROUP BY 1, 2, 3)
SELECT movie_title, count(*) AS combos, count(*) FILTER (WHERE fresh) AS fresh, CASE WHEN count(*) FILTER (WHERE fresh) = count(*) THEN 'fresh' WHEN count(*) FILTER (WHERE fresh) = 0 THEN 'cached' ELSE 'mixed (' || count(*) FILTER (WHERE fresh) || '/' || count(*) || ')' END AS label FROM m GROUP BY 1""")
def q_freshness_mix(t):
    """Fresh, cached or mixed by the title's combinations of theatre and date."""
    m = t.showtime.where("theatre is not null").groupBy("movie_title", "theatre", "show_date").agg((F.max("source_rank") >= 2).alias("f"))
    g = m.groupBy("movie_title").agg(F.count(F.lit(1)).alias("combos"), F.count_if("f").alias("fresh"))
    mixed = F.concat(F.lit("mixed ("), F.col("fresh").cast("string"), F.lit("/"), F.col("combos").cast("string"), F.lit(")"))
    return g.withColumn("label", F.when(F.col("fresh") == F.col("combos"), "fresh").when(F.col("fresh") == 0, "cached").otherwise(mixed))


@query("""WITH k AS (SELECT DISTINCT theatre, show_date FROM showtime WHERE theatre IS NOT NULL AND show_date IS NOT NULL),
s AS (SELECT theatre, show_date, max(CASE WHEN source_rank = 3 THEN CAST(timezone('UTC', ingested_at) AS DATE) END) AS live, max(CASE WHEN source_rank = 1 THEN CAST(timezone('UTC', ingested_at) AS DATE) END) AS third, max(CASE WHEN source_rank = 0 THEN CAST(timezone('UTC', ingested_at) AS DATE) END) AS cached FROM showtime GROUP BY 1, 2)
SELECT theatre, show_date, coalesce(live, third, cached) AS fetched_on, CASE WHEN live IS NOT NULL THEN 'live' WHEN third IS NOT NULL THEN 'third' WHEN cached IS NOT NULL THEN 'cached' ELSE 'unknown' END AS source FROM k LEFT JOIN s USING (theatre, show_date)""")
def q_provenance_precedence(t):
    """Precedence of sources per theatre and date."""
    s = t.showtime.where("theatre is not null and show_date is not null").select("theatre", "show_date", "source_rank", F.to_date("ingested_at").alias("fetched_on"))
    side = lambda r: s.where(F.col("source_rank") == r).drop("source_rank")
    return S.provenance(s.select("theatre", "show_date").distinct(), ["theatre", "show_date"], side(3), side(1), side(0))


@query("""WITH e AS (SELECT *, epoch_us(ts) AS u, lag(event_type) OVER w AS p1, lag(event_type, 2) OVER w AS p2, min(epoch_us(ts)) OVER (PARTITION BY user_id) AS u0 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id FROM e WHERE event_type = p1 AND event_type = p2 AND u - u0 >= 5000000 GROUP BY 1""")
def q_stable_samples(t):
    """First point with three equal samples and five seconds."""
    e = t.events.select("event_id", "user_id", "ts", "event_type", _us().alias("u"))
    return S.stable_from(e, "user_id", ["ts", "event_id"], "event_type", "u", 3, 5_000_000).select("user_id", "event_id")


@query("""WITH a AS (SELECT o_custkey, o_orderdate, CASE WHEN o_orderkey % 2 = 0 THEN 'old' ELSE 'new' END AS run, CASE WHEN o_orderpriority LIKE '1%' THEN 26 ELSE 27 END AS version FROM orders),
o AS (SELECT o_custkey, min(o_orderdate) AS first_seen FROM a WHERE run = 'old' AND version >= 27 GROUP BY 1), n AS (SELECT o_custkey, min(o_orderdate) AS now_seen, count(*) AS n FROM a WHERE run = 'new' GROUP BY 1)
SELECT n.o_custkey, coalesce(first_seen, now_seen) AS dated, first_seen IS NOT NULL AS carried, n FROM n LEFT JOIN o USING (o_custkey)""")
def q_state_versions(t):
    """Earlier state of a trusted version keeps its date; the rest is dated anew."""
    a = t.orders.select("o_custkey", "o_orderdate", (F.col("o_orderkey") % 2 == 0).alias("old"), F.when(F.col("o_orderpriority").like("1%"), 26).otherwise(27).alias("version"))
    o = a.where("old and version >= 27").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_seen"))
    n = a.where("not old").groupBy("o_custkey").agg(F.min("o_orderdate").alias("now_seen"), F.count(F.lit(1)).alias("n"))
    return n.join(o, "o_custkey", "left").select("o_custkey", F.coalesce("first_seen", "now_seen").alias("dated"), F.col("first_seen").isNotNull().alias("carried"), "n")


@query("""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, list_sort(list(DISTINCT event_type)) AS s FROM events GROUP BY 1, 2), p AS (SELECT *, lag(s) OVER (PARTITION BY user_id ORDER BY day) AS q FROM d)
SELECT CASE WHEN q IS NULL THEN 'first' WHEN NOT list_has_any(s, q) THEN 'live' WHEN len(list_filter(s, lambda x: NOT list_contains(q, x))) = 0 THEN 'reused' ELSE 'mixed' END AS outcome, count(*) AS n FROM p GROUP BY 1""")
def q_outcome_sets(t):
    """Outcome by what the sets share."""
    d = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.collect_set("event_type").alias("s"))
    p = d.withColumn("q", F.lag("s").over(Window.partitionBy("user_id").orderBy("day")))
    o = F.when(F.col("q").isNull(), "first").when(~F.arrays_overlap("s", "q"), "live").when(F.size(F.array_except("s", "q")) == 0, "reused").otherwise("mixed")
    return p.groupBy(o.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
