"""Problem 2: the best representative of each duplicate group.

Method: Bayesian fusion with copy detection. The sources are the ranks; the
votes on a field of a showing are, per source, its latest usable value.
Accuracies of the sources and their dependence are estimated from all
showings, the votes of a source that copies another are discounted, and the
value with the largest posterior wins; the best report that gives it supplies
the field.

That is p2_fused. For p2_found the data notes fix the rule: of the usable values
the one of the highest rank, then of the latest arrival. No estimate could
change that, so none is made: p2_found takes from the grouped reports, per
field, the greatest of rank and arrival.

What the estimation needs of the data is, for each showing, only which sources
agree with each other. There are few such patterns (4,140 for seven sources,
at most), so the counts per pattern are gathered from all rows, whatever their
number, and the estimate is made from these counts.

Keys of copies travel as two hashes of 64 bits, values of fields as one; what
they stand for is looked up at the end.

Defined results: null, blank and placeholder values never supply a field; a
field without usable value gets sequence number 0 and a null value; equal rank
falls back on the latest arrival; reports without rank are one more source,
trusted least, those of ranks beyond MAX_SOURCES another, trusted most;
repeated rows are rows of one showing; rows without id and without complete
key are showings of their own; an empty table gives no showings; further
columns are ignored.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightreel.llm.dedup import canonical_key
from brightreel.session import cut, table

# Words that stand for no value; marks without letter or digit stand for none either.
NO_VALUE = ["na", "none", "null", "nan", "nil", "unknown", "tba", "tbd", "tbc", "undefined", "missing", "notavailable", "nodata", "novalue", "notset", "unspecified", "empty", "blank"]
RUNTIME = (30, 400)
MAX_SOURCES = 5
SOURCES = MAX_SOURCES + 2  # no rank; further ranks
#: Weight of arrival order below the rank in one number.
SEQ_BITS = 44
TOP_RANK = (1 << 18) - 1


def usable_label(c: Column) -> Column:
    word = F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]+", ""))
    return F.when((word != "") & ~word.isin(NO_VALUE), c)


def usable_runtime(c: Column) -> Column:
    return F.when(c.between(*RUNTIME), c)


FIELDS = {"format": ("format_label", usable_label, lambda c: F.when(c.isNotNull(), F.xxhash64(c))), "runtime": ("runtime_min", usable_runtime, lambda c: c.cast("bigint")), "excluded": ("a_list_excluded", lambda c: c, lambda c: c.cast("bigint"))}


def _reports(shows: DataFrame) -> DataFrame:
    """(sid, k1, k2, seq, source, code, and per field its usable value as a number)."""
    seq = F.coalesce(F.col("ingest_seq"), F.lit(0)).cast("bigint")
    rank = F.least(F.greatest(F.coalesce(F.col("source_rank"), F.lit(-1)), F.lit(-1)), F.lit(TOP_RANK)).cast("bigint")
    source = F.when(rank < 0, MAX_SOURCES).when(rank >= MAX_SOURCES, MAX_SOURCES + 1).otherwise(rank).cast("int")
    sid = F.when(F.trim(F.regexp_replace("showtime_id", r"[\s\u00a0]+", " ")) != "", F.col("showtime_id"))
    own = shows.select(
        sid.alias("sid"), canonical_key(["show_date"], ["movie_title", "theatre", "show_time"]).alias("key"), seq.alias("seq"), source.alias("source"), (F.shiftleft(rank + 1, SEQ_BITS) + seq).alias("code"),
        *[number(usable(F.col(c))).alias(f) for f, (c, usable, number) in FIELDS.items()],
    )
    hashes = [F.when(F.col("key").isNotNull(), h).alias(n) for n, h in (("k1", F.xxhash64("key")), ("k2", F.xxhash64(F.lit(1), "key")))]
    return own.select("sid", *hashes, "seq", "source", "code", *FIELDS)


def _votes() -> list[Column]:
    """Per field the best report with a usable value, and the value."""
    return [c for f in FIELDS for c in (F.max(F.when(F.col(f).isNotNull(), F.col("code"))).alias(f"{f}_code"), F.max_by(f, F.when(F.col(f).isNotNull(), F.col("code"))).alias(f"{f}_v"))]


def showings(shows: DataFrame, sources: int = SOURCES) -> tuple[DataFrame, DataFrame]:
    """(showings with an id or a key; rows that are showings of their own), each with n, first_seq and the votes of all sources.

    Rows are first merged per (copy key, id, source), which absorbs hot keys
    on the map side. Rows without id take the one id of their copies; where
    there are two ids they stay apart, one showing per row. With one of
    ``sources`` all reports count as of the same.
    """
    reports = _reports(shows)
    if sources == 1:
        reports = reports.withColumn("source", F.lit(0))
    merged = cut(reports.where("sid is not null or k1 is not null").groupBy("k1", "k2", "sid", "source").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"), *_votes()))
    # Two ids or more, if the least and the greatest differ.
    ids = merged.where("sid is not null and k1 is not null").groupBy("k1", "k2").agg(F.min("sid").alias("only"), F.max("sid").alias("last"))
    free = merged.where("sid is null").drop("sid").join(ids, ["k1", "k2"], "left").withColumn("apart", F.coalesce(F.col("only") != F.col("last"), F.lit(False)))
    rest = ["source", "n", "first_seq", *[f"{f}_{x}" for f in FIELDS for x in ("code", "v")]]
    null = F.lit(None).cast("bigint")
    key = lambda k: F.when(F.col("only").isNull(), F.col(k)).alias(k)
    both = merged.where("sid is not null").select("sid", null.alias("k1"), null.alias("k2"), *rest).unionByName(free.where("not apart").select(F.col("only").alias("sid"), key("k1"), key("k2"), *rest))
    of = lambda c, s: F.when(F.col("source") == s, F.col(c))
    per_source = [c for f in FIELDS for s in range(sources) for c in (F.max(of(f"{f}_code", s)).alias(f"{f}_code{s}"), F.max_by(f"{f}_v", of(f"{f}_code", s)).alias(f"{f}_v{s}"))]
    whole = both.groupBy("sid", "k1", "k2").agg(F.sum("n").alias("n"), F.min("first_seq").alias("first_seq"), *per_source)
    lone = reports.where("sid is null and k1 is null")
    split = reports.where("sid is null and k1 is not null").join(free.where("apart").select("k1", "k2").distinct(), ["k1", "k2"], "left_semi").select(*lone.columns)
    single = lone.unionByName(split)
    own = [c for f in FIELDS for s in range(sources) for c in (F.when(F.col(f).isNotNull(), of("code", s)).alias(f"{f}_code{s}"), of(f, s).alias(f"{f}_v{s}"))]
    return _listed(whole, sources), _listed(single.select(F.lit(1).cast("bigint").alias("n"), F.col("seq").alias("first_seq"), *own), sources)


def _listed(df: DataFrame, sources: int) -> DataFrame:
    """Per field the codes and values of all sources as arrays."""
    each = lambda f, x: F.array(*[F.col(f"{f}_{x}{s}") for s in range(sources)]).alias(f"{f}_{x}")
    return df.select("n", "first_seq", *[each(f, x) for f in FIELDS for x in ("code", "v")])


def pattern_of(votes: list[str | None]) -> str:
    """Which sources agree: per source the number of its value in order of appearance, or '-'."""
    seen: dict[str, int] = {}
    return "".join("-" if v is None else str(seen.setdefault(v, len(seen))) for v in votes)


def estimate(counts: dict[str, float], sources: int, false_values: int = 10, copy_share: float = 0.8, prior_dependence: float = 0.2, rounds: int = 30) -> tuple[list[float], list[list[float]], dict[str, int]]:
    """Accuracies, dependence and the winner per pattern, from counts per pattern.

    Accuracy is the share of a source's votes that are right; the dependence of
    a pair follows by Bayes' rule from how often the two share a false value,
    share a true one and differ. Of two dependent sources the one whose
    accuracy beside the other is less like its accuracy elsewhere is more
    likely the copier: ``depend[a][b]`` is the chance that a copies b. A vote
    counts less by the chance that it is copied from a source counted before.
    """
    accuracy = [0.8] * sources
    depend = [[0.0] * sources for _ in range(sources)]
    posterior: dict[str, dict[str, float]] = {}

    def weight(s: int) -> float:
        return math.log(false_values * accuracy[s] / (1 - accuracy[s]))

    def beliefs(p: str) -> dict[str, float]:
        score: dict[str, float] = {}
        order = sorted((s for s in range(sources) if p[s] != "-"), key=lambda s: -weight(s))
        for i, s in enumerate(order):
            free = math.prod(1 - copy_share * max(depend[s][o], depend[o][s]) for o in order[:i] if p[o] == p[s])
            score[p[s]] = score.get(p[s], 0) + free * weight(s)
        top = max(score.values())
        # The values that nobody names share the rest.
        unseen = max(0, false_values + 1 - len(score)) * math.exp(-top)
        total = sum(math.exp(max(-700.0, x - top)) for x in score.values()) + unseen
        return {v: math.exp(max(-700.0, x - top)) / total for v, x in score.items()}

    def rate(s: int, beside: int, there: bool) -> float:
        """Accuracy of s on showings where ``beside`` votes, or where it does not."""
        own = [(c, p) for p, c in counts.items() if p[s] != "-" and (p[beside] != "-") == there]
        return (sum(c * posterior[p][p[s]] for c, p in own) + 4 * accuracy[s]) / (sum(c for c, _ in own) + 4)

    for _ in range(rounds):
        posterior = {p: beliefs(p) for p in counts if set(p) != {"-"}}
        for s in range(sources):
            n = sum(c for p, c in counts.items() if p[s] != "-")
            right = sum(c * posterior[p][p[s]] for p, c in counts.items() if p[s] != "-")
            accuracy[s] = min(0.99, max(0.01, (right + 0.8) / (n + 1)))
        for a in range(sources):
            for b in range(a):
                true = false = apart = 0.0
                for p, c in counts.items():
                    if "-" in (p[a], p[b]):
                        continue
                    if p[a] != p[b]:
                        apart += c
                    else:
                        true, false = true + c * posterior[p][p[a]], false + c * (1 - posterior[p][p[a]])
                if not true + false + apart:
                    continue  # the two never meet
                x, y = accuracy[a], accuracy[b]
                both, wrong = x * y, (1 - x) * (1 - y) / false_values
                copied = lambda free, own: copy_share * own + (1 - copy_share) * free
                odds = math.log(prior_dependence / (1 - prior_dependence))
                odds += true * math.log(copied(both, x) / both) + false * math.log(copied(wrong, 1 - x) / wrong) + apart * math.log(1 - copy_share)
                either = 1 / (1 + math.exp(-max(-50, min(50, odds))))
                change = [abs(rate(s, o, True) - rate(s, o, False)) + 0.01 for s, o in ((a, b), (b, a))]
                depend[a][b], depend[b][a] = (either * c / sum(change) for c in change)
    winner = {p: int(max(sorted(v), key=lambda k: v[k])) for p, v in posterior.items()}
    return accuracy, depend, winner


def _pattern(votes: str, distinct: str) -> Column:
    """The pattern of a showing's votes, as pattern_of gives it, without leaving the JVM."""
    marks = F.transform(votes, lambda v: F.when(v.isNull(), F.lit("-")).otherwise((F.array_position(F.col(distinct), v) - 1).cast("string")))
    return F.array_join(marks, "")


def fuse(shows: DataFrame) -> DataFrame:
    """(first_seq, n, and per field the value of largest posterior) of all showings."""
    spark = shows.sparkSession
    whole, single = showings(shows)
    whole = whole.unionByName(single)
    whole = whole.select("*", *[F.array_distinct(F.array_compact(f"{f}_v")).alias(f"{f}_distinct") for f in FIELDS])
    whole = cut(whole.select("first_seq", "n", *[f"{f}_{x}" for f in FIELDS for x in ("v", "distinct")], *[_pattern(f"{f}_v", f"{f}_distinct").alias(f"{f}_pattern") for f in FIELDS]))
    # At most 4,140 patterns of seven sources for each field, however many rows there are.
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"{f}_pattern").alias("p")) for f in FIELDS]))
    counts = whole.select(each.alias("x")).groupBy("x.f", "x.p").count().collect()
    out = whole
    for f in FIELDS:
        _, _, winner = estimate({r.p: float(r["count"]) for r in counts if r.f == f}, SOURCES)
        choice = spark.createDataFrame(pd.DataFrame(list(winner.items()) or [("", 0)], columns=[f"{f}_pattern", f"{f}_win"]))
        out = out.join(F.broadcast(choice), f"{f}_pattern", "left").withColumn(f"{f}_best", F.get(f"{f}_distinct", F.col(f"{f}_win").cast("int")))
    return out.select("first_seq", "n", *[F.col(f"{f}_best").alias(f"{f}_v") for f in FIELDS])


def best_by_trust(shows: DataFrame, least_rows: int = 1) -> DataFrame:
    """(first_seq, format_seq, runtime_seq, excluded_seq) of the showings with ``least_rows`` rows or more: by rank, then arrival."""
    whole, single = showings(shows, 1)
    whole = whole.where(F.col("n") >= least_rows) if least_rows > 1 else whole.unionByName(single)
    seq = lambda f: F.coalesce(F.array_max(f"{f}_code").bitwiseAND(F.lit((1 << SEQ_BITS) - 1)), F.lit(0).cast("bigint")).alias(f"{f}_seq")
    return whole.select("first_seq", *[seq(f) for f in FIELDS])


def best_by_fusion(shows: DataFrame) -> DataFrame:
    """(first_seq, n, and per field the value of largest posterior); each row counts in one showing."""
    label = FIELDS["format"][1](F.col("format_label"))
    labels = shows.select(label.alias("format_value")).where("format_value is not null").distinct().withColumn("format_v", F.xxhash64("format_value"))
    fused = fuse(shows).join(labels, "format_v", "left")
    return fused.select("first_seq", "n", "format_value", F.col("runtime_v").cast("string").alias("runtime_value"), F.col("excluded_v").cast("boolean").cast("string").alias("excluded_value"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_by_trust(table(spark, sf_dir, "showtime"), least_rows=2)


def p2_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_by_fusion(table(spark, sf_dir, "showtime"))


P2_SQL = r"""
WITH reports AS (
  SELECT ingest_seq AS seq, source_rank AS rk, show_date,
         CASE WHEN trim(regexp_replace(showtime_id, '[\s\x{00A0}]+', ' ', 'g')) <> '' THEN showtime_id END AS sid,
         lower(regexp_replace(movie_title, '[^\p{L}\p{M}\p{N}]+', '', 'g')) AS a,
         lower(regexp_replace(theatre, '[^\p{L}\p{M}\p{N}]+', '', 'g')) AS b,
         lower(regexp_replace(show_time, '[^\p{L}\p{M}\p{N}]+', '', 'g')) AS c,
         CASE WHEN lower(regexp_replace(format_label, '[^\p{L}\p{N}]+', '', 'g')) NOT IN
           ('', 'na', 'none', 'null', 'nan', 'nil', 'unknown', 'tba', 'tbd', 'tbc', 'undefined', 'missing', 'notavailable',
            'nodata', 'novalue', 'notset', 'unspecified', 'empty', 'blank') THEN 1 END AS f,
         CASE WHEN runtime_min BETWEEN 30 AND 400 THEN 1 END AS r,
         CASE WHEN a_list_excluded IS NOT NULL THEN 1 END AS x
  FROM showtime),
keyed AS (
  SELECT *, CASE WHEN show_date IS NOT NULL AND a <> '' AND b <> '' AND c <> ''
            THEN CAST(show_date AS VARCHAR) || CAST(list_sort([a, b, c]) AS VARCHAR) END AS k
  FROM reports),
ids AS (SELECT k, count(DISTINCT sid) AS n_ids, min(sid) AS only_id FROM keyed WHERE k IS NOT NULL GROUP BY k),
placed AS (
  SELECT t.*, CASE WHEN sid IS NOT NULL THEN 'i' || sid
                   WHEN t.k IS NULL OR n_ids > 1 THEN 's' || seq
                   WHEN n_ids = 1 THEN 'i' || only_id
                   ELSE 'k' || t.k END AS showing
  FROM keyed t LEFT JOIN ids ON t.k = ids.k)
SELECT min(seq) AS first_seq,
       coalesce(arg_max(CASE WHEN f = 1 THEN seq END, CASE WHEN f = 1 THEN (rk, seq) END), 0) AS format_seq,
       coalesce(arg_max(CASE WHEN r = 1 THEN seq END, CASE WHEN r = 1 THEN (rk, seq) END), 0) AS runtime_seq,
       coalesce(arg_max(CASE WHEN x = 1 THEN seq END, CASE WHEN x = 1 THEN (rk, seq) END), 0) AS excluded_seq
FROM placed GROUP BY showing HAVING count(*) >= 2
"""
