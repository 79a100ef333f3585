from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brightreel.functions import fuzzy, text
from brightreel.operators import relational as R
from brightreel.operators import stateful as S


def test_ranked_merge(spark):
    rows = [("a", 0, 1, "Old", 90, None, "3D"), ("a", 3, 2, "New", None, True, "Laser; 3D"), ("a", 3, 3, "Newest", 95, False, None), ("b", 1, 4, None, None, None, None)]
    df = spark.createDataFrame(rows, "k string, rk int, seq bigint, title string, runtime int, ex boolean, fmt string")
    got = {r.k: r for r in R.ranked_merge(df, "k", "rk", "seq", ["title"], ["runtime"], ["ex"], ["fmt"]).collect()}
    assert (got["a"].title, got["a"].runtime, got["a"].ex, got["a"].fmt, got["a"].n_rows) == ("Newest", 90, True, "3D; Laser", 3)
    assert (got["b"].title, got["b"].runtime, got["b"].ex, got["b"].fmt) == (None, None, False, "")
    assert R.ranked_merge(df.limit(0), "k", "rk", "seq", ["title"], ["runtime"], ["ex"], ["fmt"]).count() == 0


def test_unambiguous_and_first(spark):
    c = spark.createDataFrame([(1, 0, 5), (1, 1, 6), (2, 0, 5), (2, 0, 6), (2, 1, 7), (3, 1, 9), (3, 1, 9)], "k int, tier int, m int")
    assert sorted((r.k, r.m) for r in R.unambiguous(c, "k", "tier", "m").collect()) == [(1, 5), (3, 9)]
    f = R.first_per_key(c, ["k"], [F.col("m").desc()])
    assert sorted((r.k, r.m) for r in f.collect()) == [(1, 6), (2, 7), (3, 9)]


def test_as_of(spark):
    at = lambda m: datetime(2024, 1, 1, 0, m)
    a = spark.createDataFrame([("u", at(5), 1), ("u", at(1), 2), ("w", at(9), 3)], "k string, t timestamp, i int")
    b = spark.createDataFrame([("u", at(2), 1.0), ("u", at(5), 2.0)], "k string, t timestamp, v double")
    assert sorted((r.i, r.prev_value) for r in R.as_of(a, b, "k", "t", "t", "v").collect()) == [(1, 2.0), (2, None), (3, None)]


def test_global_row_number(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(500)], "a int, b int").repartition(5)
    got = R.global_row_number(df, [F.col("a").desc(), F.col("b").asc()], "n").collect()
    want = sorted(((i % 7, i) for i in range(500)), key=lambda x: (-x[0], x[1]))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.n)] == want and sorted(r.n for r in got) == list(range(1, 501))


def test_streaks_waits_budget(spark):
    log = spark.createDataFrame([("u", 1, "x", 0), ("u", 2, "e", 10), ("u", 3, "e", 20), ("u", 4, "x", 30), ("u", 5, "e", 40), ("v", 6, None, 50)], "k string, s int, kind string, us bigint")
    got = {r.s: r.streak for r in S.streaks(log, "k", ["s"], F.col("kind") == "e").collect()}
    assert got == {1: 0, 2: 1, 3: 2, 4: 0, 5: 1, 6: 0}
    w = {r.s: r.wait_us for r in S.waits(log, "k", ["s"], "us", F.col("kind") == "e", 15, 25).collect()}
    assert w == {1: 0, 2: 5, 3: 15, 4: 15, 5: 5, 6: 0}
    assert sorted(r.s for r in S.within_budget(log, "k", ["s"], "us", 30).collect()) == [1, 2, 3, 6]


def test_provenance(spark):
    wanted = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "k string, d int")
    side = lambda *r: spark.createDataFrame(list(r), "k string, d int, fetched_on string")
    got = {r.k: (r.fetched_on, r.source) for r in S.provenance(wanted, ["k", "d"], side(("a", 1, "l")), side(("a", 1, "t"), ("b", 1, "t")), side(("z", 1, "c"))).collect()}
    assert got == {"a": ("l", "live"), "b": ("t", "third"), "c": (None, "unknown")}


def test_text(spark):
    df = spark.createDataFrame([("  The Fox  &  the Hound (1981) ",), (None,), ("",)], "t string")
    r = df.select(text.collapse(F.col("t")).alias("a"), text.match_key(F.col("t")).alias("b"), text.identity_key(F.col("t")).alias("c"), text.slug(F.col("t")).alias("d")).collect()
    assert tuple(r[0]) == ("The Fox & the Hound (1981)", "fox and hound 1981", "the fox and the hound", "the-fox-the-hound-1981")
    assert tuple(r[1]) == (None,) * 4 and tuple(r[2]) == ("",) * 4


def test_clock(spark):
    cases = {"12:05 am": 5, "12:05 pm": 725, "7:00 pm": 1140, "13:00 pm": 10**9, "7:75 pm": 10**9, "x": 10**9}
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string")
    got = {r.t: r.m for r in df.select("t", text.clock_minutes(F.col("t")).alias("m")).collect()}
    assert got == {**cases, None: 10**9}


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", max_size=8), st.text("abc ", max_size=8))
def test_ratio_is_the_longest_common_subsequence(a, b):
    def lcs(x, y):
        return 0 if not x or not y else 1 + lcs(x[1:], y[1:]) if x[0] == y[0] else max(lcs(x[1:], y), lcs(x, y[1:]))

    want = 100.0 if not a and not b else 200.0 * lcs(a, b) / (len(a) + len(b))
    assert abs(fuzzy.ratio(a, b) - want) < 1e-9
    assert 0 <= fuzzy.token_set_ratio(a, b) <= 100


def test_token_set_ratio():
    assert fuzzy.token_set_ratio("silver foghorn", "foghorn silver returns") == 100.0
