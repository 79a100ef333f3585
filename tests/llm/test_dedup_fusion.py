import random
from datetime import date

import numpy as np
from pyspark.sql import functions as F

from brightreel.llm import dedup, fusion

COLS = "ingest_seq bigint, movie_title string, theatre string, show_date date, show_time string, format_label string, runtime_min int, a_list_excluded boolean, showtime_id string, source_rank int, _key string"
D = date(2024, 1, 5)


def rows(spark, *r):
    return spark.createDataFrame([(s, t, th, d, ti, fmt, rt, ex, sid, rk, "clash") for s, t, th, d, ti, fmt, rt, ex, sid, rk in r], COLS)


def collapse(df):
    return sorted(map(tuple, dedup.collapse_duplicates(df, ["show_date"], ["movie_title", "theatre", "show_time"], "ingest_seq").collect()))


def test_copies(spark):
    df = rows(
        spark,
        (1, "The Fox", "Lumen A", D, "7:00 pm", None, None, None, None, 1), (2, "the  FOX!", "lumen-a", D, "7:00 p.m.", None, None, None, None, 1), (3, "7:00pm", "The Fox", D, "Lumen A", None, None, None, None, 1),
        (4, "The Fox", "Lumen A", date(2024, 1, 6), "7:00 pm", None, None, None, None, 1), (5, "The Fox", None, D, "7:00 pm", None, None, None, None, 1), (6, "The Fox", " - ", D, "7:00 pm", None, None, None, None, 1),
        (7, "The Fox", "Lumen A", None, "7:00 pm", None, None, None, None, 1), (8, "The Fox", "Lumen A", None, "7:00 pm", None, None, None, None, 1),
    )
    assert collapse(df) == [(1, 3), (4, 1), (5, 1), (6, 1), (7, 1), (8, 1)]
    assert collapse(df.limit(0)) == []


def test_against_brute_force(spark):
    rng = random.Random(3)
    data = [(i, rng.choice("abcd"), rng.choice("xyz"), D, f"{rng.randint(1, 60)}:00", None, None, None, None, 1) for i in range(1500)] + [(2000 + i, "hot", "hot2", D, "hot3", None, None, None, None, 1) for i in range(700)]
    groups = {}
    for r in data:
        groups.setdefault(tuple(sorted((r[1], r[2], r[4].replace(":", "")))), []).append(r[0])
    assert collapse(rows(spark, *data).repartition(7)) == sorted((min(g), len(g)) for g in groups.values())


def test_filters_never_lose_a_repeat(monkeypatch):
    h = np.random.default_rng(1).integers(-(2**62), 2**62, 5000)
    import pyarrow as pa

    def parts(x):
        return [b.to_pandas() for b in dedup.filter_segments(4)(iter([pa.RecordBatch.from_pydict({"h": pa.array(x)})]))]

    import pandas as pd

    monkeypatch.setattr(dedup, "HASHES", 700)  # several writes a task
    merged = pd.concat(parts(h[:3000]) + parts(np.concatenate([h[2000:], h[4900:]])))
    rows = pd.concat([dedup.merge_segments((k,), g) for k, g in merged.groupby("segment")])
    for folded, most in ((4, 0.05), (2, 0.2)):
        again = {k: dedup.fold_segments((k,), g)["words"][0].view(np.uint8) for k, g in rows.groupby(rows.segment & (folded - 1))}
        has = lambda x: all(np.unpackbits(again[x & (folded - 1)], bitorder="little")[(x >> p) & (dedup.SEGMENT_BITS - 1)] for p in dedup.PROBES)  # noqa: B023, E731
        hit = np.array([has(int(x)) for x in h.view(np.uint64)])
        assert hit[2000:3000].all() and hit[4900:].all() and hit[:2000].mean() < most


def test_without_a_filter_the_result_is_the_same(spark, monkeypatch):
    data = [(i, f"film {i % 900}", "x", D, "1:00", None, None, None, None, 1) for i in range(1500)]
    want = collapse(rows(spark, *data))
    monkeypatch.setattr(dedup, "MAX_BITS", 1 << 10)
    assert collapse(rows(spark, *data)) == want and sum(n for _, n in want) == 1500


def test_trust(spark):
    df = rows(
        spark,
        (1, "A", "T", D, "1", "3D", 95, None, "s1", 1), (2, "A", "T", D, "1", "n/a", 999, True, None, 3), (3, "a", "t", D, "1", "Laser", None, None, "  ", 1),  # one id among the copies
        (4, "B", "T", D, "1", None, 20, None, "s2", 0), (5, "B", "T", D, "1", "TBA", None, None, "s3", 0), (6, "B", "T", D, "1", "3D", None, None, None, 0),  # two ids: three showings
        (7, "C", "T", D, "1", None, None, None, "s2", 2),  # same id elsewhere
        (8, "E", None, D, "1", "3D", 90, True, None, 2), (9, "E", None, D, "1", "3D", 90, True, None, 2),  # no id, no key: apart
        (10, "F", "T", D, "2", "3D", 90, True, None, None), (11, "F", "T", D, "2", "Laser", 91, None, None, 0),
    )
    assert sorted(map(tuple, fusion.best_by_trust(df, 2).collect())) == [(1, 3, 1, 2), (4, 0, 0, 0), (10, 11, 11, 10)]
    assert sorted(r.first_seq for r in fusion.best_by_trust(df).collect()) == [1, 4, 5, 6, 8, 9, 10]
    assert fusion.best_by_trust(df.limit(0), 2).count() == 0


def test_the_rule_by_rank_runs_no_estimate(spark, monkeypatch):
    """p2_found's rule holds whatever an estimate says, so none is made; a lone highest rank wins against many that agree."""
    monkeypatch.setattr(fusion, "estimate", lambda *a, **k: (_ for _ in ()).throw(AssertionError("an estimate without effect")))
    monkeypatch.setattr(fusion, "_pattern", fusion.estimate)
    data = [(i, "A", "T", D, "1", "3D", 95, False, "s1", r) for i, r in enumerate((None, 0, 1, 2, 3, 4, 5), 1)] + [(8, "A", "T", D, "1", "Laser", 96, True, "s1", 9), (9, "A", "T", D, "1", "n/a", None, None, "s1", 11), (10, "A", "T", D, "1", "3D", 90, False, "s1", 8)]
    assert list(map(tuple, fusion.best_by_trust(rows(spark, *data), 2).collect())) == [(1, 8, 8, 8)]


def test_copied_votes_are_discounted():
    # Source 1 repeats source 0 also where both are wrong; 2, 3, 4 are independent and mostly right.
    rng = random.Random(5)
    counts = {}
    for _ in range(4000):
        truth, wrong = "t", lambda: f"w{rng.randint(0, 9)}"
        a = truth if rng.random() < 0.6 else wrong()
        b = a if rng.random() < 0.95 else truth
        c, d, e = (truth if rng.random() < 0.8 else wrong() for _ in range(3))
        p = fusion.pattern_of([a, b, c, d, e])
        counts[p] = counts.get(p, 0) + 1
    accuracy, depend, winner = fusion.estimate(counts, 5)
    assert depend[0][1] + depend[1][0] > 0.9 and depend[2][3] + depend[3][2] < 0.1 and min(accuracy[2:]) > max(accuracy[:2])
    assert winner["00112"] == 1  # two independent votes beat a vote and its copy


def test_fused(spark):
    data = [(10 * i + r, f"f{i}", "T", D, "1", None if r == 2 else ("3D" if r else "Laser"), 100 if r else 90, None, f"s{i}", r) for i in range(40) for r in range(4)]
    got = fusion.best_by_fusion(rows(spark, *data)).collect()
    assert len(got) == 40 and {(r.format_value, r.runtime_value, r.excluded_value, r.n) for r in got} == {("3D", "100", None, 4)}
    assert fusion.best_by_fusion(rows(spark, *data).limit(0)).count() == 0
    assert F
