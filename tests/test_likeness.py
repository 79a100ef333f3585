import itertools
import random
import types

from brightreel.functions import fuzzy
from brightreel.plans import flows

WORDS = ["cosmic", "operator", "thunder", "sorrow", "sarrow", "elephant", "lantern", "of", "the", "a"]


def keys(x):
    words = x.split(" ")
    rest = list(itertools.dropwhile(lambda w: w in ("the", "a", "an", "when"), words))
    return {words[0], (rest or words[-1:])[0]}


def test_common_subsequence():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 70))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        assert fuzzy.common(a, b) == row[-1]


def test_likeness_of_titles_with_articles(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "BLOCK", 7)
    rng = random.Random(6)
    title = lambda: " ".join([rng.choice(["The", "A", "When", "Savage", "Café"]), *(rng.choice(WORDS) for _ in range(rng.randint(0, 4)))])
    a = [(i, title()) for i in range(150)] + [(900, "The Cosmic Operator of Thunder"), (901, None), (902, ""), (903, "Cosmic Operator of Thunder")]
    b = [(i, title()) for i in range(150)] + [(900, "The Cosmic Operator of Thunder"), (901, None), (902, "")]
    t = types.SimpleNamespace(movie_context=spark.createDataFrame(a, "context_id int, canonical_title string"), films=spark.createDataFrame(b, "film_id int, title string"))
    got = sorted((r.context_id, r.film_id, r.ratio) for r in flows.q_likeness(t).collect())
    want = sorted((i, j, r) for i, x in a for j, y in b if x is not None and y is not None for x, y in [(fuzzy.fold(x), fuzzy.fold(y))] if keys(x) & keys(y) and (r := round(fuzzy.ratio(x, y), 6)) >= 82)
    assert got == want and (900, 900, 100.0) in got and (903, 900) in {g[:2] for g in got}
