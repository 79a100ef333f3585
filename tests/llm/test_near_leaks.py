import random

import pytest

from brightreel.llm import leakage


@pytest.mark.parametrize("errors", [0, 1, 2])
def test_every_offset_and_error_place(errors):
    own = [f"u{i}" for i in range(40)]
    matcher = leakage.Matcher([(7, " ".join(own))], 12, errors)
    rng = random.Random(errors)
    for s in range(len(own) - 11):
        for at in range(12) if errors else [0]:
            for kind in ("replace", "insert", "delete"):
                w = own[s : s + 12]
                for place in sorted({at, *(rng.sample(range(12), errors - 1) if errors > 1 else [])}, reverse=True)[:errors]:
                    w[place : place + (kind != "insert")] = [] if kind == "delete" else ["other"]
                got = matcher.match(" ".join(["before", *w, "after"]))
                least = leakage.myers(own[s : s + 12], w)
                assert [g[0] for g in got] == [7] and got[0][2] <= least <= errors, (s, at, kind)


@pytest.mark.parametrize("errors", [0, 1, 2])
def test_near_leaks_against_brute_force(errors):
    rng = random.Random(9)
    found = 0
    for _ in range(400):
        own = [rng.choice("abcdefgh") for _ in range(rng.randint(8, 30))]
        s = rng.randrange(len(own))
        text = own[s : s + rng.randint(9, 16)]
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(text) + 1)
            text[k : k + rng.randint(0, 1)] = [rng.choice("abcxyz")] * rng.randint(0, 1)
        text = ["p", *text, "q"]
        least = min((leakage.myers(own[i : i + 12], text) for i in range(len(own) - 11)), default=99)
        got = leakage.Matcher([(1, " ".join(own))], 12, errors).match(" ".join(text))
        assert [g[2] for g in got] == ([least] if least <= errors else [])
        found += len(got)
    assert found
