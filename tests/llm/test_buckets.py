import random
from bisect import bisect_left

from brightreel.llm import packing


def _used(plan):
    out = {}
    for need, times in plan:
        for x, n in need.items():
            out[x] = out.get(x, 0) + n * times
    return out


def test_boundaries_decide_which_texts_share_a_batch():
    histogram = {500: 3, 300: 7, 200: 9, 40: 20, 12: 31}
    bounds = [[512], [50, 512], [12, 200, 300, 512]]
    plans = [packing.plan_batches(histogram, 512, b) for b in bounds]
    assert len({str(p) for p in plans}) == 3 and all(_used(p) == histogram for p in plans)
    # A batch that its bucket fills takes nothing from another bucket.
    full = packing.plan_batches({64: 80, 50: 10, 14: 10}, 512, [50, 64])
    assert full[0] == ({64: 8}, 10)


def test_little_room_is_left_empty():
    rng = random.Random(2)
    histogram = {}
    for _ in range(20_000):
        x = min(2048, max(1, int(rng.lognormvariate(5.5, 1.1))))
        histogram[x] = histogram.get(x, 0) + 1
    for buckets in (8, 32, 64):
        bounds = packing.optimal_buckets(histogram, buckets)
        plan = packing.plan_batches(histogram, 2048, bounds, packing.SLACK)
        room = 2048 * sum(n for _, n in plan)
        assert _used(plan) == histogram and all(sum(x * n for x, n in u.items()) <= 2048 for u, _ in plan)
        assert room - sum(x * n for x, n in histogram.items()) <= 0.005 * room
        inside = sum(n for u, n in plan if len({bisect_left(bounds, x) for x in u}) == 1)
        assert inside >= 0.2 * sum(n for _, n in plan)


def test_best_fill_is_the_largest_sum():
    rng = random.Random(4)
    for _ in range(200):
        lengths = sorted(rng.sample(range(1, 40), rng.randint(1, 5)))
        left, capacity = {x: rng.randint(1, 4) for x in lengths}, rng.randint(lengths[-1], 90)
        need = packing.best_fill(left, lengths, capacity)
        sums = {0}
        for x in lengths:
            sums = {s + x * n for s in sums for n in range(left[x] + 1) if s + x * n <= capacity} if x != lengths[-1] else {s + x * n for s in sums for n in range(1, left[x] + 1) if s + x * n <= capacity}
        assert sum(x * n for x, n in need.items()) == max(sums) and all(n <= left[x] for x, n in need.items()) and need[lengths[-1]] >= 1
