"""Problem 7: filling fixed-capacity containers with texts.

Method: optimal length buckets. The global histogram of lengths (at most
``capacity`` entries, however many texts there are) goes to the driver;
dynamic programming chooses the bucket boundaries with the least padding;
token-budget batches form inside each bucket, from the longest bucket down:
the texts of the bucket that fill the capacity best, by subset sums over its
lengths. A batch that its bucket can't fill but for ``slack`` tokens is
repacked: what is left over of a bucket takes the longest texts of shorter
buckets that still fit.

The plan names, per length, how many texts of it go to which sequences; it is
as long as the number of different batches, which the histogram bounds. Each
text finds its sequence by its rank among the texts of its length. Ranks come
from counts per part and length, so that a length that a third of all texts
share is never sorted in one task.

A text longer than the capacity is cut into pieces: full ones, which are
sequences of their own, and the rest, which is packed as a text.

Defined results: null and empty texts have no tokens and get no sequence
(null); equal lengths are ranked by id and piece; repeated ids are packed each;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightreel.session import cut, env_path, table

CAPACITY = 2048
BUCKETS = 32
#: A batch of one bucket may leave a sequence short by so many tokens; others are repacked.
SLACK = 2
#: Rank file of a public tokenizer; a parameter, the file is not part of this repository.
TOKENIZER = env_path("BRIGHTREEL_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: the split pattern of that vocabulary.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict[str, object] = {}


def encoder(path: str):
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _encoders[path] = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def token_counts(df: DataFrame, id_column: str, text_column: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(id, n_tokens) of each text, measured over the whole text."""
    kind = df.schema[id_column].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["id", "n_tokens"])

    return df.select(id_column, text_column).mapInArrow(count, f"id {kind}, n_tokens bigint")


def optimal_buckets(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding, by dynamic programming."""
    lengths = sorted(histogram)
    n = len(lengths)
    if n <= buckets:
        return lengths
    size = np.array(lengths, float)
    count = np.array([histogram[x] for x in lengths], float)
    counts, tokens = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(count * size)])
    # cost[j, i]: padding if lengths j..i-1 form one bucket
    cost = size[None, :] * (counts[None, 1:] - counts[:n, None]) - (tokens[None, 1:] - tokens[:n, None])
    cost[np.tril_indices(n, -1)] = np.inf
    best = cost[0].copy()
    back = [np.zeros(n, int)]
    for _ in range(buckets - 1):
        total = np.concatenate([[np.inf], best[:-1]])[:, None] + cost
        k = total.argmin(axis=0)
        back.append(k)
        best = total[k, np.arange(n)]
    bounds, i = [], n - 1
    for k in reversed(back):
        bounds.append(lengths[i])
        i = int(k[i]) - 1
        if i < 0:
            break
    return sorted(bounds)


def best_fill(left: dict[int, int], lengths: list[int], capacity: int) -> dict[int, int]:
    """Texts per length, with one of the longest at least, that fill the capacity best; the fewest short ones."""
    first = lengths[-1]
    reached, steps = 1, []
    mask = (1 << (capacity - first + 1)) - 1
    for x in reversed(lengths):
        n, part = min(left[x] - (x == first), (capacity - first) // x), 1
        while n > 0:
            use = min(part, n)
            more = (reached << (use * x)) & mask & ~reached
            if more:
                steps.append((x, use, more))
                reached |= more
            n, part = n - use, part * 2
        if reached >> (capacity - first) & 1:
            break
    at, need = reached.bit_length() - 1, {first: 1}
    for x, use, new in reversed(steps):
        if new >> at & 1:  # this sum was first reached with these texts
            need[x] = need.get(x, 0) + use
            at -= use * x
    return need


def plan_batches(histogram: dict[int, int], capacity: int, bounds: list[int], slack: int = 0) -> list[tuple[dict[int, int], int]]:
    """(texts per length, how many sequences like this): every text of the histogram, within the capacity."""
    left = {x: n for x, n in histogram.items() if n and 0 < x <= capacity}
    lengths = sorted(left)
    plan = []

    def take(need: dict[int, int]) -> None:
        times = min(left[x] // n for x, n in need.items())
        plan.append((need, times))
        for x, n in need.items():
            left[x] -= n * times
            if not left[x]:
                lengths.remove(x)

    while lengths:
        # The bucket of the longest length that is left.
        low = bisect_left(bounds, lengths[-1]) - 1
        own = lengths[bisect_right(lengths, bounds[low] if low >= 0 else 0) :]
        need = best_fill(left, own, capacity)
        room = capacity - sum(x * n for x, n in need.items())
        if room > slack:
            k = bisect_left(lengths, own[0])
            while room and (k := bisect_right(lengths, room, 0, k)):
                x = lengths[k - 1]
                need[x] = min(left[x], room // x)
                room -= need[x] * x
                k -= 1
        take(need)
    return plan


def _lookup(plan: list[tuple[dict[int, int], int]]) -> tuple[dict[int, tuple[np.ndarray, ...]], int]:
    """Per length: first ranks, texts per sequence and first sequences of its parts of the plan."""
    at: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for need, times in plan:
        for x, n in need.items():
            at.setdefault(x, []).append((used.get(x, 0), n, sequence))
            used[x] = used.get(x, 0) + n * times
        sequence += times
    return {x: tuple(np.array(c, np.int64) for c in zip(*v)) for x, v in at.items()}, sequence


def pack(df: DataFrame, id_column: str, text_column: str, capacity: int = CAPACITY, buckets: int = BUCKETS, tokenizer: str = TOKENIZER, slack: int = SLACK) -> DataFrame:
    """(id, piece, start_token, n_tokens, sequence_id): the sequence of each text or piece."""
    counts = token_counts(df, id_column, text_column, tokenizer)
    pieces = F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("n_tokens") / capacity))
    each = counts.select("id", F.col("n_tokens").alias("whole"), F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1)).alias("piece"))
    each = each.select("id", F.col("piece").cast("int").alias("piece"), (F.col("piece") * capacity).alias("start_token"), F.least(F.lit(capacity).cast("bigint"), F.col("whole") - F.col("piece") * capacity).alias("n_tokens"))
    # Written once to the shared folder: the ranks below need parts that stay as they are.
    each = cut(each.withColumn("part", F.spark_partition_id()))
    per_part = each.groupBy("part", "n_tokens").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r[0]: r[1] for r in per_part.groupBy("n_tokens").agg(F.sum("n")).collect()}  # at most capacity + 1 rows
    bounds = optimal_buckets({x: n for x, n in histogram.items() if x}, buckets)
    lookup, _ = _lookup(plan_batches(histogram, capacity, bounds, slack))
    before = per_part.select("part", "n_tokens", (F.sum("n").over(Window.partitionBy("n_tokens").orderBy("part")) - F.col("n")).alias("before"))
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy("part", "n_tokens").orderBy("id", "piece")))
    ranked = ranked.join(before, ["part", "n_tokens"]).select("id", "piece", "start_token", "n_tokens", (F.col("before") + F.col("rank") - 1).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, ranks = b.column(3).to_numpy(zero_copy_only=False), b.column(4).to_numpy(zero_copy_only=False)
            out = np.full(len(sizes), -1, np.int64)
            for x in np.unique(sizes):
                if x in lookup:
                    own = sizes == x
                    first, per, base = lookup[x]
                    k = np.searchsorted(first, ranks[own], side="right") - 1
                    out[own] = base[k] + (ranks[own] - first[k]) // per[k]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(out, pa.int64(), mask=out < 0)], ["id", "piece", "start_token", "n_tokens", "sequence_id"])

    kind = df.schema[id_column].dataType.simpleString()
    return ranked.mapInArrow(place, f"id {kind}, piece int, start_token bigint, n_tokens bigint, sequence_id bigint")


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")
