"""Three ratios of likeness and accent folding, in Arrow batches."""

from __future__ import annotations

import difflib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence, one bit per character of ``a``."""
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    mask = v = (1 << len(a)) - 1
    for y in b:
        u = v & at.get(y, 0)
        v = (v + u | v - u) & mask
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    """100 x 2 x longest common subsequence / both lengths."""
    return 200.0 * common(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_set_ratio(a: str, b: str) -> float:
    """The best ratio among the common words and each side's words in order."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    left, right = (both + " " + " ".join(sorted(x - y))).strip(), (both + " " + " ".join(sorted(y - x))).strip()
    if both and (both == left or both == right):
        return 100.0
    return max(ratio(both, left) if both else 0.0, ratio(both, right) if both else 0.0, ratio(left, right))


def sequence_ratio(a: str, b: str) -> float:
    return difflib.SequenceMatcher(None, a, b).ratio()


def fold(text: str) -> str:
    """No accents, @ as at, lower-case words of letters and digits."""
    t = unicodedata.normalize("NFKD", text.replace("@", " at "))
    return " ".join("".join(c if c.isalnum() else " " for c in t if not unicodedata.combining(c)).lower().split())


def _pairwise(f, a: str, b: str) -> Column:
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([f(x, y) if x is not None and y is not None else None for x, y in zip(a, b)], dtype="float64")

    return F.pandas_udf(run, "double")(a, b)


def ratio_udf(a: str, b: str) -> Column:
    return _pairwise(ratio, a, b)


def token_set_ratio_udf(a: str, b: str) -> Column:
    return _pairwise(token_set_ratio, a, b)


def sequence_ratio_udf(a: str, b: str) -> Column:
    return _pairwise(sequence_ratio, a, b)


def fold_udf(column: str) -> Column:
    def run(a: pd.Series) -> pd.Series:
        return a.map(lambda x: fold(x) if x is not None else None)

    return F.pandas_udf(run, "string")(column)


BLOCK = 500
BINS = 64
LEADING = "the|a|an|when"


def _bags(titles: list[str]) -> np.ndarray:
    """Per title how often the characters of each bin occur."""
    out = np.zeros((BINS, len(titles)), np.int16)
    for i, t in enumerate(titles):
        for c in t:
            out[ord(c) % BINS, i] += 1
    return out


def likely(x: list[str], y: list[str], least: float) -> Iterator[tuple[int, int]]:
    """Places of the pairs whose common characters, in any order, allow a ratio of ``least``; no pair with that ratio is left out."""
    a, b = _bags(x), _bags(y)
    both = np.zeros((len(x), len(y)), np.int16)
    for p, q in zip(a, b):
        if p.any() and q.any():
            both += np.minimum.outer(p, q)
    room = np.add.outer(a.sum(0, dtype=np.int32), b.sum(0, dtype=np.int32))
    return zip(*(k.tolist() for k in np.nonzero(200.0 * both >= (least - 1e-6) * room)))


def _blocks(titles: DataFrame, name: str) -> DataFrame:
    """(key, titles): distinct titles by first word and by first word after LEADING, in lists of about BLOCK."""
    c = F.col("title")
    keys = F.array_distinct(F.array(F.split(c, " ")[0], F.regexp_extract(c, rf"^(?:(?:{LEADING}) )*(\S*)", 1)))
    keyed = titles.where(c.isNotNull()).distinct().select("title", F.explode(keys).alias("key"))
    sizes = keyed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("lists"))
    return keyed.join(sizes, "key").groupBy("key", F.pmod(F.xxhash64("title"), "lists").alias("part")).agg(F.collect_list("title").alias(name)).drop("part")


def like_titles(x: DataFrame, y: DataFrame, least: float) -> DataFrame:
    """(x, y, ratio, token_set, sequence) of the distinct titles of both columns ``title`` that share a block, from a ratio of ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = [(a[i], b[j], r) for i, j in likely(a, b, least) if (r := round(ratio(a[i], b[j]), 6)) >= least]
                cols = list(zip(*[(s, t, r, round(token_set_ratio(s, t), 6), round(sequence_ratio(s, t), 6)) for s, t, r in rows])) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), *[pa.array(c, pa.float64()) for c in cols[2:]]], ["x", "y", "ratio", "token_set", "sequence"])

    pairs = _blocks(x, "a").join(_blocks(y, "b"), "key").select("a", "b")
    spread = pairs.repartition(int(x.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spread.mapInArrow(run, "x string, y string, ratio double, token_set double, sequence double").dropDuplicates(["x", "y"])
