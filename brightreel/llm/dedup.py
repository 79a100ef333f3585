"""Problem 6: duplicates hidden by formatting differences.

Method: every row gets a canonical hash (case, white space, punctuation and
the order of the parts left out). Each task fills two Bloom filters, of hashes
seen once and seen repeatedly; the tasks' filters are merged, so that a hash
in two tasks' filters counts as repeated. Rows whose hash may be repeated are
shuffled for exact grouping on the canonical key itself; all others are
emitted as singletons without a shuffle. A false positive only costs the
shuffle of one row: the result is exact.

The filters have BITS_PER_ROW bits for each row, however many there are: they
are cut into segments of SEGMENT_BITS, which are built, shuffled and merged
apart from each other, so that no task holds a whole filter. Only what the
merged filter says of repeats is broadcast. It has few bits set if few rows
are repeated, and is folded until it is about a quarter full; so it grows with
the repeated records, not with the rows. If it still had more than MAX_BITS
bits, almost any row would be shuffled anyway, and all are, without a filter.

Defined results: a row that lacks a part (null, or nothing but white space
and punctuation) or the exact column is a record of its own; exact repeats are
copies; ties for the smallest sequence number give that number; an empty table
gives no records; further columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightreel.functions.timestamps import name_key
from brightreel.session import cut, table

SEGMENT_BITS = 1 << 17
#: Of the filter that is broadcast.
MAX_BITS = 1 << 28
BITS_PER_ROW = 8
#: Hashes a task gathers before it writes their segments.
HASHES = 1 << 22
PROBES = (13, 30, 47)  # where in the hash the three bit positions begin


def canonical_key(exact: list[str], parts: list[str]) -> Column:
    """One text for equal records: ``exact`` columns as they are, ``parts`` in any order; null if one lacks."""
    names = [name_key(F.col(c)) for c in parts]
    lacks = F.lit(False)
    for c in names:
        lacks = lacks | F.coalesce(c, F.lit("")).eqNullSafe("")
    for c in exact:
        lacks = lacks | F.col(c).isNull()
    key = F.concat_ws("\u0001", *[F.col(c).cast("string") for c in exact], F.array_sort(F.array(*names)))
    return F.when(~lacks, key)


def segments_for(rows: int) -> int:
    """How many segments the filters of so many rows have, a power of two."""
    return max(SEGMENT_BITS, 1 << math.ceil(math.log2(max(1, rows * BITS_PER_ROW)))) // SEGMENT_BITS


def _bits(h: np.ndarray) -> np.ndarray:
    """The bits of a segment that its hashes set."""
    bits = np.zeros(SEGMENT_BITS, bool)
    for p in PROBES:
        bits[(h >> np.uint64(p)) & np.uint64(SEGMENT_BITS - 1)] = True
    return np.packbits(bits, bitorder="little")


_NONE = zlib.compress(bytes(SEGMENT_BITS // 8), 1)


def filter_segments(segments: int):
    """A task's two filters, as rows (segment, once, repeated) of the segments that are not empty."""

    def written(hashes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h, n = np.unique(np.concatenate(hashes).view(np.uint64), return_counts=True)
        segment = (h & np.uint64(segments - 1)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        h, n, segment = h[order], n[order], segment[order]
        names, first = np.unique(segment, return_index=True)
        ends = np.append(first[1:], len(h))
        for k in range(0, len(names), 64):
            once, again = [], []
            for a, b in zip(first[k : k + 64], ends[k : k + 64]):
                once.append(zlib.compress(_bits(h[a:b]).tobytes(), 1))
                more = h[a:b][n[a:b] > 1]
                again.append(zlib.compress(_bits(more).tobytes(), 1) if len(more) else _NONE)
            yield pa.RecordBatch.from_pydict({"segment": pa.array(names[k : k + 64], pa.int64()), "once": pa.array(once, pa.binary()), "again": pa.array(again, pa.binary())})

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
            n += len(held[-1])
            if n >= HASHES:
                yield from written(held)
                held, n = [], 0
        if n:
            yield from written(held)

    return build


def merge_segments(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """One segment's filters of all tasks, merged: the repeated bits, and how many are set."""
    once, again = np.zeros(SEGMENT_BITS // 8, np.uint8), np.zeros(SEGMENT_BITS // 8, np.uint8)
    for a, b in zip(group["once"], group["again"]):
        mine = np.frombuffer(zlib.decompress(a), np.uint8)
        again |= np.frombuffer(zlib.decompress(b), np.uint8) | (once & mine)
        once |= mine
    return pd.DataFrame({"segment": [key[0]], "again": [zlib.compress(again.tobytes(), 1)], "bits": [int(np.unpackbits(again).sum())]})


def fold_segments(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Segments of one remainder laid over each other, as 64-bit words."""
    words = np.zeros(SEGMENT_BITS // 64, np.int64)
    for a in group["again"]:
        words |= np.frombuffer(zlib.decompress(a), np.int64)
    return pd.DataFrame({"segment": [key[0]], "words": [words]})


def repeated_filter(hashes: DataFrame, rows: int) -> tuple[DataFrame | None, int]:
    """((segment, words), segments): the filter of possibly repeated hashes of a one-column table; None if it were too large."""
    segments = segments_for(rows)
    # So many tasks that each has about as many hashes as it gathers at once, but for small tables.
    tasks = hashes.coalesce(max(1, hashes.sparkSession.sparkContext.defaultParallelism, -(-rows // HASHES)))
    parts = tasks.mapInArrow(filter_segments(segments), "segment bigint, once binary, again binary")
    merged = cut(parts.groupBy("segment").applyInPandas(merge_segments, "segment bigint, again binary, bits bigint"))
    held = merged.agg(F.coalesce(F.sum("bits"), F.lit(0))).first()[0]
    folded = min(segments, max(1, 1 << math.ceil(math.log2(max(1, 4 * held / SEGMENT_BITS)))))
    if folded * SEGMENT_BITS == 2 * MAX_BITS:
        folded //= 2  # half full at the bound
    if folded * SEGMENT_BITS > MAX_BITS:
        return None, folded
    rest = F.col("segment").bitwiseAND(F.lit(folded - 1)).alias("segment")
    return merged.where("bits > 0").select(rest, "again").groupBy("segment").applyInPandas(fold_segments, "segment bigint, words array<bigint>"), folded


def may_repeat(df: DataFrame, hash_column: str, repeated: DataFrame | None, segments: int) -> DataFrame:
    """``df`` with _maybe: whether the filter holds the row's hash. The filter's size is bounded, so it is broadcast."""
    if repeated is None:
        return df.withColumn("_maybe", F.lit(True))
    h = F.col(hash_column)
    joined = df.withColumn("_segment", h.bitwiseAND(F.lit(segments - 1))).join(F.broadcast(repeated.select(F.col("segment").alias("_segment"), "words")), "_segment", "left")
    bits = [F.shiftrightunsigned(h, p).bitwiseAND(F.lit(SEGMENT_BITS - 1)).cast("int") for p in PROBES]
    hit = F.lit(True)
    for b in bits:
        hit = hit & (F.getbit(F.col("words")[F.shiftright(b, 6)], b.bitwiseAND(F.lit(63))) == 1)
    return joined.withColumn("_maybe", F.coalesce(hit, F.lit(False))).drop("_segment", "words")


def collapse_duplicates(df: DataFrame, exact: list[str], parts: list[str], sequence: str, rows: int | None = None) -> DataFrame:
    """(first_seq, n_copies): one row per record, with the smallest sequence number and the number of its copies."""
    keyed = df.select(F.col(sequence).alias("_seq"), canonical_key(exact, parts).alias("_key")).withColumn("_hash", F.xxhash64("_key"))
    repeated, segments = repeated_filter(keyed.select(F.when(F.col("_key").isNotNull(), F.col("_hash")).alias("_hash")), df.count() if rows is None else rows)
    marked = may_repeat(keyed, "_hash", repeated, segments).withColumn("_maybe", F.col("_maybe") & F.col("_key").isNotNull())
    exactly = marked.where("_maybe").groupBy("_key").agg(F.min("_seq").alias("first_seq"), F.count(F.lit(1)).alias("n_copies")).drop("_key")
    alone = marked.where("not _maybe").select(F.col("_seq").alias("first_seq"), F.lit(1).cast("bigint").alias("n_copies"))
    return exactly.unionByName(alone)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    shows = table(spark, sf_dir, "showtime")
    return collapse_duplicates(shows, ["show_date"], ["movie_title", "theatre", "show_time"], "ingest_seq").where("n_copies >= 2")


P6_SQL = r"""
WITH keyed AS (
  SELECT ingest_seq, show_date,
         lower(regexp_replace(movie_title, '[^\p{L}\p{M}\p{N}]+', '', 'g')) AS a,
         lower(regexp_replace(theatre, '[^\p{L}\p{M}\p{N}]+', '', 'g')) AS b,
         lower(regexp_replace(show_time, '[^\p{L}\p{M}\p{N}]+', '', 'g')) AS c
  FROM showtime)
SELECT min(ingest_seq) AS first_seq, count(*) AS n_copies
FROM keyed
WHERE show_date IS NOT NULL AND a <> '' AND b <> '' AND c <> ''
GROUP BY show_date, list_sort([a, b, c])
HAVING count(*) >= 2
"""
