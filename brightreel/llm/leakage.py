"""Problem 8: evaluation texts leaking into training text.

Method: pigeonhole edit matching over words. A passage of RUN words with an
error budget of ``errors`` that holds ``errors + 1`` pieces lends one of them
exactly to each text within the budget. The items are cut end to end into
pieces so short that a passage holds ``errors + 1`` whole ones wherever it
begins; an Aho-Corasick automaton finds the exact piece
hits in each text, and around each hit Myers' bit-parallel distance, with
words as symbols, verifies the passages that contain the piece. An exact check
then extends the hit to the longest common run of words. No passage within the
budget is lost.

The items form a list of fixed length; they go to the tasks in blocks of at
most MAX_ITEMS, one pass over the texts for each block, so that a longer list
is still matched as a whole. Texts are read whole, without a shuffle.

Defined results: null, empty and short texts and items match nothing; an item
that occurs twice in a text is one row; items with equal passages are each
reported; repeated texts are each reported; empty tables give no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightreel.session import table

RUN = 12
ERRORS = 1
MAX_ITEMS = 20_000
WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Maximal runs of letters and digits, in lower case."""
    return [w.lower() for w in WORD.findall(text)] if text else []


def myers(pattern: list[str], text: list[str]) -> int:
    """The least edit distance of ``pattern`` to any part of ``text``, words as symbols."""
    m = len(pattern)
    if not m:
        return 0
    peq: dict[str, int] = defaultdict(int)
    for i, w in enumerate(pattern):
        peq[w] |= 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    best = score
    for w in text:
        eq = peq.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & mask, pv & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = (ph << 1) & mask, (mh << 1) & mask  # row 0 is free: a match may begin anywhere
        pv, mv = mh | ~(xv | ph) & mask, ph & xv
        best = min(best, score)
    return best


class Matcher:
    """Piece hits and their verification for one block of items."""

    def __init__(self, items: list[tuple[int, str]], run: int, errors: int):
        self.run, self.errors = run, errors
        # A run that begins anywhere holds errors + 1 whole pieces if one piece more, less one word, fits into it.
        self.piece = max(1, (run + 1) // (errors + 2))
        self.items = [(i, w) for i, t in items if len(w := words(t)) >= run]
        at: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, w) in enumerate(self.items):
            for q in range(0, len(w) - self.piece + 1, self.piece):
                at[" " + " ".join(w[q : q + self.piece]) + " "].append((k, q))
        self.automaton = ahocorasick.Automaton()
        for s, places in at.items():
            self.automaton.add_word(s, (len(s), places))
        if at:
            self.automaton.make_automaton()
        self.empty = not at

    def match(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item_id, longest run of words, least errors in a passage) per item within the budget."""
        w = words(text)
        if self.empty or len(w) < self.piece:
            return []
        joined = " " + " ".join(w) + " "
        starts: list[int] | None = None
        best: dict[int, tuple[int, int]] = {}
        covered: dict[tuple[int, int], int] = {}
        for last, (length, places) in self.automaton.iter(joined):
            if starts is None:
                starts, at = [], 0
                for x in w:
                    starts.append(at)
                    at += len(x) + 1
            p = bisect_right(starts, last - length + 1) - 1
            for k, q in places:
                if covered.get((k, p - q), -1) > p:
                    continue
                own = self.items[k][1]
                errors = self._verify(own, q, w, p)
                if errors > self.errors:
                    continue
                a, b = 0, self.piece
                while p - a > 0 and q - a > 0 and w[p - a - 1] == own[q - a - 1]:
                    a += 1
                while p + b < len(w) and q + b < len(own) and w[p + b] == own[q + b]:
                    b += 1
                covered[k, p - q] = p + b
                item = self.items[k][0]
                run, least = best.get(item, (0, self.run))
                best[item] = (max(run, a + b), min(least, errors))
        return [(i, r, e) for i, (r, e) in best.items()]

    def _verify(self, own: list[str], q: int, w: list[str], p: int) -> int:
        """Least distance of a passage of ``run`` words around the piece to the text around the hit."""
        least = self.run
        reach = self.run - self.piece
        near = set(w[max(0, p - reach - self.errors) : p + self.run + self.errors])
        for s in range(max(0, q - reach), min(q, len(own) - self.run) + 1):
            if sum(x in near for x in own[s : s + self.run]) < self.run - self.errors:
                continue  # each word that is not there is an error
            lo = max(0, p - (q - s) - self.errors)
            least = min(least, myers(own[s : s + self.run], w[lo : p - (q - s) + self.run + self.errors]))
            if not least:
                break
        return least


def matches(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, run: int = RUN, errors: int = ERRORS) -> DataFrame:
    """(doc_id, item_id, run_words, errors): each text and item with a passage within the error budget."""
    n = items.count()
    blocks = max(1, -(-n // MAX_ITEMS))
    keyed = items.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).alias("t"), F.pmod(F.xxhash64(item_id), F.lit(blocks)).alias("b")).where("t is not null and i is not null")
    parts = []
    for b in range(blocks):
        own = [(r.i, r.t) for r in keyed.where(F.col("b") == b).collect()]

        def scan(batches: Iterator[pa.RecordBatch], own=own) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(own, run, errors)
            for batch in batches:
                rows = [(d, *m) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for m in matcher.match(t)]
                cols = list(zip(*rows)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32())], ["doc_id", "item_id", "run_words", "errors"])

        parts.append(docs.select(F.col(doc_id).cast("bigint").alias("d"), F.col(text).alias("t")).mapInArrow(scan, "doc_id bigint, item_id bigint, run_words int, errors int"))
    return reduce(DataFrame.unionByName, parts)


def _own(spark: SparkSession, sf_dir: str, errors: int) -> DataFrame:
    return matches(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_item"), "item_id", "text", errors=errors)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _own(spark, sf_dir, 0).where(F.col("run_words") >= RUN).select("doc_id", "item_id")


def p8_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also passages with an error within the budget."""
    return _own(spark, sf_dir, ERRORS)


P8_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_item),
doc_words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
item_runs AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 11], ' ') AS run
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS i FROM item_words WHERE len(w) >= 12)),
doc_runs AS (
  SELECT doc_id, array_to_string(w[i:i + 11], ' ') AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS i FROM doc_words WHERE len(w) >= 12))
SELECT DISTINCT doc_id, item_id FROM doc_runs JOIN item_runs USING (run)
"""
