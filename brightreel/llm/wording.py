"""Wording about the showing, learned from the tables: what stands before or after a title of a list.

An entry that holds a listed title as a run of its words shows by the rest
what writers put around titles ("... [Subtitled]", "Staff pick: ..."). What
stands around several different titles, and is no more usual at the ends of
the listed titles themselves, is wording. Digits count by their number only,
so that one year or edition stands for all. Where wordings of three words or more differ
in the word next to the title only, that word may be any ("Kino Fest 2019").

All titles of the list are looked for in all entries, and all is counted in the
cluster: runs of an entry's words that pass a filter of the titles' checksums
are joined with the titles. The driver holds the different wordings (119 of
42,636 entries), and how usual those are at the ends of titles. With too few
entries to learn from, nothing is peeled.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightreel.llm.lookalike import normalise
from brightreel.llm.titles import ARTICLES, plain, sequel
from brightreel.session import cut

#: Filters of titles have so many bits for each, and 2^MAX_FILTER bits at most; a fuller one only lets more runs go on to the join.
FILTER_BITS, MAX_FILTER = 16, 26
#: Different titles around which a wording must stand.
LEAST_TITLES = 2
#: How many times as usual around titles as at the ends of listed titles.
LEAST_RATIO = 5.0
ANY = "*"


def shape(word: str) -> str:
    """The word with its digits made equal; a number keeps its length."""
    return "#" * min(5, len(word)) if word.isdigit() else re.sub(r"\d+", "#", word)


def _core(words: list[str]) -> tuple[str, ...]:
    """The words without articles at the ends."""
    a, b = 0, len(words)
    while b - a > 1 and words[b - 1] in ARTICLES:
        b -= 1
    while b - a > 1 and words[a] in ARTICLES:
        a += 1
    return tuple(words[a:b])


def _is_sequel(words: list[str]) -> bool:
    """Whether what follows a title begins with the number of a sequel."""
    return any(sequel(["x", "x", *words[:k]])[1] for k in (1, 2) if k <= len(words))


def runs(words: list[str], longest: int, known: np.ndarray) -> list[tuple[int, int, str]]:
    """(number of words, first word, run) of the runs of two words or more that may be titles, by their checksums."""
    found = [(size, i, " ".join(words[i : i + size])) for size in range(2, min(longest, len(words)) + 1) for i in range(len(words) - size + 1)]
    return [x for x in found if known[(at := checksum(x[2]) & (8 * len(known) - 1)) >> 3] >> (at & 7) & 1]


def checksum(run: str) -> int:
    return zlib.crc32(run.encode())


def around(words: list[str], start: int, size: int) -> tuple[str, str]:
    """What stands before and after a title among the words."""
    before, after = words[:start], words[start + size :]
    while before and before[-1] in ARTICLES:
        before = before[:-1]
    while after and after[0] in ARTICLES:
        after = after[1:]
    return " ".join(map(shape, before)), " ".join(map(shape, after)) if not _is_sequel(after) else ""


class Wording:
    """Learned wordings, and how to take them off."""

    def __init__(self, before: list[str], after: list[str]):
        self.before, self.after = sorted(before), sorted(after)
        self._first = self._by_size(before)
        self._last = self._by_size(after)

    @staticmethod
    def _by_size(wordings: list[str]) -> list[tuple[int, set[tuple[str, ...]], set[tuple[int, tuple[str, ...]]]]]:
        sizes: dict[int, tuple[set, set]] = defaultdict(lambda: (set(), set()))
        for w in wordings:
            t = tuple(w.split())
            if ANY in t:
                k = t.index(ANY)
                sizes[len(t)][1].add((k, t[:k] + t[k + 1 :]))
            else:
                sizes[len(t)][0].add(t)
        return [(n, *sizes[n]) for n in sorted(sizes, reverse=True)]

    @staticmethod
    def _matches(part: tuple[str, ...], whole: set, loose: set) -> bool:
        return part in whole or any((k, part[:k] + part[k + 1 :]) in loose for k in range(len(part)) if loose)

    def peel(self, words: list[str]) -> list[str]:
        """The words without wording at either end, longest first until none is left; at least a title's word stays."""
        changed = True
        while changed:
            changed = False
            for sizes, end in ((self._last, True), (self._first, False)):
                for n, whole, loose in sizes:
                    rest = words[:-n] if end else words[n:]
                    if n >= len(words) or not any(w not in ARTICLES for w in rest):
                        continue
                    if self._matches(tuple(map(shape, words[-n:] if end else words[:n])), whole, loose):
                        words, changed = rest, True
                        break
        return words


def choose(counts: dict[tuple[bool, str], int], seen: int, ends: Counter, listed: int) -> Wording:
    """The wordings out of how many titles each stands around; ``ends`` counts the ends of listed titles."""
    kept: dict[bool, Wording] = {}
    for after in (False, True):
        own = {tuple(w.split()): n for (side, w), n in counts.items() if side == after and w}
        kept[after] = _side(own, after, seen, ends, listed)
        # Once more over what is left of wordings in a row, so that parts count together.
        left: Counter = Counter()
        for t, n in own.items():
            rest = kept[after].peel(["\0", *t] if after else [*t, "\0"])
            left[tuple(w for w in rest if w != "\0") or t] += n
        kept[after] = _side(left, after, seen, ends, listed)
    return Wording(kept[False].before, kept[True].after)


def _side(own: dict[tuple[str, ...], int], after: bool, seen: int, ends: Counter, listed: int) -> Wording:
    usual = {t: n for t, n in own.items() if n / max(1, seen) >= LEAST_RATIO * ends[after, t] / max(1, listed)}
    # The word next to the title may be any, where the others are two at least.
    loose: dict[tuple[str, ...], list[int]] = defaultdict(list)
    for t, n in usual.items():
        if len(t) > 2 and "#" not in t[0 if after else -1]:
            loose[(ANY, *t[1:]) if after else (*t[:-1], ANY)].append(n)
    strong = {t: sum(n) for t, n in loose.items() if len(n) >= 2 and sum(n) > LEAST_TITLES}
    out: list[str] = []
    kept = Wording([], [])
    for t, n in sorted({**usual, **strong}.items(), key=lambda x: (len(x[0]), ANY not in x[0], -x[1], x[0])):
        # What peeling already takes off needs no entry of its own.
        if n >= LEAST_TITLES and kept.peel(["\0", *t] if after else [*t, "\0"]) != ["\0"]:
            out.append(" ".join(t))
            kept = Wording([], out) if after else Wording(out, [])
    return kept


def _rows(each: Callable[[str], list[tuple]], names: list[str], kinds: list[pa.DataType]):
    """The rows that ``each`` makes of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(zip(*[r for t in b.column(0).to_pylist() for r in each(t)])) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return run


def _title_core(text: str) -> list[tuple[str, int, int]]:
    """The core of a title, if it is long enough to be looked for, the number of its words and its checksum."""
    core = _core(text.split())
    return [(run := " ".join(core), len(core), checksum(run))] if len(core) > 1 and len("".join(core)) > 7 else []


def _ends(text: str) -> list[tuple[bool, str]]:
    s = list(map(shape, text.split()))
    return [x for k in range(1, min(6, len(s))) for x in ((True, " ".join(s[-k:])), (False, " ".join(s[:k])))]


def learn(entries: DataFrame, title: str, listed: DataFrame, listed_title: str) -> Wording:
    """The wording in a column of entries, by the titles of a list."""
    spark, words = entries.sparkSession, lambda t: [(" ".join(plain(normalise(t)).split()),)]
    texts = lambda df, c: df.select(F.col(c).alias("t")).where("t is not null").distinct().mapInArrow(_rows(words, ["words"], [pa.string()]), "words string")
    names = cut(texts(listed, listed_title))
    cores = cut(names.mapInArrow(_rows(_title_core, ["core", "size", "sum"], [pa.string(), pa.int32(), pa.int64()]), "core string, size int, sum bigint").distinct())
    n, longest = cores.agg(F.count(F.lit(1)), F.coalesce(F.max("size"), F.lit(0))).first()
    known = np.zeros(1 << max(3, min(MAX_FILTER, (FILTER_BITS * n).bit_length())), np.uint8)
    places = cores.select(F.col("sum").bitwiseAND(F.lit(len(known) - 1)).cast("int").alias("at")).distinct()
    for part in places.toArrow().to_batches():  # 4 bytes for each title
        known[part.column(0).to_numpy()] = 1
    sent = spark.sparkContext.broadcast(np.packbits(known, bitorder="little"))

    def scan(text: str) -> list[tuple[str, int, int, str]]:
        return [(text, size, -i, run) for size, i, run in runs(text.split(), longest, sent.value)]

    may = texts(entries, title).distinct().mapInArrow(_rows(scan, ["words", "size", "place", "core"], [pa.string(), pa.int32(), pa.int32(), pa.string()]), "words string, size int, place int, core string")
    # The longest title among the words, of several the first.
    hits = may.join(cores.select("core"), "core").groupBy("words").agg(F.max(F.struct("size", "place", "core")).alias("h")).select("words", "h.*")

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, size, place, core in zip(*(c.to_pylist() for c in b.columns)):
                before, after = around(text.split(), -place, size)
                rows += [(side, w, core) for side, w in ((False, before), (True, after)) if w]
                rows.append((True, "", core))  # the title itself, with or without wording
            cols = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.bool_(), pa.string(), pa.string()))], ["after", "wording", "core"])

    usual = cut(hits.mapInArrow(sides, "after boolean, wording string, core string").groupBy("after", "wording").agg(F.countDistinct("core").alias("n")))
    counts = {(r.after, r.wording): r.n for r in usual.collect()}
    seen = counts.pop((True, ""), 0)
    # What peeling may leave of a wording is its part next to the title.
    w = F.split("wording", " ")
    near = F.transform(F.sequence(F.lit(1), F.size(w)), lambda k: F.array_join(F.when(F.col("after"), F.slice(w, 1, k)).otherwise(F.slice(w, -k, k)), " "))
    asked = usual.where("wording != ''").select("after", F.explode(near).alias("end")).distinct()
    ends = names.mapInArrow(_rows(_ends, ["after", "end"], [pa.bool_(), pa.string()]), "after boolean, end string").groupBy("after", "end").count()
    ends = Counter({(r.after, tuple(r.end.split())): r["count"] for r in ends.join(asked, ["after", "end"], "left_semi").collect()})
    return choose(counts, seen, ends, names.count())
