"""Problem 1: freely entered values to a canonical list.

Method: a symmetric-delete dictionary for lookups of bounded edit distance.
The dictionary holds, for every word of the list, the word and what is left of
it after up to two deletions; an entered word finds the list's words within
the distance by its own deletions (words of more than LONG_WORD letters by
segments, of which two edits leave one whole). Matches are ranked by weighted
Damerau-Levenshtein distance and then by the frequency of their words in the
list; what finds nothing acceptable is reported with reference 0.

``theatre`` is a list of fixed length: its dictionary goes to every task, after
a check of its length. ``films`` grows with the data, but its words are far
fewer: the dictionary of the words is broadcast while they are MAX_VOCABULARY
at most; beyond that it is a table, joined by the deletions. Both give the
same corrections.

Wording about the showing is learned from the tables (``wording``) and taken
off first. A film's entry is then found in two steps. First its words, those
that are not in the list corrected, and the number of the sequel form a key
that must equal an entry's key; then, for titles still unmatched (a word
damaged beyond the distance, lost or joined, or with more than MAX_KEYS
readings together), pairs of words in all their corrections nominate
candidates. Both are ranked and accepted on the whole title. Equal titles are
matched once and joined back.

Defined results: null, blank and generic values are reported with reference 0
(venues: the short name decides); ties go to the smaller distance, then the
more frequent words, then the smaller reference id; repeated rows each come
out; empty lists give reference 0 everywhere.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations, product

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightreel.llm.lookalike import normalise
from brightreel.llm.titles import SMALL_WORDS, Dictionary, lookup_keys, parse, plain, weighted_distance, within_reach
from brightreel.llm.wording import Wording, learn
from brightreel.session import cut, table

#: A list in every task's memory may have this many entries at most.
MAX_BROADCAST = 20_000
#: So many different words of a list are broadcast as a dictionary; more are joined.
MAX_VOCABULARY = 20_000
#: Readings of a whole title in the first step; titles with more go on to the second, which needs none.
MAX_KEYS = 81


# --- films -----------------------------------------------------------------


def parsed(df: DataFrame, id_column: str, title: str, also: tuple[str, ...] = (), wording: Wording | None = None) -> DataFrame:
    """(id, base, number, words) of each title, and the columns ``also``."""
    peel = wording.peel if wording else None
    names = ["id", "base", "number", "words", *also]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = [parse(x, peel) for x in b.column(1).to_pylist()]
            words = [sorted({w for w in x.base.split() if w not in SMALL_WORDS} or set(x.base.split())) for x in t]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.base for x in t], pa.string()), pa.array([x.number for x in t], pa.int32()), pa.array(words, pa.list_(pa.string())), *b.columns[2:]], names)

    kinds = "".join(f", {c} {df.schema[c].dataType.simpleString()}" for c in also)
    return df.select(F.col(id_column).cast("bigint").alias("id"), F.col(title).alias("t"), *also).mapInArrow(run, f"id bigint, base string, number int, words array<string>{kinds}")


def _delete_keys(listed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = [(w, d) for w in b.column(0).to_pylist() for d in lookup_keys(w, listed)]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())], ["word", "del"])

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        a, c = b.column(0).to_pylist(), b.column(1).to_pylist()
        d = [weighted_distance(x, y, 2.0) for x, y in zip(a, c)]
        keep = pa.array([within_reach(x, p, q) for x, p, q in zip(d, a, c)], pa.bool_())
        yield pa.RecordBatch.from_arrays([x.filter(keep) for x in (b.column(0), b.column(1), pa.array(d, pa.float64()), b.column(2))], ["word", "ref", "dist", "freq"])


_OPTIONS = "base string, number int, options array<array<string>>"


def options_joined(phrases: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(base, number, options): per word of a phrase the list's words within the distance, best first; by joins."""
    asked = phrases.select("base", "number", F.posexplode("words").alias("pos", "word"))
    keys = "word string, del string"
    known = vocabulary.select("ref").mapInArrow(_delete_keys(True), keys).select(F.col("word").alias("ref"), "del").join(vocabulary, "ref")
    near = asked.select("word").distinct().mapInArrow(_delete_keys(False), keys).join(known, "del").select("word", "ref", "freq").distinct()
    near = near.mapInArrow(_verify, "word string, ref string, dist double, freq bigint")
    ranked = F.array_sort(F.collect_list(F.struct("dist", (-F.col("freq")).alias("f"), "ref")))
    readings = near.groupBy("word").agg(F.transform(ranked, lambda x: x["ref"]).alias("refs"))
    each = asked.join(readings, "word", "left").groupBy("base", "number").agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("refs", F.array().cast("array<string>")).alias("refs")))).alias("o"))
    return each.select("base", "number", F.transform("o", lambda x: x["refs"]).alias("options"))


def options_broadcast(phrases: DataFrame, words: list[tuple[str, int]]) -> DataFrame:
    """The same as ``options_joined``, by a dictionary in each task."""
    sent = phrases.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, known = Dictionary(sent.value), {}
        for b in batches:
            out = []
            for phrase in b.column(2).to_pylist():
                for w in phrase:
                    if w not in known:
                        if len(known) > 200_000:
                            known.clear()
                        known[w] = [ref for _, _, ref in dictionary.near(w)]
                out.append([known[w] if w in known else [ref for _, _, ref in dictionary.near(w)] for w in phrase])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.list_(pa.string())))], ["base", "number", "options"])

    return phrases.select("base", "number", "words").mapInArrow(run, _OPTIONS)


def _whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(base, number, options) -> (base, number, key): every reading of all words; none where they are more than MAX_KEYS."""
    for b in batches:
        rows = []
        for phrase, number, options in zip(*(b.column(i).to_pylist() for i in range(3))):
            own = set(phrase.split())
            options = [[o[0]] if o and o[0] in own else o for o in options]  # a word of the list stands for itself
            n = 1
            for o in options:
                n *= len(o)
            if 0 < n <= MAX_KEYS:
                rows += [(phrase, number, k) for k in {" ".join(sorted(set(x))) for x in product(*options)}]
        yield _rows3(rows)


def _pair_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(phrase, number, options) -> (phrase, number, key): every pair of readings of two words, or of the only word."""
    for b in batches:
        rows = []
        for phrase, number, options in zip(*(b.column(i).to_pylist() for i in range(3))):
            options = [o for o in options if o]
            if len(options) == 1:
                keys = {f"1 {x}" for x in options[0]}
            else:
                keys = {" ".join(sorted((x, y))) for p, q in combinations(options, 2) for x in p for y in q}
            rows += [(phrase, number, k) for k in keys]
        yield _rows3(rows)


def _rows3(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
    a, n, k = zip(*rows) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(n, pa.int32()), pa.array(k, pa.string())], ["base", "number", "key"])


def limit(base: str) -> float:
    """The weighted distance up to which a whole title is the same title."""
    return 1.0 if len(base) < 6 else 2.2 if len(base) < 12 else 3.2 if len(base) < 20 else 4.0


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(base, number, ref_base, ref_id, weight) -> those within the limit, with the distance."""
    for b in batches:
        a, c = b.column(0).to_pylist(), b.column(2).to_pylist()
        d = [weighted_distance(x, y, limit(y)) for x, y in zip(a, c)]
        keep = pa.array([x <= limit(y) for x, y in zip(d, c)], pa.bool_())
        yield pa.RecordBatch.from_arrays([x.filter(keep) for x in (b.column(0), b.column(1), pa.array(d, pa.float64()), b.column(4), b.column(3))], ["base", "number", "dist", "weight", "ref_id"])


def _best(candidates: DataFrame) -> DataFrame:
    ranked = candidates.mapInArrow(_rank, "base string, number int, dist double, weight bigint, ref_id bigint")
    best = F.min_by("ref_id", F.struct("dist", (-F.col("weight")).alias("w"), "ref_id"))
    return ranked.groupBy("base", "number").agg(best.alias("ref_id"))


def match_titles(entries: DataFrame, listed: DataFrame, broadcast: bool = True) -> DataFrame:
    """(id, ref_id) for every entry; both sides are (id, base, number, words)."""
    listed, entries = cut(listed), cut(entries)
    phrases = entries.where("base != ''").groupBy("base", "number").agg(F.first("words").alias("words"))
    vocabulary = listed.select(F.explode("words").alias("ref")).groupBy("ref").agg(F.count(F.lit(1)).alias("freq"))
    words = [(r.ref, r.freq) for r in vocabulary.limit(MAX_VOCABULARY + 1).collect()] if broadcast else []
    if broadcast and len(words) <= MAX_VOCABULARY:
        options = options_broadcast(phrases, words)
        frequency = F.broadcast(phrases.sparkSession.createDataFrame(words, "ref string, freq bigint"))
    else:
        frequency = vocabulary = cut(vocabulary)
        options = options_joined(phrases, vocabulary)
    options = cut(options)
    weights = listed.select("id", F.explode("words").alias("ref")).join(frequency, "ref").groupBy("id").agg(F.sum("freq").alias("weight"))
    refs = cut(listed.where("base != ''").join(weights, "id").select(F.col("id").alias("ref_id"), F.col("base").alias("ref_base"), "number", "words", "weight"))
    whole = refs.select("ref_id", "ref_base", "number", "weight", F.array_join(F.array_sort(F.array_distinct("words")), " ").alias("key"))
    keyed = "base string, number int, key string"
    first = options.mapInArrow(_whole_keys, keyed).join(whole, ["number", "key"]).select("base", "number", "ref_base", "ref_id", "weight")
    first = cut(_best(first))
    rest = options.join(first.select("base", "number"), ["base", "number"], "left_anti")
    own = refs.select(F.col("ref_id").cast("string").alias("base"), "number", F.transform("words", lambda w: F.array(w)).alias("options")).mapInArrow(_pair_keys, keyed)
    one = refs.select(F.col("ref_id").cast("string").alias("base"), "number", F.explode("words").alias("w")).select("base", "number", F.concat(F.lit("1 "), "w").alias("key"))
    nominated = own.unionByName(one).select(F.col("base").cast("bigint").alias("ref_id"), "number", "key")
    # Keys and numbers meet first; the titles join the few that met.
    second = rest.mapInArrow(_pair_keys, keyed).join(nominated, ["number", "key"]).select("base", "number", "ref_id").distinct()
    second = second.join(refs.select("ref_id", "ref_base", "weight"), "ref_id").select("base", "number", "ref_base", "ref_id", "weight")
    found = first.unionByName(_best(second))
    return entries.select("id", "base", "number").join(found, ["base", "number"], "left").select("id", F.coalesce("ref_id", F.lit(0).cast("bigint")).alias("ref_id"))


# --- theatres --------------------------------------------------------------

# Words that name no place, and short forms.
GENERIC = frozenset("cinema cinemas theatre theatres theater theaters movie movies movieplex multiplex cineplex screen screens the at and of on in".split())
SHORT_FORMS = {"n": "north", "s": "south", "e": "east", "w": "west", "st": "saint", "mt": "mount", "ft": "fort", "cine": "cinema", "cin": "cinema", "thtr": "theatre"}
_LISTED = re.compile(r"^(?P<chain>\S+) (?P<place>.+?) (?P<screens>\d+)(?: (?:at |@ ?)(?P<mark>.+))?$")
# Names that say nothing.
NOTHING = frozenset("na tba tbd none null nil unknown venue location mainlocation mainvenue mainsite site main default test".split())
QUALIFIERS = frozenset("north south east west saint mount fort new old upper lower".split())


class Places:
    """A list of theatres, in memory: the symmetric-delete dictionary of their place names."""

    def __init__(self, listed: list[tuple[int, str]]):
        self.rows = []
        self.of_place: dict[str, list[int]] = defaultdict(list)
        self.chains: Counter[str] = Counter()
        for ref, name in sorted(listed):
            m = _LISTED.match(re.sub(r"\s+", " ", name.strip()))
            chain, place, screens, mark = (m["chain"], m["place"], m["screens"], m["mark"] or "") if m else ("", name, "", "")
            words = plain(place).split()
            head = frozenset(w for w in words[:-1] if w in QUALIFIERS)
            core = "".join(w for w in words if w not in head) or "".join(words)
            if not core:
                continue
            marks = frozenset(plain(mark).split()) - GENERIC
            self.of_place[core].append(len(self.rows))
            self.rows.append((ref, plain(chain), head, core, screens, marks))
            self.chains[plain(chain)] += 1
        self.chains.pop("", None)
        self.cores = Dictionary((c, len(k)) for c, k in self.of_place.items())
        self.chain_words = Dictionary(self.chains.items())
        self.generic = Dictionary((w, 1) for w in GENERIC - {"at", "of", "on", "in", "and", "the"})

    def near(self, word: str) -> list[tuple[float, str]]:
        """The list's places within the distance, nearest first."""
        return [(d, c) for d, _, c in self.cores.near(word)] if len(word) > 3 else []

    @staticmethod
    def _likeness(word: str) -> float:
        """The distance up to which another word is the same."""
        return 2.0 if len(word) > 5 else 1.0 if len(word) > 3 else 0.0

    def _like(self, word: str, options) -> str | None:
        """The nearest of a few words, if it is the same; of many, a dictionary tells."""
        if isinstance(options, Dictionary):
            near = options.near(word)
            return near[0][2] if near and near[0][0] <= self._likeness(word) else None
        best = min(((weighted_distance(word, o, 2.0), o) for o in options), default=(9, ""))
        return best[1] if best[0] <= self._likeness(word) else None

    def match(self, text: str | None) -> int | None:
        """The reference of a text, 0 if it means none of the list, None if it says nothing."""
        if not text:
            return None
        low = normalise(text).lower()
        words = plain(low).split()
        if "".join(words) in NOTHING:
            return None
        words = [SHORT_FORMS.get(w, w) for w in words]
        telling = [w for w in words if w not in GENERIC and not w.isdigit()]
        if not telling or all(self._like(w, self.chain_words) for w in telling) and not any(self.near(w) for w in telling):
            return None
        best: tuple | None = None
        spans = [(i, j) for i in range(len(words)) for j in (i + 1, i + 2) if j <= len(words)]
        for i, j in spans:
            joined = "".join(words[i:j])
            if any(w.isdigit() for w in words[i:j]) or (j == i + 1 and joined in GENERIC):
                continue
            glued = ""
            near = self.near(joined)
            if not near and j == i + 1:  # a qualifier written together with its place
                for q in QUALIFIERS:
                    if joined.startswith(q) and (near := self.near(joined[len(q) :])):
                        glued = q
                        break
            for d, core in near:
                rest = words[:i] + words[j:] + ([glued] if glued else [])
                for k in self.of_place[core]:
                    ref, chain, head, _, screens, marks = self.rows[k]
                    if not self._agrees(rest, chain, head, screens, marks):
                        continue
                    score = (d, j - i, -self.chains[chain], ref)
                    if best is None or score < best:
                        best = score
        return best[-1] if best else 0

    def _agrees(self, rest: list[str], chain: str, head: frozenset, screens: str, marks: frozenset) -> bool:
        """Whether nothing that stands beside the place speaks against this theatre."""
        heads = set()
        for w in rest:
            if w in GENERIC:
                continue
            if w.isdigit():
                if w != screens:
                    return False
                continue
            if (q := w if w in QUALIFIERS else self._like(w, head)) is not None:
                heads.add(q)
                continue
            if self._like(w, [chain]) is None and self._like(w, marks) is None and self._like(w, self.generic) is None:
                return False
        return heads == set(head)


def match_places(df: DataFrame, id_column: str, name: str, short: str, listed: DataFrame, ref_id: str, ref_name: str) -> DataFrame:
    """(id, ref_id): ``name`` decides, ``short`` where the name says nothing."""
    rows = listed.select(F.col(ref_id).cast("bigint"), ref_name).where(F.col(ref_name).isNotNull()).limit(MAX_BROADCAST + 1).collect()
    if len(rows) > MAX_BROADCAST:
        raise ValueError(f"a list of more than {MAX_BROADCAST} places needs the joined dictionary (match_titles)")
    own = [(int(r[0]), r[1]) for r in rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, known = Places(own), {}
        for b in batches:
            out = []
            for pair in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                if pair not in known:
                    if len(known) > 50_000:
                        known.clear()
                    hit = places.match(pair[0])
                    known[pair] = (places.match(pair[1]) or 0) if hit is None else hit
                out.append(known[pair])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.int64())], ["id", "ref_id"])

    return df.select(F.col(id_column).cast("bigint").alias("id"), F.col(name).alias("a"), F.col(short).alias("b")).mapInArrow(run, "id bigint, ref_id bigint")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    venues = match_places(table(spark, sf_dir, "venues"), "venue_row", "name", "short", table(spark, sf_dir, "theatre"), "theatre_id", "name")
    entered, listed = table(spark, sf_dir, "movie_context"), table(spark, sf_dir, "films")
    wording = learn(entered, "display_title", listed, "title")
    films = match_titles(parsed(entered, "context_id", "display_title", wording=wording), parsed(listed, "film_id", "title"))
    out = lambda df, kind: df.select(F.lit(kind).alias("kind"), F.col("id").alias("entry_id"), "ref_id")
    return out(venues, "venue").unionByName(out(films, "context"))


def p1_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of what is in neither list, by kind."""
    return p1_found(spark, sf_dir).where("ref_id = 0").select("kind", "entry_id")
