"""Film titles as several hands write them: article, number of the sequel and spelling apart.

Wording about the showing is no business of this module: ``wording`` learns it
from the tables.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterable
from typing import NamedTuple

from brightreel.llm.lookalike import normalise

ARTICLES = ("the", "a", "an")
# Words and numerals of sequels.
PART_WORDS = ("part", "chapter", "volume", "vol", "episode")
NUMBERS = {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10}
ROMAN = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9, "x": 10}
SMALL_WORDS = frozenset("the a an of and for in to with when met on at by from".split())
#: Words up to this length find each other by deletions, longer ones by segments.
LONG_WORD = 24
_SEGMENTS = 5  # two swaps touch four segments at most


class Title(NamedTuple):
    base: str  # words without leading or trailing article, separated by single spaces
    number: int  # of a sequel; 0 for none


def plain(text: str) -> str:
    """Lower case, no accents, no apostrophes, words separated by single spaces."""
    t = unicodedata.normalize("NFKD", text.lower().replace("&", " and "))
    t = re.sub(r"['’‘`ʼ]", "", "".join(c for c in t if not unicodedata.combining(c)))
    return " ".join(re.findall(r"[^\W_]+", t))


def weighted_distance(a: str, b: str, most: float = 1e9) -> float:
    """Damerau-Levenshtein distance; a swap of neighbours costs 0.8, a doubled or undoubled letter 0.7."""
    if a == b:
        return 0.0
    if abs(len(a) - len(b)) * 0.7 > most:
        return most + 1
    older: list[float] = []
    row = [j * 1.0 for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        new = [float(i)]
        px = a[i - 2] if i > 1 else ""
        for j, y in enumerate(b, 1):
            py = b[j - 2] if j > 1 else ""
            best = row[j - 1] + (x != y)
            drop = row[j] + (0.7 if x == px else 1.0)
            add = new[j - 1] + (0.7 if y == py else 1.0)
            best = drop if drop < best else best
            best = add if add < best else best
            if i > 1 and j > 1 and x == py and y == px and x != y and older[j - 2] + 0.8 < best:
                best = older[j - 2] + 0.8
            new.append(best)
        if min(new) > most:
            return most + 1
        older, row = row, new
    return row[-1]


def sequel(words: list[str]) -> tuple[list[str], int]:
    """The words before the number of a sequel, and the number (0 for none)."""
    if len(words) < 2:
        return words, 0
    last = words[-1]
    near = lambda w, options, most: next((o for o in options if weighted_distance(w, o, most) <= most), None)
    part = len(words) > 2 and len(words[-2]) > 2 and near(words[-2], PART_WORDS[:3], 1.0 if len(words[-2]) < 6 else 2.0)
    if last.isdigit() and len(last) < 3:
        n = int(last)
    elif last in ROMAN and (part or ROMAN[last] > 1 and last not in ("v", "x")):
        n = ROMAN[last]
    elif part and (word := last if last in NUMBERS else near(last, NUMBERS, 1.0)):
        n = NUMBERS[word]
    else:
        return words, 0
    return words[: -2 if part else -1], n


def parse(text: str | None, peel: Callable[[list[str]], list[str]] | None = None) -> Title:
    """The parts of a title that tell films apart; a title without letters and digits has an empty base.

    ``peel`` takes wording about the showing off the words of the title.
    """
    if not text:
        return Title("", 0)
    words = plain(normalise(text)).split()
    if peel:
        words = peel(words)
    if len(words) > 1 and words[-1] in ARTICLES:
        words = words[:-1]
    words, number = sequel(words)
    # "Wicked Pilgrim Part II, The" loses its article before its number, "Pilgrim, The 2" after it.
    if len(words) > 1 and words[-1] in ARTICLES:
        words = words[:-1]
    if len(words) > 1 and words[0] in ARTICLES:
        words = words[1:]
    return Title(" ".join(words), number)


def reach(word: str) -> int:
    """How many edits a word of a list may be away."""
    return 0 if len(word) < 4 else 1 if len(word) < 6 else 2


def deletes(word: str, depth: int) -> set[str]:
    """The word and what is left of it after up to ``depth`` deletions."""
    found, edge = {word}, {word}
    for _ in range(depth):
        edge = {w[:i] + w[i + 1 :] for w in edge for i in range(len(w))}
        found |= edge
    return found


def lookup_keys(word: str, listed: bool) -> set[str]:
    """Keys of which a word of a list (``listed``) and an entered word within its reach share one.

    Short words share a form with deletions. A long word would have too many:
    the listed one is cut into segments of which two edits leave one whole,
    and the entered one offers what may stand in each segment's place.
    """
    keys = deletes(word, reach(word)) if len(word) <= LONG_WORD + 2 else set()
    if len(word) > LONG_WORD:
        for n in (len(word),) if listed else range(len(word) - 2, len(word) + 3):
            cuts = [n * k // _SEGMENTS for k in range(_SEGMENTS + 1)]
            for k in range(_SEGMENTS):
                size = cuts[k + 1] - cuts[k]
                for shift in (0,) if listed else range(-2, 3):
                    at = cuts[k] + shift
                    if 0 <= at <= len(word) - size:
                        keys.add(f"{n}|{k}|{word[at : at + size]}")
    return keys


class Dictionary:
    """A symmetric-delete dictionary in memory, of words with their frequencies."""

    def __init__(self, words: Iterable[tuple[str, int]]):
        self.frequency = dict(words)
        self.holders: dict[str, list[str]] = defaultdict(list)
        for w in self.frequency:
            for k in lookup_keys(w, True):
                self.holders[k].append(w)

    def near(self, word: str) -> list[tuple[float, int, str]]:
        """(distance, -frequency, word of the list) of all within the reach, best first."""
        hits = {w for k in lookup_keys(word, False) for w in self.holders.get(k, ())}
        found = [(weighted_distance(word, w, 2.0), -self.frequency[w], w) for w in hits]
        return sorted(x for x in found if within_reach(x[0], word, x[2]))


def within_reach(distance: float, a: str, b: str) -> bool:
    return distance <= min(2.0, max(reach(a), reach(b)))
