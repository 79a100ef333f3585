"""Problem 9: personal information inside free text.

Method: anchor expansion. One Aho-Corasick pass over a text finds at-signs and
their spelled-out forms, words of streets, cues of persons, and digits, of
which the first of each run anchors numbers. From each anchor a deterministic
local parser expands to the left and right and validates what it finds (labels
of a domain, groups of a telephone number, forms of identity numbers, parts of
a name). The work is per text, without a shuffle, over whole texts.

To the left a parser reads as far as the longest form of its kind goes:
LOCAL_PART (the standard's own limit), STREET, HOUSE and PERSON characters.

Defined results: null and empty texts have no findings and stay as they are;
overlapping findings give the one that comes first in the order of KINDS, then
the longer one; repeated pieces of a text are one row of p9_found but are all
replaced; extra columns pass through ``redact`` unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightreel.session import table

KINDS = ["email", "id_number", "address", "phone", "name"]

# Anchors. Each list names what starts a local parser.
AT_SIGNS = ["@", "(at)", "[at]", "{at}", " at "]
STREET_WORDS = ["street", "st", "avenue", "ave", "road", "rd", "lane", "ln", "court", "ct", "boulevard", "blvd", "drive", "dr", "way", "terrace", "ter", "place", "pl", "square", "sq", "close", "crescent", "row", "parkway", "pkwy", "highway", "hwy", "circle", "cir", "trail", "alley"]
STREETS_BEFORE_NUMBER = ["straße", "strasse", "str.", "weg", "allee", "gasse", "platz", "ufer", "damm"]
STREETS_FIRST = ["calle", "avda.", "avenida", "c/", "plaza", "paseo", "camino"]
STREETS_FRENCH = ["rue", "avenue", "boulevard", "allée", "chemin", "impasse", "quai", "place", "cours", "av.", "bd"]
NAME_CUES = [
    "my name is", "i am called", "signed,", "sincerely,", "regards,", "yours,", "faithfully,", "truly,", "thanks,", "thank you,", "cheers,", "best,", "wishes,",
    "holder", "report by", "manager,", "usher", "cashier", "projectionist", "refund goes to", "refund to", "invoice for", "voucher to", "message for", "patron", "customer", "guest",
    "according to", "please call", "reported by", "spoke to", "spoke with", "ask for", "asked for", "mr.", "mr", "mrs.", "mrs", "ms.", "ms", "miss", "dr.", "dr", "prof.", "professor", "sir", "madam",
    "my sister", "my brother", "my mother", "my father", "my husband", "my wife", "my friend", "my neighbour", "my neighbor", "my colleague", "my daughter", "my son", "my aunt", "my uncle", "my cousin",
    "ich heiße", "mein name ist", "grüßen,", "grüße,", "herr", "frau", "me llamo", "mi nombre es", "atentamente,", "saludos,", "señora", "señor", "sra.", "sr.", "don", "doña",
    "je m'appelle", "je m’appelle", "mon nom est", "cordialement,", "madame", "monsieur", "mme", "mlle", "amicalement,", "salutations,",
]
NAME_FOLLOWERS = ["moved from", "lives at", "resides at", "wohnt in", "vive en", "habite", "wrote to us", "called us"]
# Particles of surnames.
PARTICLES = "van der|van den|van de|van|von der|von|de la|de los|del|de|di|da|le|la"

# How long the parts before an anchor may be.
LOCAL_PART, STREET, HOUSE, PERSON = 64, 160, 24, 160
DIGITS = "0123456789"

_UP = r"[^\W\d_a-zß-öø-ÿ]"
_WORD = rf"{_UP}(?:[^\W\d_]|['’](?=\w))+"
_SP = r"(?:[ \t\u00a0]+\n?|\n)[ \t\u00a0]*"
_SUR = rf"(?:(?i:{PARTICLES}){_SP})?{_WORD}(?:[-\u2010\u2011]{_WORD})*"
NAME = re.compile(rf"(?:{_WORD}{_SP}(?:{_UP}\.?{_SP})?{_SUR}|{_UP}\.{_SP}(?:{_UP}\.{_SP})?{_SUR}|{_SUR},{_SP}(?:{_WORD}(?:{_SP}{_UP}\.)?|{_UP}\.))(?!\w)")
NAME_AFTER = re.compile(r"[ \t\n\u00a0]+")

LOCAL = re.compile(r"[A-Za-z0-9_%+\-]+(?:\.[A-Za-z0-9_%+\-]+)*$")
_DOT = r"(?:\.|[ ]?[\[({]dot[\])}][ ]?| dot )"
DOMAIN = re.compile(rf"[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?(?:{_DOT}[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?)*{_DOT}[A-Za-z]{{2,}}(?![A-Za-z0-9])", re.I)

_D = r"[ .\-\u2010\u2011\u2013\u00a0]"
ID_FORMS = re.compile(
    r"(?<![\w\-.])(?:ID-\d{3}\.\d{3}\.\d{3}-\d|\d{3}[-‐‑ ]\d{2}[-‐‑ ]\d{4}|[A-Z]\d{3}-\d{4}-\d{4}|[A-Z]{2}\d{7}|[A-Z]\d{2} \d{3} \d{3}|\d{8}-[A-Z])(?![\w]|[-‐‑.]\d)"
)
PHONE_FORMS = re.compile(
    rf"(?<![\w#$€£+\-‐‑./])(?:\+\d{{1,3}}(?:{_D}?\(?\d{{1,5}}\)?){{2,5}}"
    rf"|(?:1{_D}?)?\([2-9]\d{{2}}\){_D}?\d{{3}}{_D}?\d{{4}}"
    rf"|(?:1{_D})?[2-9]\d{{2}}(?P<s>{_D})\d{{3}}(?P=s)\d{{4}}"
    rf"|1?[2-9]\d{{2}}[2-9]\d{{6}}"
    rf"|555{_D}\d{{4}}"
    rf"|0\d{{1,4}}(?:[ /.\-]\d{{2,8}}){{1,4}})(?![\w]|[-‐‑]\d|[.,:]\d)"
)

_HOUSE = r"\d{1,5}(?:[ ]?(?:[A-Za-z]\b|bis\b|ter\b))?"
_EN_NAME = r"(?:[^\W\d_]|['’.])+"
ADDRESS_EN = re.compile(rf"(?<![\w#$€£.\-:])\d{{1,5}}[A-Za-z]?{_SP}(?:(?:[NSEW]|NE|NW|SE|SW)\.?{_SP})?(?:{_EN_NAME}{_SP}){{1,3}}?$", re.I)
ADDRESS_FR = re.compile(rf"(?<![\w#$€£.\-:])\d{{1,5}}(?:{_SP}?(?:bis|ter))?,?{_SP}$", re.I)
FR_NAME = re.compile(rf"{_SP}(?:(?:de la|de l['’]|du|des|de|la|le){_SP})?[^\W\d_][\w'’\-]*", re.I)
DE_BACK = re.compile(r"[^\W\d_][^\W\d_\-]*[ -]?$")
DE_NUMBER = re.compile(rf"{_SP}\d{{1,5}}(?:[ ]?[a-z])?(?!\w)")
ES_NUMBER = re.compile(rf"{_SP}(?:(?:de la|del|de|la|el){_SP})?{_WORD}(?:{_SP}{_WORD})?,?(?:{_SP}(?i:nº|n\.º|no\.|num\.|número))?{_SP}\d{{1,5}}(?![\w:])")

_tools: dict[str, object] = {}


def _automaton() -> ahocorasick.Automaton:
    if "a" not in _tools:
        a = ahocorasick.Automaton()
        kinds: dict[str, set[str]] = {}
        for kind, words in (("at", AT_SIGNS), ("en", STREET_WORDS), ("de", STREETS_BEFORE_NUMBER), ("es", STREETS_FIRST), ("fr", STREETS_FRENCH), ("cue", NAME_CUES), ("after", NAME_FOLLOWERS), ("digit", DIGITS)):
            for w in words:
                kinds.setdefault(w, set()).add(kind)
        for w, k in kinds.items():
            a.add_word(w, (w, frozenset(k)))
        a.make_automaton()
        _tools["a"] = a
    return _tools["a"]


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _email(text: str, start: int, end: int) -> tuple[int, int] | None:
    left = start
    while left > 0 and text[left - 1] == " " and start - left < 1:
        left -= 1
    m = LOCAL.search(text, max(0, left - LOCAL_PART), left)
    if not m:
        return None
    right = end + 1 if text[end : end + 1] == " " else end
    d = DOMAIN.match(text, right)
    spaced = left < start or right > end or text[start:end] == " at "
    if not d or (text[start:end] == " at " and not re.search(r"dot", d.group(0), re.I)):
        return None
    if spaced and text[start:end] == "@" and (left < start) != (right > end):
        return None
    return m.start(), d.end()


def _english(text: str, start: int, end: int) -> tuple[int, int] | None:
    m = ADDRESS_EN.search(text, max(0, start - STREET), start)
    if not m:
        return None
    words = text[m.start() : start].split()[1:]
    if any(w[-1] == "." and len(w.rstrip(".")) > 2 for w in words):  # a sentence ended between
        return None
    case = [w for w in words if w[:1].isalpha()]
    lowered = [w for w in case if w[0].islower()]
    if lowered and (len(lowered) < len(case) or len(case) > 2 or text[start].isupper()):
        return None
    if not lowered and text[start].islower():
        return None
    long = [w for w in case if len(w) > 2]
    if any(w.isupper() != text[start:end].isupper() for w in long) or any(w.lower() in ("the", "on", "of", "a", "an", "and", "in", "to", "by", "at", "with") for w in words):
        return None
    word = text[start:end].lower()
    if text[end : end + 1] == "." and (word in ("st", "rd") or re.match(r"\.(?:[.,;?!]|\s+[a-z])", text[end : end + 3])):
        end += 1
    return m.start(), end


def _id_number(text: str, start: int, least: int) -> tuple[int, int] | None:
    """The identity number around a digit run that begins at ``start``; not before ``least``."""
    for at in range(max(least, start - 3), start + 1):
        # By form only: invented numbers are often of ranges that no office issues, and must go as well.
        if m := ID_FORMS.match(text, at):
            return m.start(), m.end()
    return None


def _phone(text: str, start: int, least: int) -> tuple[int, int] | None:
    """The telephone number around a digit run that begins at ``start``; not before ``least``."""
    for at in range(max(least, start - 1), start + 1):
        if m := PHONE_FORMS.match(text, at):
            digits = sum(c.isdigit() for c in m.group(0))
            return (m.start(), m.end()) if 7 <= digits <= 15 and (digits > 7 or m.group(0).startswith("555")) else (at, -m.end())
    return None


def find(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the personal information in a text, in order, without overlap."""
    if not text:
        return []
    low, found = _lower(text), []
    id_end = phone_end = 0
    for last, (word, kinds) in _automaton().iter(low):
        start, end = last - len(word) + 1, last + 1
        if "digit" in kinds:
            if start and text[start - 1] in DIGITS:
                continue
            if start >= id_end and (hit := _id_number(text, start, id_end)):
                found.append((*hit, "id_number"))
                id_end = hit[1]
            if start >= phone_end and (hit := _phone(text, start, phone_end)):
                phone_end = abs(hit[1])
                if hit[1] > 0:
                    found.append((*hit, "phone"))
            continue
        if "at" in kinds and (hit := _email(text, start, end)):
            found.append((*hit, "email"))
        whole = not (start and low[start - 1].isalnum()) and not (end < len(low) and low[end].isalnum())
        if "de" in kinds and not (end < len(low) and low[end].isalpha()):
            if (n := DE_NUMBER.match(text, end)) and (b := DE_BACK.search(text, max(0, start - STREET), start)) and text[b.start()].isupper():
                found.append((b.start(), n.end(), "address"))
        if not whole:
            continue
        if "en" in kinds and (hit := _english(text, start, end)):
            found.append((*hit, "address"))
        if "fr" in kinds and (b := ADDRESS_FR.search(text, max(0, start - HOUSE), start)) and (n := FR_NAME.match(text, end)):
            found.append((b.start(), n.end(), "address"))
        if "es" in kinds and (n := ES_NUMBER.match(text, end)):
            found.append((start, n.end(), "address"))
        shouted = end - start > 3 and text[start:end].isupper()  # in a text in capitals, capitals mark no name
        if "cue" in kinds and not shouted and (gap := NAME_AFTER.match(text, end)) and (n := NAME.match(text, gap.end())):
            found.append((n.start(), n.end(), "name"))
        if "after" in kinds:
            for n in NAME.finditer(text, max(0, start - PERSON), start):
                if not text[n.end() : start].strip():
                    found.append((n.start(), n.end(), "name"))
    kept: list[tuple[int, int, str]] = []
    for s, e, k in sorted(found, key=lambda x: (KINDS.index(x[2]), x[0] - x[1], x[0])):
        if all(e <= a or b <= s for a, b, _ in kept):
            kept.append((s, e, k))
    return sorted(kept)


def replaced(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with each span replaced by the placeholder of its kind, such as ``<EMAIL>``."""
    if text is None:
        return None
    parts, at = [], 0
    for s, e, k in spans:
        parts += [text[at:s], f"<{k.upper()}>"]
        at = e
    return "".join(parts) + text[at:]


_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("pii_text", pa.string())]))


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> (id, found, redacted)."""
    for b in batches:
        ids, texts = b.column(0), b.column(1).to_pylist()
        spans = [find(t) for t in texts]
        found = [[{"kind": k, "pii_text": p} for k, p in dict.fromkeys((k, t[s:e]) for s, e, k in x)] for t, x in zip(texts, spans)]
        yield pa.RecordBatch.from_arrays([ids, pa.array(found, _FOUND), pa.array([replaced(t, x) for t, x in zip(texts, spans)], pa.string())], ["id", "found", "redacted"])


def redact(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, found, redacted): the distinct findings of each text, and the text with placeholders."""
    kind = df.schema[id_column].dataType.simpleString()
    return df.select(F.col(id_column), F.col(text_column)).mapInArrow(scan, f"id {kind}, found array<struct<kind:string,pii_text:string>>, redacted string")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = redact(table(spark, sf_dir, "documents"), "doc_id", "text")
    return out.select(F.col("id").alias("doc_id"), F.explode("found").alias("f")).select("doc_id", "f.kind", "f.pii_text")


def p9_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redact(table(spark, sf_dir, "documents"), "doc_id", "text").select(F.col("id").alias("doc_id"), "redacted")
