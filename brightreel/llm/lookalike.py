"""Problem 3: visually identical text with different characters.

Method: a longest-match transducer over grapheme clusters. Its mapping is
built once from rules of the Unicode data (widths, font forms, ligatures,
compatibility spaces, composed accents) and a short list of look-alike
letters, and checked for conflicts: no key has two outputs, no output holds a
key. One pass over a value applies it. Whether a look-alike letter stands for
ordinary text is decided per word: in a word with letters of the other script
it does; a word that holds a letter which only its own script has is really in
that script and stays.

Values of plain ASCII, most of all, are passed on untouched. The work is per
row, without a shuffle.

Defined results: null stays null and is no case; empty values, ordinary
repeated spaces, precomposed accents, typographic quotes and dashes are no
cases; a very long value is one pass as well; extra columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightreel.session import table

# Letters that look like a Latin letter, script by script, each above its Latin twin.
CYRILLIC = "АВЕЅІЈКМНОРСТХУԚԜаеорсухѕіјһԁԛԝ"
CYRILLIC_TWIN = "ABESIJKMHOPCTXYQWaeopcyxsijhdqw"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορυϲ"
GREEK_TWIN = "ABEZHIKMNOPTYXaikvopuc"
ARMENIAN = "ԼՍՏՕհոսցօ"
ARMENIAN_TWIN = "LUSOhnugo"
CHEROKEE = "ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ"
CHEROKEE_TWIN = "ABCDEGHJKLMPRSTVWZ"
SCRIPTS = {"CYRILLIC", "GREEK", "ARMENIAN", "CHEROKEE"}
# A letter of phonetics, hyphens and marks that look like a plain one.
PLAIN = {"ɡ": "g", "‐": "-", "‑": "-", "­": "", "ʼ": "'"}
INVISIBLE = [0x034F, 0x061C, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), 0xFEFF]
JOINERS = "‌‍"


def _twins() -> tuple[dict[str, str], dict[str, str]]:
    """(look-alike -> Latin letter, look-alike -> script)."""
    pairs, script = {}, {}
    for name, letters, twins in (("CYRILLIC", CYRILLIC, CYRILLIC_TWIN), ("GREEK", GREEK, GREEK_TWIN), ("ARMENIAN", ARMENIAN, ARMENIAN_TWIN), ("CHEROKEE", CHEROKEE, CHEROKEE_TWIN)):
        if len(letters) != len(twins):
            raise ValueError(f"the list of {name} look-alikes is out of step")
        for a, b in zip(letters, twins):
            pairs[a], script[a] = b, name
    return pairs, script


TWIN, SCRIPT = _twins()


def _mapping() -> dict[str, str]:
    """Key sequence -> output, from rules; every key is checked for conflicts."""
    out: dict[str, str] = dict(PLAIN)

    def put(key: str, value: str) -> None:
        if key != value and out.setdefault(key, value) != value:
            raise ValueError(f"two outputs for {key!r}")

    for cp in INVISIBLE:
        put(chr(cp), "")
    for cp in [*range(0xA0, 0x3400), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800)]:
        c = chr(cp)
        form = unicodedata.decomposition(c)
        tag = form[1 : form.find(">")] if form.startswith("<") else ""
        if unicodedata.category(c) == "Zs":
            put(c, " ")
        elif tag in ("wide", "narrow", "font") or (tag == "compat" and (0xFB00 <= cp <= 0xFB06 or 0x2160 <= cp <= 0x217F)):
            put(c, unicodedata.normalize("NFKC", c))
        elif form and not tag and unicodedata.normalize("NFC", c) != c:
            put(c, unicodedata.normalize("NFC", c))  # singletons such as the Kelvin sign
    out = {k: "".join(out.get(c, c) for c in v) for k, v in out.items()}
    for v in out.values():
        if any(c in out for c in v):
            raise ValueError(f"an output holds a key: {v!r}")
    return out


MAPPING = _mapping()
_TRIE: dict = {}
for _k, _v in MAPPING.items():
    node = _TRIE
    for _c in _k:
        node = node.setdefault(_c, {})
    node[""] = _v
_CLUSTER = re.compile(r"[^̀-ͯ᪰-᫿᷀-᷿⃐-⃿゙゚ᅡ-ᇿ][̀-ͯ᪰-᫿᷀-᷿⃐-⃿゙゚ᅡ-ᇿ]*|.", re.S)


def _script(c: str) -> str:
    if not c.isalpha():
        return ""
    cp = ord(c)
    if cp < 0x250 or 0x1E00 <= cp < 0x1F00:
        return "LATIN"
    if 0x370 <= cp < 0x400 or 0x1F00 <= cp < 0x2000:
        return "GREEK"
    if 0x400 <= cp < 0x530:
        return "CYRILLIC"
    if 0x530 <= cp < 0x590:
        return "ARMENIAN"
    if 0x13A0 <= cp < 0x1400:
        return "CHEROKEE"
    return "OTHER"


def _joins(c: str) -> bool:
    """Whether a joiner beside ``c`` is ordinary: Arabic to South Asian scripts and pictographs."""
    return bool(c) and (0x0600 <= ord(c) < 0x1100 or ord(c) >= 0x1F000 or 0x2600 <= ord(c) < 0x2800)


def _wide(c: str) -> bool:
    """Whether wide punctuation and spaces beside ``c`` are ordinary."""
    return bool(c) and (0x3005 <= ord(c) < 0xA000 or 0xAC00 <= ord(c) < 0xD7B0)


def _word(word: str, own: set[str], latin: bool) -> str:
    scripts = {_script(c) for c in word if c not in TWIN} - {""}
    seen = {SCRIPT[c] for c in word if c in TWIN}
    real = scripts & SCRIPTS
    if real:
        if "LATIN" in scripts and len(real) == 1:  # a Latin look-alike in a word of another script
            back = {TWIN[c]: c for c in TWIN if SCRIPT[c] == next(iter(real))}
            return "".join(back.get(c, c) for c in word)
        return word
    if not seen:
        return word
    if "LATIN" in scripts or len(seen) > 1 or (latin and not seen & own):
        return unicodedata.normalize("NFC", "".join(TWIN.get(c, c) for c in word))
    return word


def normalise(text: str | None) -> str | None:
    """``text`` in its one form."""
    if text is None or text.isascii():
        return text
    own = {_script(c) for c in text if c not in TWIN} & SCRIPTS
    latin = bool(re.search("[A-Za-z]", text)) or any(MAPPING.get(c, "").isascii() and MAPPING.get(c, "").isalpha() for c in text)
    out: list[str] = []
    word: list[str] = []
    last = ""

    def close() -> None:
        if word:
            out.append(_word("".join(word), own, latin))
            word.clear()

    for m in _CLUSTER.finditer(text):
        cluster, i = m.group(0), 0
        if len(cluster) > 1:
            cluster = unicodedata.normalize("NFC", cluster)
        while i < len(cluster):
            node, j, end, value = _TRIE, i, i + 1, cluster[i]
            while j < len(cluster) and cluster[j] in node:
                node = node[cluster[j]]
                j += 1
                if "" in node:
                    end, value = j, node[""]
            key = cluster[i:end]
            following = text[m.end() : m.end() + 1]
            if key in JOINERS and _joins(last) and _joins(following):
                value = key
            elif value != key and (key == "　" or (0xFF00 < ord(key[0]) < 0xFF61 and not value.isalnum())) and _wide(last) and (_wide(following) or not following):
                value = key
            for c in value:
                if c.isalpha() or unicodedata.combining(c) or (c in "'’" and word):
                    word.append(c)
                else:
                    close()
                    out.append(c)
            last = value[-1:] or last
            i = end
    close()
    return "".join(out)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column(2).to_pylist()
        done = [normalise(t) for t in texts]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(done, pa.string()), pa.array([d != t for d, t in zip(done, texts)], pa.bool_())], ["field_name", "row_id", "normal", "affected"])


def normalised(df: DataFrame, field_name: str, row_id: str, column: str) -> DataFrame:
    """(field_name, row_id, normal, affected) of each value of ``column``."""
    texts = df.select(F.lit(field_name).alias("field_name"), F.col(row_id).cast("bigint").alias("row_id"), F.col(column).alias("text"))
    return texts.mapInArrow(_apply, "field_name string, row_id bigint, normal string, affected boolean")


def p3_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = normalised(table(spark, sf_dir, "title_info"), "title_info.display_title", "title_row", "display_title")
    return titles.unionByName(normalised(table(spark, sf_dir, "venues"), "venues.name", "venue_row", "name"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_normalised(spark, sf_dir).where("affected").select("field_name", "row_id")
