"""Searches in JSON objects of unknown shape (F71-F75): strings one level deep, labels, flags, the first runtime.

The order of an object's keys matters to these searches, and no type of the
engine keeps it, so they run in Arrow batches, one pass for all of them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys and phrases that the searches look for.
LABEL_KEYS = {"format", "formatlabel", "experience", "presentation", "label", "name", "attributes", "attribute", "experiences", "presentations", "formats", "badges", "tags"}
RUNTIME_KEYS = {"runtime", "runtimeminutes", "runtimemin", "duration", "durationminutes", "featureruntime"}
FLAG_PARTS = ("alist", "a-list", "excluded", "subscription", "eligible")
FLAG_LISTS = {"attributes", "attribute", "badges", "labels", "tags"}
FLAG_PHRASES = ("excluded from a-list", "not eligible for a-list")
LABEL_WORDS = re.compile(r"caption|subtitled|laser|dolby|imax|prime|reald|3d|trailers", re.I)
RUNTIME = re.compile(r"(\d+)\s*h(?:r|our)?s?\s*(\d+)\s*m|(\d{2,3})\s*min", re.I)


def strings(x: object) -> list[str]:
    """the strings of a value, of its members, and of their members."""
    if isinstance(x, str):
        return [x]
    inner = x.values() if isinstance(x, dict) else x if isinstance(x, list) else ()
    out: list[str] = []
    for v in inner:
        deeper = v if isinstance(v, list) and isinstance(x, dict) else [v]
        for w in deeper:
            if isinstance(w, str):
                out.append(w)
            elif isinstance(w, dict) and (isinstance(x, list) or isinstance(v, list)):
                out += [s for s in w.values() if isinstance(s, str)]
    return out


def label(x: object) -> str | None:
    """the first two different format labels under the keys of labels, joined."""
    found: dict[str, str] = {}
    for k, v in x.items() if isinstance(x, dict) else ():
        if k.lower() in LABEL_KEYS:
            for s in strings(v):
                s = " ".join(s.split())
                if s and len(s) <= 90 and len(s.split()) <= 10 and LABEL_WORDS.search(s):
                    found.setdefault(s.lower(), s)
    return " / ".join(list(found.values())[:2]) or None


def flagged(x: object) -> bool:
    """whether a key or a badge says that a showing is left out."""
    said = lambda s: any(p in s.lower() for p in FLAG_PHRASES)
    for k, v in x.items() if isinstance(x, dict) else ():
        low = k.lower()
        if any(p in low for p in FLAG_PARTS) and (v is True or isinstance(v, str) and said(v)):
            return True
        if low in FLAG_LISTS and any(map(said, strings(v))):
            return True
    return False


def runtime(x: object) -> int | None:
    """the first runtime in depth-first order; numbers count from 30 to 400."""
    stack: list[object] = [("", x)]
    while stack:
        key, v = stack.pop()
        if key in RUNTIME_KEYS:
            if isinstance(v, int) and not isinstance(v, bool) and 30 <= v <= 400:
                return v
            if isinstance(v, str) and (m := RUNTIME.search(v)):
                return int(m[1]) * 60 + int(m[2]) if m[1] else int(m[3])
        elif isinstance(v, dict):
            stack += [(str(k).lower(), w) for k, w in reversed(list(v.items()))]
        elif isinstance(v, list):
            stack += [("", w) for w in reversed(v)]
    return None


def listed(x: object, kind: str) -> list[dict]:
    """the objects of a type, whether a page holds one object, a list, or a graph."""
    if isinstance(x, dict) and isinstance(x.get("@graph"), list):
        x = x["@graph"]
    own = x if isinstance(x, list) else [x]
    return [o for o in own if isinstance(o, dict) and kind in (o["@type"] if isinstance(o.get("@type"), list) else [o.get("@type")])]


def object_facts(df: DataFrame, id_column: str, json_column: str) -> DataFrame:
    """(id, n_strings, label, flagged, runtime, movies) of JSON texts; null, broken and empty texts have none, and are not flagged."""
    kind = df.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(1).to_pylist():
                try:
                    x = json.loads(t) if t else None
                except (ValueError, RecursionError):
                    x = None
                rows.append((len(strings(x)), label(x), flagged(x), runtime(x), len(listed(x, "Movie"))))
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.string(), pa.bool_(), pa.int32(), pa.int32()))]], ["id", "n_strings", "label", "flagged", "runtime", "movies"])

    return df.select(F.col(id_column), F.col(json_column)).mapInArrow(run, f"id {kind}, n_strings int, label string, flagged boolean, runtime int, movies int")
