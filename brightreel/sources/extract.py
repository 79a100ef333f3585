"""Rows out of semi-structured text (X1-X6, X11): parsers run per text in Arrow batches."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields that name a title or hold a start time, in order.
TITLE_FIELDS = ["movieTitle", "movieName", "title", "name", "displayName"]
TIME_FIELDS = ["showDateTimeUtc", "showDateTimeLocal", "showDateTime", "startDateTime", "startTime", "startsAt", "start", "dateTime", "time"]
ANCHOR_REACH = 12_000
# A page without one of these has no heading block.
HEADED = re.compile("(?i)<h[1-6]|/movies/")


def walk(node: object, title: str | None = None) -> Iterator[tuple[str, str]]:
    """(title, time text) of every object with a start time; a title is inherited until another overrides it."""
    stack = [(node, title)]
    while stack:
        x, t = stack.pop()
        if isinstance(x, dict):
            t = next((x[k] for k in TITLE_FIELDS if isinstance(x.get(k), str) and x[k].strip()), t)
            for k in TIME_FIELDS:
                if isinstance(x.get(k), str) and t:
                    yield t, x[k]
            stack += [(v, t) for v in reversed(list(x.values())) if isinstance(v, (dict, list))]
        elif isinstance(x, list):
            stack += [(v, t) for v in reversed(x) if isinstance(v, (dict, list))]


_SCRIPT = re.compile(r"<script[^>]*>(.*?)</script>", re.S | re.I)


def scripts(page: str) -> Iterator[tuple[str, str]]:
    """The walk over every script of a page that is JSON."""
    for m in _SCRIPT.finditer(page):
        body = m.group(1).strip()
        if body[:1] in "[{":
            try:
                yield from walk(json.loads(body))
            except ValueError:
                continue


_RECORD = re.compile(r'"showtimeId":\s*"?(\w+)"?([^{}]*?)"status":\s*"(\w+)"[^{}]*?"showDateTimeUtc":\s*"([^"]+)"')
_ANCHOR = re.compile(r'"(?:movieTitle|movieName)":\s*"((?:[^"\\]|\\.)*)"')


def flight(page: str) -> list[tuple[str, str, str]]:
    """(id, title, UTC text) of escaped records in order of their fields; the title is the last one before, within reach."""
    text = page
    for _ in range(2):
        text = text.replace('\\"', '"')
    anchors = [(m.end(), m.group(1)) for m in _ANCHOR.finditer(text)]
    out, k = [], 0
    for m in _RECORD.finditer(text):
        while k < len(anchors) and anchors[k][0] <= m.start():
            k += 1
        if k and m.start() - anchors[k - 1][0] <= ANCHOR_REACH and m.group(3).lower() not in ("canceled", "cancelled"):
            out.append((m.group(1), html.unescape(anchors[k - 1][1]), m.group(4)))
    return out


class _Regions(HTMLParser):
    """Clock links inside regions labelled 'Showtimes for ...'; X11: title, Open Graph fields."""

    CLOCK = re.compile(r"\b\d{1,2}:\d{2}\s*[ap]m\b", re.I)

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.regions, self.link, self.rows, self.text, self.meta, self.in_title = 0, [], None, [], [], {}, False

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "meta":
            if a.get("property", "").startswith("og:"):
                self.meta.setdefault(a["property"], a.get("content"))
            return
        if tag in ("br", "img", "input", "link", "hr", "source"):
            return
        self.depth += 1
        label = a.get("aria-label") or ""
        if label.startswith("Showtimes for "):
            self.regions.append((self.depth, label[len("Showtimes for ") :].strip()))
        if tag == "a" and re.search(r"/showtimes/\w+", a.get("href") or ""):
            self.link = (a["href"].rstrip("/").rsplit("/", 1)[-1], [])
        self.in_title = tag == "title"

    def handle_data(self, data):
        if self.link:
            self.link[1].append(data)
        if self.in_title:
            self.meta.setdefault("title", data.strip())
        self.text.append(data)

    def handle_endtag(self, tag):
        if tag == "a" and self.link:
            clock = self.CLOCK.search(" ".join(self.link[1]))
            if clock and self.regions:
                self.rows.append((self.link[0], self.regions[-1][1], clock.group(0)))
            self.link = None
        if self.regions and self.regions[-1][0] == self.depth:
            self.regions.pop()
        self.depth = max(0, self.depth - 1)
        self.in_title = False


def regions(page: str) -> list[tuple[str, str, str]]:
    """(id, title, clock)."""
    p = _Regions()
    p.feed(page)
    return p.rows


class _Blocks(HTMLParser):
    """Headings, movie links and clocks of a page in their order."""

    TIME = re.compile(r"\d{1,2}:\d{2}\s*[ap]m", re.I)
    RUNTIME = re.compile(r"\d+\s*hr?\s*\d+\s*min|\d+\s*min", re.I)
    VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
    NO_TITLE = re.compile("showtimes|read more|amc stubs|excluded from a-list|reserved seating|details|trailer|movie theater|available at|fan faves|caption|subtitle|imax|dolby|laser at amc|prime at amc|reald|ticket", re.I)

    DAY = re.compile(r"^(?:sat|sun|mon|tue|wed|thu|fri|jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\b", re.I)

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.items = [], []

    def handle_starttag(self, tag, attrs):
        if tag not in self.VOID:
            self.open.append({"tag": tag, "attrs": {k: v or "" for k, v in attrs}, "text": [], "movie": None, "clock": False})

    def handle_data(self, data):
        for e in self.open:
            e["text"].append(data)

    def handle_endtag(self, tag):
        if any(e["tag"] == tag for e in self.open):
            while self._close(self.open.pop()) != tag:
                pass

    def close(self):
        super().close()
        while self.open:
            self._close(self.open.pop())

    def _close(self, e) -> str:
        """Notes what the element is; of nested elements with a clock the innermost counts, but a link or button before its parts."""
        text, tag, href = " ".join(" ".join(e["text"]).split()), e["tag"], e["attrs"].get("href", "")
        if tag in ("script", "style"):
            return tag
        heading = re.fullmatch("h[1-6]", tag)
        if tag == "a" and text and re.search(r"/movies/[^/]+", href):
            self.items.append(("movie", text))
            for o in self.open:
                if re.fullmatch("h[1-5]", o["tag"]):
                    o["movie"] = o["movie"] or text
        if heading and text:
            self.items.append(("linked" if e["movie"] else "heading", e["movie"] or text))
        clock = self.TIME.search(text)
        within = any(o["tag"] in ("a", "button") for o in self.open)
        named = re.search("showtime|session|time", " ".join(f"{k}={v}" for k, v in e["attrs"].items()), re.I)
        if clock and not heading and not e["clock"] and not within and len(text) <= 120 and (tag in ("a", "button") or named or clock.start() == 0):
            shown = re.search(r"/showtimes/(\w+)", href)
            self.items.append(("clock", (shown.group(1) if shown else None, clock.group(0))))
            for o in self.open:
                o["clock"] = True
        elif not heading and self.RUNTIME.search(text) and not e["clock"] and len(text) <= 120:
            self.items.append(("runtime", text))
        return tag


def heading_blocks(page: str) -> list[tuple[str | None, str, str]]:
    """(id, title, clock) of the clocks between a title and the next one.

    Titles are headings with a movie link, else headings that may be a title
    with a clock or running time before the next, else movie links.
    """
    p = _Blocks()
    p.feed(page)
    p.close()
    items = p.items
    kinds = {k for k, _ in items}
    pick = "linked" if "linked" in kinds else "heading" if any(k == "heading" and _titled(items, i) for i, (k, _) in enumerate(items)) else "movie"
    out, title = {}, None
    for i, (kind, value) in enumerate(items):
        if kind == pick and (kind != "heading" or _titled(items, i)):
            title = value
        elif kind == "clock" and title:
            out[value[0], title, value[1]] = None
    return list(out)


def _titled(items: list, i: int) -> bool:
    text = items[i][1]
    if not 2 <= len(text) <= 160 or _Blocks.TIME.search(text) or _Blocks.RUNTIME.search(text) or _Blocks.NO_TITLE.search(text) or _Blocks.DAY.search(text) or not any(c.isalpha() for c in text):
        return False
    after = next((k for k, _ in items[i + 1 :] if k in ("clock", "runtime", "heading", "linked")), None)
    return after in ("clock", "runtime")


def metadata(page: str) -> dict[str, str | None]:
    """X11: the title by Open Graph, then the title element; picture; visible text is not read."""
    p = _Regions()
    p.feed(page)
    return {"title": p.meta.get("og:title") or p.meta.get("title"), "poster_url": p.meta.get("og:image")}


def infobox_image(wikitext: Column) -> Column:
    """The file name of the first image field of an infobox; null without one. The whole text is read."""
    name = F.regexp_extract(wikitext, r"(?im)^\s*\|\s*image\s*=\s*(?:\[\[)?(?:File:|Image:)?\s*([^\]|\n]+?)\s*(?:\||\]|$)", 1)
    return F.when(name != "", name)


def showings(pages: DataFrame) -> DataFrame:
    """(page_id, kind, showing_id, title, time) from (page_id, html).

    A text filter that Spark can run goes before the parsers, which it can't look into.
    """
    some = pages.where(F.col("html").isNotNull() & (F.col("html").contains("showtime") | F.col("html").contains("Showtimes") | F.col("html").contains("start") | F.col("html").rlike(HEADED.pattern)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                shown = [(i, "rendered", *r) for r in regions(page)]
                if not shown and HEADED.search(page):
                    rows += [(i, "heading", *r) for r in heading_blocks(page)]
                found = shown + [(i, "flight", *r) for r in flight(page)]
                rows += found or [(i, "script", None, *r) for r in dict.fromkeys(scripts(page))]
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *[pa.array(c, pa.string()) for c in cols[1:]]], ["page_id", "kind", "showing_id", "title", "time"])

    return some.select(F.col("page_id").cast("bigint"), "html").mapInArrow(run, "page_id bigint, kind string, showing_id string, title string, time string")


def _replaced(c: Column, pairs: list[tuple[str, str]]) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


# What separates the parts of a programme text, and its escapes; the escape sign comes first.
ESCAPES = [("\\", "\\b"), ("\n", "\\n"), (",", "\\c")]


def escape_part(c: Column) -> Column:
    """A part of a programme text without separators; parse_blob(escaped=True) reads it back."""
    return _replaced(c, ESCAPES)


def escape_html(c: Column) -> Column:
    """Text as it stands in a page, in an attribute too."""
    return _replaced(c, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")])


def parse_blob(df: DataFrame, key: str, blob: str, escaped: bool = False) -> DataFrame:
    """(key, theatre, show_date, show_time) out of lines '# theatre' followed by lines '* date: time, time'.

    The text is split at its headers, so that each date line carries its theatre without a window.
    """
    part = F.explode(F.filter(F.split(F.concat(F.lit("\n"), F.col(blob)), "\n# "), lambda x: F.trim(x) != ""))
    lines = df.select(key, part.alias("p")).select(key, F.split("p", "\n")[0].alias("theatre"), F.explode(F.slice(F.split("p", "\n"), 2, 1_000_000)).alias("line"))
    dated = lines.select(key, "theatre", F.regexp_extract("line", r"^\* (\d{4}-\d{2}-\d{2}): ", 1).try_cast("date").alias("show_date"), F.regexp_replace("line", r"^\* \d{4}-\d{2}-\d{2}: ", "").alias("t")).where("show_date is not null")
    rows = dated.select(key, "theatre", "show_date", F.explode(F.split("t", ", ")).alias("show_time"))
    plain = [(b, a) for a, b in reversed(ESCAPES)] if escaped else []
    return rows.select(key, _replaced(F.col("theatre"), plain).alias("theatre"), "show_date", _replaced(F.col("show_time"), plain).alias("show_time"))


def claim_values(df: DataFrame, key: str, entity: str) -> DataFrame:
    """(key, property, pos, value) of the claims of a JSON entity; malformed claims are skipped, objects stay JSON."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, *c) for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for c in flat_claims(x)]
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.string())], [key, "property", "pos", "value"])

    return df.select(F.col(key).cast("bigint"), entity).mapInArrow(run, f"{key} bigint, property string, pos int, value string")


def flat_claims(text: str | None) -> Iterator[tuple[str, int, str]]:
    try:
        claims = json.loads(text or "{}")["claims"].items()
    except (ValueError, KeyError, TypeError, AttributeError):
        return
    for name, values in claims:
        for pos, claim in enumerate(values if isinstance(values, list) else []):
            try:
                value = claim["mainsnak"]["datavalue"]["value"]
            except (KeyError, TypeError):
                continue
            yield name, pos, value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
