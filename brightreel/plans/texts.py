"""Queries of text, time and extraction functions: F*, X*, P3, P5, P12, P13, P18, P22, P23, C7, C8."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightreel.functions import text
from brightreel.plans.base import query
from brightreel.sources.extract import claim_values

SP = "[ \\t\\n\\r\u00a0\u202f]+"
LIT = "trim(regexp_replace(regexp_replace(lower({0}), '&', ' and ', 'g'), '[^a-z0-9]+', ' ', 'g'))"
MATCH = "trim(regexp_replace(regexp_replace(' ' || " + LIT + " || ' ', ' (?:the|an|a) ', ' ', 'g'), ' +', ' ', 'g'))"


@query(f"""SELECT title_row, trim(regexp_replace(display_title, '{SP}', ' ', 'g'), ' ') AS collapsed, {LIT.format('display_title')} AS literal, {MATCH.format('display_title')} AS matching,
{LIT.format("regexp_replace(display_title, '\\s*\\((?:[^()]*\\b(?:film|movie)|\\d{4})\\)\\s*$', '', 'i')")} AS identity, trim(regexp_replace(lower(display_title), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
CASE WHEN length(display_title) > 40 THEN substring(display_title, 1, 37) || '...' ELSE display_title END AS short FROM title_info""")
def q_normalise_text(t):
    """Text keys."""
    d = F.col("display_title")
    return t.title_info.select("title_row", text.collapse(d).alias("collapsed"), text.literal_key(d).alias("literal"), text.match_key(d).alias("matching"), text.identity_key(d).alias("identity"), text.slug(d).alias("slug"), text.truncate(d).alias("short"))


@query(f"""WITH k AS (SELECT theatre_id, {LIT.format('name')} AS a FROM theatre), v AS (SELECT theatre_id, a, regexp_replace(a, '^\\S+ ', '') AS b FROM k)
SELECT DISTINCT theatre_id, unnest([a, b, regexp_replace(b, ' \\d+\\b', '', 'g'), regexp_replace(b, ' at .*$', '')]) AS variant FROM v""")
def q_key_variants(t):
    """Keys of a place, exploded."""
    return t.theatre.select("theatre_id", F.explode(text.place_variants(F.col("name"))).alias("variant"))


@query("""SELECT ingest_seq, CASE WHEN lower(format_label) LIKE '%open caption%' THEN 'Open Caption' WHEN lower(format_label) LIKE '%closed caption%' THEN 'Closed Caption' WHEN lower(format_label) LIKE '%subtitled%' THEN 'Subtitled'
WHEN lower(format_label) LIKE '%laser%' THEN 'Laser' WHEN lower(format_label) LIKE '%dolby%' THEN 'Dolby' WHEN lower(format_label) LIKE '%imax%' THEN 'IMAX' WHEN lower(format_label) LIKE '%prime%' THEN 'Prime'
WHEN lower(format_label) LIKE '%reald%' OR lower(format_label) LIKE '%3d%' THEN '3D' WHEN lower(format_label) LIKE '%no trailers%' THEN 'No Trailers' ELSE format_label END AS label FROM showtime""")
def q_label_cascade(t):
    """the first matching rule names the label."""
    return t.showtime.select("ingest_seq", text.format_label(F.col("format_label")).alias("label"))


@query(r"""SELECT title_row, CASE title_row % 4 WHEN 0 THEN 'hindi' WHEN 1 THEN CASE WHEN regexp_matches(coalesce(display_title, ''), '[\s\x{00A0}\x{202F}][-–—][\s\x{00A0}\x{202F}][^()\[\]]*$') THEN '' ELSE 'mandarin chinese' END ELSE '' END AS version, CASE title_row % 4 WHEN 2 THEN 'korean|tamil' ELSE '' END AS spoken FROM title_info""")
def q_languages(t):
    """Languages of wordings put behind every title; a dash suffix begins at the first dash, as in the reference."""
    suffix = F.element_at(F.array(*[F.lit(x) for x in (" (Hindi with English Subtitles)", " - Mandarin Chinese Dubbed (2024)", ", Tamil Spoken with English Subtitles; [Korean  Spoken with subs], Tamil spoken with", " [Korean War]")]), (F.col("title_row") % 4 + 1).cast("int"))
    d = t.title_info.select("title_row", F.concat(F.coalesce("display_title", F.lit("")), suffix).alias("d"))
    return d.select("title_row", F.array_join(text.version_languages(F.col("d")), "|").alias("version"), F.array_join(text.spoken_languages(F.col("d")), "|").alias("spoken"))


@query(r"""WITH e AS (SELECT event_id, regexp_extract(props, '"k": (\d+)', 1) AS k FROM events)
SELECT event_id, 'P1' AS property, CAST(0 AS INT) AS pos, k AS value FROM e WHERE k <> '' UNION ALL SELECT event_id, 'P1', 2, 'text' FROM e WHERE k <> '' UNION ALL SELECT event_id, 'P2', 0, '{"id": "Q' || k || '"}' FROM e WHERE k <> ''""")
def q_claims_flatten(t):
    """Claims flattened, malformed ones skipped."""
    k = F.regexp_extract("props", r'"k": (\d+)', 1)
    e = t.events.select("event_id", k.alias("k")).where("k <> ''")
    entity = F.format_string('{"claims": {"P1": [{"mainsnak": {"datavalue": {"value": %s}}}, {"mainsnak": {}}, {"mainsnak": {"datavalue": {"value": "text"}}}, 5], "P2": [{"mainsnak": {"datavalue": {"value": {"id": "Q%s"}}}}], "P3": "x"}}', "k", "k")
    return claim_values(e.select("event_id", entity.alias("entity")), "event_id", "entity")


@query(r"""WITH c AS (SELECT ingest_seq, show_time, regexp_matches(show_time, '^\s*\d{1,2}:\d{2}\s*[aApP][mM]\s*$') AS ok, try_cast(regexp_extract(show_time, '(\d{1,2}):', 1) AS INT) AS h, try_cast(regexp_extract(show_time, ':(\d{2})', 1) AS INT) AS m, lower(show_time) LIKE '%p%' AS pm FROM showtime),
k AS (SELECT ingest_seq, CASE WHEN ok AND h BETWEEN 1 AND 12 AND m <= 59 THEN h % 12 * 60 + m + CASE WHEN pm THEN 720 ELSE 0 END ELSE 1000000000 END AS minutes FROM c)
SELECT ingest_seq, minutes, CASE WHEN minutes < 1440 THEN CAST(CASE WHEN minutes // 60 % 12 = 0 THEN 12 ELSE minutes // 60 % 12 END AS VARCHAR) || ':' || lpad(CAST(minutes % 60 AS VARCHAR), 2, '0') || CASE WHEN minutes // 60 < 12 THEN ' am' ELSE ' pm' END END AS clock FROM k""")
def q_clock_keys(t):
    """Minutes of a clock text, sorted last where there is none, and its canonical form."""
    k = t.showtime.select("ingest_seq", text.clock_minutes(F.col("show_time")).alias("minutes"))
    return k.withColumn("clock", F.when(F.col("minutes") < 1440, text.clock_key(F.col("minutes"))))


@query("""SELECT film_id, CAST(runtimeMin // 60 AS VARCHAR) || 'h ' || CAST(runtimeMin % 60 AS VARCHAR) || 'm' AS runtime, runtimeMin AS again FROM films""")
def q_runtime_format(t):
    """Minutes to text and back."""
    r = t.films.select("film_id", text.runtime_text(F.col("runtimeMin")).alias("runtime"))
    return r.withColumn("again", text.runtime_minutes(F.col("runtime")))


@query("""SELECT context_id, CASE WHEN expected_year IS NOT NULL OR runtime_min IS NOT NULL THEN coalesce(CAST(expected_year AS VARCHAR), '-') || '/' || coalesce(CAST(runtime_min AS VARCHAR), '-') END AS pair, round_even(runtime_min / 8.0, 1) AS eighth FROM movie_context""")
def q_score_pair(t):
    """pair with a dash for the missing side; half-even rounding."""
    return t.movie_context.select("context_id", text.score_pair(F.col("expected_year"), F.col("runtime_min")).alias("pair"), F.bround(F.col("runtime_min") / 8.0, 1).alias("eighth"))


@query(r"""SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, '/film/([^/]+)/', 1) AS film, tmdb_url IS NOT NULL AS linked, coalesce(regexp_matches(lower(poster_url), 'placeholder|default|missing'), false) OR poster_url IS NULL AS no_poster, url LIKE '%/film/%' AS is_film FROM letterboxd_page""")
def q_url_parts(t):
    """Host, path, kinds of links, unusable pictures."""
    u = F.col("url")
    return t.letterboxd_page.select("page_id", F.parse_url(u, F.lit("HOST")).alias("host"), F.regexp_extract(u, "/film/([^/]+)/", 1).alias("film"), F.col("tmdb_url").isNotNull().alias("linked"),
                                   (F.coalesce(F.lower("poster_url").rlike("placeholder|default|missing"), F.lit(False)) | F.col("poster_url").isNull()).alias("no_poster"), u.like("%/film/%").alias("is_film"))


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST(CASE WHEN dayofweek(o_orderdate) = 6 THEN 1 ELSE 6 - dayofweek(o_orderdate) END AS INT) AS next_one,
CAST(o_orderdate AS DATE) + CAST(CASE WHEN dayofweek(o_orderdate) = 6 THEN 7 ELSE 7 - dayofweek(o_orderdate) END AS INT) AS next_two FROM orders""")
def q_weekend_dates(t):
    """the first two weekend days strictly after a date."""
    days = F.filter(F.sequence(F.date_add(F.to_date("o_orderdate"), 1), F.date_add(F.to_date("o_orderdate"), 8)), lambda d: F.weekday(d) >= 5)
    return t.orders.select("o_orderkey", days[0].alias("next_one"), days[1].alias("next_two"))


@query("""SELECT event_id, strftime(timezone('America/Los_Angeles', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') AS local, CAST(hour(timezone('America/Los_Angeles', timezone('UTC', ts))) * 60 + minute(timezone('America/Los_Angeles', timezone('UTC', ts))) AS INT) AS minutes FROM events""")
def q_local_time(t):
    """UTC to local date, clock and minutes."""
    local = F.convert_timezone(F.lit("UTC"), F.lit("America/Los_Angeles"), F.col("ts"))
    return t.events.select("event_id", local.alias("l")).select("event_id", F.date_format("l", "yyyy-MM-dd HH:mm:ss").alias("local"), (F.hour("l") * 60 + F.minute("l")).alias("minutes"))


@query(r"""SELECT screening_id, regexp_matches(verified_at, '(Z|[+-]\d{2}:?\d{2})$') AS has_zone, CASE WHEN regexp_matches(nightOf, '^\d{4}-\d{2}-\d{2}$') AND try_cast(nightOf AS DATE) <= DATE '2026-01-01' THEN try_cast(nightOf AS DATE) END AS safe_date FROM screenings""")
def q_timestamp_rules(t):
    """Texts with a zone; dates that exist and are not in the future of a given day."""
    d = F.col("nightOf").try_cast("date")
    return t.screenings.select("screening_id", F.col("verified_at").rlike(r"(Z|[+-]\d{2}:?\d{2})$").alias("has_zone"), F.when(F.col("nightOf").rlike(r"^\d{4}-\d{2}-\d{2}$") & (d <= F.lit("2026-01-01").cast("date")), d).alias("safe_date"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_quantity BETWEEN 1 AND 1000 THEN CAST(round_even(CASE l_linestatus WHEN 'F' THEN l_quantity * 60 ELSE l_quantity / 4 END, 0) AS BIGINT) END AS minutes FROM lineitem""")
def q_unit_convert(t):
    """Units, ranges, half-even rounding."""
    v = F.when(F.col("l_linestatus") == "F", F.col("l_quantity") * 60).otherwise(F.col("l_quantity") / 4)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_quantity").between(1, 1000), F.bround(v, 0).cast("bigint")).alias("minutes"))


@query(r"""SELECT event_id, CAST(regexp_extract(props, '"k": (\d+)', 1) AS INT) AS k FROM events""")
def q_json_props(t):
    """typed value of a JSON text."""
    return t.events.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query(r"""SELECT doc_id, len(l) AS lines, array_to_string(list_filter(l, lambda x: NOT regexp_matches(x, '^(Order|Ticket|Barcode)')), chr(10)) AS kept FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)""")
def q_noise_lines(t):
    """Lines of noise dropped, the others joined again."""
    lines = F.split("text", "\n")
    return t.documents.where("text is not null").select("doc_id", F.size(lines).cast("bigint").alias("lines"), F.array_join(F.filter(lines, lambda x: ~x.rlike("^(Order|Ticket|Barcode)")), "\n").alias("kept"))


@query(r"""WITH f AS (SELECT doc_id, trim(string_split(text, chr(10))[1]) AS line FROM documents WHERE text IS NOT NULL)
SELECT doc_id, length(line) BETWEEN 2 AND 160 AND NOT regexp_matches(lower(line), '^\d{1,2}:\d{2}') AND NOT regexp_matches(lower(line), '(refund|barcode|confirmation)') AND regexp_matches(line, '[A-Za-z]') AS title_like,
length(line) <= 90 AND len(string_split(line, ' ')) <= 10 AND regexp_matches(lower(line), '(dubbed|laser|caption|subtitled)') AS label_like,
regexp_matches(lower(text), '(access denied|are you a human|queue|captcha)') AS blocked FROM f JOIN documents USING (doc_id)""")
def q_title_like(t):
    """Text that may be a title, a label, a page that blocks."""
    f = t.documents.where("text is not null").select("doc_id", "text", F.trim(F.split("text", "\n")[0]).alias("line"))
    low = F.lower("line")
    title = F.length("line").between(2, 160) & ~low.rlike(r"^\d{1,2}:\d{2}") & ~low.rlike("(refund|barcode|confirmation)") & F.col("line").rlike("[A-Za-z]")
    label = (F.length("line") <= 90) & (F.size(F.split("line", " ")) <= 10) & low.rlike("(dubbed|laser|caption|subtitled)")
    return f.select("doc_id", title.alias("title_like"), label.alias("label_like"), F.lower("text").rlike("(access denied|are you a human|queue|captcha)").alias("blocked"))


RULES = [("kids", "sing-?along|cartoon|lullaby"), ("music", "score|ensemble|orchestra|mandolin"), ("mystery", "detective|murder|mystery"), ("sea", "lighthouse|harbor|sailor|ferryman")]


@query("""WITH r(pos, tag, rx) AS (VALUES """ + ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(RULES)) + """),
h AS (SELECT doc_id, pos, tag FROM documents JOIN r ON regexp_matches(lower(text), rx)), g AS (SELECT doc_id, string_agg(tag, '|' ORDER BY pos) AS tags, count(*) AS n FROM h GROUP BY 1)
SELECT d.doc_id, coalesce(tags, 'General') AS tags, coalesce(n, 0) AS n_reasons FROM documents d LEFT JOIN g USING (doc_id)""")
def q_multilabel_tags(t):
    """A table of rules against texts; ordered tags, a default where none applies. One pass, no join."""
    hits = F.filter(F.array(*[F.when(F.lower("text").rlike(rx), F.lit(tag)) for tag, rx in RULES]), lambda x: x.isNotNull())
    return t.documents.select("doc_id", hits.alias("h")).select("doc_id", F.when(F.size("h") > 0, F.array_join("h", "|")).otherwise("General").alias("tags"), F.size("h").cast("bigint").alias("n_reasons"))


@query("""WITH a AS (SELECT doc_id, source, CASE WHEN regexp_matches(lower(text), 'detective|murder') THEN 'mystery' END AS tag FROM documents),
b AS (SELECT source, max(tag) AS tag FROM a GROUP BY 1) SELECT a.doc_id, coalesce(a.tag, b.tag, 'General') AS tag, a.tag IS NULL AND b.tag IS NOT NULL AS second_pass FROM a LEFT JOIN b ON a.source = b.source""")
def q_two_pass_enrich(t):
    """Context is asked only where the first pass found nothing."""
    a = t.documents.select("doc_id", "source", F.when(F.lower("text").rlike("detective|murder"), "mystery").alias("tag"))
    b = a.groupBy("source").agg(F.max("tag").alias("other"))
    return a.join(b, "source", "left").select("doc_id", F.coalesce("tag", "other", F.lit("General")).alias("tag"), (F.col("tag").isNull() & F.col("other").isNotNull()).alias("second_pass"))


@query(r"""WITH p AS (SELECT title_row, display_title AS d, regexp_replace(display_title, '^(NEW! |Staff Pick: |Kids Matinee - )', '') AS s FROM title_info WHERE display_title IS NOT NULL),
a AS (SELECT title_row, d, regexp_replace(s, ' ?[-–:]? ?(\[Subtitled\]|\(Dubbed\)|Open Caption|Sing-Along|Fan Event|Opening Night|Encore|4K Remaster|in 70mm|with Live Q&A|Early Access( with Cast Q&A)?|Sensory Friendly Screening)$', '') AS s FROM p),
b AS (SELECT title_row, d, regexp_replace(s, ' ?:? ?\(?(\d+)(?:st|nd|rd|th) Anniversary\)?$', '') AS s, regexp_extract(s, '(\d+)(?:st|nd|rd|th) Anniversary\)?$', 1) AS n FROM a)
SELECT title_row, trim(s, ' ') AS canonical, try_cast(nullif(n, '') AS INT) AS anniversary, try_cast(nullif(regexp_extract(d, '\((\d{4}) Event\)', 1), '') AS INT) AS event_year, try_cast(nullif(regexp_extract(s, '\((\d{4})\)$', 1), '') AS INT) AS explicit_year,
CASE WHEN 2026 - try_cast(nullif(n, '') AS INT) BETWEEN 1888 AND 2026 THEN 2026 - try_cast(nullif(n, '') AS INT) END AS inferred FROM b""")
def q_suffix_peel(t):
    """Wording peeled from a title in stages of its own, once; q_title_analysis peels to a fixpoint."""
    suffix = r" ?[-–:]? ?(\[Subtitled\]|\(Dubbed\)|Open Caption|Sing-Along|Fan Event|Opening Night|Encore|4K Remaster|in 70mm|with Live Q&A|Early Access( with Cast Q&A)?|Sensory Friendly Screening)$"
    d = t.title_info.where("display_title is not null").select("title_row", F.col("display_title").alias("d"))
    a = d.withColumn("s", F.regexp_replace(F.regexp_replace("d", r"^(NEW! |Staff Pick: |Kids Matinee - )", ""), suffix, ""))
    n = F.regexp_extract("s", r"(\d+)(?:st|nd|rd|th) Anniversary\)?$", 1).try_cast("int")
    b = a.select("title_row", "d", F.regexp_replace("s", r" ?:? ?\(?(\d+)(?:st|nd|rd|th) Anniversary\)?$", "").alias("s"), n.alias("anniversary"))
    year = lambda c, rx: F.regexp_extract(c, rx, 1).try_cast("int")
    inferred = F.lit(2026) - F.col("anniversary")
    return b.select("title_row", F.trim("s").alias("canonical"), "anniversary", year("d", r"\((\d{4}) Event\)").alias("event_year"), year("s", r"\((\d{4})\)$").alias("explicit_year"), F.when(inferred.between(1888, 2026), inferred).alias("inferred"))


@query(r"""WITH f AS (SELECT film_id, title FROM films), v AS (SELECT film_id, unnest([title, replace(title, '''', '’'), replace(title, '&', 'and'), regexp_replace(title, ' and ', ' & ', 'g'), title || ' (film)', title || ' (2026)', title || ' (2025)']) AS variant FROM f) SELECT DISTINCT film_id, variant FROM v""")
def q_candidate_variants(t):
    """Spellings of a title, distinct; q_title_variants has all of them."""
    c = F.col("title")
    v = F.array_distinct(F.array(c, F.replace(c, F.lit("'"), F.lit("’")), F.replace(c, F.lit("&"), F.lit("and")), F.replace(c, F.lit(" and "), F.lit(" & ")), F.concat(c, F.lit(" (film)")), F.concat(c, F.lit(" (2026)")), F.concat(c, F.lit(" (2025)"))))
    return t.films.select("film_id", F.explode(v).alias("variant"))


@query("""WITH b AS (SELECT venue_row, [name, short, website] AS cells FROM venues), c AS (SELECT venue_row, i, cells[i] AS cell, 10 * (CASE WHEN lower(cells[i]) LIKE '%orbis%' THEN 1 ELSE 0 END) + 5 * len(regexp_extract_all(cells[i], '[0-9]+')) AS score FROM b, unnest([1, 2, 3]) AS u(i) WHERE cells[i] IS NOT NULL)
SELECT venue_row, arg_max(cell, (score, -i)) AS best, CAST(arg_max(i, (score, -i)) - 1 AS INT) AS place FROM c GROUP BY 1""")
def q_best_cell(t):
    """The cell with the best score, the first wins a tie."""
    cells = F.transform(F.array("name", "short", "website"), lambda x, i: F.struct((F.when(F.lower(x).contains("orbis"), 10).otherwise(0) + 5 * F.size(F.regexp_extract_all(x, F.lit("[0-9]+"), F.lit(0)))).alias("score"), (-i).alias("i"), x.alias("cell")))
    best = F.array_max(F.filter(cells, lambda x: x["cell"].isNotNull()))
    return t.venues.select("venue_row", best.alias("b")).where("b is not null").select("venue_row", "b.cell", (-F.col("b.i")).alias("place")).withColumnRenamed("cell", "best")


@query("""SELECT c_custkey AS customer_id, c_name AS name, round(c_acctbal, 2) AS balance FROM customer""")
def q_table_reshape(t):
    """Header names normalised, a fixed projection, what is missing is ignored."""
    names = {"custkey": "customer_id", "name": "name", "acctbal": "balance", "phone": "phone"}
    df = t.customer
    found = {c.lower().split("_", 1)[-1]: c for c in df.columns}
    out = df.select(*[F.col(found[k]).alias(v) for k, v in names.items() if k in found])
    return out.withColumn("balance", F.round("balance", 2))
