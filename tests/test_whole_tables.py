import types
from collections import Counter
from datetime import date

from brightreel.plans import flows

D = date(2024, 1, 5)
COLS = "ingest_seq bigint, movie_title string, theatre string, show_date date, show_time string, showtime_id string"


def tables(spark, rows):
    return types.SimpleNamespace(showtime=spark.createDataFrame(rows, COLS))


def test_programme_of_every_notation(spark):
    times = ["7:00 pm", "7.30 PM", "19h30", " 8:00pm", "Friday, 7 pm", "a,b", ", ", "x\n# T9\n* 2024-01-05: 1:00 am", "\\c\\n\\b", "7:00 pm", " ", "* # "]
    rows = [(i, title, theatre, D, x, None) for i, (title, theatre, x) in enumerate((t, p, x) for t in ("A", "B, \\c") for p in ("T", "# U\n, V") for x in times)]
    lacking = [(90, None, "T", D, "7:00 pm", None), (91, "A", None, D, "7:00 pm", None), (92, "A", "T", None, "7:00 pm", None), (93, "A", "T", D, None, None), (94, "A", "T", D, " ", None)]
    got = flows.q_blob_parse_all(tables(spark, rows + lacking)).collect()
    assert Counter(map(tuple, got)) == Counter(r[1:5] for r in rows)


def test_pages_of_every_title(spark):
    titles = ["Film", "Tom's \"Best\" <Day> & Night: 2", "Café, the End", "&amp; &quot;", "\t 9 Lives ", "夜の港"]
    rows = [(i, t, "T", D, "7:00 pm", f"s{i}") for i, t in enumerate(titles)]
    rows += [(90, "X", "T", D, "07:15 PM (3D)", "a-b \"&"), (91, "X", "T", D, "19h30", "s91"), (92, "X", "T", D, None, "s92"), (93, None, "T", D, "7:00 pm", "s93"), (94, "X", "T", D, "7:00 pm", None), (95, "X", "T", D, "7:00 pm", "")]
    got = sorted(map(tuple, flows.q_page_showings_all(tables(spark, rows)).collect()))
    assert got == [(i, "rendered", f"s{i}", t.strip(), "7:00 pm") for i, t in enumerate(titles)] + [(90, "rendered", "a-b \"&", "X", "07:15 PM")]
