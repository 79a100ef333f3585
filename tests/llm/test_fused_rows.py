from datetime import date

from brightreel.llm import fusion

COLS = "ingest_seq bigint, movie_title string, theatre string, show_date date, show_time string, format_label string, runtime_min int, a_list_excluded boolean, showtime_id string, source_rank int"
D = date(2024, 1, 5)


def test_every_row_reaches_a_showing(spark):
    data = [
        (1, "A", "T", D, "1", "3D", 95, None, "s1", 1), (2, "a", "t", D, "1", "3D", 95, True, None, None), (3, "A", "T", D, "1", None, None, None, None, 7),  # one showing, also without rank and of a further one
        (4, "B", "T", D, "1", None, 90, None, "s2", 0), (5, "B", "T", D, "1", "3D", None, None, "s3", 0), (6, "B", "T", D, "1", "Laser", 88, None, None, 0), (7, "B", "T", D, "1", "IMAX", None, False, None, None),  # two ids: four showings
        (8, "E", None, D, "1", "3D", 90, True, None, 2), (9, "E", None, D, "1", "n/a", 90, None, None, 9),  # no id, no key: apart
        (10, "F", "T", D, "2", "Laser", 91, None, "s4", None), (11, "G", "T", D, "2", "3D", 92, None, "s5", 5), (12, "G", "T", D, "2", "3D", 92, None, "s5", 6),  # only without rank, only further ranks
        (13, "H", "T", D, "3", None, None, None, None, None),
    ]
    df = spark.createDataFrame(data, COLS)
    got = {r.first_seq: (r.n, r.format_value, r.runtime_value, r.excluded_value) for r in fusion.best_by_fusion(df).collect()}
    assert got == {
        1: (3, "3D", "95", "true"), 4: (1, None, "90", None), 5: (1, "3D", None, None), 6: (1, "Laser", "88", None), 7: (1, "IMAX", None, "false"),
        8: (1, "3D", "90", "true"), 9: (1, None, "90", None), 10: (1, "Laser", "91", None), 11: (2, "3D", "92", None), 13: (1, None, None, None),
    }
    assert set(got) == {r.first_seq for r in fusion.best_by_trust(df).collect()}
    assert fusion.best_by_fusion(df.limit(0)).count() == 0
