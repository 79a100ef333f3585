import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def test_sql_only_for_known_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@here
def test_entry(spark):
    assert entry.entry(spark).count() > 0


@here
@pytest.mark.parametrize("name", ["q_source_rank_merge", "q_asof_prev", "q_unambiguous_match", "q_stream_breaker", "q_blob_parse", "p5_found"])
def test_runs(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0
