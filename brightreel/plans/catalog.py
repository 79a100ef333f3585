"""The core's registered queries: name -> callable, and the ANSI-SQL twins."""

from __future__ import annotations

from brightreel.operators import instants
from brightreel.plans import base, flows, logs, matching, merging, naming, records, texts  # noqa: F401

base.QUERIES["p5_found"] = instants.p5_found
base.SQL["p5_found"] = instants.P5_SQL
QUERIES = base.QUERIES
SQL = base.SQL
FLAGSHIP = "q_movie_summary"
